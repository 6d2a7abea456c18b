"""WARC archives: written by Spark's text sink, read back and reassembled from segments.

A record's block may be cut into segments: the first is the record itself, the others are
``continuation`` records naming its id as their origin. Reading groups them by that id, orders
them by segment number, verifies the total length and decodes the chunked transfer framing.
The blank line that ends a record is the line separator of the text sink and source, so files
are written and read by Spark alone, from any file system.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from placepulse.llm.common import saved
from placepulse.operators.joins import lookup_join

END = b"\r\n\r\n"
SEGMENT_BYTES = 64 * 1024
CHUNK_BYTES = 8 * 1024
DATE = "2024-01-01T00:00:00Z"

#: Header fields of a record that are kept, and the columns they fill. The last three are
#: extension fields, which the format allows.
FIELDS = {
    "warc-type": "record_type",
    "warc-record-id": "record_id",
    "warc-target-uri": "url",
    "warc-payload-digest": "digest",
    "warc-segment-origin-id": "origin_id",
    "warc-segment-number": "segment",
    "warc-segment-total-length": "total_length",
    "warc-page-id": "page_id",
    "warc-refers-to-page-id": "refers_to",
    "warc-payload-length": "payload_length",
}
NUMBERS = ("segment", "total_length", "page_id", "refers_to", "payload_length")
_TYPES = ", ".join(f"{c} {'BIGINT' if c in NUMBERS else 'STRING'}" for c in FIELDS.values())
SEGMENTS = f"{_TYPES}, block BINARY, whole BOOLEAN"
RECORDS = (
    "page_id BIGINT, url STRING, record_type STRING, refers_to BIGINT, segments INT, complete BOOLEAN, "
    "payload_bytes BIGINT, payload_digest STRING, payload BINARY"
)


def base32_sha1(payload: Column) -> Column:
    """SHA-1 in RFC 4648 base 32: 20 bits, five hex digits, make four of its digits."""
    fifths = F.transform(
        F.sequence(F.lit(0), F.lit(7)),
        lambda j: F.lpad(F.conv(F.substring(F.sha1(payload), F.lit(1) + j * 5, F.lit(5)), 16, 32), 4, "0"),
    )
    return F.translate(
        F.array_join(fifths, ""), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    )


def _pieces(data: str, size: int) -> str:
    return f"sequence(0, CAST((octet_length({data}) - 1) DIV {size} AS INT))"


def write_warc(
    pages: DataFrame,
    path: str,
    id_column: str = "page_id",
    url_column: str = "url",
    text_column: str = "html",
    segment_bytes: int = SEGMENT_BYTES,
    chunk_bytes: int = CHUNK_BYTES,
    min_revisit_bytes: int = 0,
) -> None:
    """Write one record per row, as gzipped archives below ``path``.

    Of rows with equal payloads of at least ``min_revisit_bytes`` the one with the smallest id is
    a response and the others are revisits of it; all smaller payloads are responses. A null text
    is an empty payload. Rows that repeat the smallest id, and rows without an id in a group that
    has none, are all responses. Null URLs leave their field out; control characters and blanks in
    URLs are percent-encoded. An empty table writes an empty archive; other columns are not read.
    """
    size = F.octet_length("_payload")
    base = pages.select(
        F.col(id_column).cast("bigint").alias("_id"),
        F.col(url_column).alias("_url"),
        F.coalesce(F.col(text_column), F.lit("")).cast("binary").alias("_payload"),
    ).withColumn("_digest", base32_sha1(F.col("_payload")))
    # Only ids and digests are grouped. The payloads move only if the list of repeated digests is too large to
    # broadcast, and then those of one digest are spread.
    repeated = (
        base.where(size >= min_revisit_bytes)
        .groupBy("_digest")
        .agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
        .where("_n > 1 AND _first IS NOT NULL")
        .drop("_n")
    )
    decided = lookup_join(base, saved(repeated, "repeated"), ["_digest"], "left").withColumn(
        "_revisit",
        F.col("_first").isNotNull() & ~F.col("_first").eqNullSafe(F.col("_id")) & (size >= min_revisit_bytes),
    )
    chunk = (
        f"concat(lower(hex(least({chunk_bytes}, octet_length(_payload) - c * {chunk_bytes}))), '\\r\\n', "
        f"CAST(substring(_payload, c * {chunk_bytes} + 1, {chunk_bytes}) AS STRING), '\\r\\n')"
    )
    framed = (
        f"concat(CASE WHEN octet_length(_payload) > 0 THEN array_join(transform("
        f"{_pieces('_payload', chunk_bytes)}, c -> {chunk}), '') ELSE '' END, '0\\r\\n\\r\\n')"
    )
    head = "'HTTP/1.1 200 OK\\r\\nContent-Type: text/html; charset=utf-8\\r\\nTransfer-Encoding: chunked\\r\\n\\r\\n'"
    blocks = decided.selectExpr(
        "_id", "_url", "_digest", "_first", "_revisit", "CAST(octet_length(_payload) AS BIGINT) AS _bytes",
        "concat('<urn:uuid:', regexp_replace(md5(concat_ws('/', _id, _digest, monotonically_increasing_id())), "
        "'(.{8})(.{4})(.{4})(.{4})(.{12})', '$1-$2-$3-$4-$5'), '>') AS _record",
        f"CAST(concat({head}, CASE WHEN _revisit THEN '' ELSE {framed} END) AS BINARY) AS _block",
    )
    cut = blocks.selectExpr("*", f"explode({_pieces('_block', segment_bytes)}) AS _k").selectExpr(
        "*",
        f"substring(_block, _k * {segment_bytes} + 1, {segment_bytes}) AS _part",
        f"octet_length(_block) > {segment_bytes} AS _cut",
        f"octet_length(_block) <= (_k + 1) * {segment_bytes} AS _last",
    )

    def field(name: str, value: str, when: str = "true") -> str:
        return f"CASE WHEN {when} THEN concat('{name}: ', {value}, '\\r\\n') END"

    url = "regexp_replace(regexp_replace(_url, '\\\\r|\\\\n', '%0A'), '[\\\\x00-\\\\x20\\\\x7f]', '%20')"
    first = "_k = 0"
    fields = [
        field("WARC-Type", "CASE WHEN _k > 0 THEN 'continuation' WHEN _revisit THEN 'revisit' ELSE 'response' END"),
        field("WARC-Record-ID", "CASE WHEN _k = 0 THEN _record ELSE concat(left(_record, octet_length(_record) - 1), '-', _k, '>') END"),
        field("WARC-Date", f"'{DATE}'"),
        field("WARC-Target-URI", url, f"{first} AND _url IS NOT NULL"),
        field("WARC-Payload-Digest", "concat('sha1:', _digest)", first),
        field("WARC-Page-ID", "_id", f"{first} AND _id IS NOT NULL"),
        field("WARC-Payload-Length", "_bytes", first),
        field("WARC-Profile", "'http://netpreserve.org/warc/1.1/revisit/identical-payload-digest'", f"{first} AND _revisit"),
        field("WARC-Refers-To-Page-ID", "_first", f"{first} AND _revisit"),
        field("WARC-Segment-Origin-ID", "_record", "_k > 0"),
        field("WARC-Segment-Number", "_k + 1", "_cut"),
        field("WARC-Segment-Total-Length", "octet_length(_block)", "_cut AND _last"),
        field("Content-Type", "'application/http; msgtype=response'", first),
    ]
    value = (
        f"concat('WARC/1.1\\r\\n', concat_ws('', {', '.join(fields)}), "
        "'Content-Length: ', octet_length(_part), '\\r\\n\\r\\n', CAST(_part AS STRING)) AS value"
    )
    cut.selectExpr(value).write.option("lineSep", END.decode()).option("compression", "gzip").text(path)


def records_of(stream: Iterator[tuple[object, bytes]]) -> Iterator[tuple[dict, bytes, bool]]:
    """Header, block and wholeness of every record in a stream of (file, text up to a blank line).

    A block may hold blank lines: pieces are put together until its stated length is reached. A
    block that ends before that, with its file, is given as not whole.
    """
    file, header, held, have, need = None, None, [], 0, 0
    for name, piece in stream:
        if name != file:
            if header is not None:
                yield header, b"".join(held), False
            file, header, held, have = name, None, [], 0
        held += (piece, END)
        have += len(piece) + len(END)
        while True:
            if header is None:
                lines, found, rest = b"".join(held).lstrip(b"\r\n").partition(END)
                if not found:
                    held, have = [lines], len(lines)
                    break
                held, have = [rest], len(rest)
                if lines.startswith(b"WARC/"):
                    header = header_of(lines)
                    length = header.get("content-length", "")
                    need = int(length) if length.isdigit() else 0
            elif have >= need + len(END):
                data = b"".join(held)
                yield header, data[:need], True
                header, held = None, [data[need + len(END) :]]
                have = len(held[0])
            else:
                break
    if header is not None:
        yield header, b"".join(held)[:need], False


def header_of(lines: bytes) -> dict:
    """Named fields, names in lower case."""
    fields = (line.partition(b":") for line in lines.split(b"\r\n")[1:])
    return {k.strip().lower().decode("latin-1"): v.strip().decode("utf-8", "replace") for k, _, v in fields}


def payload_of(block: bytes) -> tuple[bytes | None, bool]:
    """The payload of an HTTP message and whether its framing is sound."""
    head, found, body = block.partition(END)
    if not found:
        return None, False
    framing = [x.split(b":", 1)[1] for x in head.lower().split(b"\r\n")[1:] if x.startswith(b"transfer-encoding:")]
    if not any(b"chunked" in x for x in framing):
        return body, True
    parts, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        try:
            size = int(body[at:end].split(b";")[0], 16) if end >= 0 else -1
        except ValueError:
            size = -1
        if size < 0:
            return None, False
        at = end + 2
        if size == 0:
            return b"".join(parts), True
        if body[at + size : at + size + 2] != b"\r\n":
            return None, False
        parts.append(body[at : at + size])
        at += size + 2


def _digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _record(header: dict, block: bytes, segments: int, whole: bool) -> dict:
    """A finished record; the length and digest of a revisit are those it states."""
    revisit = header["record_type"] == "revisit"
    payload, sound = (None, True) if revisit else payload_of(block)
    stated = (header["digest"] or "").removeprefix("sha1:") or None
    digest = stated if revisit else _digest(payload) if payload is not None else None
    whole = whole and sound and (stated is None or digest == stated)
    return {
        "page_id": header["page_id"],
        "url": header["url"],
        "record_type": header["record_type"],
        "refers_to": header["refers_to"],
        "segments": segments,
        "complete": whole,
        "payload_bytes": header["payload_length"] if revisit else None if payload is None else len(payload),
        "payload_digest": digest,
        "payload": payload if whole else None,
    }


def _number(value: str | None) -> int | None:
    return int(value) if value and value.lstrip("-").isdigit() else None


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, bytes, bool]]:
    def stream():
        for batch in batches:
            yield from zip(batch.column("_file").to_pylist(), batch.column("_piece").to_pylist(), strict=True)

    for raw, block, whole in records_of(stream()):
        header = {to: raw.get(name) for name, to in FIELDS.items()}
        header |= {c: _number(header[c]) for c in NUMBERS}
        yield header, block, whole


def _batches(rows: Iterator[dict], schema: pa.Schema, size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    held, weight = [], 0
    for row in rows:
        held.append(row)
        weight += 200 + len(row.get("block") or row.get("payload") or b"")
        if weight >= size:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, weight = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"BIGINT": pa.int64(), "INT": pa.int32(), "STRING": pa.string(), "BINARY": pa.binary(), "BOOLEAN": pa.bool_()}
    return pa.schema([(name, kinds[kind]) for name, kind in (x.split() for x in ddl.split(", "))])


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Archives as pieces between blank lines, each file's in order; gzipped files are never split."""
    text = spark.read.option("lineSep", END.decode()).text(path)
    return text.select(F.col("_metadata.file_path").alias("_file"), F.col("value").cast("binary").alias("_piece"))


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    """The records that are parts of a cut record, as they lie in the archives."""
    schema = _arrow(SEGMENTS)

    def parts(batches):
        rows = ({**h, "block": b, "whole": w} for h, b, w in _parsed(batches) if h["segment"] is not None)
        yield from _batches(rows, schema)

    return _lines(spark, path).mapInArrow(parts, SEGMENTS)


def reassemble(segments: DataFrame) -> DataFrame:
    """Records put together from their segments, in the columns of ``read_warc``.

    A record is ``complete`` if its segments are numbered 1 to n without a gap or repeat, none is
    truncated, the last states the total length and that is met, and the payload has its stated
    digest. Otherwise its payload is null. One record meets in one task, as decoding it needs.
    """
    part = F.struct("segment", "total_length", "whole", "block")
    whole = [F.max(c).alias(c) for c in ("url", "digest", "page_id", "refers_to", "payload_length")]
    kind = F.max(F.when(F.col("record_type") != "continuation", F.col("record_type"))).alias("record_type")
    grouped = segments.groupBy(F.coalesce("origin_id", "record_id").alias("_origin")).agg(
        F.sort_array(F.collect_list(part)).alias("parts"), kind, *whole
    )
    schema = _arrow(RECORDS)

    def rows(batches):
        for batch in batches:
            for header in batch.to_pylist():
                parts = header.pop("parts")
                block = b"".join(p["block"] for p in parts)
                sound = [p["segment"] for p in parts] == list(range(1, len(parts) + 1))
                sound = sound and all(p["whole"] for p in parts) and parts[-1]["total_length"] == len(block)
                yield _record(header, block, len(parts), sound)

    return grouped.mapInArrow(lambda batches: _batches(rows(batches), schema), RECORDS)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Every response and revisit below ``path``, whole: one row per record, segments put together.

    Columns: ``page_id, url, record_type, refers_to, segments, complete, payload_bytes,
    payload_digest, payload``. A damaged or truncated record has ``complete`` false and a null
    payload. Only cut records are shuffled; the others are decoded where they are read.
    """
    schema = _arrow(RECORDS)

    def single(batches):
        found = (_record(h, b, 1, w) for h, b, w in _parsed(batches) if h["segment"] is None)
        yield from _batches((r for r in found if r["record_type"] in ("response", "revisit")), schema)

    return _lines(spark, path).mapInArrow(single, RECORDS).unionByName(reassemble(read_segments(spark, path)))
