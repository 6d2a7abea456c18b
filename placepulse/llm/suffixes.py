"""Removal of long repeated strings with a logarithmic family of suffix arrays.

Suffixes are indexed where they start at an anchor: the position whose leading bytes have the
least hash among the ``span`` positions that a repeated string can align to. Anchors depend on
content alone, so two equal strings of ``min_bytes`` share an anchor at the same distance from
their start. A batch's suffix array holds its anchors' suffixes in the order of fingerprints of
their leading bytes, which brings equal ones together. Each new batch is merge-scanned against
the levels there are, and levels of equal size merge into one of twice the size.

The scan finds the anchors whose surroundings occur elsewhere. An anchor stands for the strings
around it by their distance. If all bytes that these cover repeat as a whole, all are repeated; if
the bytes they have in common do not, none is. Otherwise the distances are split into blocks and
the same is asked of each, down to single strings. Only fingerprints are shuffled and counted, so
a passage that stands in a third of all documents is a count and never a group.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placepulse.llm.common import saved, small_side
from placepulse.llm.shingles import mix, powers

MIN_BYTES = 400
BATCHES = 4
#: Bytes of a text that are indexed at once.
PIECE = 1 << 20
_SECOND = np.uint64(0xD6E8FEB86659FD93)


class Fingerprints:
    """Two independent 64-bit fingerprints of any substring of a byte array."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        self.up, self.down = powers(n + 1)
        value = data.astype(np.uint64) + np.uint64(1)
        self.sums = [self._sums(value, n), self._sums(mix(value * _SECOND), n)]

    def _sums(self, value: np.ndarray, n: int) -> np.ndarray:
        return np.concatenate([np.zeros(1, np.uint64), np.cumsum(value * self.up[:n])])

    def of(self, which: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        sums = self.sums[which]
        return mix((sums[end] - sums[start]) * self.down[start] + (end - start).astype(np.uint64))


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` values in a row."""
    n = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def split(min_bytes: int) -> tuple[int, int]:
    """Distances an anchor serves, a square, and the width of the blocks they are split into."""
    block = max(1, isqrt(min_bytes * 16 // 25))
    return block * block, block


def anchors(prints: Fingerprints, size: int, min_bytes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of all strings of ``min_bytes``, with the least and greatest distance each serves."""
    span, _ = split(min_bytes)
    lead = min_bytes - span + 1
    at = np.arange(size - lead + 1)
    low = np.uint64((1 << 24) - 1)
    order = (prints.of(0, at, at + lead) & ~low) | at.astype(np.uint64)
    chosen = (sliding_minimum(order, span) & low).astype(np.int64)
    first = np.flatnonzero(np.diff(chosen, prepend=-1))
    last = np.append(first[1:], len(chosen)) - 1
    anchor = chosen[first]
    return anchor, anchor - last, anchor - first


def blocks_of(
    prints: Fingerprints, size: int, min_bytes: int, anchor: np.ndarray, near: np.ndarray, far: np.ndarray, width: int
) -> tuple[np.ndarray, ...]:
    """Fingerprints of the blocks of ``width`` distances that meet ``near..far``.

    ``core`` is of the bytes that a block's strings have in common, ``full`` of all they cover, 0
    where that leaves the text. The distance takes part, so that a place never matches itself.
    """
    first, last = near // width, far // width
    n = last - first + 1
    row = np.repeat(np.arange(len(anchor)), n)
    block = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + first[row]
    start, end = block * width, block * width + width - 1
    place = anchor[row]
    salt = mix((start + 1).astype(np.uint64))
    core = prints.of(0, place - start, place - end + min_bytes) ^ salt
    inside = (place - end >= 0) & (place - start + min_bytes <= size)
    left, right = np.where(inside, place - end, 0), np.where(inside, place - start + min_bytes, 0)
    full = np.where(inside, (prints.of(1, left, right) ^ salt) | np.uint64(1), np.uint64(0))
    return core, full, place, np.maximum(near[row], start), np.minimum(far[row], end)


_BLOCK = pa.schema([("core", pa.int64()), ("full", pa.int64()), ("_row", pa.int64()),
                    ("place", pa.int64()), ("near", pa.int32()), ("far", pa.int32())])
_BLOCK_DDL = "core BIGINT, full BIGINT, _row BIGINT, place BIGINT, near INT, far INT"


def _pieces(size: int, min_bytes: int, piece: int) -> Iterator[tuple[int, int, int, int]]:
    """Starts ``a..b`` of strings served at once, and the bytes ``c..d`` they and their blocks need."""
    for a in range(0, size - min_bytes + 1, piece):
        b = min(a + piece, size - min_bytes + 1)
        yield a, b, max(0, a - min_bytes), min(size, b + 3 * min_bytes)


def _emit(batch_rows: list[tuple[int, tuple[np.ndarray, ...]]]) -> pa.RecordBatch:
    row = np.concatenate([np.full(len(found[0]), r) for r, found in batch_rows])
    core, full, place, near, far = (np.concatenate([found[k] for _, found in batch_rows]) for k in range(5))
    values = [core.view(np.int64), full.view(np.int64), row, place, near.astype(np.int32), far.astype(np.int32)]
    return pa.RecordBatch.from_arrays([pa.array(v) for v in values], schema=_BLOCK)


def _batched(found: Iterator[tuple[int, tuple[np.ndarray, ...]]]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for one in found:
        held.append(one)
        size += len(one[1][0])
        if size >= 100_000:
            yield _emit(held)
            held, size = [], 0
    if size:
        yield _emit(held)


def _index(min_bytes: int, piece: int):
    span, _ = split(min_bytes)

    def found(batches):
        for batch in batches:
            for row, text in zip(batch.column("_row").to_pylist(), batch.column("_bytes"), strict=True):
                whole = np.frombuffer(text.as_py(), np.uint8)
                last = len(whole) - min_bytes + 1
                held = np.empty((3, 0), np.int64)
                for a, b, c, d in _pieces(len(whole), min_bytes, piece):
                    # Strings that start in a..b; their anchors see only these bytes.
                    own = Fingerprints(whole[a : b + min_bytes - 1])
                    anchor, near, far = anchors(own, b - a + min_bytes - 1, min_bytes)
                    here = np.stack([anchor + a, near, far])
                    if held.size and held[0, 0] == here[0, 0]:
                        # One anchor on both sides of a cut is one entry, or it would match itself.
                        here[2, 0] = held[2, 0]
                    else:
                        here = np.concatenate([held, here], axis=1)
                    if b < last:
                        here, held = here[:, :-1], here[:, -1:]
                    prints = own if (a, b + min_bytes - 1) == (c, d) else Fingerprints(whole[c:d])
                    # At a cut the bytes beyond it are there, so surroundings are the same everywhere.
                    core, full, place, low, high = blocks_of(prints, d - c, min_bytes, here[0] - c, here[1], here[2], span)
                    yield row, (core, full, place + c, low, high)

    return lambda batches: _batched(found(batches))


def _refine(min_bytes: int, width: int, size: int):
    def found(batches):
        for batch in batches:
            for row, text, asked in zip(*(batch.column(c) for c in ("_row", "_bytes", "_asked")), strict=True):
                whole = np.frombuffer(text.as_py(), np.uint8)
                place, near, far = (
                    np.array(asked.values.field(k).to_numpy(), np.int64) for k in ("place", "near", "far")
                )
                piece = place // size
                for k in np.unique(piece):
                    mine = piece == k
                    c, d = max(0, int(k) * size - 2 * min_bytes), min(len(whole), (int(k) + 1) * size + 2 * min_bytes)
                    prints = Fingerprints(whole[c:d])
                    core, full, at, low, high = blocks_of(
                        prints, d - c, min_bytes, place[mine] - c, near[mine], far[mine], width
                    )
                    yield row.as_py(), (core, full, at + c, low, high)

    return lambda batches: _batched(found(batches))


class SuffixLevels:
    """Suffix arrays of batches, at most one of each size 2**k, and the matches found so far."""

    def __init__(self):
        self.levels: list[tuple[int, DataFrame]] = []
        self.found: list[DataFrame] = []

    def add(self, batch: DataFrame) -> None:
        """Merge levels of equal size, scan the batch against every level, then make it one.

        A suffix in the array is the pair of its fingerprints with the times that it occurs.
        """
        array = batch.groupBy("core", "full").agg(F.count(F.lit(1)).alias("n"))
        array = saved(array.sortWithinPartitions("core", "full"), "array")
        while len(self.levels) > 1 and self.levels[-1][0] == self.levels[-2][0]:
            (size, one), (_, two) = self.levels.pop(), self.levels.pop()
            both = one.union(two).groupBy("core", "full").agg(F.sum("n").alias("n"))
            self.levels.append((size + 1, saved(both.sortWithinPartitions("core", "full"), "level")))
        twice = array.groupBy("core").agg(F.sum("n").alias("n")).where("n > 1")
        hits = [twice.select("core", F.lit(0).cast("bigint").alias("full")), array.where("n > 1 AND full <> 0").select("core", "full")]
        for _, level in self.levels:
            hits.append(array.join(level, "core", "left_semi").select("core", F.lit(0).cast("bigint").alias("full")))
            hits.append(array.where("full <> 0").join(level, ["core", "full"], "left_semi").select("core", "full"))
        matches = hits[0]
        for more in hits[1:]:
            matches = matches.union(more)
        self.found.append(saved(matches.distinct(), "matches"))
        self.levels.append((0, array))

    def matches(self) -> DataFrame:
        """``core, full`` of what occurs more than once; ``full`` is 0 where only the core is said to."""
        out = self.found[0]
        for more in self.found[1:]:
            out = out.union(more)
        return saved(out.distinct(), "matches")


def _counted(blocks: DataFrame) -> DataFrame:
    """As ``SuffixLevels.matches``, of one table."""
    kinds = blocks.groupBy("core", "full").agg(F.count(F.lit(1)).alias("n"))
    kinds = saved(kinds, "kinds")
    twice = kinds.groupBy("core").agg(F.sum("n").alias("n")).where("n > 1").select("core", F.lit(0).cast("bigint").alias("full"))
    return saved(twice.union(kinds.where("n > 1 AND full <> 0").select("core", "full")), "matches")


def _judged(blocks: DataFrame, matches: DataFrame) -> DataFrame:
    """Blocks whose core repeats, and whether all of their strings do (``whole``)."""
    open_ = blocks.join(matches.where("full = 0").select("core"), "core", "left_semi")
    whole = matches.where("full <> 0").withColumn("_whole", F.lit(True))
    return open_.join(whole, ["core", "full"], "left").select(
        "core", "full", "_row", "place", "near", "far", F.coalesce("_whole", F.lit(False)).alias("whole")
    )


def _asked(judged: DataFrame) -> DataFrame:
    """What to refine, by row: undecided blocks, and of decided ones with the same core one of each kind.

    The latter are already removed themselves, but an undecided block may repeat parts of them.
    """
    undecided = judged.where("NOT whole")
    cores = undecided.select("core").distinct()
    # One of each kind before the join: a passage that stands in very many texts is one row there.
    kinds = judged.where("whole").groupBy("core", "full").agg(F.min(F.struct("_row", "place", "near", "far")).alias("_one"))
    one = kinds.join(cores, "core", "left_semi").select("_one.*")
    asked = undecided.select("_row", "place", "near", "far").union(one)
    return asked.groupBy("_row").agg(F.collect_set(F.struct("place", "near", "far")).alias("_asked"))


def _removal():
    schema = pa.schema([
        ("_row", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()),
        ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
    ])

    def remove(batches):
        for batch in batches:
            out = []
            for row, text, cuts in zip(*(batch.column(c) for c in ("_row", "_bytes", "_cuts")), strict=True):
                whole = np.frombuffer(text.as_py(), np.uint8)
                marks = np.zeros(len(whole) + 1, np.int64)
                np.add.at(marks, np.array(cuts.values.field("start").to_numpy()), 1)
                np.add.at(marks, np.array(cuts.values.field("end").to_numpy()), -1)
                gone = np.cumsum(marks[:-1]) > 0
                edge = np.diff(gone.astype(np.int8), prepend=0, append=0)
                spans = [{"start": s, "end": e} for s, e in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(), strict=True)]
                out.append({"_row": row.as_py(), "n_removed": int(gone.sum()), "n_spans": len(spans),
                            "kept_sha256": hashlib.sha256(whole[~gone].tobytes()).hexdigest(), "spans": spans})
            yield pa.RecordBatch.from_pylist(out, schema)

    return remove


def repeated_spans(
    docs: DataFrame,
    min_bytes: int = MIN_BYTES,
    batches: int = BATCHES,
    id_column: str = "doc_id",
    text_column: str = "text",
    piece: int = PIECE,
) -> DataFrame:
    """One row per row: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans``.

    Removed is every byte covered by a string of ``min_bytes`` bytes that also starts anywhere
    else, in the same text or another; strings are judged on the input and may overlap. ``spans``
    are the maximal removed runs of bytes. Null texts count as empty; texts shorter than
    ``min_bytes`` lose nothing. Rows alike in id and text repeat each other. Null ids are allowed.
    An empty table gives an empty result; other columns are not read. Strings are equal here if
    two 64-bit fingerprints agree. A text is indexed ``piece`` bytes at a time, which changes no result.
    """
    data = F.coalesce(F.col(text_column), F.lit("")).cast("binary")
    rows = docs.select(F.col(id_column).alias("doc_id"), F.xxhash64(id_column, text_column).alias("_row"), data.alias("_bytes"))
    long = rows.where(F.octet_length("_bytes") >= min_bytes).select("_row", "_bytes")
    entries = saved(long.mapInArrow(_index(min_bytes, piece), _BLOCK_DDL), "entries")
    index = SuffixLevels()
    for batch in range(batches):
        index.add(entries.where(F.pmod(F.xxhash64("_row"), F.lit(batches)) == batch).select("core", "full"))
    judged = saved(_judged(entries, index.matches()), "judged")
    _, block = split(min_bytes)
    # Rows alike in id and text repeat each other as a whole; their text is needed once.
    twice = long.groupBy("_row").agg(F.count(F.lit(1)).alias("n"), F.max(F.octet_length("_bytes")).alias("size"))
    twice = saved(twice.where("n > 1"), "alike")
    affected = judged.select("_row").union(twice.select("_row")).distinct()
    texts = saved(long.join(small_side(saved(affected, "affected")), "_row", "left_semi").dropDuplicates(["_row"]), "affected_texts")
    done = [judged.where("whole")]
    for width in sorted({block, 1}, reverse=True):
        blocks = saved(texts.join(_asked(judged), "_row").mapInArrow(_refine(min_bytes, width, piece), _BLOCK_DDL), "blocks")
        judged = saved(_judged(blocks, _counted(blocks)), "judged")
        done.append(judged.where("whole"))
    cuts = done[0]
    for more in done[1:]:
        cuts = cuts.union(more)
    cut = F.struct((F.col("place") - F.col("far")).alias("start"), (F.col("place") - F.col("near") + min_bytes).alias("end"))
    all_of = F.struct(F.lit(0).cast("bigint").alias("start"), F.col("size").cast("bigint").alias("end"))
    cuts = cuts.select("_row", cut.alias("_cut")).union(twice.select("_row", all_of))
    grouped = cuts.groupBy("_row").agg(F.collect_set("_cut").alias("_cuts"))
    ddl = "_row BIGINT, n_removed BIGINT, n_spans BIGINT, kept_sha256 STRING, spans ARRAY<STRUCT<start: BIGINT, end: BIGINT>>"
    removed = saved(texts.join(grouped, "_row").mapInArrow(_removal(), ddl), "removed")
    plain = rows.select("doc_id", "_row", F.octet_length("_bytes").cast("bigint").alias("n_bytes"), F.sha2("_bytes", 256).alias("_sha"))
    return plain.join(removed, "_row", "left").select(
        "doc_id",
        "n_bytes",
        F.coalesce("n_removed", F.lit(0)).cast("bigint").alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).cast("bigint").alias("n_spans"),
        F.coalesce("kept_sha256", "_sha").alias("kept_sha256"),
        F.coalesce("spans", F.array().cast("array<struct<start:bigint,end:bigint>>")).alias("spans"),
    )

