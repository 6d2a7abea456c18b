"""Alignment of two tokenizers over the same bytes, by products of sparse incidence matrices.

A document's tokens are rows of a token-byte matrix: a one for every byte that a token covers. The
product of one tokenizer's matrix with the other's transpose, row by row as Gustavson has it, has an
entry for every pair of tokens that overlap: the number of bytes they share. Where both tokens of
a pair end, a group ends. Tokens and groups give a second pair of matrices, whose product links all
tokens of a group with each other. Matrices are compressed sparse rows made here from arrays.

Links are counted per pair of ids over all documents, and each document's links are looked up there:
one aggregate, and one join that broadcasts the counts if they measure small and is salted if not.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placepulse.llm.common import saved
from placepulse.operators.joins import lookup_join

TOKENIZERS = "/opt/tokenizers"
BYTE_FILE = "byte_bpe_50k.json"
PIECE_FILE = "piece_bpe_32k.model"
#: Fixed value: how byte-level vocabularies of this kind cut a text before merging.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Bytes of text aligned at once; a longer document is cut where tokens of both sides end.
CHUNK = 1 << 20


@dataclass(frozen=True)
class Csr:
    """A sparse matrix by rows: ``indices[indptr[i]:indptr[i + 1]]`` are the columns of row ``i``."""

    indptr: np.ndarray
    indices: np.ndarray
    data: np.ndarray
    columns: int

    def rows(self) -> np.ndarray:
        """The row of every entry."""
        return np.repeat(np.arange(len(self.indptr) - 1, dtype=np.int32), np.diff(self.indptr))

    def transposed(self) -> Csr:
        sizes = np.bincount(self.indices, minlength=self.columns)
        indptr = np.concatenate([[0], np.cumsum(sizes)])
        rows, data = self.rows(), self.data
        if np.any(self.indices[1:] < self.indices[:-1]):
            order = np.argsort(self.indices, kind="stable")
            rows, data = rows[order], data[order]
        return Csr(indptr, rows, data, len(self.indptr) - 1)


def incidence(lengths: np.ndarray) -> Csr:
    """Tokens by bytes: consecutive tokens of these lengths."""
    indptr = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
    total = int(indptr[-1])
    return Csr(indptr, np.arange(total, dtype=np.int32), np.ones(total, np.int32), total)


def membership(ends: np.ndarray) -> Csr:
    """Tokens by groups: group ``g`` has the tokens up to ``ends[g]``."""
    sizes = np.diff(ends, prepend=0)
    total = int(ends[-1]) if len(ends) else 0
    groups = np.repeat(np.arange(len(ends), dtype=np.int32), sizes)
    return Csr(np.arange(total + 1), groups, np.ones(total, np.int32), len(ends))


def gustavson(a: Csr, b: Csr) -> Csr:
    """The product: row ``i`` is the sum of the rows of ``b`` that row ``i`` of ``a`` names, entries merged."""
    width = np.diff(b.indptr)[a.indices]
    rows, data = a.rows(), a.data
    if np.all(width == 1):
        at = b.indptr[:-1][a.indices]
    else:
        before = np.concatenate([[0], np.cumsum(width)])
        at = np.arange(before[-1]) + np.repeat(b.indptr[:-1][a.indices] - before[:-1], width)
        rows, data = np.repeat(rows, width), np.repeat(data, width)
    columns, data = b.indices[at], data * b.data[at]
    same = rows[1:] == rows[:-1]
    if np.any(same & (columns[1:] < columns[:-1])):
        order = np.lexsort((columns, rows))
        rows, columns, data = rows[order], columns[order], data[order]
        same = rows[1:] == rows[:-1]
    first = np.flatnonzero(np.concatenate([[True], ~(same & (columns[1:] == columns[:-1]))])) if len(rows) else np.empty(0, np.int64)
    sums = np.add.reduceat(data, first) if len(first) else data
    indptr = np.concatenate([[0], np.cumsum(np.bincount(rows[first], minlength=len(a.indptr) - 1))])
    return Csr(indptr, columns[first], sums, b.columns)


@dataclass(frozen=True)
class Links:
    """Overlapping tokens ``a, b``, the bytes they share, and whether they end together."""

    a: np.ndarray
    b: np.ndarray
    n_bytes: np.ndarray
    together: np.ndarray


def overlaps(a_lengths: np.ndarray, b_lengths: np.ndarray) -> Links:
    """All overlap links of two sequences of tokens over the same bytes, in order."""
    a_ends, b_ends = np.cumsum(a_lengths, dtype=np.int64), np.cumsum(b_lengths, dtype=np.int64)
    found, a_at, b_at = [], 0, 0
    for a_to, b_to in _cuts(a_ends, b_ends):
        product = gustavson(incidence(a_lengths[a_at:a_to]), incidence(b_lengths[b_at:b_to]).transposed())
        found.append((product.rows() + a_at, product.indices + b_at, product.data))
        a_at, b_at = a_to, b_to
    a, b, n_bytes = (np.concatenate(c) for c in zip(*found, strict=True)) if found else (np.empty(0, np.int64),) * 3
    return Links(a, b, n_bytes, a_ends[a] == b_ends[b])


def _cuts(a_ends: np.ndarray, b_ends: np.ndarray) -> list[tuple[int, int]]:
    """Token counts of both sides at common ends, about ``CHUNK`` bytes apart. No link crosses one."""
    if not len(a_ends):
        return []
    if a_ends[-1] <= 2 * CHUNK:
        return [(len(a_ends), len(b_ends))]
    common = np.intersect1d(a_ends, b_ends, assume_unique=True)
    marks = np.append(np.arange(CHUNK, a_ends[-1], CHUNK), a_ends[-1])
    ends = np.unique(common[np.searchsorted(common, marks)])
    return list(zip(np.searchsorted(a_ends, ends) + 1, np.searchsorted(b_ends, ends) + 1, strict=True))


def shared(a_ends: np.ndarray, b_ends: np.ndarray, entries: int = 1 << 20) -> Iterator[tuple[int, Csr]]:
    """Links of all tokens of a group, as products of at most about ``entries`` entries: first token of side a, product.

    ``a_ends[g]`` and ``b_ends[g]`` are the tokens up to the end of group ``g``.
    """
    a, b = membership(a_ends), membership(b_ends).transposed()
    size = np.cumsum(np.diff(b.indptr)[a.indices])
    start = 0
    while start < len(size):
        stop = int(np.searchsorted(size, (size[start - 1] if start else 0) + entries, side="right"))
        stop = max(stop, start + 1)
        some = Csr(a.indptr[start : stop + 1] - start, a.indices[start:stop], a.data[start:stop], a.columns)
        yield start, gustavson(some, b)
        start = stop


@dataclass(frozen=True)
class Vocabulary:
    """The bytes of every token."""

    blob: np.ndarray
    starts: np.ndarray
    lengths: np.ndarray

    @staticmethod
    def of(entries: list[bytes]) -> Vocabulary:
        if not all(entries):
            raise ValueError("a token without bytes can't be aligned")
        lengths = np.array([len(e) for e in entries], np.int64)
        return Vocabulary(np.frombuffer(b"".join(entries), np.uint8), np.cumsum(lengths) - lengths, lengths)

    def spelled(self, ids: np.ndarray) -> np.ndarray:
        """The joined bytes of tokens."""
        lengths = self.lengths[ids]
        shift = self.starts[ids] - (np.cumsum(lengths) - lengths)
        return self.blob[np.arange(int(lengths.sum())) + np.repeat(shift, lengths)]


def _byte_of() -> dict[str, int]:
    """Byte-level vocabularies write printable Latin-1 as itself and the other bytes, in order, from U+0100 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAC + 1), *range(0xAE, 0xFF + 1)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(others)}


def _merged(token: bytes, ranks: dict[bytes, int], pairs: dict[tuple[int, int], int]) -> list[int]:
    """What the merges make of a token's bytes: always the first merge of the list, leftmost."""
    ids = [ranks[token[k : k + 1]] for k in range(len(token))]
    while len(ids) > 1:
        best = min(range(len(ids) - 1), key=lambda k: pairs.get((ids[k], ids[k + 1]), 1 << 30))
        made = pairs.get((ids[best], ids[best + 1]))
        if made is None:
            break
        ids[best : best + 2] = [made]
    return ids


def _merges_by_rank(path: str, entries: list[bytes]) -> tiktoken.Encoding | None:
    """The same tokenizer by ranks, which is faster, if its file allows it.

    Ranks join a pair wherever its bytes are a token. That is what the list of merges does if texts are cut by
    ``PATTERN``, each merge makes the next id out of smaller ones, and every token is what merges make of its bytes.
    """
    with open(path, encoding="utf-8") as file:
        held = json.load(file)
    model, cut = held["model"], held["pre_tokenizer"] or {}
    plain = not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "fuse_unk", "byte_fallback"))
    plain &= model["type"] == "BPE" and not held["normalizer"] and cut.get("type") == "ByteLevel"
    if not plain or cut.get("add_prefix_space") or not cut.get("use_regex", True):
        return None
    vocab, pairs = model["vocab"], {}
    for i, merge in enumerate(model["merges"], 256):
        a, b = merge.split(" ") if isinstance(merge, str) else merge
        if vocab.get(a + b) != i or max(vocab[a], vocab[b]) >= i:
            return None
        pairs[vocab[a], vocab[b]] = i
    if len(vocab) != 256 + len(model["merges"]):
        return None
    ranks = {entries[i]: i for i in vocab.values()}
    if any(_merged(token, ranks, pairs) != [i] for token, i in ranks.items()):
        return None
    return tiktoken.Encoding("merges", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=4)
def byte_tokenizer(path: str):
    """Encoder of many texts and vocabulary of a byte-level tokenizer; special tokens are plain text."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    of = _byte_of()
    entries = [bytes(of[c] for c in tokenizer.id_to_token(i)) for i in range(tokenizer.get_vocab_size())]
    if ranked := _merges_by_rank(path, entries):
        return (lambda texts: [ranked.encode_to_numpy(t).view(np.int32) for t in texts]), Vocabulary.of(entries)

    def encode(texts: list[str]) -> list[list[int]]:
        return [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    return encode, Vocabulary.of(entries)


@lru_cache(maxsize=4)
def piece_tokenizer(path: str):
    """Encoder of many texts and vocabulary of a piece tokenizer, which puts a space in front itself."""
    from sentencepiece import SentencePieceProcessor

    pieces = SentencePieceProcessor(model_file=path)
    entries = [
        bytes([int(pieces.id_to_piece(i)[1:-1], 16)]) if pieces.is_byte(i) else pieces.id_to_piece(i).replace("▁", " ").encode()
        for i in range(pieces.get_piece_size())
    ]
    return (lambda texts: pieces.encode(texts, num_threads=1)), Vocabulary.of(entries)


@dataclass(frozen=True)
class Aligned:
    """Documents aligned one behind the other; documents without tokens take no place.

    ``*_ids`` are the tokens of all, ``*_ends[g]`` the tokens up to the end of group ``g``; ``*_doc[d]``
    the tokens and ``groups[d]`` the groups up to the end of document ``d``.
    """

    a_ids: np.ndarray
    b_ids: np.ndarray
    links: Links
    a_ends: np.ndarray
    b_ends: np.ndarray
    a_doc: np.ndarray
    b_doc: np.ndarray
    groups: np.ndarray


def _flat(lists: list[np.ndarray]) -> np.ndarray:
    return np.concatenate(lists) if lists else np.empty(0, np.int32)


def align(texts: list[str | None], a_path: str, b_path: str) -> Aligned:
    """Tokens, links and groups of texts. Texts that a side's tokens do not spell exactly have none."""
    (a_encode, a_words), (b_encode, b_words) = byte_tokenizer(a_path), piece_tokenizer(b_path)
    full = [" " + t if t else "" for t in texts]
    there = [i for i, t in enumerate(full) if t]
    sides = []
    for encode, words, given in ((a_encode, a_words, full), (b_encode, b_words, texts)):
        ids: list[np.ndarray] = [np.empty(0, np.int32)] * len(texts)
        for i, found in zip(there, encode([given[i] for i in there]), strict=True):
            ids[i] = np.array(found, np.int32)
        sides.append((ids, words))
    wanted = [t.encode() for t in full]
    spelled = {
        i: all(int(words.lengths[ids[i]].sum()) == len(wanted[i]) for ids, words in sides) for i in there
    }
    kept = [i for i in there if spelled[i]]
    data, ends = np.frombuffer(b"".join(wanted[i] for i in kept), np.uint8), np.cumsum([len(wanted[i]) for i in kept])
    for ids, words in sides:
        wrong = np.flatnonzero(words.spelled(_flat([ids[i] for i in kept])) != data)
        for d in np.unique(np.searchsorted(ends, wrong, side="right")):
            spelled[kept[d]] = False
    for ids, _ in sides:
        for i in there:
            if not spelled[i]:
                ids[i] = ids[i][:0]
    (a, a_words), (b, b_words) = sides
    a_ids, b_ids = _flat(a), _flat(b)
    links = overlaps(a_words.lengths[a_ids], b_words.lengths[b_ids])
    a_ends, b_ends = links.a[links.together] + 1, links.b[links.together] + 1
    a_doc, b_doc = np.cumsum([len(x) for x in a], dtype=np.int64), np.cumsum([len(x) for x in b], dtype=np.int64)
    return Aligned(a_ids, b_ids, links, a_ends, b_ends, a_doc, b_doc, np.searchsorted(a_ends, a_doc, side="right"))


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[int | None], list[str | None]]]:
    """Ids and texts of about ``CHUNK`` bytes."""
    keys, texts, size = [], [], 0
    for batch in batches:
        for key, text in zip(batch.column("doc_id"), batch.column("_text"), strict=True):
            keys.append(key.as_py())
            texts.append(text.as_py())
            size += len(texts[-1] or "")
            if size >= CHUNK or len(keys) >= 4096:
                yield keys, texts
                keys, texts, size = [], [], 0
    if keys:
        yield keys, texts


@lru_cache(maxsize=4)
def _decimals(size: int) -> tuple[np.ndarray, np.ndarray]:
    """``id`` and a separator of ``,|;`` as eight bytes padded by zeros, and their lengths."""
    text = [f"{i}{s}".encode() for s in ",|;" for i in range(size)]
    if max(map(len, text)) > 8:
        raise ValueError("ids have more than seven digits")
    return np.array(text, "S8").view(np.uint64), np.array([len(t) for t in text], np.int64)


def group_digests(found: Aligned) -> list[str]:
    """SHA-256 of every document's groups, as ``a,a|b;a|b,b``; empty without tokens."""
    size = int(max(found.a_ids.max(initial=0), found.b_ids.max(initial=0))) + 1
    table, lengths = _decimals(1 << size.bit_length())
    size = 1 << size.bit_length()
    codes = np.empty(len(found.a_ids) + len(found.b_ids), np.int64)
    a_group, b_group = membership(found.a_ends).indices, membership(found.b_ends).indices
    a_last, b_last = np.zeros(len(found.a_ids), np.int64), np.zeros(len(found.b_ids), np.int64)
    a_last[found.a_ends - 1], b_last[found.b_ends - 1] = 1, 2
    b_before = np.concatenate([[0], found.b_ends])
    codes[np.arange(len(found.a_ids)) + b_before[a_group]] = found.a_ids + a_last * size
    codes[np.arange(len(found.b_ids)) + found.a_ends[b_group]] = found.b_ids + b_last * size
    padded = table[codes].view(np.uint8)
    text = padded[padded != 0].tobytes()
    ends = np.concatenate([[0], np.cumsum(lengths[codes])])[found.a_doc + found.b_doc]
    digests, at = [], 0
    for end in ends.tolist():
        digests.append(hashlib.sha256(text[at : end - 1]).hexdigest() if end > at else "")
        at = end
    return digests


def _per_document(ends: np.ndarray) -> np.ndarray:
    return np.diff(ends, prepend=0)


_COUNTED = pa.schema(
    [*((c, pa.int64()) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_overlaps", "n_shared")),
     ("groups_sha256", pa.string()), ("_links", pa.list_(pa.struct([("pair", pa.int64()), ("times", pa.int32())])))]
)
_COUNTED_DDL = (
    "doc_id BIGINT, n_a BIGINT, n_b BIGINT, n_groups BIGINT, n_overlaps BIGINT, n_shared BIGINT, groups_sha256 STRING, "
    "_links ARRAY<STRUCT<pair: BIGINT, times: INT>>"
)


def _counted(a_path: str, b_path: str):
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, texts in _chunks(batches):
            found = align(texts, a_path, b_path)
            a_size, b_size = len(byte_tokenizer(a_path)[1].lengths), len(piece_tokenizer(b_path)[1].lengths)
            links = found.links
            a, b = found.a_ids[links.a[links.together]].astype(np.int64), found.b_ids[links.b[links.together]]
            documents = np.repeat(np.arange(len(keys)), _per_document(found.groups))
            several, times = np.unique((documents * a_size + a) * b_size + b, return_counts=True)
            documents, pairs = np.divmod(several, a_size * b_size)
            offsets = np.searchsorted(documents, np.arange(len(keys) + 1)).astype(np.int32)
            entries = pa.StructArray.from_arrays([pa.array(pairs), pa.array(times.astype(np.int32))], ["pair", "times"])
            sizes = _per_document(found.a_ends) * _per_document(found.b_ends)
            n_shared = np.diff(np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], found.groups])])
            n_overlaps = _per_document(np.searchsorted(links.a, found.a_doc))
            columns = [keys, _per_document(found.a_doc), _per_document(found.b_doc), _per_document(found.groups),
                       n_overlaps, n_shared]
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(c, pa.int64()) for c in columns), pa.array(group_digests(found), pa.string()),
                 pa.ListArray.from_arrays(pa.array(offsets), entries)], schema=_COUNTED)

    return counted


_LINK = pa.schema(
    [("doc_id", pa.int64()), *((c, pa.int32()) for c in ("a_place", "a_id", "b_place", "b_id", "weight")), ("together", pa.bool_())]
)
_LINK_DDL = "doc_id BIGINT, a_place INT, a_id INT, b_place INT, b_id INT, weight INT, together BOOLEAN"


def _linked(a_path: str, b_path: str, kind: str):
    def products(found: Aligned):
        if kind == "overlap":
            for at in range(0, len(found.links.a), 1 << 20):
                part = slice(at, at + (1 << 20))
                yield found.links.a[part], found.links.b[part], found.links.n_bytes[part], found.links.together[part]
            return
        a_last, b_last = (np.isin(np.arange(len(i)), e - 1) for i, e in ((found.a_ids, found.a_ends), (found.b_ids, found.b_ends)))
        for start, product in shared(found.a_ends, found.b_ends):
            a, b = product.rows() + start, product.indices
            yield a, b, product.data, a_last[a] & b_last[b]

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, texts in _chunks(batches):
            found = align(texts, a_path, b_path)
            for a, b, weight, together in products(found):
                document = np.searchsorted(found.a_doc, a, side="right")
                before = [np.concatenate([[0], ends])[document] for ends in (found.a_doc, found.b_doc)]
                numbers = (a - before[0], found.a_ids[a], b - before[1], found.b_ids[b], weight)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.int64()).take(pa.array(document)), *(pa.array(n.astype(np.int32)) for n in numbers),
                     pa.array(together)], schema=_LINK)

    return linked


def _texts(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    return docs.select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(text_column).alias("_text"))


def _paths(folder: str) -> tuple[str, str]:
    return f"{folder}/{BYTE_FILE}", f"{folder}/{PIECE_FILE}"


def token_links(
    docs: DataFrame, kind: str = "overlap", id_column: str = "doc_id", text_column: str = "text", tokenizers: str = TOKENIZERS
) -> DataFrame:
    """One row per link of two tokens: ``doc_id, a_place, a_id, b_place, b_id, weight, together``.

    ``kind`` is ``overlap`` (the weight is the bytes shared) or ``shared`` (all tokens of a group; the weight
    is 1). Places count from 0 in the document. ``together``: both tokens end at the same byte.
    """
    if kind not in ("overlap", "shared"):
        raise ValueError(f"kind must be overlap or shared, not {kind!r}")
    return _texts(docs, id_column, text_column).mapInArrow(_linked(*_paths(tokenizers), kind), _LINK_DDL)


def align_documents(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", tokenizers: str = TOKENIZERS
) -> tuple[DataFrame, DataFrame]:
    """Documents and id pairs.

    Documents: ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, n_overlaps, n_shared``, a row per row.
    Pairs: ``pair, a_id, b_id, count, best``: links of the two ids that end together, over all documents, and
    whether no other ``a_id`` has more with this ``b_id``. Null and empty texts, and texts that a tokenizer does not
    give back byte for byte, have no tokens: zeros and an empty digest. Ids may be null or repeat; other
    columns are not read; an empty table gives empty results.
    """
    a_path, b_path = _paths(tokenizers)
    b_size = len(piece_tokenizer(b_path)[1].lengths)
    texts = _texts(docs, id_column, text_column)
    # Ids may be null or repeat, so every row gets a key of its own, written with it.
    counted = texts.mapInArrow(_counted(a_path, b_path), _COUNTED_DDL).withColumn("_row", F.monotonically_increasing_id())
    counted = saved(counted, "aligned")
    counts = counted.select(F.inline("_links")).groupBy("pair").agg(F.sum("times").alias("count"))
    counts = saved(counts.withColumn("b_id", F.col("pair") % b_size), "pairs")
    # One row per token of the vocabulary.
    highest = counts.groupBy("b_id").agg(F.max("count").alias("_most"))
    pairs = saved(
        counts.join(F.broadcast(highest), "b_id").select(
            "pair", F.floor(F.col("pair") / b_size).cast("int").alias("a_id"), F.col("b_id").cast("int").alias("b_id"),
            "count", (F.col("count") == F.col("_most")).alias("best"),
        ),
        "links",
    )
    linked = lookup_join(counted.select("_row", F.inline("_links")), pairs.select("pair", "count", "best"), ["pair"], "inner")
    sums = linked.groupBy("_row").agg(
        F.sum("times").alias("n_links"),
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("times") * F.col("count")).alias("count_sum"),
    )
    found = counted.drop("_links").join(sums, "_row", "left")
    zero = [F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in ("n_links", "n_best", "count_sum")]
    columns = ["doc_id", "n_a", "n_b", "n_groups", *zero, "groups_sha256", "n_overlaps", "n_shared"]
    return found.select(*columns), pairs
