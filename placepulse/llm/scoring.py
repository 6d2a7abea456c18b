"""Scores of texts by a causal self-attention model over subwords, beside add-one word counts.

Texts become subword ids once; everything after reads those. Every training text is learnt from once: in
each of ``ROUNDS`` rounds the tasks go on from common weights, each over its own texts of that round,
and the weights they arrive at are averaged by the tokens behind them. A text is scored in
overlapping windows, of which all but the first score only what the one before has not.

A word is known by a 64-bit hash of its ids: words have no blanks, so the one id that begins with a
space starts a word, and equal ids spell equal words. The words with the most tokens go to the
tasks as a table of bounded size; the counts of all others, none of which has a large
share of the tokens, are joined.
"""

from __future__ import annotations

import base64
import math
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placepulse.llm import attention
from placepulse.llm.alignment import PATTERN, TOKENIZERS
from placepulse.llm.common import saved
from placepulse.llm.shingles import mix, powers

ROUNDS = 4
BATCH = 128
#: Windows scored at once.
SCORED = 256
RATE = 0.03
SEED = 13
#: Most words whose counts are sent to every task: 16 bytes each.
FREQUENT = 500_000
#: Bytes of text, and numbers of subwords, handled at once.
CHUNK = 1 << 20
RANKS_FILE = "byte_bpe_50k.tiktoken"
#: The pattern without its parts for blanks that stand alone, and the blanks that can remain in a word.
_PLAIN = PATTERN.removesuffix(r"|\s+(?!\S)|\s+")
_BLANKS = re.compile("[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_SPACED_BLANKS = "\u00a0 \u00a0"
_LOWER_BYTES = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_LN10 = math.log(10)
Texts = Iterator[pa.RecordBatch]


@lru_cache(maxsize=4)
def tokenizer(path: str) -> tuple[tiktoken.Encoding, np.ndarray, tiktoken.Encoding]:
    """A byte-level tokenizer from its file of ranks, which of its ids begin with a space, and one for texts without other blanks than single spaces."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    spaced = np.zeros(max(ranks.values()) + 1, bool)
    spaced[[rank for token, rank in ranks.items() if token[:1] == b" "]] = True
    # Without any special token the empty one would be looked for, and found, at every place of a text.
    special = {"<|endoftext|>": len(spaced)}
    whole, plain = (tiktoken.Encoding("subwords", pat_str=p, mergeable_ranks=ranks, special_tokens=special) for p in (PATTERN, _PLAIN))
    return whole, spaced, plain


def encoded(text: str | None, path: str) -> np.ndarray:
    """Subword ids of a text's words: A-Z in lower case, one space in front of each."""
    words = (text or "").encode().translate(_LOWER_BYTES).split()
    if not words:
        return np.empty(0, np.int32)
    encoding, _, plain = tokenizer(path)
    joined = (b" " + b" ".join(words)).decode()
    if not _BLANKS.search(joined):
        # Every space goes with the letter, digit or sign behind it.
        encoding = plain
    elif _SPACED_BLANKS in joined:
        # The only subwords with a space inside hold several words.
        return np.concatenate([encoding.encode_to_numpy(f" {w.decode()}", disallowed_special=()) for w in words]).astype(np.int32)
    return encoding.encode_to_numpy(joined, disallowed_special=()).astype(np.int32)


def _batched(batches: Texts, size: Callable[[dict], int]) -> Iterator[list[dict]]:
    """Rows, about ``CHUNK`` of ``size`` together."""
    held, weight = [], 0
    for batch in batches:
        for start in range(0, batch.num_rows, 512):
            for row in batch.slice(start, 512).to_pylist():
                held.append(row)
                weight += size(row)
                if weight >= CHUNK:
                    yield held
                    held, weight = [], 0
    if held:
        yield held


_IDS = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("ids", pa.binary()), ("wide", pa.binary())])


def kept_as(size: int) -> np.dtype:
    """Type of the ids of a vocabulary of that size as they are kept."""
    return np.dtype(np.uint16 if size <= 1 << 16 else np.int32)



def subwords(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", tokenizers: str = TOKENIZERS) -> DataFrame:
    """``_row, doc_id, held_out, ids`` (as ``kept_as`` says) and their ``hash``, written once. A null id is an empty text to the crc."""
    path = f"{tokenizers}/{RANKS_FILE}"
    doc_id = F.col(id_column).cast("bigint")
    held_out = F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 7 == 2

    def encode(batches: Texts) -> Texts:
        kept = kept_as(len(tokenizer(path)[1]))
        for rows in _batched(batches, lambda r: len(r["text"] or "")):
            ids = [encoded(r["text"], path) for r in rows]
            narrow, wide = [i.astype(kept).tobytes() for i in ids], [i.tobytes() for i in ids]
            columns = [[r["doc_id"] for r in rows], [r["held_out"] for r in rows], narrow, wide]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _IDS, strict=True)], schema=_IDS)

    texts = docs.select(doc_id.alias("doc_id"), held_out.alias("held_out"), F.col(text_column).alias("text"))
    found = texts.mapInArrow(encode, "doc_id BIGINT, held_out BOOLEAN, ids BINARY, wide BINARY")
    found = found.withColumns({"_row": F.monotonically_increasing_id(), "hash": F.xxhash64("wide")})
    return saved(found.drop("wide"), "subwords")


@lru_cache(maxsize=4)
def _mixed(size: int) -> np.ndarray:
    return mix(np.arange(1, size + 1, dtype=np.uint64))


def word_keys(ids: np.ndarray, spaced: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every word, and where it starts."""
    starts = np.flatnonzero(spaced[ids])
    ends = np.append(starts[1:], len(ids))
    up, down = powers(len(ids) + 1)
    sums = np.zeros(len(ids) + 1, np.uint64)
    np.cumsum(_mixed(len(spaced))[ids] * up[: len(ids)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64)).view(np.int64), starts


def _flat(rows: list[dict], kept: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """All ids, and how many there are up to each text's end."""
    held = [np.frombuffer(r["ids"], kept) for r in rows]
    return np.concatenate(held).astype(np.int32), np.cumsum([len(i) for i in held])


_TIMES = pa.schema([("key", pa.int64()), ("n", pa.int64())])


def _word_times(path: str):
    def times(batches: Texts) -> Texts:
        spaced = tokenizer(path)[1]
        kept = kept_as(len(spaced))
        for rows in _batched(batches, lambda r: len(r["ids"]) // kept.itemsize + 1):
            keys, n = np.unique(word_keys(_flat(rows, kept)[0], spaced)[0], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n)], schema=_TIMES)

    return times


def _id_times(kept: np.dtype):
    def times(batches: Texts) -> Texts:
        total = np.zeros(0, np.int64)
        for rows in _batched(batches, lambda r: len(r["ids"]) // kept.itemsize + 1):
            n = np.bincount(_flat(rows, kept)[0], minlength=len(total))
            n[: len(total)] += total
            total = n
        ids = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total[ids])], schema=_TIMES)

    return times


@dataclass(frozen=True)
class Model:
    """Weights, classes of the ids, and the end of a text: the id behind the vocabulary."""

    flat: np.ndarray
    ranks: attention.Ranks

    @property
    def end(self) -> int:
        return len(self.ranks.rank) - 1

    def ended(self, rows: list[dict]) -> tuple[np.ndarray, np.ndarray]:
        """Texts' ids and ends, and their numbers by text."""
        flat, ends = _flat(rows, kept_as(self.end))
        return np.insert(flat, ends, self.end), np.diff(ends, prepend=0) + 1

    def rare(self, ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The log of the shares of each text's rare ids."""
        logs = self.ranks.rare[ids]
        few = np.flatnonzero(logs)
        # Of no ids the counts are integers.
        return np.bincount(np.searchsorted(np.cumsum(sizes), few, side="right"), logs[few], len(sizes)).astype(float)


_LEARNT = pa.schema([("part", pa.int64()), ("n", pa.int64()), ("weights", pa.binary())])
_LEARNT_DDL = "part BIGINT, n BIGINT, weights BINARY"


def _learnt(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _LEARNT, strict=True)], schema=_LEARNT)


def _learner(model: Model, rate: float, batch_size: int):
    kept = kept_as(model.end)

    def learn(batches: Texts) -> Texts:
        flat, part, n = model.flat.copy(), 0, 0
        weights, steps = attention.unpacked(flat), attention.Adam(rate)
        start = int(model.ranks.rank[model.end])
        held: list[tuple] = []
        for rows in _batched(batches, lambda r: len(r["ids"]) // kept.itemsize + 1):
            part = rows[0]["part"]
            ids, sizes = model.ended(rows)
            held.append(attention.windows(model.ranks.rank[ids], sizes, start, attention.WINDOW, attention.WINDOW)[:3])
            inputs, targets, there = (np.concatenate(c) for c in zip(*held, strict=True))
            for at in range(0, len(inputs) - batch_size + 1, batch_size):
                some = slice(at, at + batch_size)
                steps.step(flat, attention.gradient(weights, inputs[some], targets[some], there[some])[0])
                n += int(there[some].sum())
            rest = slice(len(inputs) - len(inputs) % batch_size, None)
            held = [(inputs[rest], targets[rest], there[rest])]
        if held and len(held[0][0]):
            inputs, targets, there = held[0]
            steps.step(flat, attention.gradient(weights, inputs, targets, there)[0])
            n += int(there.sum())
        if n:
            yield _learnt([(part % 64, n, flat.tobytes())])

    return learn


def _averaged(table: pa.Table) -> pa.Table:
    n, total = 0, np.zeros(attention.SIZE)
    for row in table.to_pylist():
        n += row["n"]
        total += row["n"] * np.frombuffer(row["weights"], np.float32)
    return pa.Table.from_batches([_learnt([(0, n, (total / n).astype(np.float32).tobytes())])])


def fit_model(texts: DataFrame, tokenizers: str = TOKENIZERS, rounds: int = ROUNDS, batch_size: int = BATCH) -> Model:
    """A model of all texts of ``subwords`` that are not held out. Without any it is the untrained one."""
    training = texts.where("NOT held_out")
    size = len(tokenizer(f"{tokenizers}/{RANKS_FILE}")[1]) + 1
    counts = np.zeros(size, np.int64)
    # One row per id of the vocabulary at most.
    for key, n in training.select("ids").mapInArrow(_id_times(kept_as(size - 1)), "key BIGINT, n BIGINT").groupBy("key").agg(F.sum("n")).collect():
        counts[key] = n
    counts[-1] = training.count()
    model = Model(attention.started(counts, SEED), attention.Ranks.of(counts))
    turn = F.pmod("hash", F.lit(rounds))
    for i in range(rounds):
        some = training.where(turn == i).select("ids", F.spark_partition_id().cast("bigint").alias("part"))
        learnt = some.mapInArrow(_learner(model, RATE / (1 + i), batch_size), _LEARNT_DDL)
        # At most 64 rows of weights come back, each the mean of a group of tasks.
        found = learnt.groupBy("part").applyInArrow(_averaged, _LEARNT_DDL).collect()
        n = sum(r["n"] for r in found)
        if n:
            total = sum(r["n"] / n * np.frombuffer(r["weights"], np.float32).astype(float) for r in found)
            model = Model(total.astype(np.float32), model.ranks)
    return model


def text_scores(model: Model, rows: list[dict]) -> np.ndarray:
    """Natural log of each text's probability, its end included."""
    weights, start = attention.unpacked(model.flat), int(model.ranks.rank[model.end])
    ids, sizes = model.ended(rows)
    total = model.rare(ids, sizes)
    later = attention.WINDOW - attention.FRESH
    inputs, targets, there, of, turn = attention.windows(model.ranks.rank[ids], sizes, start, attention.WINDOW, attention.FRESH)
    for first, some in ((0, np.flatnonzero(turn == 0)), (later, np.flatnonzero(turn))):
        for at in range(0, len(some), SCORED):
            part = some[at : at + SCORED]
            found = attention.log_likelihoods(weights, inputs[part], targets[part, first:], first)
            total += np.bincount(of[part], (found * there[part, first:]).sum(axis=1), len(rows))
    return total


_SCORED = pa.schema(
    [("_row", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_words", pa.int64()), ("score", pa.float64()),
     ("logs", pa.float64()), ("known", pa.int64()), ("rest", pa.list_(pa.struct([("key", pa.int64()), ("times", pa.int64())])))]
)
_SCORED_DDL = (
    "_row BIGINT, doc_id BIGINT, held_out BOOLEAN, n_words BIGINT, score DOUBLE, logs DOUBLE, known BIGINT, "
    "rest ARRAY<STRUCT<key: BIGINT, times: BIGINT>>"
)


def _scorer(model: Model, path: str, keys: np.ndarray, counts: np.ndarray):
    """Scores; sums over the words found among ``keys`` (sorted), and the other words of each text."""

    def score(batches: Texts) -> Texts:
        spaced = tokenizer(path)[1]
        kept = kept_as(len(spaced))
        for rows in _batched(batches, lambda r: len(r["ids"]) // kept.itemsize + 1):
            flat, ends = _flat(rows, kept)
            words, starts = word_keys(flat, spaced)
            of = np.searchsorted(ends, starts, side="right")
            found = pa.array(words).dictionary_encode()
            several = found.dictionary.to_numpy()
            order = np.argsort(several)
            several, back = several[order], np.argsort(order)[found.indices.to_numpy()]
            at = np.minimum(np.searchsorted(keys, several), max(0, len(keys) - 1))
            hit = keys[at] == several if len(keys) else np.zeros(len(several), bool)
            count = np.where(hit, counts[at], 0) if len(keys) else np.zeros(len(several))
            logs = np.bincount(of, np.log10(count + 1.0)[back], len(rows))
            known = np.bincount(of, hit[back], len(rows)).astype(np.int64)
            other = ~hit[back]
            pairs, times = np.unique(of[other] * len(several) + back[other], return_counts=True)
            offsets = np.searchsorted(pairs, np.arange(len(rows) + 1) * max(1, len(several))).astype(np.int32)
            rest = pa.StructArray.from_arrays([pa.array(several[pairs % max(1, len(several))]), pa.array(times)], ["key", "times"])
            n_words = np.bincount(of, minlength=len(rows))
            plain = [[r[c] for r in rows] for c in ("_row", "doc_id", "held_out")]
            columns = [*plain, n_words, text_scores(model, rows) / _LN10, logs, known]
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(c, f.type) for c, f in zip(columns, _SCORED, strict=False)), pa.ListArray.from_arrays(pa.array(offsets), rest)],
                schema=_SCORED,
            )

    return score


def word_counts(texts: DataFrame, tokenizers: str = TOKENIZERS) -> DataFrame:
    """``key, n`` of the words of the texts of ``subwords`` that are not held out."""
    found = texts.where("NOT held_out").select("ids").mapInArrow(_word_times(f"{tokenizers}/{RANKS_FILE}"), "key BIGINT, n BIGINT")
    return found.groupBy("key").agg(F.sum("n").alias("n"))


def score_texts(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    tokenizers: str = TOKENIZERS,
    frequent: int = FREQUENT,
    model: Model | None = None,
) -> DataFrame:
    """One row per row: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    Learns from the texts whose ``crc32`` of the id is not 2 modulo 7 (a null id is an empty string to it),
    or takes ``model``. Null texts are empty: their one token is the end. ``base_score`` adds one to the counts of words
    (and ends) in training texts, ``score`` is the model's log10 probability of the subwords and the end.
    Ids may be null or repeat; other columns are not read; an empty table gives an empty result.
    """
    path = f"{tokenizers}/{RANKS_FILE}"
    texts = subwords(docs, id_column, text_column, tokenizers)
    counts = saved(word_counts(texts, tokenizers), "word_counts")
    steps = range(0, 63)
    sums = counts.agg(
        F.count(F.lit(1)).alias("words"), F.coalesce(F.sum("n"), F.lit(0)).alias("n"), *(F.count_if(F.col("n") >= 2**k).alias(f"_{k}") for k in steps)
    ).first()
    ends = texts.where("NOT held_out").count()
    tokens, distinct = sums["n"] + ends, sums["words"] + (ends > 0)
    # At most `frequent` words have so many tokens, so no other word has more than their `frequent`-th part.
    least = next(2**k for k in steps if sums[f"_{k}"] <= frequent)
    first = counts.where(F.col("n") >= least).toArrow()
    keys, numbers = (first.column(c).to_numpy() for c in ("key", "n"))
    order = np.argsort(keys)
    model = model or fit_model(texts, tokenizers)
    scored = texts.mapInArrow(_scorer(model, path, keys[order], numbers[order]), _SCORED_DDL)
    scored = saved(scored, "scored")
    rest = scored.select("_row", F.inline("rest")).join(counts.where(F.col("n") < least), "key")
    rest = rest.groupBy("_row").agg(
        F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("_logs"), F.sum("times").alias("_known")
    )
    n_tokens = F.col("n_words") + 1
    base = F.col("logs") + F.coalesce("_logs", F.lit(0.0)) + F.lit(math.log10(ends + 1)) - n_tokens * F.lit(math.log10(tokens + distinct + 1))
    return scored.drop("rest").join(rest, "_row", "left").select(
        "doc_id",
        "held_out",
        n_tokens.alias("n_tokens"),
        (F.col("known") + F.coalesce("_known", F.lit(0)) + F.lit(int(ends > 0))).alias("n_known"),
        F.lit(tokens).cast("bigint").alias("train_tokens"),
        base.alias("base_score"),
        "score",
    )
