"""Quality by perplexity under an interpolated modified Kneser-Ney model of trusted text.

The model is over characters, one per language, and is counted over every trusted text. Counts,
continuation counts, discounts and back-off weights are joins and aggregates sharded by n-gram.
Documents are scored where they are read, against shards of the model small enough to broadcast.
The bound of a language is a quantile over trusted texts that were kept out of the counts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placepulse.llm.common import saved, small_side, without
from placepulse.llm.shingles import mix

ORDER = 5
#: One trusted text in so many sets the bound instead of being counted.
HELD_OUT = 5
QUANTILE = 0.995
#: Perplexity allowed beyond the quantile, as a factor.
SLACK = 1.15
#: Characters at a language's mean that every text is given, so that short texts vary less.
PRIOR_CHARS = 60
#: Model entries that are broadcast at once, 24 bytes each.
SHARD_ENTRIES = 4_000_000
CHUNK = 1 << 19
START = "\u0002"

_FACTORS = mix(np.arange(1, 65, dtype=np.uint64)) | np.uint64(1)


def language_key(lang: str | None) -> np.uint64:
    return np.uint64(int.from_bytes(hashlib.blake2b((lang or "").encode(), digest_size=8).digest(), "little"))


def gram_keys(codes: np.ndarray, at: np.ndarray, order: int, langs: np.ndarray) -> np.ndarray:
    """64-bit keys of the n-grams of one order that end at the given places."""
    total = langs + np.uint64(order)
    for k in range(order):
        total = total + (codes[at - k].astype(np.uint64) + np.uint64(1)) * _FACTORS[8 * order + k]
    return mix(total)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _count(order: int):
    schema = pa.schema([("lang", pa.string()), ("gram", pa.string()), ("n", pa.int64())])

    def grams(texts: list[str], lang: str) -> pa.RecordBatch:
        codes = code_points("".join(texts))
        alphabet, ids = np.unique(codes, return_inverse=True)
        bits = max(1, int(len(alphabet) - 1).bit_length())
        width = len(codes) - order + 1
        if bits * order <= 64:
            packed = np.zeros(width, np.uint64)
            for k in range(order):
                packed = (packed << np.uint64(bits)) | ids[k : k + width].astype(np.uint64)
            kinds, n = np.unique(packed, return_counts=True)
            mask = np.uint64((1 << bits) - 1)
            rows = np.stack([(kinds >> np.uint64(bits * (order - 1 - k))) & mask for k in range(order)], 1)
        else:
            rows, n = np.unique(np.lib.stride_tricks.sliding_window_view(ids, order), axis=0, return_counts=True)
        points = alphabet[rows.astype(np.int64)]
        # What spans two texts has a start mark within or at its end.
        marks = points == ord(START)
        real = ~marks[:, -1] & ~(marks[:, 1:] & ~marks[:, :-1]).any(axis=1)
        data = np.ascontiguousarray(points[real]).astype("<u4").tobytes().decode("utf-32-le", "replace")
        words = [data[i : i + order] for i in range(0, len(data), order)]
        return pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(words), pa.string()), pa.array(words, pa.string()), pa.array(n[real], pa.int64())],
            schema=schema,
        )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[str]] = {}
        sizes: dict[str, int] = {}
        for batch in batches:
            for lang, text in zip(batch.column("_lang").to_pylist(), batch.column("_text"), strict=True):
                whole = (text.as_py() or "").replace(START, " ")
                # A very long text is counted in pieces that overlap by less than one n-gram.
                for at in range(0, len(whole), CHUNK):
                    head = START * (order - 1) if at == 0 else whole[at - order + 1 : at]
                    held.setdefault(lang, []).append(head + whole[at : at + CHUNK])
                    sizes[lang] = sizes.get(lang, 0) + len(whole)
                if sizes.get(lang, 0) >= CHUNK:
                    yield grams(held.pop(lang), lang)
                    sizes[lang] = 0
        for lang, texts in held.items():
            yield grams(texts, lang)

    return count


def kneser_ney(counts: DataFrame, order: int) -> DataFrame:
    """``lang, gram, logp, logg`` for n-grams of all orders: log probability of the last character
    after the others, and log back-off weight of the whole as a context, each null where unseen."""
    key = ["lang", "gram"]
    tables = {order: counts.groupBy("lang", "gram").agg(F.sum("n").alias("c"))}
    tables[order] = saved(tables[order], "grams")
    for n in range(order - 1, 0, -1):
        # A lower order counts the different characters seen before the n-gram.
        longer = tables[n + 1].select("lang", F.substring("gram", 2, n).alias("gram"))
        tables[n] = saved(longer.groupBy("lang", "gram").agg(F.count(F.lit(1)).alias("c")), "grams")
    probabilities, out = None, None
    for n in range(1, order + 1):
        rows = tables[n]
        seen = [F.sum((F.col("c") == k).cast("double")).alias(f"n{k}") for k in range(1, 5)]
        y = F.try_divide(F.col("n1"), F.col("n1") + 2 * F.col("n2"))

        def discount(k: int, y=y) -> Column:
            value = k - (k + 1) * y * F.try_divide(F.col(f"n{k + 1}"), F.col(f"n{k}"))
            usable = (F.col(f"n{k}") > 0) & (value > 0) & (value < k)
            return F.when(usable, value).otherwise(0.6 * k).alias(f"d{k}")

        discounts = rows.groupBy("lang").agg(*seen, F.count(F.lit(1)).alias("kinds")).select(
            "lang", discount(1), discount(2), discount(3), "kinds"
        )
        part = rows.join(small_side(discounts), "lang").withColumn("context", F.substring("gram", 1, n - 1))
        d = F.when(F.col("c") == 1, F.col("d1")).when(F.col("c") == 2, F.col("d2")).otherwise(F.col("d3"))
        part = part.withColumn("d", d)
        contexts = part.groupBy("lang", "context").agg(F.sum("c").alias("total"), F.sum("d").alias("taken"))
        whole = part.join(contexts, ["lang", "context"]).withColumn("own", (F.col("c") - F.col("d")) / F.col("total"))
        weight = F.col("taken") / F.col("total")
        if n == 1:
            # The empty context backs off to any of the known characters or one unknown.
            p = F.col("own") + weight / (F.col("kinds") + 1)
            probabilities = whole.select(*key, p.alias("p"))
            unknown = contexts.join(small_side(discounts.select("lang", "kinds")), "lang").select(
                "lang", F.lit("").alias("gram"), F.lit(None).cast("double").alias("logp"),
                F.log(weight / (F.col("kinds") + 1)).alias("logg"),
            )
            out = unknown
            logp = probabilities.select(*key, F.log("p").alias("logp"))
        else:
            lower = probabilities.toDF("lang", "_suffix", "_lower")
            whole = whole.withColumn("_suffix", F.substring("gram", 2, n - 1)).join(lower, ["lang", "_suffix"])
            probabilities = whole.select(*key, (F.col("own") + weight * F.col("_lower")).alias("p"))
            weights = contexts.select("lang", F.col("context").alias("gram"), F.log(weight).alias("logg"))
            out = out.unionByName(logp.join(weights, key, "full").select(*key, "logp", "logg"))
            logp = probabilities.select(*key, F.log("p").alias("logp"))
        probabilities = saved(probabilities, "probabilities")
        logp = probabilities.select(*key, F.log("p").alias("logp"))
    return saved(out.unionByName(logp.withColumn("logg", F.lit(None).cast("double"))), "model")


class Lookup:
    """Values by 64-bit key. A key lies in the first level where its slot was free."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.levels = []
        while len(keys):
            bits = max(4, int(2 * len(keys)).bit_length())
            slot = self.slots(keys, bits, len(self.levels))
            owner = np.full(1 << bits, -1, np.int64)
            owner[slot] = np.arange(len(keys))
            placed = owner[slot] == np.arange(len(keys))
            there = np.zeros(1 << bits, np.uint64)
            there[slot[placed]] = keys[placed]
            data = np.full((1 << bits, values.shape[1]), np.nan, np.float32)
            data[slot[placed]] = values[placed]
            self.levels.append((bits, there, data))
            keys, values = keys[~placed], values[~placed]

    @staticmethod
    def slots(keys: np.ndarray, bits: int, level: int) -> np.ndarray:
        return (keys * _FACTORS[level] >> np.uint64(64 - bits)).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """A row of values for every key, NaN for unknown ones."""
        out, rest = None, np.arange(len(keys))
        for level, (bits, there, data) in enumerate(self.levels):
            slot = self.slots(keys if out is None else keys[rest], bits, level)
            found = there[slot]
            got = data[slot]
            miss = found != (keys if out is None else keys[rest])
            got[miss] = np.nan
            if out is None:
                out = got
            else:
                out[rest] = got
            # An empty slot here means that no later level has the key either.
            rest = rest[miss & (found != 0)]
            if not len(rest):
                break
        return np.full((len(keys), 2), np.nan, np.float32) if out is None else out


def log_loss(codes: np.ndarray, at: np.ndarray, langs: np.ndarray, model: Lookup, order: int) -> np.ndarray:
    """Negative log probability of the characters at the given places; NaN without a model."""
    loss = np.zeros(len(at))
    rest = np.arange(len(at))
    for n in range(order, 0, -1):
        places, lang = at[rest], langs[rest]
        logp = model.get(gram_keys(codes, places, n, lang))[:, 0]
        hit = ~np.isnan(logp)
        loss[rest[hit]] -= logp[hit]
        rest, places, lang = rest[~hit], places[~hit], lang[~hit]
        if not len(rest):
            return loss
        weight = model.get(gram_keys(codes, places - 1, n - 1, lang))[:, 1]
        # An unseen context passes everything on; without an empty context there is no model.
        loss[rest] -= weight if n == 1 else np.nan_to_num(weight, nan=0.0)
    return loss


def _score(order: int, shard: int, shards: int, broadcast):
    schema = pa.schema([("doc_id", pa.int64()), ("lang", pa.string()), ("_hash", pa.int64()), ("_held", pa.bool_()),
                        ("nll", pa.float64()), ("n_chars", pa.int64())])
    pad = np.full(order, ord(START), np.uint32)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Lookup(*broadcast.value)
        for batch in batches:
            langs = [language_key(x) for x in batch.column("_lang").to_pylist()]
            total, size = np.zeros(len(langs)), np.zeros(len(langs), np.int64)

            def flush(rows: list[int], parts: list[np.ndarray], heads: list[int], langs=langs, total=total, size=size):
                codes = np.concatenate(parts)
                lengths = np.array([len(p) for p in parts])
                starts = np.cumsum(lengths) - lengths
                each = lengths - np.array(heads)
                owner = np.repeat(np.arange(len(parts)), each)
                at = np.arange(len(owner)) - np.repeat(np.cumsum(each) - each, each)
                at += np.repeat(starts + np.array(heads), each)
                if shards > 1:
                    mine = codes[at - 1] % shards == shard
                    at, owner = at[mine], owner[mine]
                loss = log_loss(codes, at, np.array([langs[r] for r in rows], np.uint64)[owner], model, order)
                np.add.at(total, rows, np.bincount(owner, loss, minlength=len(parts)))
                np.add.at(size, rows, np.bincount(owner, minlength=len(parts)))

            rows, parts, heads, held = [], [], [], 0
            for row, text in enumerate(batch.column("_text")):
                codes = code_points((text.as_py() or "").replace(START, " "))
                for start in range(0, len(codes), CHUNK):
                    head = pad if start == 0 else codes[start - order : start]
                    parts.append(np.concatenate([head, codes[start : start + CHUNK]]))
                    rows.append(row)
                    heads.append(order)
                    held += len(parts[-1])
                    if held >= CHUNK:
                        flush(rows, parts, heads)
                        rows, parts, heads, held = [], [], [], 0
            if parts:
                flush(rows, parts, heads)
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), batch.column("_lang"), batch.column("_hash"), batch.column("_held"),
                 pa.array(total), pa.array(size)], schema=schema)

    return score


def _entries(model: DataFrame) -> DataFrame:
    """The model with 64-bit keys, and of each entry the character that decides its shard."""
    schema = pa.schema([("key", pa.int64()), ("logp", pa.float32()), ("logg", pa.float32()),
                        ("gram_by", pa.int64()), ("context_by", pa.int64())])

    def entries(batches):
        for batch in batches:
            grams = batch.column("gram").to_pylist()
            langs = [language_key(x) for x in batch.column("lang").to_pylist()]
            keys = np.empty(len(grams), np.uint64)
            sizes = np.array([len(g) for g in grams])
            for n in np.unique(sizes):
                rows = np.flatnonzero(sizes == n)
                codes = code_points("".join(grams[r] for r in rows))
                at = (np.arange(len(rows)) + 1) * n - 1
                keys[rows] = gram_keys(codes, at, int(n), np.array([langs[r] for r in rows], np.uint64))
            by = [[ord(g[-k]) if len(g) >= k else None for g in grams] for k in (2, 1)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.view(np.int64)), batch.column("logp").cast(pa.float32()),
                 batch.column("logg").cast(pa.float32()), *(pa.array(b, pa.int64()) for b in by)], schema=schema)

    ddl = "key BIGINT, logp FLOAT, logg FLOAT, gram_by BIGINT, context_by BIGINT"
    return model.mapInArrow(entries, ddl)


def score_quality(
    docs: DataFrame,
    labels: DataFrame,
    order: int = ORDER,
    quantile: float = QUANTILE,
    slack: float = SLACK,
    shard_entries: int = SHARD_ENTRIES,
    id_column: str = "doc_id",
    text_column: str = "text",
    lang_column: str = "lang",
) -> DataFrame:
    """One row per row: ``doc_id, lang, n_chars, perplexity, threshold, kept, text_hash``.

    Trusted are documents whose labels all say quality 1 and toxic 0. Perplexity is per
    character. A document is kept unless it exceeds its language's threshold: the quantile of
    held-out trusted texts times ``slack``. Null and empty texts have no perplexity and are kept,
    as are texts of languages without trusted text; a null language is a language of its own.
    Rows with equal ids are scored one by one. Empty tables are fine; other columns are not read.
    """
    spark = docs.sparkSession
    trusted = labels.groupBy(F.col("doc_id").cast("bigint").alias("_id")).agg(
        (F.coalesce(F.min("quality") == 1, F.lit(False)) & F.coalesce(F.max("toxic") == 0, F.lit(False))).alias("_good")
    )
    trusted = small_side(saved(trusted.where("_good AND _id IS NOT NULL"), "trusted"))
    texts = docs.select(
        F.col(id_column).cast("bigint").alias("_id"),
        F.coalesce(F.col(lang_column).cast("string"), F.lit("")).alias("_lang"),
        F.col(text_column).alias("_text"),
        F.xxhash64(F.col(text_column)).alias("_hash"),
    )
    held = F.pmod(F.xxhash64("_id"), F.lit(HELD_OUT)) == 0
    taught = texts.where(~held).join(trusted, "_id", "left_semi").select("_lang", "_text")
    counts = taught.mapInArrow(_count(order), "lang STRING, gram STRING, n BIGINT")
    entries = saved(_entries(kneser_ney(counts, order)), "entries")

    texts = texts.join(trusted, "_id", "left").withColumn("_held", F.coalesce("_good", F.lit(False)) & held)
    texts = texts.select("_id", "_lang", "_hash", "_held", "_text")
    ddl = "doc_id BIGINT, lang STRING, _hash BIGINT, _held BOOLEAN, nll DOUBLE, n_chars BIGINT"
    shards = max(1, -(-entries.count() // shard_entries))
    passes = []
    for shard in range(shards):
        mine = entries
        if shards > 1:
            # The entries used for a character after another lie in the shard of that other one.
            gram = F.col("gram_by").isNull() | (F.col("gram_by") % shards == shard)
            context = F.col("context_by").isNull() | (F.col("context_by") % shards == shard)
            mine = entries.where(gram | context)
        part = mine.select("key", "logp", "logg").toArrow()
        values = np.stack([part[c].to_numpy().astype(np.float32) for c in ("logp", "logg")], 1)
        model = spark.sparkContext.broadcast((part["key"].to_numpy().view(np.uint64), values))
        passes.append(texts.mapInArrow(_score(order, shard, shards, model), ddl))
    scored = passes[0]
    for more in passes[1:]:
        scored = scored.unionByName(more)
    if shards > 1:
        # Rows alike in id and text add up alike, which their quotient does not see.
        scored = scored.groupBy("doc_id", "lang", "_hash", "_held").agg(
            F.sum("nll").alias("nll"), F.sum("n_chars").alias("n_chars")
        )
    scored = saved(scored.withColumn("nll", F.when((F.col("n_chars") > 0) & ~F.isnan("nll"), F.col("nll"))), "scored")
    known = scored.where("_held AND nll IS NOT NULL")
    means = known.groupBy("lang").agg((F.sum("nll") / F.sum("n_chars")).alias("_mean"))
    means = small_side(saved(means, "means"))
    smooth = (F.col("nll") + PRIOR_CHARS * F.col("_mean")) / (F.col("n_chars") + PRIOR_CHARS)
    rated = scored.join(means, "lang", "left").withColumn("_smooth", smooth)
    bounds = rated.where("_held").groupBy("lang").agg(F.percentile_approx("_smooth", quantile, 100_000).alias("_bound"))
    bounds = small_side(saved(bounds.where("_bound IS NOT NULL"), "bounds"))
    threshold = F.exp("_bound") * slack
    return rated.join(bounds, "lang", "left").select(
        "doc_id", "lang", "n_chars", F.exp("_smooth").alias("perplexity"), threshold.alias("threshold"),
        F.coalesce(F.exp("_smooth") <= threshold, F.lit(True)).alias("kept"), F.col("_hash").alias("text_hash"),
    )


def drop_low_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns."""
    gone = saved(score_quality(docs, labels).where("NOT kept").select("doc_id", "text_hash"), "rejected")
    return without(docs, gone, {"doc_id": F.col("doc_id").cast("bigint"), "text_hash": F.xxhash64("text")})
