"""Five-star labelling and pluggable batch scorers."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placepulse.functions.text import is_blank, words
from placepulse.operators.columns import fingerprint
from placepulse.operators.joins import BROADCAST_BYTES, BROADCAST_ROWS, fits_broadcast, lookup_join
from placepulse.schema import NO_TEXT_LABEL
from placepulse.session import durable

LITERAL_WORDS = 10_000
NEUTRAL_STARS = 3
SCORER_BATCH = 16


def fit_lexicon(
    df: DataFrame, text: str = "cleaned_text", rating: str = "rating_review", size: int | None = None
) -> DataFrame:
    """Star value of every word, or the ``size`` most frequent: the rounded mean rating of the texts using it."""
    rated = df.where(F.col(rating).between(1, 5))
    used = rated.select(rating, F.explode(F.array_distinct(words(F.col(text)))).alias("word"))
    means = used.groupBy("word").agg(F.count(F.lit(1)).alias("n"), F.avg(rating).alias("mean"))
    kept = means if size is None else means.orderBy(F.col("n").desc(), "word").limit(size)
    return kept.select("word", F.round("mean").cast("int").alias("stars"))


def _among(level: list[str]) -> Callable[[Column], Column]:
    return lambda word: word.isin(level)


def _rounded(total: Column, n: Column) -> Column:
    mean = F.floor(total / n + F.lit(0.5)).cast("int")
    return F.when(n > 0, F.greatest(F.lit(1), F.least(F.lit(5), mean))).otherwise(NEUTRAL_STARS)


def score_stars(
    df: DataFrame,
    lexicon: DataFrame,
    text: str = "cleaned_text",
    output: str = "predicted_rating",
) -> DataFrame:
    """Add a 1..5 rating: the mean star value of the known words, 3 when none is known.

    ``lexicon`` has one row ``(word, stars)`` per word, stars 1..5; it is computed once and kept. A
    lexicon of up to ``LITERAL_WORDS`` words becomes five hash sets inside the expression, so scoring
    is a projection without a shuffle. A larger one is joined word by word, with equal results:
    neither way looks at ids, so repeated and null ids are rows like others.
    """
    entries = lexicon.where(F.col("stars").between(1, 5)).groupBy("word").agg(F.max("stars").alias("stars"))
    entries = durable(entries)
    listed = entries.limit(LITERAL_WORDS + 1).collect()
    if len(listed) > LITERAL_WORDS:
        return _score_by_join(df, entries, text, output)
    levels = {stars: [row["word"] for row in listed if row["stars"] == stars] for stars in range(1, 6)}
    # In steps, so that the words are split once and every level is counted once.
    hits = {
        f"_hits{stars}": F.size(F.filter("_words", _among(level))) if level else F.lit(0)
        for stars, level in levels.items()
    }
    counted = df.withColumn("_words", words(F.coalesce(F.col(text), F.lit("")))).withColumns(hits)
    total = sum((F.col(f"_hits{stars}") * stars for stars in levels), F.lit(0))
    known = sum((F.col(f"_hits{stars}") for stars in levels), F.lit(0))
    sums = counted.select(*df.columns, total.alias("_total"), known.alias("_known"))
    return sums.select(*df.columns, _rounded(F.col("_total"), F.col("_known")).alias(output))


def _score_by_join(df: DataFrame, entries: DataFrame, text: str, output: str) -> DataFrame:
    """Scores per different text, by its 128-bit identity: copies of a text raise both sums alike."""
    one, two = fingerprint(text)
    keyed = df.withColumns({"_one": one, "_two": two})
    used = keyed.select("_one", "_two", F.explode(words(F.col(text))).alias("word"))
    # The words of a text are in one task, so their sums are a row per text when they travel.
    sums = _starred(used, entries).groupBy("_one", "_two").agg(
        F.sum("stars").alias("_total"), F.count(F.lit(1)).alias("_known")
    )
    joined = lookup_join(keyed, durable(sums), ["_one", "_two"], "left")
    known = F.coalesce("_known", F.lit(0))
    return joined.select(*df.columns, _rounded(F.coalesce("_total", F.lit(0)), known).alias(output))


def _starred(used: DataFrame, entries: DataFrame) -> DataFrame:
    """``_one, _two, stars`` of every use of a known word.

    A lexicon that measures small is broadcast. Of a larger one the words most used in these texts are, known or not, which
    are most of the uses; only uses of the other words are shuffled, none of which is used often enough to be a hot key.
    """
    if fits_broadcast(entries):
        return used.join(F.broadcast(entries), "word").select("_one", "_two", "stars")
    counts = used.groupBy("word").agg(F.length(F.bin(F.count(F.lit(1)))).alias("_level"))
    found = durable(counts.join(entries, "word", "left"))
    level = _broadcast_level(found)
    often, rest = found.where(F.col("_level") >= level), found.where((F.col("_level") < level) & F.col("stars").isNotNull())
    near = used.join(F.broadcast(often.where("stars IS NOT NULL").select("word", "stars")), "word")
    others = used.join(F.broadcast(often.select("word")), "word", "left_anti")
    far = others.join(rest.select("word", "stars"), "word")
    return near.select("_one", "_two", "stars").unionByName(far.select("_one", "_two", "stars"))


def _broadcast_level(found: DataFrame) -> int:
    """The least level, the binary digits of a word's uses, from which on all words can be broadcast together."""
    width = F.octet_length("word") + F.lit(8)
    # At most 64 rows.
    levels = found.groupBy("_level").agg(F.count(F.lit(1)).alias("rows"), F.sum(width).alias("bytes")).collect()
    rows, size, least = BROADCAST_ROWS, BROADCAST_BYTES, 65
    for found_at in sorted(levels, key=lambda row: -row["_level"]):
        rows, size = rows - found_at["rows"], size - found_at["bytes"]
        if rows < 0 or size < 0:
            break
        least = found_at["_level"]
    return least


def score_with(
    df: DataFrame,
    loader: Callable[[], Callable[[list[str]], list[str]]],
    text: str = "full_review",
    output: str = "predicted_sentiment",
    batch_size: int = SCORER_BATCH,
) -> DataFrame:
    """Label text with any model: ``loader`` is called once per task and returns a batch function.

    Only the text crosses to Python and only the label comes back. A blank text never reaches
    the model and is labelled ``No Text``.
    """

    @F.pandas_udf("string")
    def label(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = loader()
        for texts in batches:
            labels: list[str | None] = [None] * len(texts)
            wanted = [(at, value) for at, value in enumerate(texts) if value is not None]
            for start in range(0, len(wanted), batch_size):
                chunk = wanted[start : start + batch_size]
                answers = model([value for _, value in chunk])
                for (at, _), answer in zip(chunk, answers, strict=True):
                    labels[at] = answer
            yield pd.Series(labels, dtype="object")

    blank = is_blank(F.col(text))
    scored = df.withColumn("_label", label(F.when(~blank, F.col(text))))
    return scored.select(*df.columns, F.when(blank, NO_TEXT_LABEL).otherwise(F.col("_label")).alias(output))
