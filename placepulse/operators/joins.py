"""Joins and lookups that hold up when one key has a large share of the rows.

A side is broadcast only after its size was measured. Beyond the limit the join is shuffled and
the hot keys are salted: their rows on the large side are spread over several partitions and
their (already distinct) rows on the other side are repeated for each.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placepulse.operators.columns import fingerprint
from placepulse.schema import label_to_id
from placepulse.session import durable

BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 * 1024 * 1024
HOT_SHARE = 1 / 1000
SALTS = 64


def fits_broadcast(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> bool:
    """Whether a table is small enough to send to every executor, by measuring it."""
    width = F.lit(0)
    for field in df.schema.fields:
        if isinstance(field.dataType, T.StringType):
            width = width + F.coalesce(F.octet_length(F.col(field.name)), F.lit(0))
        else:
            width = width + F.lit(8)
    measured = df.agg(
        F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(width), F.lit(0)).alias("bytes")
    ).first()
    return measured["rows"] <= rows and measured["bytes"] <= size


def hot_keys(df: DataFrame, key: str, share: float = HOT_SHARE) -> DataFrame:
    """Keys holding more than ``share`` of the rows: at most ``1 / share`` of them by counting."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n").alias("_total")).scalar()
    return durable(counts.where(F.col("_n") > total * share).select(key))


def salted_join(
    big: DataFrame, small: DataFrame, on: Sequence[str], how: str, salts: int = SALTS
) -> DataFrame:
    """Equi join of any size; nulls never match.

    ``small`` is made distinct first, so many copies of one of its rows travel as one. The key
    is shuffled as a 64-bit hash next to the values themselves, so comparing long text is left
    to rows whose hashes agree. The salt of a hot row is the number of the partition it is read
    from, which a re-run task sees again.
    """
    on = list(on)
    left = big.withColumn("_key", F.xxhash64(*on))
    right = small.select(F.xxhash64(*on).alias("_key"), *small.columns).distinct()
    hot = hot_keys(left.select("_key"), "_key")
    if hot.isEmpty():
        return left.join(right, ["_key", *on], how).drop("_key")
    hot = F.broadcast(hot.withColumn("_hot", F.lit(True)))
    salt = F.when(F.col("_hot"), F.spark_partition_id() % salts).otherwise(0)
    copies = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    left = left.join(hot, "_key", "left").withColumn("_salt", salt).drop("_hot")
    right = right.join(hot, "_key", "left").withColumn("_salt", F.explode(copies)).drop("_hot")
    return left.join(right, ["_key", "_salt", *on], how).drop("_key", "_salt")


def lookup_join(big: DataFrame, small: DataFrame, on: Sequence[str], how: str) -> DataFrame:
    """Join with a table of one row per key: broadcast if it measures small, else salted.

    Rows of ``small`` that repeat count once on either way.
    """
    small = small.distinct()
    if fits_broadcast(small):
        return big.join(F.broadcast(small), list(on), how)
    return salted_join(big, small, on, how)


def new_reviews(
    batch: DataFrame, existing: DataFrame, keys: Sequence[str] = ("text_review", "source")
) -> DataFrame:
    """Rows of the batch whose key is not among the existing ones.

    Copies inside the batch all stay. ``batch`` is read more than once, so give it a table or rows that were kept.
    """
    return _by_identity(batch, existing, keys, "left_anti")


def known_reviews(
    batch: DataFrame, existing: DataFrame, keys: Sequence[str] = ("text_review", "source")
) -> DataFrame:
    """The other rows of the batch: those whose key is among the existing ones. A key with a null never is."""
    return _by_identity(batch, existing, keys, "left_semi")


def _by_identity(batch: DataFrame, existing: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Look rows up by a 128-bit identity of their key, so that of the existing rows and, for a list that measures
    small, of the batch no text is shuffled. A longer list is first cut to what the batch asks for."""
    pair = ["_one", "_two"]
    identities = [F.when(_all_present(keys), value).alias(name) for name, value in zip(pair, fingerprint(*keys), strict=True)]
    known = durable(existing.where(_all_present(keys)).select(*identities).distinct())
    named = batch.select(*batch.columns, *identities)
    if not fits_broadcast(known):
        known = durable(known.join(named.select(*pair).distinct(), pair, "left_semi"))
    return lookup_join(named, known, pair, how).select(*batch.columns)


def _all_present(keys: Sequence[str]) -> Column:
    condition = F.lit(True)
    for key in keys:
        condition = condition & F.col(key).isNotNull()
    return condition


def attach_attraction_id(scored: DataFrame, attractions: DataFrame) -> DataFrame:
    """Attraction id by exact title; rows without one, or with id 0, are left out.

    Of several ids for a title the highest is taken.
    """
    dimension = attractions.groupBy("title").agg(F.max("id").alias("attraction_id"))
    dimension = dimension.where(F.col("title").isNotNull() & (F.col("attraction_id") != 0))
    return lookup_join(scored, dimension, ["title"], "inner")


def normalize_titles(df: DataFrame, aliases: DataFrame) -> DataFrame:
    """Replace titles found among the aliases, once; other titles are unchanged."""
    mapping = (
        aliases.where(F.col("from_title").isNotNull())
        .groupBy(F.col("from_title").alias("title"))
        .agg(F.max("to_title").alias("_to"))
    )
    joined = lookup_join(df, mapping, ["title"], "left")
    titled = joined.withColumn("title", F.coalesce("_to", "title"))
    return titled.select(*df.columns)


def encode_labels(df: DataFrame, column: str = "predicted_sentiment_label") -> DataFrame:
    """Add ``labels_id``; null for a label outside the vocabulary."""
    return df.withColumn("labels_id", label_to_id(F.col(column)))
