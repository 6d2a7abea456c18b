"""Union, distinct, difference and deduplication."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from placepulse.operators.columns import fingerprint, row_identity, with_row_id
from placepulse.operators.filters import StepCounter, counted
from placepulse.operators.joins import lookup_join
from placepulse.session import durable


def union_sources(*tables: DataFrame) -> DataFrame:
    """All rows of all tables by column name; a column a table lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """The different values of a column."""
    return df.select(column).distinct()


def dedupe_reviews(
    df: DataFrame,
    keys: Sequence[str] = ("cleaned_text", "rating_review"),
    order: str = "review_id",
    steps: StepCounter | None = None,
) -> DataFrame:
    """Keep the first row, by ``order`` with nulls last, of those equal in ``keys``; null equals null.

    Rows stay whole, also where their order is null. Equal means equal in a 128-bit identity.

    ``df`` is read twice, so give it a table or rows that were kept. First only identities and
    ``order`` are shuffled, copies being combined before; the identities that repeat are kept with their
    first order. Then the rows are looked up there: without a shuffle of text if the list measures small. Rows that repeat
    with their order are told apart by a hash of their content, and only those meet once more.
    """
    keys, (first, second) = list(keys), fingerprint(*keys)
    named = df.withColumns({"_one": first, "_two": second})
    counts = named.groupBy("_one", "_two", order).agg(F.count(F.lit(1)).alias("_n"))
    groups = counts.groupBy("_one", "_two").agg(
        F.min(order).alias("_first"), F.sum("_n").alias("_rows"), F.max("_n").alias("_alike")
    )
    groups = durable(groups.where("_rows > 1").select("_one", "_two", "_first", (F.col("_alike") > 1).alias("_tied")))
    # The list has one row per identity, so these are the rows of ``df``.
    found = counted(steps, "input", lookup_join(named, groups, ["_one", "_two"], "left"))
    kept = found.where(F.col("_tied").isNull() | F.col(order).eqNullSafe(F.col("_first")))
    if groups.where("_tied").isEmpty():
        return counted(steps, "deduplicate", kept.select(*df.columns))
    place = Window.partitionBy("_one", "_two").orderBy(F.xxhash64(*df.columns))
    tied = kept.where("_tied").withColumn("_place", F.row_number().over(place)).where("_place = 1")
    alone = kept.where("NOT coalesce(_tied, false)").select(*df.columns)
    return counted(steps, "deduplicate", alone.unionByName(tied.select(*df.columns)))


def duplicate_count(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows in excess of the distinct rows. Only row identities are shuffled, not the rows."""
    identity = row_identity(*(columns or df.columns)).alias("_row")
    groups = df.groupBy(identity).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicates"))


def new_titles(scored: DataFrame, attractions: DataFrame) -> DataFrame:
    """Titles that are not yet among the attractions."""
    titles = scored.where(F.col("title").isNotNull()).select("title").distinct()
    return titles.join(attractions.select("title").distinct(), "title", "left_anti")


def extend_dimension(attractions: DataFrame, titles: DataFrame) -> DataFrame:
    """The attractions plus one row per new title, with the following ids in title order.

    The new ids are ranked within ranges of the sorted titles plus the sizes of the ranges
    before, so the titles are never brought into one task.
    """
    last = attractions.agg(F.coalesce(F.max("id"), F.lit(0)).alias("_last")).scalar()
    numbered = with_row_id(titles.select("title"), ["title"], "_rank")
    added = numbered.select((last + F.col("_rank") + 1).cast("bigint").alias("id"), "title")
    return attractions.select("id", "title").unionByName(added)

