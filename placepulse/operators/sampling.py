"""Exact-size sampling by a seeded hash of the row id.

Each row gets the key ``md5(seed-id)``: a fixed random order that does not depend on how the
data is partitioned and that another engine can reproduce. Taking the first ``q`` rows of a
class in that order needs no sort of the class. A histogram over the leading digits of the key
says in which bucket the ``q``-th row lies; a bucket too large to rank gets a histogram of its
own; the key found at the rank is a threshold, and every row is then kept or not by comparing its
own key with it. The data itself is never shuffled, however uneven the classes are.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from placepulse.schema import SEED
from placepulse.session import durable

BUCKET_DIGITS = 3  # hexadecimal digits per histogram: 4,096 buckets for each class
RANK_ROWS = 1_000_000  # a bucket with more rows than this is divided once more before ranking
CLASS_ROWS = 100_000  # up to here tables of one row per class and cut are broadcast
_NULL_GROUP = "\u0000"


def order_key(id_column: Column | str, seed: int = SEED) -> Column:
    """The seeded random position of a row."""
    column = F.col(id_column) if isinstance(id_column, str) else id_column
    return F.md5(F.concat(F.lit(f"{seed}-"), column.cast("string")))


def shuffle_rows(df: DataFrame, id_column: str, seed: int = SEED) -> DataFrame:
    """The rows in seeded random order, for a sink that keeps order."""
    return df.orderBy(order_key(id_column, seed), id_column)


def _group(label: Column) -> Column:
    return F.coalesce(label.cast("string"), F.lit(_NULL_GROUP))


def _histogram(df: DataFrame, group: Column, key: Column) -> DataFrame:
    """Rows per class and key bucket, kept: all later steps start from this small table."""
    counts = df.groupBy(group.alias("_g"), F.left(key, F.lit(BUCKET_DIGITS)).alias("_b"))
    return durable(counts.agg(F.count(F.lit(1)).alias("_n")))


def _edges(running: DataFrame, ranks: DataFrame, keys: Sequence[str], bucket: str) -> DataFrame:
    """For every cut the bucket that holds its rank, with the rank inside of the bucket."""
    upto = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, 0)
    ends = running.withColumn("_end", F.sum("_n").over(upto))
    before = F.col("_end") - F.col("_n")
    inside = (F.col("_rank") > before) & (F.col("_rank") <= F.col("_end"))
    found = ends.join(ranks, list(keys)).where(inside)
    rank = (F.col("_rank") - before).alias("_rank")
    return durable(found.select("_g", F.col(bucket).alias("_b"), "_cut", rank, "_n"))


def _thresholds(
    df: DataFrame, group: Column, key: Column, histogram: DataFrame, cuts: DataFrame
) -> DataFrame:
    """Key of the row at each cut.

    ``cuts`` has ``_g`` and one count per cut column; the result has ``_g`` and, under the same
    names, the key of the row with that rank (null for a cut of 0: no row is below it).
    """
    names = [name for name in cuts.columns if name != "_g"]
    pairs = [F.struct(F.lit(name).alias("_cut"), F.col(name).alias("_rank")) for name in names]
    edges = _edges(histogram, cuts.select("_g", F.inline(F.array(*pairs))), ["_g"], "_b")
    digits = BUCKET_DIGITS
    keyed = df.select(group.alias("_g"), key.alias("_k"))

    def near(digits: int) -> DataFrame:
        return keyed.withColumn("_b", F.left("_k", F.lit(digits)))

    # One row per class and cut. Measured here, and an upper bound for all tables below.
    measured = edges.agg(F.count(F.lit(1)).alias("rows"), F.max("_n").alias("largest")).first()
    small = F.broadcast if measured["rows"] <= CLASS_ROWS else (lambda table: table)
    while (measured["largest"] or 0) > RANK_ROWS:
        inner = near(digits).join(small(edges.select("_g", "_b").distinct()), ["_g", "_b"])
        digits += BUCKET_DIGITS
        finer = inner.groupBy("_g", "_b", F.left("_k", F.lit(digits)).alias("_b2"))
        ranks = edges.select("_g", "_b", "_cut", "_rank")
        edges = _edges(finer.agg(F.count(F.lit(1)).alias("_n")), ranks, ["_g", "_b"], "_b2")
        measured = edges.agg(F.max("_n").alias("largest")).first()

    within = Window.partitionBy("_g", "_cut").orderBy("_k")
    found = (
        near(digits)
        .join(small(edges.drop("_n")), ["_g", "_b"])
        .withColumn("_rn", F.row_number().over(within))
        .where("_rn = _rank")
        .groupBy("_g")
        .agg(*[F.max(F.when(F.col("_cut") == name, F.col("_k"))).alias(name) for name in names])
    )
    return small(durable(found))


def _class_counts(histogram: DataFrame) -> DataFrame:
    return histogram.groupBy("_g").agg(F.sum("_n").alias("_n"))


def balance_classes(
    df: DataFrame, label: str, id_column: str = "review_id", seed: int = SEED
) -> DataFrame:
    """As many rows of every class as the smallest class has; rows without a label are dropped.

    ``id_column`` must be unique.
    """
    labelled = df.where(F.col(label).isNotNull())
    group, key = _group(F.col(label)), order_key(id_column, seed)
    histogram = _histogram(labelled, group, key)
    counts = _class_counts(histogram)
    smallest = counts.agg(F.min("_n").alias("_min")).scalar()
    cuts = counts.select("_g", smallest.alias("_keep"))
    limits = _thresholds(labelled, group, key, histogram, cuts)
    joined = labelled.withColumn("_g", group).join(limits, "_g")
    return joined.where(key <= F.col("_keep")).select(*df.columns)


def _shares(counts: DataFrame, part: Column | int, total: Column | int) -> DataFrame:
    """Split ``part`` rows over the classes in proportion; ``_q`` rows for each.

    Every class gets the whole part of its share and the largest fractions get the rest, equal
    fractions in label order. One row per class, so one task is enough for the ranking.
    """
    exact = counts.withColumn("_part", F.lit(part)).withColumn("_total", F.lit(total))
    whole = F.floor(F.col("_n") * F.col("_part") / F.col("_total"))
    split = exact.withColumn("_whole", whole).withColumn(
        "_rest", F.col("_n") * F.col("_part") - F.col("_whole") * F.col("_total")
    )
    everything = Window.partitionBy(F.lit(1))
    largest = everything.orderBy(F.col("_rest").desc(), "_g")
    left_over = F.col("_part") - F.sum("_whole").over(everything)
    bonus = (F.row_number().over(largest) <= left_over).cast("bigint")
    return split.select("_g", "_n", (F.col("_whole") + bonus).alias("_q"))


def split_sizes(n: int, test_size: float = 0.2, val_size: float = 0.1) -> tuple[int, int, int]:
    """Rows for training, validation and test. The held-out part is rounded up, twice."""
    held_out = math.ceil((test_size + val_size) * n)
    test = math.ceil(test_size / (test_size + val_size) * held_out)
    return n - held_out, held_out - test, test


def stratified_split(
    df: DataFrame,
    label: str,
    test_size: float = 0.2,
    val_size: float = 0.1,
    seed: int = SEED,
    id_column: str = "review_id",
) -> DataFrame:
    """Add ``split``: ``train``, ``validation`` or ``test``, in exact sizes and class shares.

    Two stages: training against the rest, then validation against test. A stage in which some
    class has fewer than two rows is not stratified. ``id_column`` must be unique.
    """
    key = order_key(id_column, seed)
    histogram = _histogram(df, _group(F.col(label)), key)
    counts = durable(_class_counts(histogram))
    size = counts.agg(F.sum("_n").alias("n"), F.min("_n").alias("low"), F.count(F.lit(1)).alias("classes")).first()
    if size["classes"] > CLASS_ROWS:  # the shares of all classes are ranked in one task
        raise ValueError(f"{size['classes']} classes in {label!r}; at most {CLASS_ROWS} can share a split")
    if not size["n"]:
        return df.withColumn("split", F.lit(None).cast("string"))
    n_train, n_val, n_test = split_sizes(size["n"], test_size, val_size)

    if size["low"] < 2:
        cuts = _whole_table(df, n_train, n_train + n_val)
        histogram = _one_group(histogram)
        return _assign(df, F.lit(""), key, histogram, cuts)

    train = durable(_shares(counts, n_train, size["n"]))
    rest = train.select("_g", (F.col("_n") - F.col("_q")).alias("_n")).where("_n > 0")
    lowest = rest.agg(F.min("_n").alias("low")).first()["low"]
    if lowest is None or lowest >= 2:
        val = _shares(rest, n_val, n_val + n_test).select("_g", F.col("_q").alias("_v"))
        cuts = train.join(val, "_g", "left").select(
            "_g", F.col("_q").alias("_train"), (F.col("_q") + F.coalesce("_v", F.lit(0))).alias("_val")
        )
        return _assign(df, _group(F.col(label)), key, histogram, cuts)

    # Stratified training set, plain second stage over what is left.
    cuts = train.select("_g", F.col("_q").alias("_train"))
    limits = _thresholds(df, _group(F.col(label)), key, histogram, cuts)
    marked = df.withColumn("_g", _group(F.col(label))).join(limits, "_g", "left")
    marked = marked.withColumn("_in", F.coalesce(key <= F.col("_train"), F.lit(False)))
    held = marked.where(~F.col("_in"))
    held_histogram = _histogram(held, F.lit(""), key)
    val_limit = _thresholds(held, F.lit(""), key, held_histogram, _whole_table(df, n_val)).select("_train").scalar()
    in_val = F.coalesce(key <= val_limit, F.lit(False))
    split = F.when(F.col("_in"), "train").when(in_val, "validation").otherwise("test")
    return marked.select(*df.columns, split.alias("split"))


def _whole_table(df: DataFrame, *ranks: int) -> DataFrame:
    names = ("_train", "_val")[: len(ranks)]
    cells = ", ".join(f"CAST({rank} AS BIGINT) AS {name}" for rank, name in zip(ranks, names, strict=True))
    return df.sparkSession.sql(f"SELECT '' AS _g, {cells}")


def _one_group(histogram: DataFrame) -> DataFrame:
    merged = histogram.groupBy(F.lit("").alias("_g"), "_b").agg(F.sum("_n").alias("_n"))
    return durable(merged)


def _assign(df: DataFrame, group: Column, key: Column, histogram: DataFrame, cuts: DataFrame) -> DataFrame:
    limits = _thresholds(df, group, key, histogram, cuts)
    joined = df.withColumn("_g", group).join(limits, "_g", "left")
    split = F.when(key <= F.col("_train"), "train").when(key <= F.col("_val"), "validation").otherwise("test")
    return joined.select(*df.columns, split.alias("split"))


def split_tables(split: DataFrame, names: Sequence[str] = ("train", "validation", "test")) -> dict[str, DataFrame]:
    """The parts of a split table as separate tables."""
    return {name: split.where(F.col("split") == name).drop("split") for name in names}
