"""Aggregates and data profiles. Each is one pass with map-side partial aggregation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placepulse.functions.labels import sentiment3
from placepulse.functions.text import text_length, word_count
from placepulse.operators.sets import duplicate_count
from placepulse.schema import LABELS, label_to_id
from placepulse.session import durable

IMBALANCE_THRESHOLD = 3
SHORT_TEXT, LONG_TEXT = 10, 2000
# Thresholds of the findings; only their outcome on one data set is known, so these are choices.
LARGE_DATASET_ROWS = 100_000
LOW_NEGATIVE_PCT = 10.0


def _counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("count"))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, most frequent first; nulls are not counted."""
    counts = _counts(df.where(F.col(column).isNotNull()), column)
    return counts.orderBy(F.col("count").desc(), column)


def class_distribution(df: DataFrame, column: str) -> DataFrame:
    """Rows and percent per value. Null rows have no line but count in the total.

    The total is summed from the counts, so the table is read once.
    """
    counts = _counts(df, column)
    total = counts.agg(F.sum("count").alias("_total")).scalar()
    share = F.round(F.col("count") / total * 100, 1)
    shares = counts.where(F.col(column).isNotNull()).withColumn("pct", share)
    return shares.orderBy(F.col("count").desc(), column)


def rating_distribution(df: DataFrame, column: str = "rating_review") -> DataFrame:
    """Rows and percent per rating, in rating order."""
    return class_distribution(df, column).orderBy(column)


def imbalance(df: DataFrame, column: str, threshold: float = IMBALANCE_THRESHOLD) -> DataFrame:
    """Largest and smallest class present, their ratio, and whether it exceeds the threshold."""
    counts = _counts(df.where(F.col(column).isNotNull()), column)
    ends = counts.agg(F.max("count").alias("max_class"), F.min("count").alias("min_class"))
    ratio = F.col("max_class") / F.col("min_class")
    return ends.select(
        "max_class",
        "min_class",
        F.round(ratio, 6).alias("imbalance_ratio"),
        (ratio > threshold).alias("imbalanced"),
    )


def describe_numeric(df: DataFrame, columns: Sequence[str], exact: bool = True) -> DataFrame:
    """Count, mean, sample deviation, minimum, quartiles and maximum per column.

    Exact quartiles keep one counter per distinct value, which suits ratings, lengths and
    counts. For free-form doubles ask for approximate ones.
    """
    points = F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))
    quartiles = F.percentile if exact else F.percentile_approx
    summaries = df.agg(
        *[
            F.struct(
                F.count(name).alias("count"),
                F.avg(name).alias("mean"),
                F.stddev_samp(name).alias("std"),
                F.min(name).cast("double").alias("min"),
                quartiles(F.col(name), points).alias("q"),
                F.max(name).cast("double").alias("max"),
            ).alias(name)
            for name in columns
        ]
    )
    rows = F.array(*[F.struct(F.lit(name).alias("column"), F.col(name).alias("s")) for name in columns])
    flat = summaries.select(F.inline(rows))

    def rounded(value: str) -> Column:
        return F.round(F.expr(value).cast("double"), 6)

    return flat.select(
        "column",
        F.col("s.count").alias("count"),
        rounded("s.mean").alias("mean"),
        rounded("s.std").alias("std"),
        rounded("s.min").alias("min"),
        rounded("s.q[0]").alias("p25"),
        rounded("s.q[1]").alias("p50"),
        rounded("s.q[2]").alias("p75"),
        rounded("s.max").alias("max"),
    )


def length_stats(df: DataFrame, column: str = "cleaned_text") -> DataFrame:
    """Mean and median text length."""
    length = F.length(F.col(column))
    return df.agg(
        F.round(F.avg(length), 6).alias("mean_length"),
        F.round(F.median(length), 6).alias("median_length"),
    )


def length_by(df: DataFrame, key: str = "rating_review", length: str = "text_length") -> DataFrame:
    """Mean, median and deviation of the length per key, one decimal."""
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(
            F.round(F.avg(length), 1).alias("mean"),
            F.round(F.median(length), 1).alias("median"),
            F.round(F.stddev_samp(length), 1).alias("std"),
        )
        .orderBy(key)
    )


def _per_column(df: DataFrame, measure) -> DataFrame:
    """One pass over all columns, turned into a row per column ``(column, n, rows)``."""
    counted = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[measure(F.col(f"`{name}`")).alias(f"_{i}") for i, name in enumerate(df.columns)],
    )
    rows = [
        F.struct(F.lit(name).alias("column"), F.lit(dtype).alias("type"), F.col(f"_{i}").alias("n"), F.col("_rows").alias("rows"))
        for i, (name, dtype) in enumerate(df.dtypes)
    ]
    return counted.select(F.inline(F.array(*rows)))


def missing_report(df: DataFrame) -> DataFrame:
    """Null count and percent per column; columns without nulls are left out."""
    nulls = _per_column(df, lambda c: F.count_if(c.isNull())).where("n > 0")
    return nulls.select(
        "column",
        F.col("n").alias("missing_count"),
        F.round(F.col("n") / F.col("rows") * 100, 6).alias("missing_pct"),
    )


def profile(df: DataFrame) -> DataFrame:
    """Name, type and non-null count per column, with the shape of the table."""
    return _per_column(df, F.count).select(
        "column",
        "type",
        F.col("n").alias("non_null"),
        F.col("rows").alias("total_rows"),
        F.lit(len(df.columns)).alias("total_columns"),
    )


def quality_indicators(
    df: DataFrame,
    text: str = "cleaned_text",
    rating: str = "rating_review",
    duplicate_columns: Sequence[str] | None = None,
    length: Column | None = None,
) -> DataFrame:
    """Duplicate rows, ratings outside 1..5, very short and very long texts.

    Give ``length`` where the table has the text length instead of the text.
    """
    length = F.length(F.col(text)) if length is None else length
    duplicates = duplicate_count(df, duplicate_columns or [text, rating]).scalar()
    measured = df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(~F.col(rating).between(1, 5)).alias("invalid_ratings"),
        F.count_if(length < SHORT_TEXT).alias("very_short"),
        F.count_if(length > LONG_TEXT).alias("very_long"),
    )
    return measured.select(
        "total_rows",
        duplicates.alias("duplicate_rows"),
        F.round(duplicates / F.col("total_rows") * 100, 2).alias("duplicate_pct"),
        "invalid_ratings",
        "very_short",
        "very_long",
    )


def findings(
    df: DataFrame,
    text: str = "cleaned_text",
    rating: str = "rating_review",
    duplicate_columns: Sequence[str] | None = None,
    length: Column | None = None,
) -> DataFrame:
    """What to do before training: one row for each rule the profile triggers."""
    quality = quality_indicators(df, text, rating, duplicate_columns, length)
    # Three classes at most, so this side is one row whatever the size of the table.
    classes = df.groupBy(sentiment3(F.col(rating)).alias("class")).agg(F.count(F.lit(1)).alias("n"))
    return findings_from(quality, classes)


def findings_from(quality: DataFrame, classes: DataFrame) -> DataFrame:
    """The findings of quality indicators (one row) and rows ``n`` per sentiment ``class``, null included."""
    summary = classes.agg(
        F.max(F.when(F.col("class").isNotNull(), F.col("n"))).alias("top"),
        F.min(F.when(F.col("class").isNotNull(), F.col("n"))).alias("low"),
        (
            F.sum(F.when(F.col("class") == "Negative", F.col("n")).otherwise(0)) / F.sum("n") * 100
        ).alias("negative_pct"),
    )
    ratio = summary.select(F.col("top") / F.col("low")).scalar()
    negative = summary.select("negative_pct").scalar()
    rules = [
        ("class imbalance", ratio > IMBALANCE_THRESHOLD),
        ("extreme text lengths", (F.col("very_short") > 0) | (F.col("very_long") > 0)),
        ("duplicate entries", F.col("duplicate_rows") > 0),
        ("large data set", F.col("total_rows") > LARGE_DATASET_ROWS),
        ("few negative samples", negative < LOW_NEGATIVE_PCT),
    ]
    rows = [F.struct(F.lit(name).alias("finding"), hit.alias("hit")) for name, hit in rules]
    return quality.select(F.inline(F.array(*rows))).where("hit").select("finding")


def profile_cube(
    df: DataFrame, text: str = "cleaned_text", rating: str = "rating_review", identity: Sequence[Column] = ()
) -> DataFrame:
    """Counts from which the whole profile follows, made in one pass over the table and kept.

    Rows are combined by identity and measures, then counted by two grouping sets: rating with text length
    (``words`` null) and word count (``sets`` tells which). ``n`` counts rows, ``different`` identities, ``_null_i`` the nulls
    of column ``i``. Only numbers are shuffled; the result has a row per length and rating, and
    one per word count.
    """
    nulls = [F.col(f"`{name}`").isNull().cast("bigint").alias(f"_null_{i}") for i, name in enumerate(df.columns)]
    sums = [f"_null_{i}" for i in range(len(nulls))]
    measured = df.select(
        *(c.alias(f"_id_{i}") for i, c in enumerate(identity)), F.col(rating).alias("rating"),
        text_length(F.col(text)).alias("length"), word_count(F.col(text)).alias("words"), *nulls,
    )
    keys = [*(f"_id_{i}" for i in range(len(identity))), "rating", "length", "words"]
    rows = measured.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *(F.sum(c).alias(c) for c in sums))
    sets = rows.groupingSets([["rating", "length"], ["words"]], "rating", "length", "words")
    counts = sets.agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("different"), *(F.sum(c).alias(c) for c in sums), F.grouping("words").alias("lengths")
    )
    return durable(counts.withColumn("lengths", F.col("lengths") == 1))


def describe_counted(counts: DataFrame, column: str, name: str | None = None, n: str = "n") -> DataFrame:
    """``describe_numeric`` of one column from a table of values and how often each occurs."""
    some = counts.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("v")).agg(F.sum(n).alias("n"))
    points = F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))
    value = F.col("v").cast("double")
    # The deviation in two steps: sums of squares lose digits where the mean is large.
    mean = some.agg(F.sum(F.col("n") * value) / F.sum("n")).scalar()
    summary = some.withColumn("mean", mean).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("count"),
        F.max("mean").alias("mean"),
        F.sqrt(F.sum(F.col("n") * (value - F.col("mean")) ** 2) / F.nullif(F.sum("n") - 1, F.lit(0))).alias("std"),
        F.min(value).alias("min"),
        F.percentile(F.col("v"), points, F.col("n")).alias("q"),
        F.max(value).alias("max"),
    )
    cells = {"mean": F.col("mean"), "std": F.col("std"), "min": F.col("min"), "max": F.col("max")}
    cells |= {p: F.col("q")[i] for i, p in enumerate(("p25", "p50", "p75"))}
    rounded = [F.round(cells[c], 6).alias(c) for c in ("mean", "std", "min", "p25", "p50", "p75", "max")]
    return summary.select(F.lit(name or column).alias("column"), "count", *rounded)


def temporal_profile(df: DataFrame) -> DataFrame:
    """Rows per month of the first date or timestamp column; no rows if the table has none."""
    dated = [
        field.name
        for field in df.schema.fields
        if isinstance(field.dataType, T.DateType | T.TimestampType | T.TimestampNTZType)
    ]
    if not dated:
        empty = T.StructType(
            [
                T.StructField("date_column", T.StringType()),
                T.StructField("month", T.StringType()),
                T.StructField("count", T.LongType()),
            ]
        )
        return df.sparkSession.createDataFrame([], empty)
    name = dated[0]
    months = df.where(F.col(name).isNotNull()).groupBy(F.date_format(name, "yyyy-MM").alias("month"))
    counts = months.agg(F.count(F.lit(1)).alias("count"))
    return counts.select(F.lit(name).alias("date_column"), "month", "count").orderBy("month")


def label_audit(df: DataFrame, column: str = "predicted_sentiment_label", examples: int = 5) -> DataFrame:
    """How many labels are outside the vocabulary, with the first few different ones."""
    invalid = df.where(label_to_id(F.col(column)).isNull())
    values = invalid.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    total = values.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).scalar()
    shown = values.where(F.col(column).isNotNull()).orderBy(column).limit(examples)
    return shown.agg(
        total.alias("invalid_labels"),
        F.array_join(F.sort_array(F.collect_list(column)), "|").alias("examples"),
    )


def sentiment_stats(attractions: DataFrame, reviews: DataFrame) -> DataFrame:
    """Reviews per class for every attraction, those without reviews included.

    The reviews are counted before the join, so a place with most of the reviews is one row.
    """
    stat = {name: name.lower().replace(" ", "_") for name in LABELS}
    counts = reviews.groupBy(F.col("attraction_id").alias("id")).agg(
        *[F.count_if(F.col("predicted_sentiment") == name).alias(alias) for name, alias in stat.items()],
        F.count(F.lit(1)).alias("total"),
    )
    joined = attractions.select("id").distinct().join(counts, "id", "left")
    zero_filled = [F.coalesce(F.col(c), F.lit(0)).alias(c) for c in [*stat.values(), "total"]]
    return joined.select(F.col("id").alias("attraction_id"), *zero_filled)


def top_k(df: DataFrame, column: str, k: int) -> DataFrame:
    """The ``k`` most frequent values."""
    return value_counts(df, column).limit(k)
