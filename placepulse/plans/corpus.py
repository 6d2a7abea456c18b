"""Corpus preparation: merge, clean, profile, label, prepare training data."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from placepulse.functions.labels import sentiment3, sentiment_label
from placepulse.functions.text import clean_again, clean_text, text_length, word_count
from placepulse.operators import profiling
from placepulse.operators.columns import resolve_text_column, select_columns, with_place_id, with_row_id
from placepulse.operators.filters import StepCounter, counted, derive_and_keep, filter_language, filter_text_length
from placepulse.operators.language import LanguageModel, detect_language
from placepulse.operators.sampling import balance_classes, split_tables, stratified_split
from placepulse.operators.sets import dedupe_reviews, fingerprint, union_sources
from placepulse.operators.stars import score_stars
from placepulse.schema import CLEANED_MIN_EXCLUSIVE, SEED, TEXT_MIN
from placepulse.session import durable, job_scratch
from placepulse.sources.files import read_reviews_csv, write_csv

MERGED_COLUMNS = ("text_review", "rating_review")


@dataclass(frozen=True)
class CsvSource:
    """One delivery of review files."""

    path: str
    encoding: str = "UTF-8"


def merge_tables(tables: Sequence[DataFrame]) -> DataFrame:
    """Text and rating of all review tables."""
    return union_sources(*[select_columns(table, MERGED_COLUMNS) for table in tables])


def merge_reviews(
    spark: SparkSession, sources: Sequence[CsvSource], output: str | None = None, ids: str = "order"
) -> DataFrame:
    """Read the review files, keep text and rating, give every row an id; optionally write CSV.

    Ids follow the ``order`` of text and rating, which sorts the texts, or the ``place`` of the row in the files, source
    after source, for which no row is moved.
    """
    if ids not in ("order", "place"):
        raise ValueError(f"ids must be order or place, not {ids!r}")
    tables = [read_reviews_csv(spark, source.path, encoding=source.encoding) for source in sources]
    merged = merge_tables(tables)
    by_order = ids == "order"
    merged = with_row_id(merged, list(MERGED_COLUMNS), "review_id") if by_order else with_place_id(merged, "review_id")
    if output:
        write_csv(merged, output)
    return merged


@dataclass(frozen=True)
class Cleaned:
    """Clean reviews in one language, and the language distribution of all reviews."""

    reviews: DataFrame
    languages: DataFrame


def clean_and_keep(df: DataFrame, text: str = "text_review", minimum: int = CLEANED_MIN_EXCLUSIVE) -> DataFrame:
    """Add ``cleaned_text`` and keep the rows where it is there and longer than ``minimum``."""
    return derive_and_keep(df, "cleaned_text", clean_text(F.col(text)), lambda c: F.length(c) > minimum)


def clean_reviews(
    df: DataFrame,
    model: LanguageModel | None = None,
    text: str = "text_review",
    lang: str = "en",
    steps: StepCounter | None = None,
) -> Cleaned:
    """Detect the language, keep one, clean the text, drop what is then empty or too short.

    The detected languages are made durable because both results read them; without a model the
    table must already have ``detected_language``. ``steps`` counts the rows after each step, for
    which the cleaned rows are kept.
    """
    detected = df if model is None else durable(detect_language(df, model, text))
    spoken = counted(steps, "language", filter_language(counted(steps, "input", detected), lang))
    kept = counted(steps, "clean", clean_and_keep(spoken, text))
    columns = [name for name in ("review_id", "rating_review", "cleaned_text") if name in kept.columns]
    rows = kept.select(*columns)
    return Cleaned(rows if steps is None else steps.keep(rows), profiling.value_counts(detected, "detected_language"))


def profile_reviews(
    df: DataFrame, languages: DataFrame | None = None, text: str = "cleaned_text", rating: str = "rating_review"
) -> dict[str, DataFrame]:
    """The data report, one table per section.

    One pass over the table leaves a small table of counts (``profiling.profile_cube``), and every section
    is read from that; only a date column, where there is one, is counted on its own.
    """
    cube = profiling.profile_cube(df, text, rating, fingerprint(text, rating))
    lengths, words = cube.where("lengths"), cube.where("NOT lengths")
    ratings = lengths.groupBy("rating").agg(F.sum("n").alias("n"))
    total = lengths.agg(F.coalesce(F.sum("n"), F.lit(0))).scalar()
    classes = ratings.groupBy(sentiment3(F.col("rating")).alias("class")).agg(F.sum("n").alias("n"))

    def shares(counts: DataFrame, name: str, column: str) -> DataFrame:
        present = counts.where(F.col(column).isNotNull())
        return present.select(F.col(column).alias(name), F.col("n").alias("count"), F.round(F.col("n") / total * 100, 1).alias("pct"))

    def columns_of() -> DataFrame:
        nulls = [F.coalesce(F.sum(f"_null_{i}"), F.lit(0)).alias(f"_{i}") for i in range(len(df.columns))]
        rows = [
            F.struct(F.lit(name).alias("column"), F.lit(dtype).alias("type"), F.col(f"_{i}").alias("nulls"))
            for i, (name, dtype) in enumerate(df.dtypes)
        ]
        summed = lengths.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), *nulls)
        return summed.select("rows", F.inline(F.array(*rows)))

    def over(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))

    quality = lengths.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum("n") - F.sum("different"), F.lit(0)).alias("duplicate_rows"),
        over(~F.col("rating").between(1, 5)).alias("invalid_ratings"),
        over(F.col("length") < profiling.SHORT_TEXT).alias("very_short"),
        over(F.col("length") > profiling.LONG_TEXT).alias("very_long"),
    )
    quality = quality.select(
        "total_rows", "duplicate_rows", F.round(F.col("duplicate_rows") / F.col("total_rows") * 100, 2).alias("duplicate_pct"),
        "invalid_ratings", "very_short", "very_long",
    )
    value, mean = F.col("length").cast("double"), F.sum(F.col("length") * F.col("n")) / F.sum("n")
    typical = lengths.where("rating IS NOT NULL AND length IS NOT NULL").groupBy("rating").agg(
        mean.alias("_mean"), F.percentile("length", F.lit(0.5), F.col("n")).alias("_median"), F.sum("n").alias("_n")
    )
    # One row per rating.
    spread = lengths.join(F.broadcast(typical), "rating").groupBy("rating").agg(
        F.max("_mean").alias("_mean"), F.max("_median").alias("_median"),
        F.sqrt(F.sum(F.col("n") * (value - F.col("_mean")) ** 2) / F.nullif(F.max("_n") - 1, F.lit(0))).alias("_std"),
    )
    by_rating = [F.round(f"_{c}", 1).alias(c) for c in ("mean", "median", "std")]
    ends = classes.where("class IS NOT NULL").agg(F.max("n").alias("max_class"), F.min("n").alias("min_class"))
    ratio = F.col("max_class") / F.col("min_class")
    per_column = columns_of()
    report = {
        "basic": per_column.select(
            "column", "type", (F.col("rows") - F.col("nulls")).alias("non_null"), F.col("rows").alias("total_rows"),
            F.lit(len(df.columns)).alias("total_columns"),
        ),
        "missing": per_column.where("nulls > 0").select(
            "column", F.col("nulls").alias("missing_count"), F.round(F.col("nulls") / F.col("rows") * 100, 6).alias("missing_pct")
        ),
        "rating_summary": profiling.describe_counted(ratings, "rating", rating),
        "rating_distribution": shares(ratings, rating, "rating").orderBy(rating),
        "length_summary": profiling.describe_counted(lengths, "length", "text_length").unionByName(
            profiling.describe_counted(words, "words", "word_count")
        ),
        "length_by_rating": spread.select(F.col("rating").alias(rating), *by_rating).orderBy(rating),
        "sentiment_distribution": shares(classes, "sentiment_label", "class").orderBy(F.col("count").desc(), "sentiment_label"),
        "imbalance": ends.select(
            "max_class", "min_class", F.round(ratio, 6).alias("imbalance_ratio"),
            (ratio > profiling.IMBALANCE_THRESHOLD).alias("imbalanced"),
        ),
        "temporal": profiling.temporal_profile(df),
        "quality": quality,
        "findings": profiling.findings_from(quality, classes),
    }
    if languages is not None:
        report["languages"] = languages.orderBy(F.col("count").desc(), "detected_language").limit(10)
    return report


def report_table(report: dict[str, DataFrame]) -> DataFrame:
    """All numbers of a report as one table ``(section, item, measure, value)``.

    The item is the first text or rating column of a section, where it has one.
    """
    shape = ("total_rows", "total_columns")
    parts = []
    for section, table in report.items():
        keys = [name for name, dtype in table.dtypes if dtype == "string" or name == "rating_review"]
        numeric = [
            name
            for name, dtype in table.dtypes
            if dtype in ("int", "bigint", "double") and name not in (*keys, *shape)
        ]
        item = F.col(keys[0]).cast("string") if keys else F.lit("")
        values = [F.struct(F.lit(n).alias("measure"), F.col(n).cast("double").alias("value")) for n in numeric]
        values = values or [F.struct(F.lit("present").alias("measure"), F.lit(1.0).alias("value"))]
        rows = table.select(item.alias("item"), F.inline(F.array(*values)))
        parts.append(rows.select(F.lit(section).alias("section"), "item", "measure", "value"))
    return union_sources(*parts)


def label_reviews(df: DataFrame, lexicon: DataFrame, id_column: str = "review_id") -> DataFrame:
    """Add text length, word count, a predicted rating and its label."""
    text = resolve_text_column(df)
    measured = df.withColumns(
        {"text_length": text_length(F.col(text)), "word_count": word_count(F.col(text))}
    )
    scored = score_stars(measured, lexicon, text)
    return scored.withColumn("predicted_sentiment_label", sentiment_label(F.col("predicted_rating")))


def label_balance(
    labelled: DataFrame, label: str = "predicted_sentiment_label", threshold: float = profiling.IMBALANCE_THRESHOLD
) -> DataFrame:
    """Rows and percent per predicted label, with the ratio of the largest to the smallest class.

    The table is counted once; both figures come from the counts, a row per label.
    """
    counts = durable(labelled.groupBy(label).agg(F.count(F.lit(1)).alias("count")))
    ends = counts.where(F.col(label).isNotNull()).agg(F.max("count").alias("_most"), F.min("count").alias("_least"))
    total, ratio = counts.agg(F.sum("count")).scalar(), ends.select(F.col("_most") / F.col("_least")).scalar()
    found = counts.where(F.col(label).isNotNull())
    return found.select(
        label, "count", F.round(F.col("count") / total * 100, 1).alias("pct"),
        F.round(ratio, 6).alias("imbalance_ratio"), (ratio > threshold).alias("imbalanced"),
    )


def reclean(df: DataFrame, text: str = "cleaned_text", minimum: int = TEXT_MIN) -> DataFrame:
    """The second cleaning pass with lengths taken anew; texts now too short are dropped."""
    cleaned = derive_and_keep(df, text, clean_again(F.col(text)), lambda c: F.length(c) >= minimum)
    return cleaned.withColumns(
        {"text_length": text_length(F.col(text)), "word_count": word_count(F.col(text))}
    )


def refine_reviews(df: DataFrame, id_column: str = "review_id", steps: StepCounter | None = None) -> DataFrame:
    """Deduplicate, clean again, keep usable lengths. Deduplication comes first."""
    cleaned = counted(steps, "clean again", reclean(dedupe_reviews(df, order=id_column, steps=steps)))
    return counted(steps, "usable length", filter_text_length(cleaned))


def prepare_training_data(
    df: DataFrame,
    label: str = "predicted_sentiment_label",
    id_column: str = "review_id",
    seed: int = SEED,
    steps: StepCounter | None = None,
) -> DataFrame:
    """Refine, balance the classes by downsampling and add the ``split`` column; ``steps`` counts rows."""
    return prepared(df, label, id_column, seed, steps).rows


@dataclass(frozen=True)
class Prepared:
    """Balanced, split rows, and the classes before and after balancing."""

    rows: DataFrame
    before: DataFrame
    after: DataFrame


def prepared(
    df: DataFrame,
    label: str = "predicted_sentiment_label",
    id_column: str = "review_id",
    seed: int = SEED,
    steps: StepCounter | None = None,
) -> Prepared:
    """As ``prepare_training_data``, with the class distributions before and after balancing."""
    refined = refine_reviews(df, id_column, steps)
    refined = durable(refined) if steps is None else steps.keep(refined)
    balanced = balance_classes(refined, label, id_column, seed)
    balanced = balanced if steps is None else steps.keep(steps("balance", balanced))
    rows = stratified_split(balanced, label, seed=seed, id_column=id_column)
    return Prepared(rows, profiling.class_distribution(refined, label), profiling.class_distribution(balanced, label))


SPLITS = ("train", "validation", "test")


def prepare_to_files(
    df: DataFrame, folder: str, label: str = "predicted_sentiment_label", id_column: str = "review_id", seed: int = SEED
) -> dict[str, str]:
    """The whole preparation into files: the three splits, and the classes before and after balancing.

    Nothing else is left when it ends or fails. Returns the path of each table.
    """
    with job_scratch(df.sparkSession):
        found = prepared(df, label, id_column, seed)
        paths = write_splits(durable(found.rows), folder)
        for moment, table in (("before", found.before), ("after", found.after)):
            paths[moment] = f"{folder}/classes_{moment}"
            write_csv(table, paths[moment])
    return paths


def write_splits(rows: DataFrame, folder: str) -> dict[str, str]:
    """One CSV file set per part of a split table, label last; the path of each."""
    paths = {}
    for name, part in split_tables(rows, SPLITS).items():
        paths[name] = f"{folder}/{name}"
        last = [c for c in ("predicted_sentiment_label",) if c in part.columns]
        write_csv(part.select(*(c for c in part.columns if c not in last), *last), paths[name])
    return paths
