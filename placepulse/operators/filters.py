"""Filters, and the audit of what each removes."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from placepulse.schema import CLEANED_MIN_EXCLUSIVE, TEXT_MAX, TEXT_MIN, label_to_id
from placepulse.session import durable


def filter_language(df: DataFrame, lang: str = "en", column: str = "detected_language") -> DataFrame:
    """Rows of one language."""
    return df.where(F.col(column) == lang)


def drop_nulls(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """Rows with no null in ``subset``."""
    return df.na.drop(subset=list(subset))


def filter_min_length(
    df: DataFrame, minimum: int = CLEANED_MIN_EXCLUSIVE, column: str = "cleaned_text", strict: bool = True
) -> DataFrame:
    """Text longer than ``minimum``; with ``strict=False`` also of just that length."""
    length = F.length(F.col(column))
    return df.where(length > minimum if strict else length >= minimum)


def filter_text_length(
    df: DataFrame, minimum: int = TEXT_MIN, maximum: int = TEXT_MAX, column: str = "text_length"
) -> DataFrame:
    """Length within both limits, limits included."""
    return df.where(F.col(column).between(minimum, maximum))


def derive_and_keep(
    df: DataFrame, name: str, value: Column, condition: Callable[[Column], Column]
) -> DataFrame:
    """Add or replace a column by ``value`` and keep the rows where ``condition`` holds for it.

    A filter on a computed column is pushed below the projection and computes the column a
    second time. As the one element of an array that the condition may empty, an expensive
    value is computed once per row.
    """
    others = [column for column in df.columns if column != name]
    kept = df.select(*others, F.explode(F.filter(F.array(value), condition)).alias(name))
    return kept.select(*df.columns) if name in df.columns else kept


def filter_valid_labels(df: DataFrame, column: str = "predicted_sentiment_label") -> DataFrame:
    """Rows whose label is one of the five classes."""
    return df.where(label_to_id(F.col(column)).isNotNull())


def require_labels(df: DataFrame, column: str = "label", training: bool = False) -> DataFrame:
    """Rows with a label; for a training table it is an error when none is left."""
    labelled = df.where(F.col(column).isNotNull())
    if training and labelled.isEmpty():
        raise ValueError("no row with a valid label is left to train on")
    return labelled


def step_audit(df: DataFrame, steps: Sequence[tuple[str, Column]]) -> DataFrame:
    """Rows before and after each of a chain of conditions, from one pass over the table.

    A row is counted out at the first step whose condition is not true for it.
    """
    survives = F.lit(True)
    counts = [F.count(F.lit(1)).alias("_0")]
    for number, (_, condition) in enumerate(steps, start=1):
        survives = survives & F.coalesce(condition, F.lit(False))
        counts.append(F.count_if(survives).alias(f"_{number}"))
    rows = [
        F.struct(
            F.lit(number).alias("step_no"),
            F.lit(name).alias("step"),
            F.col(f"_{number - 1}").alias("rows_in"),
            F.col(f"_{number}").alias("rows_out"),
        )
        for number, (name, _) in enumerate(steps, start=1)
    ]
    audit = df.agg(*counts).select(F.inline(F.array(*rows)))
    removed = F.col("rows_in") - F.col("rows_out")
    kept = F.when(F.col("rows_in") > 0, F.col("rows_out") / F.col("rows_in") * 100)
    return audit.withColumn("removed", removed).withColumn("kept_pct", F.round(kept, 6))


class StepCounter:
    """Counts the rows after each step inside a running plan, without a pass of its own.

    Wrap what goes into the first step and what comes out of each, and let ``keep`` run the plan. The metrics
    are observed by name: an ``Observation`` object would stay with the session, whose fitted
    classifiers could then no longer be sent to tasks.
    """

    def __init__(self):
        self._names: list[tuple[str, str]] = []
        self._counts: dict[str, int] = {}

    def __call__(self, step: str, df: DataFrame) -> DataFrame:
        name = f"{step}-{uuid.uuid4().hex}"
        self._names.append((step, name))
        return df.observe(name, F.count(F.lit(1)).alias("rows"))

    def keep(self, df: DataFrame) -> DataFrame:
        """Run the plan into reliable storage, taking the counts it made on the way."""
        kept = durable(df)
        seen = df._jdf.queryExecution().observedMetrics()
        for _, name in self._names:
            if seen.contains(name):
                self._counts[name] = seen.apply(name).getLong(0)
        return kept

    def table(self, spark: SparkSession) -> DataFrame:
        """``step_no, step, rows_in, rows_out, removed, kept_pct``; a step that met no rows counts none."""
        counts = [self._counts.get(name, 0) for _, name in self._names]
        rows = [
            (number, step, before, after, before - after, round(after / before * 100, 6) if before else None)
            for number, ((step, _), before, after) in enumerate(zip(self._names[1:], counts, counts[1:], strict=False), start=1)
        ]
        ddl = "step_no INT, step STRING, rows_in BIGINT, rows_out BIGINT, removed BIGINT, kept_pct DOUBLE"
        return spark.createDataFrame(rows, ddl)


def counted(steps: StepCounter | None, step: str, df: DataFrame) -> DataFrame:
    """``df``, counted if steps are."""
    return df if steps is None else steps(step, df)
