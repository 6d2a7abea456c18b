"""Class weights and evaluation, all from one small confusion table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placepulse.schema import LABELS


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """Balanced weights ``n / (k * n_c)`` over the ``k`` classes present."""
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    rows = counts.agg(F.sum("n").alias("rows")).scalar()
    classes = counts.agg(F.count(F.lit(1)).alias("classes")).scalar()
    return counts.select(label, "n", (rows / (classes * F.col("n"))).alias("weight"))


def argmax(c: Column) -> Column:
    """Zero-based position of the largest element; the first of equals."""
    return (F.array_position(c, F.array_max(c)) - 1).cast("int")


def confusion(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Rows per pair of true and predicted class."""
    pairs = df.groupBy(F.col(label).cast("int").alias("label"), F.col(prediction).cast("int").alias("prediction"))
    return pairs.agg(F.count(F.lit(1)).alias("n"))


def _per_class(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Per class of the vocabulary: hits, predicted and true rows, and the three scores."""
    zero = F.lit(0).cast("bigint")
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(zero)
    as_truth = [F.col("label").alias("label_id"), F.col("n").alias("truth"), zero.alias("guess"), zero.alias("hit")]
    as_guess = [F.col("prediction").alias("label_id"), zero.alias("truth"), F.col("n").alias("guess"), hit.alias("hit")]
    flat = confusion(df, label, prediction).select(F.inline(F.array(F.struct(*as_truth), F.struct(*as_guess))))
    sums = [F.sum(name).alias(name) for name in ("truth", "guess", "hit")]
    # A row without a prediction counts in its true class; null itself is no class.
    counted = flat.where("label_id IS NOT NULL").groupBy("label_id").agg(*sums)
    return counted.withColumns(
        {
            "precision": _ratio("hit", "guess"),
            "recall": _ratio("hit", "truth"),
            "f1": F.when(
                F.col("truth") + F.col("guess") > 0, 2 * F.col("hit") / (F.col("truth") + F.col("guess"))
            ).otherwise(0.0),
        }
    )


def _ratio(top: str, bottom: str) -> Column:
    return F.when(F.col(bottom) > 0, F.col(top) / F.col(bottom)).otherwise(F.lit(0.0))


def _weighted(name: str) -> Column:
    return F.sum(F.col(name) * F.col("truth")) / F.sum("truth")


def weighted_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Accuracy and the support-weighted precision, recall and F1; 0 where undefined."""
    scores = _per_class(df, label, prediction)
    return scores.agg(
        F.round(F.sum("hit") / F.sum("truth"), 6).alias("accuracy"),
        *[F.round(_weighted(name), 6).alias(name) for name in ("precision", "recall", "f1")],
    )


def classification_report(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Scores per class, always all five, then accuracy, macro and weighted average.

    The averages are over the classes seen as truth or as prediction.
    """
    scores = _per_class(df, label, prediction)
    vocabulary = scores.sparkSession.range(len(LABELS)).select(F.col("id").cast("int").alias("label_id"))
    names = F.array(*[F.lit(name) for name in LABELS])
    columns = ["precision", "recall", "f1"]

    def rounded(value: Column, name: str) -> Column:
        return F.round(F.coalesce(value, F.lit(0.0)), 6).alias(name)

    # Five rows against at most one row per class.
    classes = vocabulary.join(scores, "label_id", "left").select(
        F.get(names, F.col("label_id")).alias("class"),
        *[rounded(F.col(name), name) for name in columns],
        F.coalesce("truth", F.lit(0)).cast("bigint").alias("support"),
    )
    hit_rate = F.sum("hit") / F.sum("truth")
    averages = scores.agg(
        F.array(
            F.struct(
                F.lit("accuracy").alias("class"),
                *[rounded(hit_rate, name) for name in columns],
                F.sum("truth").cast("bigint").alias("support"),
            ),
            F.struct(
                F.lit("macro avg").alias("class"),
                *[rounded(F.avg(name), name) for name in columns],
                F.sum("truth").cast("bigint").alias("support"),
            ),
            F.struct(
                F.lit("weighted avg").alias("class"),
                *[rounded(_weighted(name), name) for name in columns],
                F.sum("truth").cast("bigint").alias("support"),
            ),
        ).alias("rows")
    ).select(F.inline("rows"))
    return classes.unionByName(averages)


def weighted_log_loss(
    df: DataFrame, label: str = "label", probability: str = "probability", weight: str = "weight"
) -> DataFrame:
    """Class-weighted cross entropy: weighted sum of the losses over the sum of the weights."""
    loss = -F.log(F.get(F.col(probability), F.col(label).cast("int")))
    total = F.sum(F.col(weight) * loss) / F.sum(weight)
    return df.agg(F.round(total, 6).alias("weighted_log_loss"))
