"""Profiles and metrics against numbers worked out by hand or by pandas."""

import math

import pytest
from conftest import values
from pyspark.sql import functions as F

from placepulse.operators import filters, metrics, profiling


@pytest.fixture(scope="module")
def rated(spark):
    rows = [(5, "x" * 5), (5, "y" * 20), (5, "y" * 20), (4, "z" * 3000), (1, None), (None, "w" * 12), (9, "v" * 30)]
    return spark.createDataFrame(rows, "rating_review int, cleaned_text string")


def test_distribution_counts_nulls_in_the_total(rated):
    assert values(profiling.class_distribution(rated, "rating_review")) == [(1, 1, 14.3), (4, 1, 14.3), (5, 3, 42.9), (9, 1, 14.3)]
    assert [row[0] for row in profiling.value_counts(rated, "rating_review").collect()] == [5, 1, 4, 9]


def test_imbalance(rated):
    assert tuple(profiling.imbalance(rated, "rating_review").first()) == (3, 1, 3.0, False)


def test_describe_equals_pandas(spark):
    df = spark.range(1, 98).select((F.col("id") * F.col("id") % 31).alias("v"))
    found = profiling.describe_numeric(df, ["v"]).first()
    expected = df.toPandas()["v"].describe()
    for name, label in (("count", "count"), ("mean", "mean"), ("std", "std"), ("min", "min"), ("p25", "25%"), ("p50", "50%"), ("p75", "75%"), ("max", "max")):
        assert math.isclose(found[name], expected[label], rel_tol=1e-6), name


def test_quality_and_findings(rated):
    assert tuple(profiling.quality_indicators(rated).first()) == (7, 1, 14.29, 1, 1, 1)
    assert values(profiling.findings(rated)) == [("class imbalance",), ("duplicate entries",), ("extreme text lengths",)]


def test_missing_and_profile(rated):
    assert values(profiling.missing_report(rated)) == [("cleaned_text", 1, 14.285714), ("rating_review", 1, 14.285714)]
    assert values(profiling.profile(rated), "column", "type", "non_null", "total_columns") == [
        ("cleaned_text", "string", 6, 2),
        ("rating_review", "int", 6, 2),
    ]
    assert profiling.missing_report(rated.na.drop()).count() == 0


def test_temporal(spark, rated):
    assert profiling.temporal_profile(rated).count() == 0
    dated = spark.sql("SELECT explode(array(date'2024-01-31', date'2024-01-01', date'2023-12-01', null)) AS day")
    assert values(profiling.temporal_profile(dated)) == [("day", "2023-12", 1), ("day", "2024-01", 2)]


def test_label_audit(spark):
    df = spark.createDataFrame([("Neutral",), ("neutral",), ("x",), ("x",), (None,)], "predicted_sentiment_label string")
    assert tuple(profiling.label_audit(df).first()) == (4, "neutral|x")
    assert tuple(profiling.label_audit(df.where("predicted_sentiment_label = 'Neutral'")).first()) == (0, "")


def test_stats_of_places_without_reviews(spark):
    places = spark.createDataFrame([(1, "A"), (2, "B")], "id bigint, title string")
    reviews = spark.createDataFrame([(1, "Positive"), (1, "Very Negative"), (1, "No Text")], "attraction_id bigint, predicted_sentiment string")
    assert values(profiling.sentiment_stats(places, reviews)) == [(1, 1, 0, 0, 1, 0, 3), (2, 0, 0, 0, 0, 0, 0)]


def test_step_audit(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (None,)], "a int")
    audit = filters.step_audit(df, [("known", F.col("a").isNotNull()), ("big", F.col("a") > 1)])
    assert values(audit) == [(1, "known", 4, 3, 1, 75.0), (2, "big", 3, 2, 1, 66.666667)]


def test_weights_add_up_to_the_rows(spark):
    df = spark.createDataFrame([(0,)] * 6 + [(3,)] * 2, "label int")
    assert values(metrics.class_weights(df)) == [(0, 6, 8 / 12), (3, 2, 2.0)]


def test_argmax_takes_the_first(spark):
    df = spark.createDataFrame([([1.0, 3.0, 3.0],), ([2.0],), (None,)], "v array<double>")
    assert [row[0] for row in df.select(metrics.argmax(F.col("v"))).collect()] == [1, 0, None]


def test_metrics_with_a_class_never_predicted_and_one_never_true(spark):
    pairs = [(0, 0), (0, 0), (0, 1), (2, 1), (2, 2), (3, 0)]
    df = spark.createDataFrame(pairs, "label int, prediction int")
    report = {row["class"]: row for row in metrics.classification_report(df).collect()}
    assert len(report) == 8
    assert (report["Positive"].precision, report["Positive"].recall, report["Positive"].support) == (0.0, 0.0, 1)
    assert (report["Negative"].precision, report["Negative"].support) == (0.0, 0)
    assert report["Very Positive"].support == 0
    assert report["Very Negative"].precision == report["Very Negative"].recall == 0.666667
    assert report["accuracy"].f1 == 0.5
    whole = metrics.weighted_metrics(df).first()
    assert (whole.accuracy, whole.recall) == (0.5, 0.5)
    assert whole.f1 == report["weighted avg"].f1 == round((2 / 3 * 3 + 2 / 3 * 2 + 0) / 6, 6)


def test_metrics_agree_with_spark_ml(spark):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator

    df = spark.range(300).select((F.col("id") % 5).cast("double").alias("label"), (F.col("id") * 7 % 11 % 5).cast("double").alias("prediction"))
    mine = metrics.weighted_metrics(df).first()
    for name, metric in (("accuracy", "accuracy"), ("f1", "f1"), ("precision", "weightedPrecision"), ("recall", "weightedRecall")):
        assert math.isclose(mine[name], MulticlassClassificationEvaluator(metricName=metric).evaluate(df), abs_tol=1e-6), name
