"""Exact sizes, disjoint parts and independence of the partitioning."""

import pytest
from conftest import values
from pyspark.sql import functions as F

from placepulse.operators import sampling


def classes(spark, n, edges):
    """``n`` rows with labels a, b, ... cut at the given ids."""
    label = F.lit("abcdefgh"[len(edges)])
    for edge, name in reversed(list(zip(edges, "abcdefgh", strict=False))):
        label = F.when(F.col("id") < edge, name).otherwise(label)
    return spark.range(n).select(F.col("id").alias("review_id"), label.alias("l"))


@pytest.mark.parametrize(("digits", "rank_rows"), [(3, 1_000_000), (1, 2)])
def test_balance(spark, monkeypatch, digits, rank_rows):
    """One class holds most rows; the second setting forces histograms of histograms."""
    monkeypatch.setattr(sampling, "BUCKET_DIGITS", digits)
    monkeypatch.setattr(sampling, "RANK_ROWS", rank_rows)
    df = classes(spark, 2000, [30, 100])
    df = df.union(spark.createDataFrame([(9001, None)], "review_id bigint, l string"))
    expected = None
    for partitions in (1, 6):
        kept = sampling.balance_classes(df.repartition(partitions), "l")
        assert values(kept.groupBy("l").count()) == [("a", 30), ("b", 30), ("c", 30)]
        assert expected in (None, values(kept))
        expected = values(kept)
    keys = values(df.where("l = 'c'").select("review_id", sampling.order_key("review_id").alias("k")))
    first = {row[0] for row in sorted(keys, key=lambda r: r[1])[:30]}
    assert {row[0] for row in expected if row[1] == "c"} == first


@pytest.mark.parametrize(("n", "sizes"), [(50, (34, 5, 11)), (100, (69, 10, 21)), (1000, (699, 100, 201)), (2000, (1399, 200, 401))])
def test_sizes(spark, n, sizes):
    assert sampling.split_sizes(n) == sizes
    split = sampling.stratified_split(classes(spark, n, [n // 5, n // 2]), "l")
    found = dict(values(split.groupBy("split").count()))
    assert (found["train"], found["validation"], found["test"]) == sizes
    assert split.select("review_id").distinct().count() == n
    for label, total in (("a", n // 5), ("b", n // 2 - n // 5), ("c", n - n // 2)):
        train = split.where((F.col("l") == label) & (F.col("split") == "train")).count()
        assert abs(train - total * sizes[0] / n) < 1


def test_split_does_not_depend_on_partitions(spark):
    df = classes(spark, 500, [40])
    assert values(sampling.stratified_split(df.repartition(1), "l")) == values(sampling.stratified_split(df.repartition(9), "l"))


@pytest.mark.parametrize("edges", [[1], [2], [3]])
def test_fallback_when_a_class_is_tiny(spark, edges):
    """A class of one row: no stratification; a class too small for the second stage: only there."""
    split = sampling.stratified_split(classes(spark, 50, edges), "l")
    found = dict(values(split.groupBy("split").count()))
    assert (found["train"], found["validation"], found["test"]) == (34, 5, 11)
    assert split.where("split IS NULL").count() == 0


def test_empty_table(spark):
    assert sampling.stratified_split(classes(spark, 0, [1]), "l").count() == 0
    assert sampling.balance_classes(classes(spark, 0, [1]), "l").count() == 0


def test_parts(spark):
    parts = sampling.split_tables(sampling.stratified_split(classes(spark, 50, [20]), "l"))
    assert sum(part.count() for part in parts.values()) == 50
    assert parts["train"].columns == ["review_id", "l"]
