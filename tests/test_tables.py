"""Filters, joins and set operators, with attention to skew and to nulls."""

import pytest
from conftest import values
from pyspark.sql import functions as F

from placepulse.operators import columns, filters, joins, sets


def test_new_reviews_keeps_copies_and_looks_at_the_source(spark):
    batch = spark.createDataFrame(
        [("t1", "a", "s1"), ("t2", "a", "s2"), ("t3", "b", "s1"), ("t4", "b", "s1")],
        "title string, text_review string, source string",
    )
    known = spark.createDataFrame([("a", "s1"), ("a", "s1"), (None, "s1")], "text_review string, source string")
    assert values(joins.new_reviews(batch, known), "title") == [("t2",), ("t3",), ("t4",)]


def test_new_reviews_with_one_hot_text(spark):
    """A third of the batch is one text; what is kept and what is dropped is the whole batch."""
    hot = F.when(F.col("id") % 3 == 0, "same").otherwise(F.concat(F.lit("text "), F.col("id")))
    batch = spark.range(3000).select("id", hot.alias("text_review"), F.lit("s").alias("source")).repartition(8)
    known = spark.range(0, 3000, 4).select(F.concat(F.lit("text "), F.col("id")).alias("text_review"), F.lit("s").alias("source"))
    assert not joins.hot_keys(batch, "text_review").isEmpty()
    kept = {row.id for row in joins.new_reviews(batch, known).collect()}
    assert kept == {i for i in range(3000) if i % 3 == 0 or i % 4 != 0}
    with_hot = known.union(spark.createDataFrame([("same", "s")] * 500, known.schema))
    kept = {row.id for row in joins.new_reviews(batch, with_hot).collect()}
    assert kept == {i for i in range(3000) if i % 3 and i % 4}


@pytest.mark.parametrize("limit", [joins.BROADCAST_ROWS, 1])
def test_lookup_join_by_broadcast_and_by_shuffle(spark, monkeypatch, limit):
    monkeypatch.setattr(joins.fits_broadcast, "__defaults__", (limit, joins.BROADCAST_BYTES))
    big = spark.range(2000).select("id", F.when(F.col("id") % 2 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"))
    small = spark.createDataFrame([("hot", 1), ("7", 2), ("none", 3)], "k string, v int")
    left = {row.id: row.v for row in joins.lookup_join(big, small, ["k"], "left").collect()}
    assert left == {i: 1 if i % 2 == 0 else 2 if i == 7 else None for i in range(2000)}
    assert joins.lookup_join(big, small, ["k"], "inner").count() == 1001



def test_keys_are_looked_up_without_moving_text(spark, monkeypatch):
    rows = [(1, "a", "s"), (2, "a", "t"), (3, None, "s"), (4, "b", None), (5, "c", "s"), (5, "c", "s"), (None, "d", "s")]
    batch = spark.createDataFrame(rows, "id int, text_review string, source string")
    existing = spark.createDataFrame([("a", "s"), ("a", "s"), (None, "s"), ("b", None), ("c", "t"), ("d", "s"), ("e", "s")], "text_review string, source string")
    for fits in (joins.fits_broadcast, lambda df: False):
        monkeypatch.setattr(joins, "fits_broadcast", fits)
        unseen, known = joins.new_reviews(batch, existing), joins.known_reviews(batch, existing)
        assert values(unseen, "id") == [(2,), (3,), (4,), (5,), (5,)] and unseen.columns == batch.columns
        assert values(known) == [(1, "a", "s"), (None, "d", "s")]
    monkeypatch.undo()
    plan = joins.new_reviews(batch, existing)._jdf.queryExecution().toString()
    assert "BroadcastHashJoin" in plan and not any("Exchange hashpartitioning" in line and "_one" not in line for line in plan.splitlines())


def test_hot_keys_are_few(spark):
    df = spark.range(10_000).select(F.col("id") % 100)
    assert joins.hot_keys(df.toDF("k"), "k").count() == 100
    assert joins.hot_keys(spark.range(10_000).toDF("k"), "k").count() == 0


def test_attach_attraction_id(spark):
    scored = spark.createDataFrame([("A",), ("a",), ("B",), ("Z",), (None,)], "title string")
    places = spark.createDataFrame([(1, "A"), (9, "A"), (0, "B"), (3, None)], "id bigint, title string")
    assert values(joins.attach_attraction_id(scored, places)) == [("A", 9)]


def test_normalize_titles_once(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (4, None)], "id int, title string")
    aliases = spark.createDataFrame([("a", "b"), ("b", "x")], "from_title string, to_title string")
    assert values(joins.normalize_titles(df, aliases)) == [(1, "b"), (2, "x"), (3, "c"), (4, None)]


def test_dedupe_keeps_the_first_and_null_equals_null(spark):
    rows = [(5, "a", None, "e"), (2, "a", None, "b"), (3, "a", 1, "c"), (1, None, 1, "x"), (4, None, 1, "y")]
    df = spark.createDataFrame(rows, "review_id bigint, cleaned_text string, rating_review int, note string")
    for partitions in (1, 5):
        kept = values(sets.dedupe_reviews(df.repartition(partitions)))
        assert kept == sorted([(2, "a", None, "b"), (3, "a", 1, "c"), (1, None, 1, "x")], key=repr)


def test_duplicate_count(spark):
    df = spark.createDataFrame([("1:a", "b"), ("1", ":ab"), (None, "-"), (None, "-"), ("-", None)], "a string, b string")
    assert sets.duplicate_count(df).first()[0] == 1
    assert sets.duplicate_count(df.where("false")).first()[0] == 0


def test_titles_and_ids(spark):
    scored = spark.createDataFrame([("C",), ("A",), ("B",), ("B",), (None,)], "title string")
    places = spark.createDataFrame([(7, "A")], "id bigint, title string")
    fresh = sets.new_titles(scored, places)
    assert values(fresh) == [("B",), ("C",)]
    assert values(sets.extend_dimension(places, fresh)) == [(7, "A"), (8, "B"), (9, "C")]
    nothing = places.where("false")
    assert values(sets.extend_dimension(nothing, sets.new_titles(scored, nothing))) == [(1, "A"), (2, "B"), (3, "C")]


def test_row_id_is_dense_ordered_and_independent_of_partitions(spark):
    df = spark.range(1000).select("id", (F.col("id") % 3).alias("k"))
    expected = None
    for partitions in (1, 7):
        found = values(columns.with_row_id(df.repartition(partitions), ["k", "id"]))
        assert [row[2] for row in sorted(found, key=lambda r: r[2])] == list(range(1000))
        assert expected in (None, found)
        expected = found
    assert sorted((r[1], r[0]) for r in expected) == [(r[1], r[0]) for r in sorted(expected, key=lambda r: r[2])]


def test_row_id_of_many_copies(spark):
    copies = columns.with_row_id(spark.range(3000).select(F.lit("same").alias("t")).repartition(8), ["t"])
    assert copies.select("row_id").distinct().count() == 3000
    assert copies.agg(F.max("row_id")).first()[0] == 2999


def test_union_fills_missing_columns(spark):
    a = spark.createDataFrame([(1, "x")], "i int, t string")
    b = spark.createDataFrame([("y",)], "t string")
    assert values(sets.union_sources(a, b), "i", "t") == [(1, "x"), (None, "y")]


def test_required_columns(spark):
    df = spark.createDataFrame([(1,)], "a int")
    with pytest.raises(ValueError, match="missing columns"):
        columns.select_columns(df, ["a", "b"])
    with pytest.raises(ValueError, match="none of the text columns"):
        columns.resolve_text_column(df)
    assert columns.resolve_text_column(df.select(F.lit("").alias("text"), F.lit("").alias("review_text"))) == "review_text"


def test_length_limits(spark):
    df = spark.createDataFrame([("x" * n, n) for n in (10, 11, 19, 20, 1000, 1001)], "cleaned_text string, text_length int")
    assert values(filters.filter_min_length(df), "text_length") == [(1000,), (1001,), (11,), (19,), (20,)]
    assert values(filters.filter_text_length(df), "text_length") == [(1000,), (20,)]
    kept = filters.derive_and_keep(df, "n", F.length("cleaned_text"), lambda n: n < 20)
    assert values(kept, "n") == [(10,), (11,), (19,)]


def test_require_labels(spark):
    df = spark.createDataFrame([(1,), (None,)], "label int")
    assert filters.require_labels(df, training=True).count() == 1
    with pytest.raises(ValueError, match="no row"):
        filters.require_labels(df.where("label IS NULL"), training=True)


def test_derived_filter_computes_once(spark):
    df = spark.range(5).select(F.col("id").cast("string").alias("t"))
    kept = filters.derive_and_keep(df, "c", F.regexp_replace("t", "[0-2]", ""), lambda c: F.length(c) > 0)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("regexp_replace") == 1
