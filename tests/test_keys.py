"""The index of published keys, and what deduplication and incremental scoring move."""

import re

import pytest
from pyspark.sql import functions as F

from conftest import values
from placepulse.operators import filters, joins, sets
from placepulse.plans.publishing import score_new_reviews
from placepulse.session import scratch_path
from placepulse.sources.keys import KeyIndex
from placepulse.sources.tables import TableStore

DDL = "text_review STRING, source STRING, n INT"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def store(spark):
    return TableStore(spark, scratch_path(spark, "store"))


def test_index_agrees_with_the_join(spark, store):
    history = spark.createDataFrame([("a", "x", 1), ("a", "y", 2), ("a", "x", 3), (None, "x", 4), ("", "x", 5), ("b", None, 6)], DDL)
    batch = spark.createDataFrame(
        [("a", "x", 1), ("a", "z", 2), ("a", "z", 3), (None, "x", 4), ("", "x", 5), ("b", None, 6), ("x", "a", 7), ("", "", 8)], DDL
    )
    index = KeyIndex(store)
    assert values(index.unseen(batch)) == values(batch)
    store.append_table(history.where("n <= 2"), "reviews", "one")
    index.sync()
    store.append_table(history.where("n > 2"), "reviews", "two")
    assert values(index.unseen(batch)) == values(joins.new_reviews(batch, history))
    assert values(index.unseen(batch, "two")) == values(joins.new_reviews(batch, history.where("n <= 2")))
    assert index.unseen(batch.limit(0)).count() == 0
    # A part written again brings its own keys, a replaced table only the new ones.
    store.append_table(batch.where("n = 7"), "reviews", "two")
    assert values(index.unseen(batch)) == values(joins.new_reviews(batch, history.where("n <= 2").unionByName(batch.where("n = 7"))))
    store.replace_table(batch.where("n = 2"), "reviews")
    assert values(index.unseen(batch)) == values(joins.new_reviews(batch, batch.where("n = 2")))
    scored = score_new_reviews(batch.withColumn("title", F.lit("t")), index, lambda df: df.withColumn("predicted_sentiment", F.lit("Neutral")))
    assert scored.count() == 5


def test_index_reads_the_batchs_buckets_only(spark, store):
    history = spark.range(5000).select(F.concat(F.lit("text "), "id").alias("text_review"), F.lit("s").alias("source"))
    store.append_table(history, "reviews")
    index = KeyIndex(store)
    found = index.known(history.limit(3))
    plan = plan_of(found)
    assert "text_review" not in plan and "PartitionFilters: [bucket" in plan.replace("isnotnull(bucket), ", "")
    assert found.count() == 3


def test_dedupe_moves_identities_not_texts(spark):
    rows = spark.createDataFrame([(1, "a", 1), (2, "a", 1), (3, "b", 1)], "review_id BIGINT, cleaned_text STRING, rating_review INT")
    plan = plan_of(sets.dedupe_reviews(rows))
    assert "SortAggregate" not in plan
    assert not [line for line in re.findall(r"Exchange hash.*", plan) if "cleaned_text" in line]


@pytest.mark.parametrize("ids", [[5, 3, 3, None, None, 1], [None, None, None, None, None, None], [2, 2, 2, 2, 2, 2]])
def test_dedupe_with_repeated_and_null_ids(spark, ids):
    texts = ["a", "a", "a", "a", "b", None]
    rows = [(i, t, 1, n) for n, (i, t) in enumerate(zip(ids, texts, strict=True))] + [(7, None, 1, 9), (8, "", None, 9), (8, "", None, 9)]
    df = spark.createDataFrame(rows, "review_id BIGINT, cleaned_text STRING, rating_review INT, n INT").repartition(4)
    steps = filters.StepCounter()
    kept = steps.keep(sets.dedupe_reviews(df, steps=steps)).collect()
    groups = {}
    for i, t, r, _ in rows:
        groups.setdefault((t, r), []).append(i)
    want = {key: min((i for i in found if i is not None), default=None) for key, found in groups.items()}
    assert len(kept) == len(want) and {(r[1], r[2]): r[0] for r in kept} == want
    assert all(tuple(r) in rows for r in kept)
    assert steps.table(spark).collect()[0][2:4] == (len(rows), len(want))
