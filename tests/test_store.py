"""Commits over several tables, and ids by place."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import values
from placepulse.operators import columns
from placepulse.plans import corpus, publishing
from placepulse.schema import ATTRACTIONS, REVIEWS
from placepulse.sources import tables
from placepulse.sources.tables import ConflictError, TableStore

ONE = T.StructType([T.StructField("a", T.LongType())])


def ids(spark, *numbers):
    return spark.createDataFrame([(n,) for n in numbers], ONE)


def test_tables_change_together(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    change = store.change()
    change.append_table(ids(spark, 1), "t")
    change.replace_table(ids(spark, 2), "u")
    assert values(change.read_table("t", ONE)) == [(1,)]
    assert store.snapshot().tables == {} and store.read_table("t", ONE).count() == 0
    assert change.commit() == 1
    assert values(store.read_table("t", ONE)) == [(1,)] and values(store.read_table("u", ONE)) == [(2,)]
    assert store.change().commit() == 1  # nothing to commit


def test_appends_of_two_writers_both_count(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    one, two = store.change(), TableStore(spark, str(tmp_path)).change()
    one.append_table(ids(spark, 1), "t", "p1")
    two.append_table(ids(spark, 2), "t", "p2")
    assert (two.commit(), one.commit()) == (1, 2)
    assert values(store.read_table("t", ONE)) == [(1,), (2,)]


@pytest.mark.parametrize("kind", ["read", "replace", "part"])
def test_a_stale_change_raises(spark, tmp_path, kind):
    store = TableStore(spark, str(tmp_path))
    store.append_table(ids(spark, 1), "t", "p")
    stale = store.change()
    if kind == "read":
        stale.read_table("t", ONE)
        stale.append_table(ids(spark, 9), "u")
    elif kind == "replace":
        stale.replace_table(ids(spark, 9), "t")
    else:
        stale.append_table(ids(spark, 9), "t", "p")
    store.append_table(ids(spark, 2), "t", "p")
    with pytest.raises(ConflictError):
        stale.commit()
    assert values(store.read_table("t", ONE)) == [(2,)] and store.read_table("u", ONE).count() == 0


def test_work_is_done_again_after_a_conflict(spark, tmp_path):
    store, seen = TableStore(spark, str(tmp_path)), []

    def work(change):
        total = change.read_table("t", ONE).count()
        seen.append(total)
        if len(seen) == 1:
            store.append_table(ids(spark, 5), "t")
        change.replace_table(ids(spark, total), "total")

    store.changed(work)
    assert seen == [0, 1] and values(store.read_table("total", ONE)) == [(1,)]


def test_a_commit_is_put_once(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    path = f"{tmp_path}/_commits/000000000001.json"
    assert store._put(path, {"tables": {}}) and not store._put(path, {"tables": {"t": [["p", "f"]]}})
    assert store.snapshot().tables == {}
    assert [p.name for p in (tmp_path / "_commits").glob("*.json*")] == ["000000000001.json"]


def test_crash_while_publishing_leaves_the_old_state(spark, tmp_path, monkeypatch):
    store = TableStore(spark, str(tmp_path))
    aliases = spark.createDataFrame([], "from_title string, to_title string")

    def scored(*rows):
        return spark.createDataFrame(list(rows), "source string, title string, text_review string, predicted_sentiment string")

    publishing.publish_reviews(scored(("G", "Wat", "good", "Positive")), store, aliases, part="b1")
    before = store.snapshot()

    def broken(*_):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(publishing, "sentiment_stats", broken)
        with pytest.raises(OSError, match="lost"):
            publishing.publish_reviews(scored(("G", "Zoo", "bad", "Negative")), store, aliases, part="b2")
    assert store.snapshot() == before
    assert values(store.read_table("attractions", ATTRACTIONS)) == [(1, "Wat")]
    assert store.read_table("reviews", REVIEWS).count() == 1
    out = publishing.publish_reviews(scored(("G", "Zoo", "bad", "Negative")), store, aliases, part="b2")
    assert values(out.stats, "attraction_id", "total") == [(1, 1), (2, 1)]
    # Reviews, attractions and statistics are those of one commit each time.
    assert store.snapshot().number == 2


def test_compact_and_vacuum(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    for n in range(4):
        store.append_table(ids(spark, n), "t", f"p{n}")
    old = store.snapshot()
    reader = store.read_table("t", ONE)
    store.compact("t", ONE, keep="p3")
    assert [name for name, _ in store.parts("t")][1:] == ["p3"] and len(store.parts("t")) == 2
    assert store.vacuum() == 0 and reader.count() == 4
    assert values(store.read_table("t", ONE, at=old)) == values(store.read_table("t", ONE))
    stray = tmp_path / "t" / "never-named"
    stray.mkdir()
    assert store.vacuum(keep=1, older_than=3600) == 0
    assert store.vacuum(keep=1, older_than=-5) == 4  # three merged parts and the stray folder
    assert values(store.read_table("t", ONE)) == [(0,), (1,), (2,), (3,)]
    store.append_table(ids(spark, 8), "t", "p3")
    assert values(store.read_table("t", ONE)) == [(0,), (1,), (2,), (8,)]


def test_place_ids(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.range(5000).select("id", F.lit(7).alias("_at"), F.lit("x").alias("_part")).repartition(6).write.parquet(path)
    rows = spark.read.parquet(path).where("id % 3 <> 1")
    found = columns.with_place_id(rows.unionByName(rows.where("id < 10")))
    again = columns.with_place_id(rows.unionByName(rows.where("id < 10")))
    got = values(found)
    assert sorted(r[3] for r in got) == list(range(len(got))) and got == values(again)
    assert found.columns == ["id", "_at", "_part", "row_id"]
    assert "Exchange rangepartitioning" not in found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in found._jdf.queryExecution().executedPlan().toString()
    assert columns.with_place_id(rows.where("false")).count() == 0
    with pytest.raises(ValueError, match="no fixed place"):
        columns.with_place_id(rows.repartition(3))
    with pytest.raises(ValueError, match="no fixed place"):
        columns.with_place_id(rows.groupBy("id").count())


def test_merge_with_ids_by_place(spark, tmp_path):
    for name, rows in (("a", "text_review,rating_review\nb,1\na,2\n"), ("b", "rating_review,text_review\n3,c\n")):
        (tmp_path / f"{name}.csv").write_text(rows)
    sources = [corpus.CsvSource(str(tmp_path / f"{name}.csv")) for name in "ab"]
    merged = corpus.merge_reviews(spark, sources, ids="place")
    assert values(merged, "review_id", "text_review") == [(0, "b"), (1, "a"), (2, "c")]
    with pytest.raises(ValueError, match="order or place"):
        corpus.merge_reviews(spark, sources, ids="other")
    assert tables.Snapshot().parts("t") == []
