"""Intermediate results last as long as their job; CSV deliveries are accounted for."""

import pytest

from conftest import values
from placepulse.operators import sampling
from placepulse.plans import corpus, publishing
from placepulse.session import checkpoint_root, durable, job_scratch, scratch_path, sweep_scratch
from placepulse.sources import files
from placepulse.sources.tables import TableStore


def jobs(spark):
    path = spark._jvm.org.apache.hadoop.fs.Path(checkpoint_root(spark) + "/job-*")
    return [s.getPath().getName() for s in path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path) or []]


def test_a_job_leaves_nothing(spark):
    with job_scratch(spark) as folder:
        kept = durable(spark.range(5).selectExpr("id", "id * 2 AS twice"))
        assert values(kept, "twice") == [(i * 2,) for i in range(5)] and scratch_path(spark, "x").startswith(folder)
        assert "ReadSchema: struct<twice:bigint>" in kept.select("twice")._jdf.queryExecution().executedPlan().toString()
        with job_scratch(spark) as inner:
            durable(spark.range(1))
            assert inner != folder and len(jobs(spark)) == 2
        assert kept.count() == 5
    assert jobs(spark) == []
    assert durable(spark.range(3)).count() == 3  # outside of a job a checkpoint


def test_a_failed_job_leaves_nothing(spark):
    with pytest.raises(OSError), job_scratch(spark):
        durable(spark.range(5))
        raise OSError
    assert jobs(spark) == []


def test_jobs_killed_are_swept(spark):
    with job_scratch(spark):
        durable(spark.range(1))
        assert sweep_scratch(spark, 3600) == 0
        assert sweep_scratch(spark, -5) == 1 and jobs(spark) == []


def test_publishing_leaves_its_tables_only(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    scored = spark.createDataFrame(
        [("G", "Wat", "good", "Positive")], "source string, title string, text_review string, predicted_sentiment string"
    )
    out = publishing.publish_reviews(scored, store, spark.createDataFrame([], "from_title string, to_title string"))
    assert jobs(spark) == []
    assert (out.attractions.count(), out.reviews.count(), out.stats.count()) == (1, 1, 1)


def test_preparing_leaves_its_files_only(spark, tmp_path):
    rows = spark.range(300).selectExpr(
        "id AS review_id", "concat('a review long enough to be kept ', id) AS cleaned_text", "CAST(id % 5 + 1 AS INT) AS rating_review",
        "CASE WHEN id % 3 = 0 THEN 'Positive' ELSE 'Negative' END AS predicted_sentiment_label",
    )
    paths = corpus.prepare_to_files(rows, str(tmp_path / "out"))
    assert jobs(spark) == []
    sizes = {name: files.account_csv(spark, paths[name]).agg({"rows": "sum"}).first()[0] for name in corpus.SPLITS}
    assert sizes == dict(zip(corpus.SPLITS, sampling.split_sizes(200), strict=True))
    after = spark.read.option("header", True).csv(paths["after"])
    assert {r["count"] for r in after.collect()} == {"100"}


def test_account_of_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text('x,y\n1,2\n3\n4,5,6\n"two\nlines",\n')
    (tmp_path / "b.csv").write_text("y\n1\n2\n")
    (tmp_path / "c.csv").write_text("")
    (tmp_path / "d.csv").write_text("x,y\n")
    found = {r["file"].rsplit("/", 1)[1]: tuple(r)[1:] for r in files.account_csv(spark, str(tmp_path / "*.csv")).collect()}
    assert found == {"a.csv": (4, 6, 2), "b.csv": (2, 2, 0)}
    assert files.account_csv(spark, str(tmp_path / "c.csv")).count() == 0


def test_too_many_classes_raise(spark, monkeypatch):
    monkeypatch.setattr(sampling, "CLASS_ROWS", 3)
    with pytest.raises(ValueError, match="at most 3"):
        sampling.stratified_split(spark.range(20).selectExpr("id AS review_id", "id % 4 AS label"), "label")
