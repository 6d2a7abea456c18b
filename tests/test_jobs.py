"""Sources, tables, and the jobs end to end."""

import pytest
from conftest import values
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placepulse.operators.stars import score_with
from placepulse.plans import corpus, learning, publishing
from placepulse.schema import ATTRACTIONS, LABELS, REVIEWS, SCORED_REVIEWS
from placepulse.sources import files
from placepulse.sources.tables import TableStore
from placepulse.streaming.incremental import run_available


def test_csv_by_name_with_awkward_cells(spark, tmp_path):
    path = tmp_path / "r.csv"
    path.write_text('rating_review,x,text_review\n4.0,q,"two\nlines, ""quoted"""\nNA,q,  spaced \n5,,n/a\nbad,q,é\n', "utf-8")
    found = [tuple(row) for row in files.read_reviews_csv(spark, str(path)).collect()]
    assert found == [('two\nlines, "quoted"', 4), ("  spaced ", None), (None, 5), ("é", None)]
    with pytest.raises(ValueError, match="missing columns"):
        files.read_reviews_csv(spark, str(path), SCORED_REVIEWS)


def test_csv_files_with_columns_in_different_orders(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a 1.csv").write_text("text_review,rating_review\nnice one,4\n")
    (folder / "b.csv").write_text("rating_review,x,text_review\n5,q,nice two\n")
    (folder / "c.csv").write_text("")
    for path in (str(folder), [str(folder / "a*.csv"), str(folder / "b.csv")]):
        assert values(files.read_reviews_csv(spark, path)) == [("nice one", 4), ("nice two", 5)]
    (folder / "d.csv").write_text("text_review\nno rating\n")
    with pytest.raises(ValueError, match="missing columns"):
        files.read_reviews_csv(spark, str(folder))


def test_csv_latin1(spark, tmp_path):
    path = tmp_path / "r.csv"
    path.write_bytes("text_review,rating_review\ncafé,3\n".encode("iso-8859-1"))
    assert values(files.read_reviews_csv(spark, str(path), encoding="ISO-8859-1")) == [("café", 3)]


def test_csv_round_trip(spark, tmp_path):
    rows = [(' a "b"\n\tc, d ', 1), ("x\\", 2), ("\\n", 3), ("é😀", 4)]
    df = spark.createDataFrame(rows, "text_review string, rating_review int")
    files.write_csv(df, str(tmp_path / "out"))
    assert values(files.read_reviews_csv(spark, str(tmp_path / "out"))) == sorted(rows, key=repr)


def test_empty_scored_file_has_a_header(spark, tmp_path):
    files.write_scored(spark.createDataFrame([], SCORED_REVIEWS), str(tmp_path / "s"))
    assert any(part.read_text().startswith('"source","title"') or part.read_text().startswith("source,title") for part in (tmp_path / "s").glob("*.csv"))
    back = files.read_scored_csv(spark, str(tmp_path / "s"))
    assert back.schema == SCORED_REVIEWS and back.count() == 0


def test_label_map(spark, tmp_path):
    files.write_label_map(spark, str(tmp_path / "l"))
    assert values(files.read_label_map(spark, str(tmp_path / "l"))) == list(enumerate(LABELS))


def test_store_versions_and_parts(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    schema = T.StructType([T.StructField("a", T.LongType())])
    assert store.read_table("t", schema).count() == 0
    store.append_table(spark.range(2).toDF("a"), "t", "one")
    store.append_table(spark.range(2, 4).toDF("a"), "t", "two")
    store.append_table(spark.range(2, 5).toDF("a"), "t", "two")
    assert values(store.read_table("t", schema)) == [(0,), (1,), (2,), (3,), (4,)]
    assert values(store.read_table("t", schema, without_part="two")) == [(0,), (1,)]
    before = store.read_table("t", schema)
    assert store.replace_table(before.where("a > 3"), "t", skip_if_empty=True)
    assert not store.replace_table(before.where("a > 9"), "t", skip_if_empty=True)
    assert values(store.read_table("t", schema)) == [(4,)]
    assert before.count() == 5
    # A version whose write never finished is not seen.
    (tmp_path / "t" / "v000009" / "part").mkdir(parents=True)
    assert values(store.read_table("t", schema)) == [(4,)]


def scorer(df):
    return score_with(df, lambda: lambda texts: ["Positive" if "good" in text else "Negative" for text in texts])


def batch_of(spark, *rows):
    return spark.createDataFrame(list(rows), "title string, text_review string, source string")


ALIASES = [("Old Wat", "Wat")]


def test_two_batches(spark, tmp_path):
    """The second batch repeats the first and adds one review; only that one is scored."""
    store = TableStore(spark, str(tmp_path))
    aliases = spark.createDataFrame(ALIASES, "from_title string, to_title string")
    first = [("Wat", "good", "G"), ("Old Wat", "bad", "G"), ("Zoo", "bad", "T"), ("Zoo", None, "T")]

    def run(rows, **options):
        known = store.read_table("reviews", REVIEWS, ["text_review", "source"])
        scored = publishing.score_new_reviews(batch_of(spark, *rows), known, scorer)
        return scored.count(), publishing.publish_reviews(scored, store, aliases, **options)

    count, out = run(first, part="b1")
    assert count == 3
    assert values(out.attractions) == [(1, "Wat"), (2, "Zoo")]
    assert values(out.stats, "attraction_id", "negative", "positive", "total") == [(1, 1, 1, 2), (2, 1, 0, 1)]
    count, out = run([*first, ("Park", "good", "T")])
    assert count == 1
    assert values(out.attractions) == [(1, "Wat"), (2, "Zoo"), (3, "Park")]
    assert out.reviews.count() == 4
    count, out = run([("Zoo", "very good", "G")], mode="replace")
    assert count == 1 and values(out.reviews) == [(2, "G", "very good", "Positive")]
    assert values(out.stats, "attraction_id", "total") == [(1, 0), (2, 1), (3, 0)]
    count, out = run([("Zoo", "very good", "G")], mode="replace")
    assert count == 0 and out.reviews.count() == 1
    with pytest.raises(ValueError, match="append or replace"):
        publishing.publish_reviews(out.reviews, store, aliases, mode="other")


def test_stream_publishes_once(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "store"))
    aliases = spark.createDataFrame(ALIASES, "from_title string, to_title string")
    inbox, progress = str(tmp_path / "inbox"), str(tmp_path / "progress")
    batch_of(spark, ("Wat", "good", "G"), ("Zoo", "bad", "T")).coalesce(1).write.parquet(inbox)
    run_available(spark, inbox, progress, store, aliases, scorer)
    assert store.read_table("reviews", REVIEWS).count() == 2
    batch_of(spark, ("Wat", "good", "G"), ("Zoo", "so good", "T")).coalesce(1).write.mode("append").parquet(inbox)
    run_available(spark, inbox, progress, store, aliases, scorer)
    run_available(spark, inbox, progress, store, aliases, scorer)
    assert values(store.read_table("reviews", REVIEWS), "text_review") == [("bad",), ("good",), ("so good",)]
    assert values(store.read_table("attractions", ATTRACTIONS)) == [(1, "Wat"), (2, "Zoo")]


def test_corpus_to_model(spark):
    """Merge to evaluation on made reviews whose words give the rating away."""
    words = ["awful dreadful", "poor weak", "average plain", "nice pleasant", "superb wonderful"]
    rows = [(f"The place was {words[i % 5]} on visit {i % 50} of guide {'abcdefghij'[i // 60]}", 1 + i % 5) for i in range(600)]
    raw = spark.createDataFrame(rows, "text_review string, rating_review int")
    ids = raw.withColumn("review_id", F.monotonically_increasing_id()).withColumn("detected_language", F.lit("en"))
    cleaned = corpus.clean_reviews(ids).reviews
    lexicon = spark.createDataFrame([(w, 1 + i) for i, pair in enumerate(words) for w in pair.split()], "word string, stars int")
    labelled = corpus.label_reviews(cleaned, lexicon)
    assert labelled.where("predicted_rating <> rating_review").count() == 0
    prepared = corpus.prepare_training_data(labelled)
    sizes = dict(values(prepared.groupBy("split").count()))
    assert sum(sizes.values()) == prepared.select("cleaned_text").distinct().count() and sizes["train"] > sizes["test"]
    encoded = learning.encode_features(prepared, vocab_size=50, max_len=16)
    assert encoded.features.columns == ["review_id", "split", "label", "input_ids", "attention_mask"]
    assert encoded.features.where(F.size("input_ids") != 16).count() == 0
    labels = prepared.join(encoded.features.select("review_id", "label"), "review_id")
    parts = {name: labels.where(F.col("split") == name) for name in ("train", "validation", "test")}
    result = learning.train_and_evaluate(*parts.values(), [learning.Params(max_iter=10, features=512)])
    assert result.metrics.first()["accuracy"] > 0.9
