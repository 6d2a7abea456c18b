"""Language, tokens, stars, scorers and the classifier."""

import pytest
from conftest import values
from pyspark.sql import functions as F

from placepulse.operators import language, stars, tokens, training
from placepulse.schema import LABELS, NO_TEXT_LABEL


def test_language_held_out(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").where(F.length("text") > 50)
    part = F.pmod(F.xxhash64("text"), F.lit(4))
    model = language.fit_language_profiles(docs.where(part > 0), vocabulary=1500)
    judged = language.detect_language(docs.where(part == 0), model, "text")
    assert language.accuracy(judged, "lang", "detected_language").first()[0] > 0.95


def test_language_unknown(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = language.fit_language_profiles(docs, vocabulary=500)
    df = spark.createDataFrame([(None,), ("",), (" a ",), ("12 34 56",), ("かなかな",), ("the one and the other",)], "text_review string")
    found = [row.detected_language for row in language.detect_language(df, model).collect()]
    assert found == ["unknown"] * 5 + ["en"]


def test_language_ngrams_of_a_word(spark):
    df = spark.createDataFrame([("ab",)], "w string").select(language.word_ngrams(F.col("w")))
    assert sorted(df.first()[0]) == sorted([" a", "a", "ab", "b", "b ", " ab", "ab "])


def test_tokens(spark):
    df = spark.createDataFrame([(1, 0, "b a b c"), (2, 1, ""), (3, 1, None), (4, 0, "z a")], "review_id int, label int, cleaned_text string")
    vocab = tokens.build_vocab(df, 2)
    assert values(vocab) == [("a", 2, 2), ("b", 2, 3)]
    encoded = {row.review_id: row for row in tokens.encode_tokens(df, vocab, max_len=3).collect()}
    assert (encoded[1].input_ids, encoded[1].attention_mask, encoded[1].label) == ([3, 2, 3], [1, 1, 1], 0)
    assert (encoded[2].input_ids, encoded[2].attention_mask) == ([0, 0, 0], [0, 0, 0])
    assert encoded[3].input_ids == [0, 0, 0]
    assert (encoded[4].input_ids, encoded[4].attention_mask) == ([1, 2, 0], [1, 1, 0])
    alike = spark.createDataFrame([(1, 0, "b"), (1, 0, "b"), (None, 1, "a q")], df.schema)
    ids = values(tokens.encode_tokens(alike, vocab, max_len=2), "review_id", "input_ids")
    assert ids == [(1, [3, 0]), (1, [3, 0]), (None, [2, 1])]
    assert tokens.encode_tokens(df.limit(0), vocab).count() == 0


def test_too_large_vocabulary_raises(spark, monkeypatch):
    df = spark.createDataFrame([(1, "a")], "review_id int, cleaned_text string")
    monkeypatch.setattr(tokens, "fits_broadcast", lambda table: False)
    with pytest.raises(ValueError, match="too large"):
        tokens.encode_tokens(df, tokens.build_vocab(df, 2))


def test_model_scorer_labels_blank_text(spark):
    rows = [(0, "bad place"), (0, "bad food"), (1, "good place"), (1, "good food")]
    model = training.train_classifier(spark.createDataFrame(rows, "label int, cleaned_text string"), training.Params(max_iter=5, features=64))
    new = spark.createDataFrame([("good", 7), (" ", 8), (None, 9)], "full_review string, cleaned_text int")
    scored = training.model_scorer(model)(new)
    assert scored.columns == ["full_review", "cleaned_text", "predicted_sentiment"]
    found = {row.cleaned_text: row.predicted_sentiment for row in scored.collect()}
    assert found == {7: LABELS[1], 8: NO_TEXT_LABEL, 9: NO_TEXT_LABEL}


@pytest.mark.parametrize("limit", [stars.LITERAL_WORDS, 1])
def test_stars_inline_and_joined(spark, monkeypatch, limit):
    monkeypatch.setattr(stars, "LITERAL_WORDS", limit)
    lexicon = spark.createDataFrame([("good", 5), ("bad", 1), ("fine", 4), ("odd", 9)], "word string, stars int")
    rows = [(1, "good good bad"), (2, "bad"), (3, "what odd"), (4, None), (5, "good fine"), (6, "")]
    df = spark.createDataFrame(rows, "review_id int, cleaned_text string")
    found = dict(values(stars.score_stars(df, lexicon), "review_id", "predicted_rating"))
    assert found == {1: 4, 2: 1, 3: 3, 4: 3, 5: 5, 6: 3}
    alike = spark.createDataFrame([(1, "good"), (1, "bad"), (None, "good"), (None, None)], df.schema)
    assert values(stars.score_stars(alike, lexicon), "cleaned_text", "predicted_rating") == [("bad", 1), ("good", 5), ("good", 5), (None, 3)]


def test_large_lexicon_moves_no_frequent_word(spark, monkeypatch):
    monkeypatch.setattr(stars, "LITERAL_WORDS", 1)
    lexicon = spark.createDataFrame([("good", 5), ("bad", 1), ("fine", 4), ("dull", 2), ("unused", 3)], "word string, stars int")
    rows = [(i, f"the good good {w}") for i, w in enumerate(["bad", "fine", "dull", "rare", "bad bad"] * 2)] + [(None, None), (11, "the"), (11, "dull the the")]
    df = spark.createDataFrame(rows, "review_id int, cleaned_text string")
    whole = values(stars.score_stars(df, lexicon))
    used = df.selectExpr("cleaned_text AS _one", "cleaned_text AS _two", "explode(split(cleaned_text, ' ')) AS word")
    assert "Exchange hashpartitioning" not in stars._starred(used, lexicon)._jdf.queryExecution().toString()
    # Too large to broadcast: two words, of three tenths of the uses each, may be; then none.
    for most, level in ((2, 4), (0, 65)):
        monkeypatch.setattr(stars, "BROADCAST_ROWS", most)
        monkeypatch.setattr(stars, "fits_broadcast", lambda df: False)
        assert values(stars.score_stars(df, lexicon)) == whole
        counts = used.groupBy("word").agg(F.expr("length(bin(count(1)))").alias("_level"))
        assert stars._broadcast_level(counts) == level
        assert values(stars._starred(used, lexicon).groupBy("stars").count()) == [(1, 6), (2, 3), (4, 2), (5, 20)]
    assert dict(values(df.join(stars.score_stars(df, lexicon), ["review_id", "cleaned_text"]), "cleaned_text", "predicted_rating")) == {
        "the good good bad": 4, "the good good fine": 5, "the good good dull": 4, "the good good rare": 5, "the good good bad bad": 3, "the": 3, "dull the the": 2,
    }


def test_scorer_never_sees_blank_text(spark):
    def loader():
        def model(texts):
            assert all(text.strip() for text in texts) and len(texts) <= 16
            return [text.upper() for text in texts]

        return model

    df = spark.createDataFrame([("a",), ("  ",), (None,)] + [("b",)] * 40, "full_review string")
    found = [row.predicted_sentiment for row in stars.score_with(df, loader).collect()]
    assert found == ["A", "No Text", "No Text"] + ["B"] * 40


def test_classifier_beats_the_majority_class_and_survives_saving(spark, tmp_path):
    words = ["awful", "poor", "okay", "nice", "superb"]
    rows = [(i, f"{words[i % 5]} place {words[i % 5]} number{i % 7}", i % 5) for i in range(200)] + [(999, "superb", 4)] * 50
    df = spark.createDataFrame(rows, "review_id int, cleaned_text string, label int")
    grid = [training.Params(max_iter=1, features=1), training.Params(max_iter=10, features=256)]
    best = training.select_best(df, df, grid)
    assert best.params == grid[1] and len(best.history) == 2 and best.f1 > 0.95
    training.save_model(best.model, str(tmp_path / "m"))
    again = training.predict(training.load_model(str(tmp_path / "m")), df)
    assert again.where("label <> prediction").count() == 0
    assert again.where("predicted_sentiment = 'Very Positive'").count() == 90


def test_selection_stops_after_patience(spark):
    df = spark.createDataFrame([(1, "a", 0), (2, "b", 1)] * 5, "review_id int, cleaned_text string, label int")
    same = [training.Params(max_iter=1, features=16)] * 6
    assert len(training.select_best(df, df, same, patience=2).history) == 3
