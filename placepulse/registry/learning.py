"""Language, tokens, stars, training and evaluation over the given tables."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placepulse.functions.text import full_review
from placepulse.operators import language, metrics, sampling, stars, tokens, training
from placepulse.registry import query
from placepulse.registry.fixtures import REVIEWS_SQL, STARRED_SQL, reviews, starred, table, titled
from placepulse.registry.profiles import SPLIT_SQL
from placepulse.registry.texts import SQL_SPACE
from placepulse.schema import LABELS, label_to_id, label_vocab
from placepulse.session import durable, scratch_path, spread


def words_sql(column: str) -> str:
    return f"regexp_extract_all({column}, '[^{SQL_SPACE}]+')"


def _grams(source: str, name: str) -> str:
    """CTEs ``<name>_kept(id, lang, gram)``: the n-grams of one to three letters of a table ``id, lang, text``."""
    return rf"""{name}_padded AS (SELECT id, lang,
    string_split(' ' || trim(regexp_replace(lower(text), '[^\p{{L}}]+', ' ', 'g')) || ' ', '') AS p FROM {source}),
{name}_letters AS (SELECT id, lang, unnest(p) AS a, unnest(p[2:]) AS b, unnest(p[3:]) AS c FROM {name}_padded),
{name}_grams AS (SELECT id, lang, a AS gram FROM {name}_letters UNION ALL SELECT id, lang, a || b FROM {name}_letters
    UNION ALL SELECT id, lang, a || b || c FROM {name}_letters WHERE b <> ' '),
{name}_kept AS (SELECT id, lang, gram FROM {name}_grams WHERE gram IS NOT NULL AND trim(gram) <> '')"""


# Naive Bayes over character n-grams spelled out: counts per language, smoothed log-probabilities,
# the best sum per document. Equal sums go to the first language.
def language_sql(asked: str) -> str:
    """CTE ``detected(id, lang)`` of a table ``asked(id, text)``, the model being that of the documents."""
    return f"""taught AS (SELECT doc_id AS id, lang, text FROM documents), {_grams("taught", "taught")},
asked AS (SELECT id, NULL AS lang, text FROM ({asked})), {_grams("asked", "asked")},
seen AS (SELECT lang, gram, count(*) AS n FROM taught_kept GROUP BY ALL),
vocab AS (SELECT DISTINCT gram FROM seen),
langs AS (SELECT lang, count(*) AS docs FROM documents GROUP BY lang),
pair AS (SELECT lang, gram FROM langs, vocab),
total AS (SELECT lang, sum(n) AS n FROM seen GROUP BY lang),
theta AS (SELECT p.lang, p.gram, ln(coalesce(s.n, 0) + 1) - ln(t.n + (SELECT count(*) FROM vocab)) AS w
    FROM pair p JOIN total t ON p.lang = t.lang LEFT JOIN seen s ON p.lang = s.lang AND p.gram = s.gram),
prior AS (SELECT lang, ln(docs + 1) - ln((SELECT count(*) FROM documents) + (SELECT count(*) FROM langs)) AS w FROM langs),
counted AS (SELECT id, gram, count(*) AS n FROM asked_kept GROUP BY ALL),
scores AS (SELECT c.id, t.lang, sum(c.n * t.w) + any_value(p.w) AS score
    FROM counted c JOIN theta t ON c.gram = t.gram JOIN prior p ON p.lang = t.lang GROUP BY c.id, t.lang),
best AS (SELECT id, lang, row_number() OVER (PARTITION BY id ORDER BY score DESC, lang) AS rn FROM scores),
detected AS (SELECT d.id, CASE WHEN length(trim(d.text)) < 3 THEN 'unknown' ELSE coalesce(b.lang, 'unknown') END AS lang
    FROM asked d LEFT JOIN best b ON d.id = b.id AND b.rn = 1)"""


@query(
    "l1_detect_language",
    f"WITH {language_sql('SELECT doc_id AS id, text FROM documents')} SELECT id AS doc_id, lang AS detected_language FROM detected",
)
def detect_language(spark: SparkSession, sf: str) -> DataFrame:
    docs = spread(table(spark, sf, "documents"), "doc_id")
    model = language.fit_language_profiles(docs)
    return language.detect_language(docs.select("doc_id", "text"), model, "text").drop("text")


_BODY = r"""regexp_replace(regexp_replace(html, '(?s)<(script|style).*?</(script|style)>', ' ', 'g'), '<[^>]+>', ' ', 'g')"""


@query(
    "l1_language_accuracy",
    f"""WITH {language_sql(f"SELECT page_id AS id, {_BODY} AS text FROM pages")} SELECT round(count(*) FILTER
    (lang = regexp_extract(html, '<html lang="([a-z]+)"', 1)) / count(*), 6) AS accuracy FROM pages JOIN detected ON page_id = id""",
)
def language_accuracy(spark: SparkSession, sf: str) -> DataFrame:
    """Trained on the documents, measured on every web page by the language it names."""
    docs = spread(table(spark, sf, "documents"), "doc_id")
    model = language.fit_language_profiles(docs)
    pages = spread(table(spark, sf, "pages"), "page_id")
    body = F.regexp_replace(F.regexp_replace("html", "(?s)<(script|style).*?</(script|style)>", " "), "<[^>]+>", " ")
    truth = F.regexp_extract("html", '<html lang="([a-z]+)"', 1)
    judged = language.detect_language(pages.select("page_id", truth.alias("lang"), body.alias("text")), model, "text")
    return language.accuracy(judged, "lang", "detected_language")


@query(
    "l2_label_vocab",
    f"""WITH {STARRED_SQL} SELECT predicted_sentiment_label AS label, CAST(label AS INTEGER) AS label_id,
    count(*) AS n FROM starred GROUP BY ALL""",
)
def label_vocabulary(spark: SparkSession, sf: str) -> DataFrame:
    """Both directions of the vocabulary: text to id by expression, id to text by table."""
    ids = starred(spark, sf).select(label_to_id(F.col("predicted_sentiment_label")).alias("label_id"))
    counts = ids.groupBy("label_id").agg(F.count(F.lit(1)).alias("n"))
    return counts.join(label_vocab(spark), "label_id").select("label", "label_id", "n")


_VOCAB_SQL = f"""words AS (SELECT unnest({words_sql("text")}) AS token FROM documents),
    vocab AS (SELECT token, count, CAST(row_number() OVER (ORDER BY count DESC, token) + 1 AS INTEGER) AS token_id
    FROM (SELECT token, count(*) AS count FROM words GROUP BY token ORDER BY count DESC, token LIMIT 3000))"""


@query("l3_build_vocab", f"WITH {_VOCAB_SQL} SELECT * FROM vocab")
def build_vocab(spark: SparkSession, sf: str) -> DataFrame:
    return tokens.build_vocab(spread(table(spark, sf, "documents"), "doc_id"), 3000, "text")


@query(
    "l4_encode_tokens",
    f"""WITH {_VOCAB_SQL}, heads AS (SELECT doc_id, {words_sql("text")}[1:512] AS w FROM documents),
    places AS (SELECT doc_id, unnest(w) AS token, unnest(range(1, len(w) + 1)) AS place FROM heads),
    ids AS (SELECT doc_id, list(coalesce(token_id, 1) ORDER BY place) AS ids FROM places LEFT JOIN vocab USING (token) GROUP BY doc_id)
    SELECT d.doc_id, array_to_string(list_resize(coalesce(ids, []), 512, 0), ',') AS input_ids,
    CAST(coalesce(len(ids), 0) AS INTEGER) AS n_tokens FROM documents d LEFT JOIN ids USING (doc_id)""",
)
def encode_tokens(spark: SparkSession, sf: str) -> DataFrame:
    docs = spread(table(spark, sf, "documents"), "doc_id").select("doc_id", "text")
    encoded = tokens.encode_tokens(docs, tokens.build_vocab(docs, 3000, "text"), "text")
    return encoded.select(
        "doc_id",
        F.array_join("input_ids", ",").alias("input_ids"),
        F.aggregate("attention_mask", F.lit(0), lambda a, b: a + b).alias("n_tokens"),
    )




def lexicon_sql(size: int | None = None) -> str:
    """All words, or the most frequent ones."""
    most = "" if size is None else f" ORDER BY n DESC, word LIMIT {size}"
    return f"""{REVIEWS_SQL}, used AS (SELECT review_id, rating_review,
    unnest(list_distinct({words_sql("text_review")})) AS word FROM reviews),
    lexicon AS (SELECT word, CAST(round(mean) AS INTEGER) AS stars FROM (SELECT word, count(*) AS n,
    avg(rating_review) AS mean FROM used GROUP BY word{most}))"""


def _stars(size: int | None = None) -> str:
    return f"""WITH {lexicon_sql(size)}, occurrences AS (SELECT review_id, unnest({words_sql("text_review")}) AS word FROM reviews),
    sums AS (SELECT review_id, floor(sum(stars) / count(*) + 0.5) AS mean FROM occurrences JOIN lexicon USING (word) GROUP BY review_id)
    SELECT review_id, CAST(CASE WHEN mean IS NULL THEN 3 ELSE greatest(1, least(5, mean)) END AS INTEGER) AS predicted_rating
    FROM reviews LEFT JOIN sums USING (review_id)"""


@query("m1_fit_lexicon", f"WITH {lexicon_sql()} SELECT word, stars FROM lexicon")
def fit_lexicon(spark: SparkSession, sf: str) -> DataFrame:
    return stars.fit_lexicon(reviews(spark, sf), "text_review")


@query("m1_score_stars", _stars())
def score_stars(spark: SparkSession, sf: str) -> DataFrame:
    rows = reviews(spark, sf)
    scored = stars.score_stars(rows, stars.fit_lexicon(rows, "text_review"), "text_review")
    return scored.select("review_id", "predicted_rating")


@query("m1_score_stars_large_lexicon", _stars(20000))
def score_stars_largelexicon_sql(spark: SparkSession, sf: str) -> DataFrame:
    """A lexicon too large for literals is joined instead."""
    rows = reviews(spark, sf)
    scored = stars.score_stars(rows, stars.fit_lexicon(rows, "text_review", size=20000), "text_review")
    return scored.select("review_id", "predicted_rating")


def length_model():
    """A stand-in for an external model: texts are judged by the evenness of their length."""
    return lambda texts: [LABELS[len(text) % 5] for text in texts]


@query(
    "m2_score_with",
    f"""WITH {REVIEWS_SQL} SELECT review_id, CASE length(' ' || text_review) % 5 {
        " ".join(f"WHEN {i} THEN '{name}'" for i, name in enumerate(LABELS))} END AS predicted_sentiment FROM reviews""",
)
def score_with(spark: SparkSession, sf: str) -> DataFrame:
    rows = reviews(spark, sf).select("review_id", full_review(F.lit(None).cast("string"), F.col("text_review")).alias("full_review"))
    return stars.score_with(rows, length_model).drop("full_review")


@query("m3_argmax", "SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS INTEGER) AS best FROM embeddings")
def argmax(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings").select("vec_id", metrics.argmax(F.col("embedding")).alias("best"))


@query(
    "a13_class_weights",
    f"""WITH {REVIEWS_SQL} SELECT rating_review AS label, count(*) AS n, round((SELECT count(*) FROM reviews) /
    ((SELECT count(DISTINCT rating_review) FROM reviews) * count(*)), 6) AS weight FROM reviews GROUP BY 1""",
)
def class_weights(spark: SparkSession, sf: str) -> DataFrame:
    weights = metrics.class_weights(reviews(spark, sf).select(F.col("rating_review").alias("label")))
    return weights.withColumn("weight", F.round("weight", 6))


_SCORES_SQL = f"""{STARRED_SQL}, classes AS (SELECT unnest(range(0, 5)) AS k),
    scores AS (SELECT k, count(*) FILTER (label = k) AS truth, count(*) FILTER (prediction = k) AS guess,
    count(*) FILTER (label = k AND prediction = k) AS hit FROM classes, starred GROUP BY k),
    rates AS (SELECT *, CASE WHEN guess > 0 THEN hit / guess ELSE 0 END AS precision,
    CASE WHEN truth > 0 THEN hit / truth ELSE 0 END AS recall, 2 * hit / (truth + guess) AS f1 FROM scores)"""


@query(
    "m6_weighted_metrics",
    f"""WITH {_SCORES_SQL} SELECT round(sum(hit) / sum(truth), 6) AS accuracy,
    round(sum(precision * truth) / sum(truth), 6) AS precision, round(sum(recall * truth) / sum(truth), 6) AS recall,
    round(sum(f1 * truth) / sum(truth), 6) AS f1 FROM rates""",
)
def weighted_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.weighted_metrics(starred(spark, sf))


_NAMES_SQL = "[" + ", ".join(f"'{name}'" for name in LABELS) + "]"


@query(
    "m7_classification_report",
    f"""WITH {_SCORES_SQL} SELECT {_NAMES_SQL}[k + 1] AS class, round(precision, 6) AS precision,
    round(recall, 6) AS recall, round(f1, 6) AS f1, truth AS support FROM rates
    UNION ALL SELECT 'accuracy', round(sum(hit) / sum(truth), 6), round(sum(hit) / sum(truth), 6),
        round(sum(hit) / sum(truth), 6), CAST(sum(truth) AS BIGINT) FROM rates
    UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), CAST(sum(truth) AS BIGINT) FROM rates
    UNION ALL SELECT 'weighted avg', round(sum(precision * truth) / sum(truth), 6), round(sum(recall * truth) / sum(truth), 6),
        round(sum(f1 * truth) / sum(truth), 6), CAST(sum(truth) AS BIGINT) FROM rates""",
)
def classification_report(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.classification_report(starred(spark, sf))


@query(
    "m5_weighted_log_loss",
    f"""WITH {STARRED_SQL}, p AS (SELECT label + 1 AS weight,
    -ln(CASE WHEN prediction = label THEN 0.6 ELSE 0.1 END::DOUBLE) AS loss FROM starred)
    SELECT round(sum(weight * loss) / sum(weight), 6) AS weighted_log_loss FROM p""",
)
def weighted_log_loss(spark: SparkSession, sf: str) -> DataFrame:
    sure = [F.when(F.col("prediction") == k, 0.6).otherwise(0.1) for k in range(5)]
    rows = starred(spark, sf).select("label", F.array(*sure).alias("probability"), (F.col("label") + 1).alias("weight"))
    return metrics.weighted_log_loss(rows)


def judged(spark: SparkSession, sf: str) -> DataFrame:
    """Documents judged for quality, as a training set."""
    docs = spread(table(spark, sf, "documents"), "doc_id").select("doc_id", F.col("text").alias("cleaned_text"))
    return docs.join(table(spark, sf, "labels").select("doc_id", F.col("quality").alias("label")), "doc_id")


JUDGED_SQL = f"""judged AS (SELECT doc_id AS review_id, quality AS label FROM documents JOIN labels USING (doc_id)),
    {SPLIT_SQL.format("judged", "label")}"""
#: Two points of the grid at the library's sizes.
GRID = (training.Params(), training.Params(reg_param=0.1))


def judged_parts(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """The judged documents split for training, validation and test."""
    rows = durable(judged(spark, sf).withColumnRenamed("doc_id", "review_id"))
    return sampling.split_tables(sampling.stratified_split(rows, "label"))


@query("m4_train_classifier", f"WITH {JUDGED_SQL} SELECT count(*) AS rows, true AS known, true AS learnt FROM split_rows WHERE split = 'test'")
def train_classifier(spark: SparkSession, sf: str) -> DataFrame:
    """Trained on one part, judged on another: every prediction a label, no worse than the most frequent class."""
    parts = judged_parts(spark, sf)
    scored = durable(training.predict(training.train_classifier(parts["train"]), parts["test"]))
    # One row per class.
    most = parts["train"].groupBy("label").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "label").first()["label"]
    plain = metrics.weighted_metrics(scored.withColumn("prediction", F.lit(most))).select("f1").scalar()
    learnt = metrics.weighted_metrics(scored).select("f1").scalar() >= plain
    known = F.bool_and(F.col("predicted_sentiment").isin(*LABELS))
    return scored.agg(F.count(F.lit(1)).alias("rows"), known.alias("known")).withColumn("learnt", learnt)


@query(
    "m8_select_best",
    f"WITH {JUDGED_SQL} SELECT label, count(*) AS support, true AS best FROM split_rows WHERE split = 'test' GROUP BY label",
)
def select_best(spark: SparkSession, sf: str) -> DataFrame:
    """Chosen on validation rows, applied to test rows; the choice has the best score of all trials."""
    parts = judged_parts(spark, sf)
    chosen = training.select_best(parts["train"], parts["validation"], GRID)
    scored = training.predict(chosen.model, parts["test"])
    support = scored.where(F.col("predicted_sentiment").isin(*LABELS)).groupBy("label").agg(F.count(F.lit(1)).alias("support"))
    return support.withColumn("best", F.lit(chosen.f1 == max(chosen.history) and len(chosen.history) == len(GRID)))


@query("m9_save_and_load", "SELECT doc_id, true AS same FROM documents JOIN labels USING (doc_id)")
def save_and_load(spark: SparkSession, sf: str) -> DataFrame:
    """The loaded model gives every document the probabilities of the one that was saved."""
    docs, path = judged(spark, sf), scratch_path(spark, "model")
    model = training.train_classifier(docs)
    training.save_model(model, path)
    first, second = (
        m.transform(docs).select("doc_id", vector_to_array("probability").alias(name))
        for m, name in ((model, "saved"), (training.load_model(path), "loaded"))
    )
    gap = F.array_max(F.zip_with("saved", "loaded", lambda a, b: F.abs(a - b)))
    return first.join(second, "doc_id").select("doc_id", (gap < 1e-9).alias("same"))


@query("m10_predict", "SELECT doc_id AS review_id, true AS labelled FROM documents")
def predict(spark: SparkSession, sf: str) -> DataFrame:
    """Trained on the judged documents, applied to every titled review: each gets the label of its class."""
    model = training.train_classifier(judged(spark, sf))
    rows = titled(spark, sf).select("review_id", full_review(F.col("title"), F.col("text_review")).alias("cleaned_text"))
    label = F.element_at(F.array(*map(F.lit, LABELS)), F.col("prediction") + 1)
    scored = training.predict(model, rows)
    return scored.select("review_id", (F.coalesce(F.col("predicted_sentiment") == label, F.lit(False))).alias("labelled"))
