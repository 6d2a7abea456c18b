"""Profiles, aggregates, sampling and splits over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placepulse.functions.labels import sentiment_label
from placepulse.functions.text import text_length, word_count
from placepulse.operators import profiling, sampling
from placepulse.operators.columns import with_row_id
from placepulse.operators.joins import attach_attraction_id
from placepulse.registry import query
from placepulse.registry.fixtures import (
    ATTRACTIONS_SQL,
    LABEL_CASE,
    REVIEWS_SQL,
    STARRED_SQL,
    TITLED_SQL,
    attractions,
    reviews,
    starred,
    table,
    titled,
)
from placepulse.registry.texts import SQL_SPACE


def _measured(spark: SparkSession, sf: str) -> DataFrame:
    text = F.col("text_review")
    return reviews(spark, sf).select(
        "review_id",
        text.alias("cleaned_text"),
        "rating_review",
        text_length(text).alias("text_length"),
        word_count(text).alias("word_count"),
    )


MEASURED_SQL = f"""{REVIEWS_SQL}, measured AS (SELECT review_id, text_review AS cleaned_text, rating_review,
    CAST(length(text_review) AS INTEGER) AS text_length,
    CAST(len(regexp_extract_all(text_review, '[^{SQL_SPACE}]+')) AS INTEGER) AS word_count FROM reviews)"""


def describe_sql(source: str, names: list[str]) -> str:
    lines = [
        f"""SELECT '{name}' AS "column", count({name}) AS count, round(avg({name}), 6) AS mean,
        round(stddev_samp({name}), 6) AS std, round(CAST(min({name}) AS DOUBLE), 6) AS min,
        round(quantile_cont({name}, 0.25), 6) AS p25, round(quantile_cont({name}, 0.5), 6) AS p50,
        round(quantile_cont({name}, 0.75), 6) AS p75, round(CAST(max({name}) AS DOUBLE), 6) AS max FROM {source}"""
        for name in names
    ]
    return " UNION ALL ".join(lines)


@query(
    "a1_value_counts",
    "SELECT lang, count(*) AS count FROM documents WHERE lang IS NOT NULL GROUP BY lang",
)
def value_counts(spark: SparkSession, sf: str) -> DataFrame:
    return profiling.value_counts(table(spark, sf, "documents"), "lang")


@query(
    "a2_class_distribution",
    """SELECT quality, count(*) AS count,
    round(count(*) / (SELECT count(*) FROM documents) * 100, 1) AS pct
    FROM documents LEFT JOIN labels USING (doc_id) WHERE quality IS NOT NULL GROUP BY quality""",
)
def class_distribution(spark: SparkSession, sf: str) -> DataFrame:
    judged = table(spark, sf, "labels").select("doc_id", "quality")
    docs = table(spark, sf, "documents").select("doc_id").join(judged, "doc_id", "left")
    return profiling.class_distribution(docs, "quality")


_IMBALANCE = """SELECT max(n) AS max_class, min(n) AS min_class, round(max(n) / min(n), 6) AS imbalance_ratio,
    max(n) / min(n) > 3 AS imbalanced FROM (SELECT count(*) AS n FROM {0} WHERE {1} IS NOT NULL GROUP BY {1})"""


@query("a3_imbalance", f"WITH {REVIEWS_SQL} {_IMBALANCE.format('reviews', 'rating_review')}")
def imbalance(spark: SparkSession, sf: str) -> DataFrame:
    return profiling.imbalance(reviews(spark, sf), "rating_review")


@query("a3_imbalance_orders", _IMBALANCE.format("orders", "o_orderpriority"))
def imbalance_orders(spark: SparkSession, sf: str) -> DataFrame:
    return profiling.imbalance(table(spark, sf, "orders"), "o_orderpriority")


@query(
    "a4_describe_numeric",
    f"WITH {MEASURED_SQL} {describe_sql('measured', ['rating_review', 'text_length', 'word_count'])}",
)
def describe_numeric(spark: SparkSession, sf: str) -> DataFrame:
    return profiling.describe_numeric(_measured(spark, sf), ["rating_review", "text_length", "word_count"])


@query(
    "a5_length_stats",
    """SELECT round(avg(length(text)), 6) AS mean_length, round(median(length(text)), 6) AS median_length
    FROM documents""",
)
def length_stats(spark: SparkSession, sf: str) -> DataFrame:
    return profiling.length_stats(table(spark, sf, "documents"), "text")


@query(
    "a6_length_by_rating",
    f"""WITH {MEASURED_SQL} SELECT rating_review, round(avg(text_length), 1) AS mean,
    round(median(text_length), 1) AS median, round(stddev_samp(text_length), 1) AS std
    FROM measured GROUP BY rating_review""",
)
def length_by_rating(spark: SparkSession, sf: str) -> DataFrame:
    return profiling.length_by(_measured(spark, sf))


@query(
    "a7_missing_report",
    """WITH joined AS (SELECT doc_id, quality, toxic FROM documents LEFT JOIN labels USING (doc_id)),
    counts AS (SELECT 'quality' AS "column", count(*) FILTER (quality IS NULL) AS missing_count, count(*) AS n FROM joined
    UNION ALL SELECT 'toxic', count(*) FILTER (toxic IS NULL), count(*) FROM joined
    UNION ALL SELECT 'doc_id', count(*) FILTER (doc_id IS NULL), count(*) FROM joined)
    SELECT "column", missing_count, round(missing_count / n * 100, 6) AS missing_pct FROM counts WHERE missing_count > 0""",
)
def missing_report(spark: SparkSession, sf: str) -> DataFrame:
    judged = table(spark, sf, "labels")
    return profiling.missing_report(table(spark, sf, "documents").select("doc_id").join(judged, "doc_id", "left"))


@query(
    "a8_profile",
    """SELECT * FROM (SELECT 'doc_id' AS "column", 'bigint' AS type, count(doc_id) AS non_null, count(*) AS total_rows, 5 AS total_columns FROM documents
    UNION ALL SELECT 'text', 'string', count(text), count(*), 5 FROM documents
    UNION ALL SELECT 'lang', 'string', count(lang), count(*), 5 FROM documents
    UNION ALL SELECT 'source', 'string', count(source), count(*), 5 FROM documents
    UNION ALL SELECT 'n_chars', 'bigint', count(n_chars), count(*), 5 FROM documents)""",
)
def profile(spark: SparkSession, sf: str) -> DataFrame:
    return profiling.profile(table(spark, sf, "documents"))


_QUALITY_SQL = """quality AS (SELECT count(*) AS total_rows,
    count(*) - (SELECT count(*) FROM (SELECT DISTINCT text_review, rating_review FROM reviews)) AS duplicate_rows,
    count(*) FILTER (NOT rating_review BETWEEN 1 AND 5) AS invalid_ratings,
    count(*) FILTER (length(text_review) < 10) AS very_short,
    count(*) FILTER (length(text_review) > 2000) AS very_long FROM reviews)"""


@query(
    "a9_quality_indicators",
    f"""WITH {REVIEWS_SQL}, {_QUALITY_SQL} SELECT total_rows, duplicate_rows,
    round(duplicate_rows / total_rows * 100, 2) AS duplicate_pct, invalid_ratings, very_short, very_long FROM quality""",
)
def quality_indicators(spark: SparkSession, sf: str) -> DataFrame:
    return profiling.quality_indicators(reviews(spark, sf), "text_review", "rating_review")


@query(
    "a10_rating_distribution",
    f"""WITH {REVIEWS_SQL} SELECT rating_review, count(*) AS count,
    round(count(*) / (SELECT count(*) FROM reviews) * 100, 1) AS pct FROM reviews GROUP BY rating_review""",
)
def rating_distribution(spark: SparkSession, sf: str) -> DataFrame:
    return profiling.rating_distribution(reviews(spark, sf))


@query(
    "a11_findings",
    f"""WITH {REVIEWS_SQL}, {_QUALITY_SQL}, classes AS (SELECT CASE WHEN rating_review >= 4 THEN 'Positive'
    WHEN rating_review = 3 THEN 'Neutral' ELSE 'Negative' END AS class, count(*) AS n FROM reviews GROUP BY 1)
    SELECT 'class imbalance' AS finding WHERE (SELECT max(n) / min(n) FROM classes) > 3
    UNION ALL SELECT 'extreme text lengths' FROM quality WHERE very_short > 0 OR very_long > 0
    UNION ALL SELECT 'duplicate entries' FROM quality WHERE duplicate_rows > 0
    UNION ALL SELECT 'large data set' FROM quality WHERE total_rows > 100000
    UNION ALL SELECT 'few negative samples' WHERE
    (SELECT coalesce(sum(n) FILTER (class = 'Negative'), 0) / sum(n) * 100 FROM classes) < 10""",
)
def findings(spark: SparkSession, sf: str) -> DataFrame:
    return profiling.findings(reviews(spark, sf), "text_review", "rating_review")


@query(
    "a12_temporal_profile",
    """SELECT 'o_orderdate' AS date_column, strftime(o_orderdate, '%Y-%m') AS month, count(*) AS count
    FROM orders WHERE o_orderdate IS NOT NULL GROUP BY 2""",
)
def temporal_profile(spark: SparkSession, sf: str) -> DataFrame:
    return profiling.temporal_profile(table(spark, sf, "orders"))


@query(
    "a12_temporal_profile_undated",
    "SELECT source AS date_column, lang AS month, n_chars AS count FROM documents WHERE false",
)
def temporal_profile_undated(spark: SparkSession, sf: str) -> DataFrame:
    return profiling.temporal_profile(table(spark, sf, "documents"))


STATS = ["very_negative", "negative", "neutral", "positive", "very_positive"]
STATS_SQL = ", ".join(
    f"count(*) FILTER (predicted_sentiment = '{name.replace('_', ' ').title()}') AS {name}" for name in STATS
)


@query(
    "a14_sentiment_stats",
    f"""WITH {TITLED_SQL}, {ATTRACTIONS_SQL}, placed AS (SELECT a.id,
    {LABEL_CASE.format("rating_review")} AS predicted_sentiment FROM titled t JOIN attractions a ON t.title = a.title), counts AS (SELECT id, {STATS_SQL}, count(*) AS total FROM placed GROUP BY id)
    SELECT a.id AS attraction_id, {", ".join(f"coalesce({name}, 0) AS {name}" for name in [*STATS, "total"])}
    FROM attractions a LEFT JOIN counts c ON a.id = c.id""",
)
def sentiment_stats(spark: SparkSession, sf: str) -> DataFrame:
    known = attractions(spark, sf)
    labelled = titled(spark, sf).withColumn("predicted_sentiment", sentiment_label(F.col("rating_review")))
    return profiling.sentiment_stats(known, attach_attraction_id(labelled, known))


@query(
    "a15_label_audit",
    """WITH invalid AS (SELECT event_type AS label FROM events WHERE event_type NOT IN ('Neutral'))
    SELECT (SELECT count(*) FROM invalid) AS invalid_labels,
    (SELECT string_agg(label, '|' ORDER BY label) FROM (SELECT DISTINCT label FROM invalid ORDER BY label LIMIT 5)) AS examples""",
)
def label_audit(spark: SparkSession, sf: str) -> DataFrame:
    return profiling.label_audit(table(spark, sf, "events"), "event_type")


def _balanced_sql(ctes: str, source: str, label: str) -> str:
    return f"""WITH {ctes}, ranked AS (SELECT *, row_number() OVER (PARTITION BY {label}
    ORDER BY md5('42-' || review_id)) AS rn FROM {source}) SELECT review_id, {label} FROM ranked
    WHERE rn <= (SELECT min(n) FROM (SELECT count(*) AS n FROM {source} GROUP BY {label}))"""


@query("r1_balance_classes", _balanced_sql(STARRED_SQL, "starred", "stars"))
def balance_classes(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.balance_classes(starred(spark, sf).select("review_id", "stars"), "stars")


@query("r1_balance_classes_uneven", _balanced_sql(REVIEWS_SQL, "reviews", "rating_review"))
def balance_classes_uneven(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.balance_classes(reviews(spark, sf).select("review_id", "rating_review"), "rating_review")


@query(
    "r2_shuffle_rows",
    """SELECT o_orderkey, row_number() OVER (ORDER BY md5('42-' || o_orderkey)) - 1 AS position FROM orders""",
)
def shuffle_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The random order, made visible as a position."""
    keyed = table(spark, sf, "orders").select("o_orderkey", sampling.order_key("o_orderkey").alias("k"))
    return with_row_id(keyed, ["k", "o_orderkey"], "position").drop("k")


# A stage in which some class has fewer than two rows is not stratified.
SPLIT_SQL = """sizes AS (SELECT count(*) AS n, CAST(ceil((0.2::DOUBLE + 0.1::DOUBLE) * count(*)) AS BIGINT) AS held FROM {0}),
    parts AS (SELECT n - held AS n_train, held - CAST(ceil(0.2::DOUBLE / (0.2::DOUBLE + 0.1::DOUBLE) * held) AS BIGINT) AS n_val,
        n, held FROM sizes),
    c1 AS (SELECT {1} AS g, count(*) AS c FROM {0} GROUP BY 1),
    q1 AS (SELECT g, c, c * n_train // n AS whole, c * n_train % n AS rest, n_train AS part FROM c1, parts),
    train_q AS (SELECT g, c, whole + CASE WHEN row_number() OVER (ORDER BY rest DESC, g) <=
        part - sum(whole) OVER () THEN 1 ELSE 0 END AS qt FROM q1),
    q2 AS (SELECT g, (c - qt) * n_val // held AS whole, (c - qt) * n_val % held AS rest, n_val AS part
        FROM train_q, parts WHERE c > qt),
    val_q AS (SELECT g, whole + CASE WHEN row_number() OVER (ORDER BY rest DESC, g) <=
        part - sum(whole) OVER () THEN 1 ELSE 0 END AS qv FROM q2),
    lows AS (SELECT (SELECT min(c) FROM c1) AS low, (SELECT min(c - qt) FROM train_q WHERE c > qt) AS low_held),
    ordered AS (SELECT *, row_number() OVER (PARTITION BY {1} ORDER BY md5('42-' || review_id)) AS rn,
        row_number() OVER (ORDER BY md5('42-' || review_id)) AS ra FROM {0}),
    marked AS (SELECT o.*, qt, qv, n_train, n_val, low, low_held, CASE WHEN low < 2 THEN ra <= n_train ELSE rn <= qt END AS in_train
        FROM ordered o JOIN train_q t ON o.{1} = t.g LEFT JOIN val_q v ON o.{1} = v.g, parts, lows),
    placed AS (SELECT *, row_number() OVER (PARTITION BY in_train ORDER BY ra) AS rh FROM marked),
    split_rows AS (SELECT * EXCLUDE (rn, ra, rh, qt, qv, n_train, n_val, low, low_held, in_train), CASE WHEN in_train THEN 'train'
        WHEN CASE WHEN low < 2 THEN ra <= n_train + n_val WHEN low_held < 2 THEN rh <= n_val
        ELSE rn <= qt + coalesce(qv, 0) END THEN 'validation' ELSE 'test' END AS split FROM placed)"""


@query(
    "r3_stratified_split",
    f"""WITH {STARRED_SQL}, {SPLIT_SQL.format("starred", "predicted_sentiment_label")}
    SELECT review_id, predicted_sentiment_label, split FROM split_rows""",
)
def stratified_split(spark: SparkSession, sf: str) -> DataFrame:
    rows = starred(spark, sf).select("review_id", "predicted_sentiment_label")
    return sampling.stratified_split(rows, "predicted_sentiment_label")


@query(
    "r3_stratified_split_uneven",
    f"""WITH {REVIEWS_SQL}, {SPLIT_SQL.format("reviews", "detected_language")}
    SELECT review_id, detected_language, split FROM split_rows""",
)
def stratified_split_uneven(spark: SparkSession, sf: str) -> DataFrame:
    rows = reviews(spark, sf).select("review_id", "detected_language")
    return sampling.stratified_split(rows, "detected_language")


@query(
    "r4_top_k",
    "SELECT source, count(*) AS count FROM documents GROUP BY source ORDER BY count(*) DESC, source LIMIT 10",
)
def top_k(spark: SparkSession, sf: str) -> DataFrame:
    return profiling.top_k(table(spark, sf, "documents"), "source", 10)
