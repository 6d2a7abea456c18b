"""Sources, sinks, projections, filters, joins and set operators over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placepulse.functions.text import text_length
from placepulse.operators import columns, filters, joins, sets
from placepulse.plans.corpus import reclean
from placepulse.registry import query
from placepulse.registry.fixtures import (
    ALIASES_SQL,
    ATTRACTIONS_SQL,
    PUBLISHED_SQL,
    REVIEWS_SQL,
    STARRED_SQL,
    TITLED_SQL,
    aliases,
    attractions,
    published,
    reviews,
    starred,
    table,
    titled,
)
from placepulse.registry.texts import SQL_SPACE, rule_ctes
from placepulse.schema import ATTRACTIONS, LABELS
from placepulse.session import scratch_path
from placepulse.sources import files
from placepulse.sources.keys import KeyIndex
from placepulse.sources.tables import TableStore

_DELIVERY = T.StructType(
    [
        T.StructField("review_id", T.LongType()),
        T.StructField("text_review", T.StringType()),
        T.StructField("rating_review", T.IntegerType()),
    ]
)
_REVIEWS_3 = f"WITH {REVIEWS_SQL} SELECT review_id, text_review, rating_review FROM reviews"
_ORDER_KEYS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice"


def _orders(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")


# --- sources and sinks -----------------------------------------------------------------------


def _delivered(spark: SparkSession, sf: str, encoding: str) -> DataFrame:
    """Write the reviews as a CSV delivery with other columns in front, and read it back."""
    path = scratch_path(spark, "delivery")
    shuffled = reviews(spark, sf).select("source", "rating_review", "review_id", "text_review")
    writer = shuffled.write.option("header", True).option("quoteAll", True).option("escape", '"')
    writer = writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    writer.option("encoding", encoding).csv(path)
    return files.read_reviews_csv(spark, path, _DELIVERY, encoding=encoding)


@query("s1_csv_scan", _REVIEWS_3)
def csv_scan(spark: SparkSession, sf: str) -> DataFrame:
    return _delivered(spark, sf, "UTF-8")


@query("s2_csv_scan_latin1", _REVIEWS_3)
def csv_scan_latin1(spark: SparkSession, sf: str) -> DataFrame:
    return _delivered(spark, sf, "ISO-8859-1")


@query("s3_csv_sink", _REVIEWS_3)
def csv_sink(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "csv")
    files.write_csv(reviews(spark, sf).select("review_id", "text_review", "rating_review"), path)
    return files.read_reviews_csv(spark, path, _DELIVERY)


@query(
    "s4_distribution_sink",
    "SELECT event_type, count(*) AS count FROM events WHERE event_type IS NOT NULL GROUP BY event_type",
)
def distribution_sink(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "distribution")
    files.write_distribution(table(spark, sf, "events"), "event_type", path)
    schema = T.StructType([T.StructField("event_type", T.StringType()), T.StructField("count", T.LongType())])
    return files.read_reviews_csv(spark, path, schema)


@query(
    "s5_empty_scored_sink",
    f"""WITH {TITLED_SQL} SELECT source, title, text_review, 'Neutral' AS predicted_sentiment FROM titled t
    WHERE NOT EXISTS (SELECT 1 FROM reviews r WHERE r.text_review = t.text_review AND r.source = t.source)""",
)
def empty_scored_sink(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "scored")
    unseen = joins.new_reviews(titled(spark, sf), reviews(spark, sf))
    files.write_scored(unseen.withColumn("predicted_sentiment", F.lit("Neutral")), path)
    return files.read_scored_csv(spark, path)


@query("s6_parquet_round_trip", f"SELECT {_ORDER_KEYS} FROM orders")
def parquet_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "orders")
    files.write_parquet(_orders(spark, sf), path)
    return files.read_parquet(spark, path)


@query(
    "s7_label_map",
    f"""WITH {STARRED_SQL} SELECT CAST(label AS INTEGER) AS label_id, predicted_sentiment_label AS label,
    count(*) AS n FROM starred GROUP BY 1, 2""",
)
def label_map(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "labels")
    files.write_label_map(spark, path)
    counts = starred(spark, sf).groupBy(F.col("label").alias("label_id")).agg(F.count(F.lit(1)).alias("n"))
    # One row per class on both sides.
    return counts.join(files.read_label_map(spark, path), "label_id").select("label_id", "label", "n")


@query("s8_table_scan", f"WITH {ATTRACTIONS_SQL} SELECT title FROM attractions")
def table_scan(spark: SparkSession, sf: str) -> DataFrame:
    store = TableStore(spark, scratch_path(spark, "store"))
    store.replace_table(attractions(spark, sf), "attractions")
    return store.read_table("attractions", ATTRACTIONS, ["title"])


@query(
    "s9_table_append",
    f"WITH {REVIEWS_SQL} SELECT review_id, text_review, rating_review FROM reviews",
)
def table_append(spark: SparkSession, sf: str) -> DataFrame:
    store = TableStore(spark, scratch_path(spark, "store"))
    rows = reviews(spark, sf).select("review_id", "text_review", "rating_review")
    english = F.col("detected_language") == "en"
    for part, wanted in (("en", english), ("other", ~english), ("en", english)):
        store.append_table(reviews(spark, sf).where(wanted).select(*rows.columns), "reviews", part)
    return store.read_table("reviews", rows.schema)


@query(
    "s10_table_replace",
    f"WITH {ATTRACTIONS_SQL} SELECT id + 100 AS id, title FROM attractions",
)
def table_replace(spark: SparkSession, sf: str) -> DataFrame:
    store = TableStore(spark, scratch_path(spark, "store"))
    store.replace_table(attractions(spark, sf), "attractions")
    current = store.read_table("attractions", ATTRACTIONS)
    store.replace_table(current.withColumn("id", F.col("id") + 100), "attractions")
    store.replace_table(current.where("id IS NULL"), "attractions", skip_if_empty=True)
    return store.read_table("attractions", ATTRACTIONS)


# --- projections -----------------------------------------------------------------------------


@query("p1_select_columns", f"SELECT {_ORDER_KEYS} FROM orders")
def select_columns(spark: SparkSession, sf: str) -> DataFrame:
    return columns.select_columns(table(spark, sf, "orders"), _ORDER_KEYS.split(", "))


@query("p2_with_source", "SELECT c_custkey, c_name, 'reviews site' AS source FROM customer")
def with_source(spark: SparkSession, sf: str) -> DataFrame:
    return columns.with_source(table(spark, sf, "customer").select("c_custkey", "c_name"), "reviews site")


@query(
    "p3_drop_columns",
    "SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag FROM lineitem",
)
def drop_columns(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem")
    kept = columns.keep_only(lines, ["l_orderkey", "l_linenumber", "l_quantity", "l_tax", "l_returnflag", "absent"])
    return columns.drop_columns(kept, "l_tax", "absent")


@query("p4_rename_label", f"WITH {STARRED_SQL} SELECT review_id, CAST(label AS INTEGER) AS label FROM starred")
def rename_label(spark: SparkSession, sf: str) -> DataFrame:
    named = starred(spark, sf).select("review_id", F.col("label").alias("labels_id"))
    return columns.rename_label(columns.rename_label(named))


@query("p5_resolve_text_column", "SELECT doc_id, 'text' AS picked, CAST(length(text) AS INTEGER) AS n FROM documents")
def resolve_text_column(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    name = columns.resolve_text_column(docs)
    return docs.select("doc_id", F.lit(name).alias("picked"), F.length(name).alias("n"))


@query("p6_cast_column", "SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey FROM orders")
def cast_column(spark: SparkSession, sf: str) -> DataFrame:
    return columns.cast_column(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), "o_custkey", "string")


@query("p7_preview", f"SELECT {_ORDER_KEYS} FROM orders ORDER BY o_orderkey LIMIT 3")
def preview(spark: SparkSession, sf: str) -> DataFrame:
    return columns.preview(_orders(spark, sf), "o_orderkey", 3)


@query(
    "p7_table_shape",
    f"SELECT count(*) AS rows, CAST(4 AS INTEGER) AS columns, '{_ORDER_KEYS}' AS column_names FROM orders",
)
def table_shape(spark: SparkSession, sf: str) -> DataFrame:
    return columns.table_shape(_orders(spark, sf))


@query(
    "p8_row_id",
    """SELECT o_orderkey, o_custkey,
    row_number() OVER (ORDER BY o_custkey DESC, o_orderkey) - 1 AS row_id FROM orders""",
)
def row_id(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", (-F.col("o_custkey")).alias("k"))
    return columns.with_row_id(orders, ["k", "o_orderkey"]).drop("k")


# --- filters ---------------------------------------------------------------------------------


@query("f1_filter_language", f"WITH {REVIEWS_SQL} SELECT review_id, text_review FROM reviews WHERE detected_language = 'en'")
def filter_language(spark: SparkSession, sf: str) -> DataFrame:
    return filters.filter_language(reviews(spark, sf)).select("review_id", "text_review")


@query(
    "f2_drop_nulls",
    """SELECT doc_id, source, quality FROM documents LEFT JOIN labels USING (doc_id) WHERE quality IS NOT NULL""",
)
def drop_nulls(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "source")
    judged = docs.join(table(spark, sf, "labels").select("doc_id", "quality"), "doc_id", "left")
    return filters.drop_nulls(judged, ["quality"])


@query("f3_min_length", "SELECT doc_id, text AS cleaned_text FROM documents WHERE length(text) > 10")
def min_length(spark: SparkSession, sf: str) -> DataFrame:
    return filters.filter_min_length(table(spark, sf, "documents").select("doc_id", F.col("text").alias("cleaned_text")))


@query(
    "f4_text_length",
    """SELECT doc_id, CAST(length(text) AS INTEGER) AS text_length FROM documents
    WHERE length(text) BETWEEN 20 AND 1000""",
)
def filter_text_length(spark: SparkSession, sf: str) -> DataFrame:
    measured = table(spark, sf, "documents").select("doc_id", text_length(F.col("text")).alias("text_length"))
    return filters.filter_text_length(measured)


_SECOND, _SECOND_LAST = rule_ctes(["second"], "raw")


@query(
    "f5_reclean",
    f"""WITH raw AS (SELECT doc_id AS review_id, text AS t FROM documents), {_SECOND}
    SELECT review_id, t AS cleaned_text, CAST(length(t) AS INTEGER) AS text_length,
    CAST(len(regexp_extract_all(t, '[^{SQL_SPACE}]+')) AS INTEGER) AS word_count
    FROM {_SECOND_LAST} WHERE length(t) >= 20""",
)
def reclean_texts(spark: SparkSession, sf: str) -> DataFrame:
    return reclean(reviews(spark, sf).select("review_id", F.col("text_review").alias("cleaned_text")))


_VOCAB_SQL = ", ".join(f"'{name}'" for name in LABELS)
_EVENT_LABELS = """event_labels AS (SELECT event_id, CASE event_type WHEN 'click' THEN 'Positive'
    WHEN 'error' THEN 'Very Negative' WHEN 'view' THEN 'Neutral' ELSE event_type END
    AS predicted_sentiment_label FROM events)"""


def _event_labels(spark: SparkSession, sf: str) -> DataFrame:
    """Events with a label, many of them outside the vocabulary."""
    kind = F.col("event_type")
    label = F.when(kind == "click", "Positive").when(kind == "error", "Very Negative")
    label = label.when(kind == "view", "Neutral").otherwise(kind)
    return table(spark, sf, "events").select("event_id", label.alias("predicted_sentiment_label"))


@query(
    "f6_valid_labels",
    f"WITH {_EVENT_LABELS} SELECT * FROM event_labels WHERE predicted_sentiment_label IN ({_VOCAB_SQL})",
)
def valid_labels(spark: SparkSession, sf: str) -> DataFrame:
    return filters.filter_valid_labels(_event_labels(spark, sf))


@query(
    "f7_require_labels",
    "SELECT doc_id, quality AS label FROM documents LEFT JOIN labels USING (doc_id) WHERE quality IS NOT NULL",
)
def require_labels(spark: SparkSession, sf: str) -> DataFrame:
    judged = table(spark, sf, "labels").select("doc_id", F.col("quality").alias("label"))
    return filters.require_labels(table(spark, sf, "documents").select("doc_id").join(judged, "doc_id", "left"), training=True)


# --- joins -----------------------------------------------------------------------------------


@query(
    "j1_new_reviews",
    f"""WITH {REVIEWS_SQL}, {PUBLISHED_SQL} SELECT review_id, text_review, source FROM reviews r
    WHERE NOT EXISTS (SELECT 1 FROM published p WHERE p.text_review = r.text_review AND p.source = r.source)""",
)
def new_reviews(spark: SparkSession, sf: str) -> DataFrame:
    batch = reviews(spark, sf).select("review_id", "text_review", "source")
    return joins.new_reviews(batch, published(spark, sf))


@query(
    "j1_new_reviews_indexed",
    f"""WITH {REVIEWS_SQL}, {PUBLISHED_SQL} SELECT review_id, text_review, source FROM reviews r
    WHERE NOT EXISTS (SELECT 1 FROM published p WHERE p.text_review = r.text_review AND p.source = r.source)""",
)
def new_reviews_indexed(spark: SparkSession, sf: str) -> DataFrame:
    """The published reviews in two parts of a stored table, compared through the index of their keys."""
    store, known = TableStore(spark, scratch_path(spark, "store")), published(spark, sf)
    store.append_table(known.where("source < 'src2'"), "reviews", "first")
    index = KeyIndex(store)
    index.sync()
    store.append_table(known.where("source >= 'src2'"), "reviews", "second")
    return index.unseen(reviews(spark, sf).select("review_id", "text_review", "source"))


@query(
    "j2_attach_attraction_id",
    f"""WITH {TITLED_SQL}, {ATTRACTIONS_SQL}, dimension AS (SELECT title, max(id) AS attraction_id
    FROM attractions GROUP BY title) SELECT t.review_id, t.title, d.attraction_id
    FROM titled t JOIN dimension d ON t.title = d.title""",
)
def attach_attraction_id(spark: SparkSession, sf: str) -> DataFrame:
    return joins.attach_attraction_id(titled(spark, sf).select("review_id", "title"), attractions(spark, sf))


@query(
    "f8_truthy_attraction_id",
    f"""WITH {TITLED_SQL}, {ATTRACTIONS_SQL} SELECT t.review_id, t.title, a.id - 1 AS attraction_id
    FROM titled t JOIN attractions a ON t.title = a.title WHERE a.id - 1 <> 0""",
)
def truthy_attraction_id(spark: SparkSession, sf: str) -> DataFrame:
    shifted = attractions(spark, sf).withColumn("id", F.col("id") - 1)
    return joins.attach_attraction_id(titled(spark, sf).select("review_id", "title"), shifted)


@query(
    "j3_features_with_label",
    f"""WITH {STARRED_SQL} SELECT review_id, o_custkey, o_totalprice, predicted_sentiment_label FROM starred""",
)
def features_with_label(spark: SparkSession, sf: str) -> DataFrame:
    """Features and label are one row throughout, so re-attaching them is a projection."""
    return starred(spark, sf).select("review_id", "o_custkey", "o_totalprice", "predicted_sentiment_label")


_LABEL_ID = "list_position([{}], predicted_sentiment_label)".format(_VOCAB_SQL)


@query(
    "j4_encode_labels",
    f"""WITH {_EVENT_LABELS} SELECT event_id, predicted_sentiment_label,
    CAST(nullif({_LABEL_ID}, 0) - 1 AS INTEGER) AS labels_id FROM event_labels""",
)
def encode_labels(spark: SparkSession, sf: str) -> DataFrame:
    return joins.encode_labels(_event_labels(spark, sf))


@query(
    "j5_normalize_titles",
    f"""WITH {TITLED_SQL}, {ALIASES_SQL} SELECT review_id, coalesce(to_title, title) AS title
    FROM titled LEFT JOIN aliases ON title = from_title""",
)
def normalize_titles(spark: SparkSession, sf: str) -> DataFrame:
    return joins.normalize_titles(titled(spark, sf).select("review_id", "title"), aliases(spark, sf))


# --- sets ------------------------------------------------------------------------------------


@query(
    "u1_union_sources",
    """SELECT doc_id AS id, text, source, CAST(NULL AS VARCHAR) AS role FROM documents
    UNION ALL SELECT conv_id, text, NULL, role FROM conversations
    UNION ALL SELECT item_id, text, NULL, NULL FROM benchmark""",
)
def union_sources(spark: SparkSession, sf: str) -> DataFrame:
    return sets.union_sources(
        table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "text", "source"),
        table(spark, sf, "conversations").select(F.col("conv_id").alias("id"), "text", "role"),
        table(spark, sf, "benchmark").select(F.col("item_id").alias("id"), "text"),
    ).select("id", "text", "source", "role")


@query("u2_distinct_values", "SELECT DISTINCT source FROM documents")
def distinct_values(spark: SparkSession, sf: str) -> DataFrame:
    return sets.distinct_values(table(spark, sf, "documents"), "source")


@query(
    "u3_new_titles",
    f"""WITH {TITLED_SQL}, {ATTRACTIONS_SQL} SELECT DISTINCT title FROM titled
    WHERE title NOT IN (SELECT title FROM attractions)""",
)
def new_titles(spark: SparkSession, sf: str) -> DataFrame:
    return sets.new_titles(titled(spark, sf), attractions(spark, sf))


@query(
    "u4_dedupe_reviews",
    f"""WITH {REVIEWS_SQL}, ranked AS (SELECT *, row_number() OVER
    (PARTITION BY text_review, rating_review ORDER BY review_id) AS rn FROM reviews)
    SELECT review_id, text_review AS cleaned_text, rating_review, source FROM ranked WHERE rn = 1""",
)
def dedupe_reviews(spark: SparkSession, sf: str) -> DataFrame:
    rows = reviews(spark, sf).select("review_id", F.col("text_review").alias("cleaned_text"), "rating_review", "source")
    return sets.dedupe_reviews(rows)


@query(
    "u5_extend_dimension",
    f"""WITH {TITLED_SQL}, {ATTRACTIONS_SQL}, fresh AS (SELECT DISTINCT title FROM titled
    WHERE title NOT IN (SELECT title FROM attractions))
    SELECT id, title FROM attractions UNION ALL SELECT
    CAST((SELECT max(id) FROM attractions) + row_number() OVER (ORDER BY title) AS BIGINT), title FROM fresh""",
)
def extend_dimension(spark: SparkSession, sf: str) -> DataFrame:
    known = attractions(spark, sf)
    return sets.extend_dimension(known, sets.new_titles(titled(spark, sf), known))


@query(
    "u6_duplicate_count",
    """SELECT CAST(sum(n - 1) AS BIGINT) AS duplicates FROM
    (SELECT count(*) AS n FROM documents GROUP BY text, lang, n_chars)""",
)
def duplicate_count(spark: SparkSession, sf: str) -> DataFrame:
    return sets.duplicate_count(table(spark, sf, "documents").select("text", "lang", "n_chars"))


@query(
    "a16_step_audit",
    f"""WITH steps AS (SELECT count(*) AS s0, count(*) FILTER (lang = 'en') AS s1,
    count(*) FILTER (lang = 'en' AND length(text) > 10) AS s2,
    count(*) FILTER (lang = 'en' AND length(text) BETWEEN 20 AND 1000) AS s3 FROM documents),
    audit AS (SELECT 1 AS step_no, 'language' AS step, s0 AS rows_in, s1 AS rows_out FROM steps
    UNION ALL SELECT 2, 'minimum length', s1, s2 FROM steps UNION ALL SELECT 3, 'usable length', s2, s3 FROM steps)
    SELECT step_no, step, rows_in, rows_out, rows_in - rows_out AS removed,
    round(rows_out / rows_in * 100, 6) AS kept_pct FROM audit""",
)
def step_audit(spark: SparkSession, sf: str) -> DataFrame:
    length = F.length("text")
    steps = [("language", F.col("lang") == "en"), ("minimum length", length > 10), ("usable length", length.between(20, 1000))]
    return filters.step_audit(table(spark, sf, "documents"), steps)

