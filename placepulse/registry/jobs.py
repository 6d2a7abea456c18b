"""The composite jobs over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placepulse.functions.labels import sentiment_label
from placepulse.operators import filters, sets, stars, training
from placepulse.operators.joins import known_reviews, lookup_join, normalize_titles
from placepulse.operators.language import fit_language_profiles
from placepulse.operators.profiling import value_counts
from placepulse.plans import corpus, learning, publishing
from placepulse.registry import query
from placepulse.registry.fixtures import (
    ALIASES_SQL,
    ATTRACTIONS_SQL,
    LABEL_CASE,
    PUBLISHED_SQL,
    RATING_SQL,
    REVIEWS_SQL,
    TITLED_SQL,
    aliases,
    attractions,
    published,
    reviews,
    table,
    titled,
)
from placepulse.registry.learning import GRID, JUDGED_SQL, judged, judged_parts, language_sql, length_model, lexicon_sql, words_sql
from placepulse.registry.profiles import MEASURED_SQL, SPLIT_SQL, STATS, STATS_SQL, describe_sql
from placepulse.registry.texts import SQL_SPACE, clean_sql, rule_ctes
from placepulse.schema import ATTRACTIONS, LABELS, NO_TEXT_LABEL
from placepulse.session import durable, scratch_path, spread
from placepulse.sources import files
from placepulse.sources.files import read_reviews_csv, read_scored_csv, write_csv
from placepulse.sources.tables import TableStore
from placepulse.streaming.incremental import BATCH, run_available


@query(
    "k1_merge_reviews",
    f"""WITH {REVIEWS_SQL}, merged AS (SELECT text_review, rating_review FROM reviews
    UNION ALL SELECT text, CAST(1 + turn % 5 AS INTEGER) FROM conversations)
    SELECT *, row_number() OVER (ORDER BY text_review, rating_review) - 1 AS review_id FROM merged""",
)
def merge_reviews(spark: SparkSession, sf: str) -> DataFrame:
    """Two CSV deliveries with different columns, merged."""
    first, second = scratch_path(spark, "first"), scratch_path(spark, "second")
    write_csv(reviews(spark, sf).select("source", "rating_review", "text_review"), first)
    turns = table(spark, sf, "conversations").withColumn("rating_review", (F.col("turn") % 5 + 1).cast("int"))
    write_csv(turns.select("role", F.col("text").alias("text_review"), "rating_review"), second)
    return corpus.merge_reviews(spark, [corpus.CsvSource(first), corpus.CsvSource(second)])


@query(
    "k1_merge_in_place",
    f"""WITH {REVIEWS_SQL}, merged AS (SELECT 0 AS delivery, text_review, rating_review FROM reviews
    UNION ALL SELECT 1, text, CAST(1 + turn % 5 AS INTEGER) FROM conversations),
    counts AS (SELECT delivery, count(*) AS n, count(text_review) AS texts, CAST(sum(rating_review) AS BIGINT) AS stars FROM merged GROUP BY 1)
    SELECT delivery, n AS ids, texts, stars, CAST(sum(n) OVER (ORDER BY delivery) - n AS BIGINT)
    AS first_id, CAST(sum(n) OVER (ORDER BY delivery) - 1 AS BIGINT) AS last_id, true AS repeatable FROM counts""",
)
def merge_in_place(spark: SparkSession, sf: str) -> DataFrame:
    """The deliveries of ``k1_merge_reviews`` with ids by place: dense, one delivery after the other, alike when read again."""
    first, second = scratch_path(spark, "first"), scratch_path(spark, "second")
    write_csv(reviews(spark, sf).select("source", "rating_review", "text_review"), first)
    turns = table(spark, sf, "conversations").withColumn("rating_review", (F.col("turn") % 5 + 1).cast("int"))
    write_csv(turns.select("role", F.col("text").alias("text_review"), "rating_review"), second)
    sources = [corpus.CsvSource(first), corpus.CsvSource(second)]
    size = reviews(spark, sf).count()

    def summary(again: int) -> DataFrame:
        merged = corpus.merge_reviews(spark, sources, ids="place").withColumn("again", F.lit(again))
        return merged.withColumn("delivery", (F.col("review_id") >= size).cast("int"))

    alike = F.bit_xor(F.xxhash64("review_id", "text_review", "rating_review"))
    counts = summary(0).unionByName(summary(1)).groupBy("delivery", "again").agg(
        F.countDistinct("review_id").alias("ids"), F.count("text_review").alias("texts"), F.sum("rating_review").alias("stars"),
        F.min("review_id").alias("first_id"), F.max("review_id").alias("last_id"), alike.alias("_rows"),
    )
    measures = ("ids", "texts", "stars", "first_id", "last_id")
    return counts.groupBy("delivery").agg(
        *(F.max(name).alias(name) for name in measures), (F.min("_rows") == F.max("_rows")).alias("repeatable")
    )


_CLEAN, _CLEAN_LAST = clean_sql("english")
_CLEANED_SQL = f"""{REVIEWS_SQL}, english AS (SELECT review_id, rating_review, text_review AS t FROM reviews
    WHERE detected_language = 'en'), {_CLEAN}, cleaned AS (SELECT review_id, rating_review, t AS cleaned_text
    FROM {_CLEAN_LAST} WHERE t IS NOT NULL AND length(t) > 10)"""


@query("k2_clean_reviews", f"WITH {_CLEANED_SQL} SELECT * FROM cleaned")
def clean_reviews(spark: SparkSession, sf: str) -> DataFrame:
    return corpus.clean_reviews(reviews(spark, sf)).reviews


def _audit_sql(counts: list[tuple[str, str]]) -> str:
    """The audit from the name of each step and the rows after it; the first is the input."""
    lines = [
        f"SELECT CAST({i} AS INTEGER) AS step_no, '{step}' AS step, ({before}) AS rows_in, ({after}) AS rows_out"
        for i, ((_, before), (step, after)) in enumerate(zip(counts, counts[1:], strict=False), start=1)
    ]
    return f"""SELECT *, rows_in - rows_out AS removed, round(rows_out / rows_in * 100, 6) AS kept_pct
    FROM ({" UNION ALL ".join(lines)})"""


_K2_STEPS = [
    ("input", "SELECT count(*) FROM reviews"),
    ("language", "SELECT count(*) FROM english"),
    ("clean", "SELECT count(*) FROM cleaned"),
]


@query("k2_step_audit", f"WITH {_CLEANED_SQL} {_audit_sql(_K2_STEPS)}")
def clean_audit(spark: SparkSession, sf: str) -> DataFrame:
    """Rows after each cleaning step, counted while the cleaned reviews are made."""
    steps = filters.StepCounter()
    corpus.clean_reviews(reviews(spark, sf), steps=steps)
    return steps.table(spark)


_DETECTED_REVIEWS = f"""{language_sql("SELECT doc_id AS id, text FROM documents")}, reviews AS (SELECT doc_id AS review_id,
    text AS text_review, {RATING_SQL} AS rating_review, d.lang AS detected_language FROM documents JOIN detected d ON id = doc_id)"""


@query("k2_clean_detected_reviews", f"WITH {_CLEANED_SQL.replace(REVIEWS_SQL, _DETECTED_REVIEWS)} SELECT * FROM cleaned")
def clean_detected_reviews(spark: SparkSession, sf: str) -> DataFrame:
    """With the language detected rather than given."""
    rows = reviews(spark, sf)
    model = fit_language_profiles(rows, "text_review", "detected_language")
    return corpus.clean_reviews(rows.drop("detected_language"), model).reviews


_PROFILE_SQL = f"""{MEASURED_SQL}, described AS (SELECT 'rating_summary' AS section, * FROM ({describe_sql("measured", ["rating_review"])})
    UNION ALL SELECT 'length_summary', * FROM ({describe_sql("measured", ["text_length", "word_count"])})),
    ratings AS (SELECT rating_review, count(*) AS n, round(avg(text_length), 1) AS mean, round(median(text_length), 1) AS median,
        round(stddev_samp(text_length), 1) AS std, round(count(*) / (SELECT count(*) FROM measured) * 100, 1) AS pct FROM measured GROUP BY 1),
    sentiments AS (SELECT CASE WHEN rating_review >= 4 THEN 'Positive' WHEN rating_review = 3 THEN 'Neutral' ELSE 'Negative' END AS s,
        count(*) AS n, round(count(*) / (SELECT count(*) FROM measured) * 100, 1) AS pct FROM measured GROUP BY 1),
    dups AS (SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT cleaned_text, rating_review FROM measured)) AS d, count(*) AS n FROM measured),
    facts AS (SELECT section, "column" AS item, unnest(['count', 'mean', 'std', 'min', 'p25', 'p50', 'p75', 'max']) AS measure,
        unnest([count, mean, std, min, p25, p50, p75, max]) AS value FROM described
    UNION ALL SELECT 'rating_distribution', CAST(rating_review AS VARCHAR), unnest(['count', 'pct']), unnest([n, pct]) FROM ratings
    UNION ALL SELECT 'length_by_rating', CAST(rating_review AS VARCHAR), unnest(['mean', 'median', 'std']), unnest([mean, median, std]) FROM ratings
    UNION ALL SELECT 'sentiment_distribution', s, unnest(['count', 'pct']), unnest([n, pct]) FROM sentiments
    UNION ALL SELECT 'imbalance', '', unnest(['max_class', 'min_class', 'imbalance_ratio']), unnest([max(n), min(n), round(max(n) / min(n), 6)]) FROM sentiments
    UNION ALL SELECT 'quality', '', unnest(['duplicate_rows', 'duplicate_pct', 'invalid_ratings', 'very_short', 'very_long']),
        unnest([(SELECT d FROM dups), (SELECT round(d / n * 100, 2) FROM dups), count(*) FILTER (NOT rating_review BETWEEN 1 AND 5),
        count(*) FILTER (text_length < 10), count(*) FILTER (text_length > 2000)]) FROM measured
    UNION ALL SELECT 'basic', unnest(['rating_review', 'cleaned_text']), 'non_null', unnest([count(rating_review), count(cleaned_text)]) FROM measured
    UNION ALL (SELECT 'languages', detected_language, 'count', count(*) AS n FROM reviews
        WHERE detected_language IS NOT NULL GROUP BY 2 ORDER BY n DESC, 2 LIMIT 10)
    UNION ALL SELECT 'findings', 'class imbalance', 'present', 1 WHERE (SELECT max(n) / min(n) FROM sentiments) > 3
    UNION ALL SELECT 'findings', 'extreme text lengths', 'present', 1 WHERE (SELECT count(*) FROM measured WHERE text_length < 10 OR text_length > 2000) > 0
    UNION ALL SELECT 'findings', 'duplicate entries', 'present', 1 WHERE (SELECT d FROM dups) > 0
    UNION ALL SELECT 'findings', 'large data set', 'present', 1 WHERE (SELECT n FROM dups) > 100000
    UNION ALL SELECT 'findings', 'few negative samples', 'present', 1
        WHERE (SELECT coalesce(sum(n) FILTER (s = 'Negative'), 0) / sum(n) * 100 FROM sentiments) < 10)"""


@query("k3_profile_reviews", f"WITH {_PROFILE_SQL} SELECT section, item, measure, CAST(value AS DOUBLE) AS value FROM facts")
def profile_reviews(spark: SparkSession, sf: str) -> DataFrame:
    found = reviews(spark, sf)
    rows = found.select("rating_review", F.col("text_review").alias("cleaned_text"))
    return corpus.report_table(corpus.profile_reviews(rows, value_counts(found, "detected_language")))


@query(
    "k4_label_reviews",
    f"""WITH {lexicon_sql()}, occurrences AS (SELECT review_id, unnest({words_sql("text_review")}) AS word FROM reviews),
    sums AS (SELECT review_id, floor(sum(stars) / count(*) + 0.5) AS mean FROM occurrences JOIN lexicon USING (word) GROUP BY review_id),
    rated AS (SELECT review_id, rating_review, CAST(length(text_review) AS INTEGER) AS text_length,
        CAST(len({words_sql("text_review")}) AS INTEGER) AS word_count,
        CAST(CASE WHEN mean IS NULL THEN 3 ELSE greatest(1, least(5, mean)) END AS INTEGER) AS predicted_rating
        FROM reviews LEFT JOIN sums USING (review_id))
    SELECT *, {LABEL_CASE.format("predicted_rating")} AS predicted_sentiment_label FROM rated""",
)
def label_reviews(spark: SparkSession, sf: str) -> DataFrame:
    rows = reviews(spark, sf).select("review_id", F.col("text_review").alias("cleaned_text"), "rating_review")
    return corpus.label_reviews(rows, stars.fit_lexicon(rows)).drop("cleaned_text")


_SPLIT = T.StructType(
    [
        T.StructField("review_id", T.LongType()),
        T.StructField("cleaned_text", T.StringType()),
        T.StructField("rating_review", T.IntegerType()),
        T.StructField("predicted_sentiment_label", T.StringType()),
    ]
)


def _labelled(spark: SparkSession, sf: str) -> DataFrame:
    """Reviews of all languages with the label of their rating."""
    return reviews(spark, sf).select(
        "review_id",
        F.col("text_review").alias("cleaned_text"),
        "rating_review",
        sentiment_label(F.col("rating_review")).alias("predicted_sentiment_label"),
    )


_K4_RATED = f"""{lexicon_sql()}, occurrences AS (SELECT review_id, unnest({words_sql("text_review")}) AS word FROM reviews),
    sums AS (SELECT review_id, floor(sum(stars) / count(*) + 0.5) AS mean FROM occurrences JOIN lexicon USING (word) GROUP BY review_id),
    rated AS (SELECT CAST(CASE WHEN mean IS NULL THEN 3 ELSE greatest(1, least(5, mean)) END AS INTEGER) AS predicted_rating
        FROM reviews LEFT JOIN sums USING (review_id)),
    labelled AS (SELECT {LABEL_CASE.format("predicted_rating")} AS predicted_sentiment_label FROM rated),
    counts AS (SELECT predicted_sentiment_label, count(*) AS n FROM labelled GROUP BY 1)"""


@query(
    "k4_label_balance",
    f"""WITH {_K4_RATED} SELECT predicted_sentiment_label, n AS count, round(n / (SELECT sum(n) FROM counts) * 100, 1) AS pct,
    round((SELECT max(n) / min(n) FROM counts), 6) AS imbalance_ratio, (SELECT max(n) / min(n) FROM counts) > 3 AS imbalanced FROM counts""",
)
def label_balance(spark: SparkSession, sf: str) -> DataFrame:
    """Distribution and imbalance of the predicted labels."""
    rows = reviews(spark, sf).select("review_id", F.col("text_review").alias("cleaned_text"), "rating_review")
    labelled = corpus.label_reviews(rows, stars.fit_lexicon(rows))
    return corpus.label_balance(labelled)


_AGAIN, _AGAIN_LAST = rule_ctes(["second"], "first_copies")
_PREPARED_SQL = f"""{REVIEWS_SQL}, copies AS (SELECT review_id, text_review AS t, rating_review,
    {LABEL_CASE.format("rating_review")} AS predicted_sentiment_label,
    row_number() OVER (PARTITION BY text_review, rating_review ORDER BY review_id) AS copy FROM reviews),
    first_copies AS (SELECT * EXCLUDE (copy) FROM copies WHERE copy = 1), {_AGAIN},
    usable AS (SELECT * FROM {_AGAIN_LAST} WHERE length(t) BETWEEN 20 AND 1000),
    ranked_usable AS (SELECT *, row_number() OVER (PARTITION BY predicted_sentiment_label ORDER BY md5('42-' || review_id)) AS nth FROM usable),
    balanced AS (SELECT * EXCLUDE (nth) FROM ranked_usable WHERE nth <=
        (SELECT min(n) FROM (SELECT count(*) AS n FROM usable GROUP BY predicted_sentiment_label))),
    {SPLIT_SQL.format("balanced", "predicted_sentiment_label")}"""


@query(
    "k5_prepare_training_data",
    f"""WITH {_PREPARED_SQL} SELECT review_id, t AS cleaned_text, rating_review, predicted_sentiment_label,
    CAST(length(t) AS INTEGER) AS text_length, CAST(len(regexp_extract_all(t, '[^{SQL_SPACE}]+')) AS INTEGER) AS word_count,
    split FROM split_rows""",
)
def prepare_training_data(spark: SparkSession, sf: str) -> DataFrame:
    return corpus.prepare_training_data(_labelled(spark, sf))


_K5_STEPS = [
    ("input", "SELECT count(*) FROM reviews"),
    ("deduplicate", "SELECT count(*) FROM first_copies"),
    ("clean again", f"SELECT count(*) FROM {_AGAIN_LAST} WHERE length(t) >= 20"),
    ("usable length", "SELECT count(*) FROM usable"),
    ("balance", "SELECT count(*) FROM balanced"),
]


@query("k5_step_audit", f"WITH {_PREPARED_SQL} {_audit_sql(_K5_STEPS)}")
def prepare_audit(spark: SparkSession, sf: str) -> DataFrame:
    """Rows after each step of preparation, counted while it runs."""
    steps = filters.StepCounter()
    corpus.prepare_training_data(_labelled(spark, sf), steps=steps)
    return steps.table(spark)


_CLASS_SHARES = """SELECT '{0}' AS moment, predicted_sentiment_label, count(*) AS count,
    round(count(*) / (SELECT count(*) FROM {1}) * 100, 1) AS pct FROM {1} GROUP BY 2"""


@query(
    "k5_class_distributions",
    f"""WITH {_PREPARED_SQL} {_CLASS_SHARES.format("before", "usable")} UNION ALL {_CLASS_SHARES.format("after", "balanced")}""",
)
def class_distributions(spark: SparkSession, sf: str) -> DataFrame:
    """Classes before and after balancing."""
    found = corpus.prepared(_labelled(spark, sf))
    tables = (("before", found.before), ("after", found.after))
    return sets.union_sources(*(t.select(F.lit(name).alias("moment"), *t.columns) for name, t in tables))


@query(
    "k5_split_files",
    f"""WITH {_PREPARED_SQL} SELECT review_id, t AS cleaned_text, rating_review, predicted_sentiment_label, split FROM split_rows""",
)
def split_files(spark: SparkSession, sf: str) -> DataFrame:
    """The three files of the split, read back."""
    paths = corpus.write_splits(corpus.prepare_training_data(_labelled(spark, sf)), scratch_path(spark, "splits"))
    parts = [read_reviews_csv(spark, path, _SPLIT).withColumn("split", F.lit(name)) for name, path in paths.items()]
    return sets.union_sources(*parts)


@query(
    "k5_prepare_to_files",
    f"""WITH {_PREPARED_SQL} SELECT 'split' AS kind, split AS item, count(*) AS rows FROM split_rows GROUP BY 2
    UNION ALL SELECT 'before', predicted_sentiment_label, count(*) FROM usable GROUP BY 2
    UNION ALL SELECT 'after', predicted_sentiment_label, count(*) FROM balanced GROUP BY 2""",
)
def prepare_to_files(spark: SparkSession, sf: str) -> DataFrame:
    """Sizes of what the whole job wrote; its intermediate results are gone by then."""
    paths = corpus.prepare_to_files(_labelled(spark, sf), scratch_path(spark, "prepared"))
    rows = F.count(F.lit(1)).alias("rows")
    parts = [read_reviews_csv(spark, paths[name], _SPLIT).agg(rows).select(F.lit("split").alias("kind"), F.lit(name).alias("item"), "rows")
             for name in corpus.SPLITS]
    for moment in ("before", "after"):
        classes = spark.read.option("header", True).csv(paths[moment])
        parts.append(classes.select(F.lit(moment).alias("kind"), F.col(classes.columns[0]).alias("item"), F.col("count").cast("bigint").alias("rows")))
    return sets.union_sources(*parts)


@query(
    "s1_csv_account",
    f"WITH {REVIEWS_SQL} SELECT source, count(*) AS rows, 2 * count(*) AS cells, count(*) FILTER (review_id % 3 = 0) AS misshapen "
    "FROM reviews GROUP BY 1",
)
def csv_account(spark: SparkSession, sf: str) -> DataFrame:
    """A delivery of one file set per source, a third of whose rows has a cell too many."""
    folder = scratch_path(spark, "delivery")
    extra = F.when(F.col("review_id") % 3 == 0, ",extra").otherwise("")
    lines = reviews(spark, sf).select("source", F.concat(F.col("review_id"), F.lit(","), F.col("rating_review"), extra).alias("value"))
    # The header is the first line of every file.
    lines = lines.withColumn("value", F.concat(F.lit("id,rating\n"), "value")).repartition(4, "source")
    found = durable(lines.withColumn("_first", F.row_number().over(Window.partitionBy("source").orderBy("value"))))
    first, rest = found.where("_first = 1"), found.where("_first > 1").withColumn("value", F.substring_index("value", "\n", -1))
    whole = first.unionByName(rest).repartition("source").sortWithinPartitions("source", "_first").drop("_first")
    whole.write.partitionBy("source").text(folder)
    counts = files.account_csv(spark, f"{folder}/*/*.txt")
    source = F.regexp_extract("file", "source=([^/]*)", 1).alias("source")
    return counts.groupBy(source).agg(*(F.sum(name).alias(name) for name in ("rows", "cells", "misshapen")))


_LABELS_LIST = "[" + ", ".join(f"'{name}'" for name in LABELS) + "]"


@query(
    "k6_encode_features",
    f"""WITH {_PREPARED_SQL}, train_words AS (SELECT unnest({words_sql("t")}) AS token FROM split_rows WHERE split = 'train'),
    vocab AS (SELECT token, row_number() OVER (ORDER BY n DESC, token) + 1 AS token_id FROM
        (SELECT token, count(*) AS n FROM train_words GROUP BY token ORDER BY n DESC, token LIMIT 50000)),
    places AS (SELECT review_id, unnest({words_sql("t")}[1:512]) AS token, unnest(range(1, len({words_sql("t")}[1:512]) + 1)) AS place FROM split_rows),
    ids AS (SELECT review_id, list(coalesce(token_id, 1) ORDER BY place) AS ids FROM places LEFT JOIN vocab USING (token) GROUP BY review_id)
    SELECT s.review_id, s.split, CAST(list_position({_LABELS_LIST}, predicted_sentiment_label) - 1 AS INTEGER) AS label,
    array_to_string(list_resize(coalesce(ids, []), 512, 0), ',') AS input_ids FROM split_rows s LEFT JOIN ids USING (review_id)""",
)
def encode_features(spark: SparkSession, sf: str) -> DataFrame:
    split = durable(corpus.prepare_training_data(_labelled(spark, sf)))
    features = learning.encode_features(split).features
    return features.select("review_id", "split", "label", F.array_join("input_ids", ",").alias("input_ids"))


@query(
    "k7_train_and_evaluate",
    f"""WITH {JUDGED_SQL}, held AS (SELECT * FROM split_rows WHERE split = 'test')
    SELECT {_LABELS_LIST}[k + 1] AS class, (SELECT count(*) FROM held WHERE label = k) AS support, true AS sound FROM range(5) r(k)
    UNION ALL SELECT unnest(['accuracy', 'macro avg', 'weighted avg']), count(*), true FROM held""",
)
def train_and_evaluate(spark: SparkSession, sf: str) -> DataFrame:
    """Quality judgements as the label; split, trained over a small grid, reported on the test set."""
    parts = judged_parts(spark, sf)
    report = learning.train_and_evaluate(parts["train"], parts["validation"], parts["test"], GRID).report
    sound = F.lit(True)
    for measure in ("precision", "recall", "f1"):
        sound = sound & F.coalesce(F.col(measure).between(0, 1), F.lit(False))
    return report.select("class", "support", sound.alias("sound"))


def _scorer(df: DataFrame) -> DataFrame:
    return stars.score_with(df, length_model)


_UNSEEN_SQL = f"""{TITLED_SQL}, {PUBLISHED_SQL}, unseen AS (SELECT source, title, text_review,
    CASE length(title || ' ' || text_review) % 5 {" ".join(f"WHEN {i} THEN '{name}'" for i, name in enumerate(LABELS))} END
    AS predicted_sentiment FROM titled t WHERE NOT EXISTS
    (SELECT 1 FROM published p WHERE p.text_review = t.text_review AND p.source = t.source))"""


@query("k8_score_new_reviews", f"WITH {_UNSEEN_SQL} SELECT * FROM unseen")
def score_new_reviews(spark: SparkSession, sf: str) -> DataFrame:
    batch = titled(spark, sf).select("title", "text_review", "source")
    return publishing.score_new_reviews(batch, published(spark, sf), _scorer)


_DELIVERED = "CASE WHEN review_id % 2 = 0 THEN 'first' ELSE 'second' END"


@query(
    "k8_score_files",
    f"""WITH {TITLED_SQL}, named AS (SELECT review_id, {_DELIVERED} AS source, title, text_review FROM titled)
    SELECT source, title, text_review, true AS labelled FROM named n WHERE text_review <> '' AND NOT EXISTS
    (SELECT 1 FROM named p JOIN labels l ON p.review_id = l.doc_id WHERE p.text_review = n.text_review AND p.source = n.source)""",
)
def score_files(spark: SparkSession, sf: str) -> DataFrame:
    """Two CSV sources, one of them in two column orders; a model trained, saved and loaded; the scored table written."""
    path, output = scratch_path(spark, "model"), scratch_path(spark, "scored")
    training.save_model(training.train_classifier(judged(spark, sf)), path)
    named = titled(spark, sf).withColumn("source", F.expr(_DELIVERED))
    first, swapped, second = (scratch_path(spark, name) for name in ("first", "swapped", "second"))
    even = named.where("source = 'first'")
    write_csv(even.where("review_id % 4 = 0").select("title", "text_review"), first)
    write_csv(even.where("review_id % 4 = 2").select("text_review", "rating_review", "title"), swapped)
    write_csv(named.where("source = 'second'").select("rating_review", "title", "text_review"), second)
    batch = publishing.load_batch(spark, {"first": [first, swapped], "second": second})
    known = named.join(table(spark, sf, "labels").select(F.col("doc_id").alias("review_id")), "review_id", "left_semi")
    publishing.score_new_reviews(batch, known, training.model_scorer(training.load_model(path)), output)
    labelled = F.coalesce(F.col("predicted_sentiment").isin(*LABELS, NO_TEXT_LABEL), F.lit(False)).alias("labelled")
    return read_scored_csv(spark, output).select("source", "title", "text_review", labelled)


_PUBLISHED_NOW = f"""{_UNSEEN_SQL}, {ATTRACTIONS_SQL}, {ALIASES_SQL}, renamed AS (SELECT source, text_review, predicted_sentiment,
    coalesce(to_title, title) AS title FROM unseen LEFT JOIN aliases ON title = from_title),
    fresh AS (SELECT DISTINCT title FROM renamed WHERE title NOT IN (SELECT title FROM attractions)),
    places AS (SELECT id, title FROM attractions UNION ALL SELECT
        CAST((SELECT max(id) FROM attractions) + row_number() OVER (ORDER BY title) AS BIGINT), title FROM fresh),
    placed AS (SELECT p.id AS attraction_id, source, text_review, predicted_sentiment FROM renamed r JOIN places p ON r.title = p.title)"""


def _store(spark: SparkSession, sf: str) -> TableStore:
    store = TableStore(spark, scratch_path(spark, "store"))
    store.replace_table(attractions(spark, sf), "attractions")
    return store


def _publish(spark: SparkSession, sf: str) -> publishing.Published:
    batch = titled(spark, sf).select("title", "text_review", "source")
    scored = publishing.score_new_reviews(batch, published(spark, sf), _scorer)
    return publishing.publish_reviews(scored, _store(spark, sf), aliases(spark, sf))


@query("k9_publish_reviews", f"WITH {_PUBLISHED_NOW} SELECT * FROM placed")
def publish_reviews(spark: SparkSession, sf: str) -> DataFrame:
    return _publish(spark, sf).reviews


@query(
    "k9_publish_stats",
    f"""WITH {_PUBLISHED_NOW}, counts AS (SELECT attraction_id, {STATS_SQL}, count(*) AS total FROM placed GROUP BY 1)
    SELECT p.id AS attraction_id, {", ".join(f"coalesce({name}, 0) AS {name}" for name in [*STATS, "total"])}
    FROM places p LEFT JOIN counts c ON c.attraction_id = p.id""",
)
def publish_stats(spark: SparkSession, sf: str) -> DataFrame:
    return _publish(spark, sf).stats


_REPLACED_SQL = f"""{_PUBLISHED_NOW}, later AS (SELECT * FROM placed WHERE attraction_id % 2 = 1),
    counts AS (SELECT attraction_id, {STATS_SQL}, count(*) AS total FROM later GROUP BY 1)"""


@query(
    "k9_replace_reviews",
    f"""WITH {_REPLACED_SQL} SELECT p.id AS attraction_id, p.title, {", ".join(f"coalesce({name}, 0) AS {name}" for name in [*STATS, "total"])}
    FROM places p LEFT JOIN counts c ON c.attraction_id = p.id""",
)
def replace_reviews(spark: SparkSession, sf: str) -> DataFrame:
    """All new reviews published, then replaced by those of every other attraction, then by an empty batch, which is ignored."""
    store, renames = _store(spark, sf), aliases(spark, sf)
    batch = titled(spark, sf).select("title", "text_review", "source")
    scored = durable(publishing.score_new_reviews(batch, published(spark, sf), _scorer))
    first = publishing.publish_reviews(scored, store, renames)
    odd = first.attractions.where("id % 2 = 1").select("title")
    later = durable(lookup_join(normalize_titles(scored, renames), odd, ["title"], "left_semi"))
    publishing.publish_reviews(later, store, renames, mode="replace")
    publishing.publish_reviews(later.where("false"), store, renames, mode="replace")
    stats = store.read_table("sentiment_stats", first.stats.schema)
    places = store.read_table("attractions", ATTRACTIONS).select(F.col("id").alias("attraction_id"), "title")
    return lookup_join(stats, places, ["attraction_id"], "inner")


@query(
    "s10_store_upkeep",
    f"WITH {REVIEWS_SQL} SELECT review_id, text_review, rating_review, 1 AS parts FROM reviews",
)
def store_upkeep(spark: SparkSession, sf: str) -> DataFrame:
    """Reviews added in five parts, one of them twice; parts merged, what no commit names removed."""
    store = TableStore(spark, scratch_path(spark, "store"))
    rows = reviews(spark, sf).select("review_id", "text_review", "rating_review")
    for part in (1, 2, 3, 4, 5, 3):
        store.append_table(rows.where(F.col("rating_review") == part), "reviews", f"stars-{part}")
    store.compact("reviews", rows.schema)
    store.vacuum(keep=1, older_than=0)
    return store.read_table("reviews", rows.schema).withColumn("parts", F.lit(len(store.parts("reviews"))))


@query("k9_incremental_stream", f"WITH {_PUBLISHED_NOW} SELECT * FROM placed")
def incremental_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The same files offered to the stream twice: the second run finds nothing new."""
    store, inbox = _store(spark, sf), scratch_path(spark, "inbox")
    unseen = publishing.new_reviews(titled(spark, sf).select("title", "text_review", "source"), published(spark, sf))
    unseen.write.parquet(inbox)
    run_available(spark, inbox, f"{inbox}-progress", store, aliases(spark, sf), _scorer)
    # Only what was unseen can be in the store, and all of it lies in the inbox.
    offered, held = spark.read.schema(BATCH).parquet(inbox), store.read_table("reviews", publishing.REVIEWS)
    known_reviews(offered, held).write.mode("append").parquet(inbox)
    run_available(spark, inbox, f"{inbox}-progress", store, aliases(spark, sf), _scorer)
    return store.read_table("reviews", publishing.REVIEWS)
