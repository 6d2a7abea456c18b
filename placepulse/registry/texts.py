"""Text and label functions over every text of the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from placepulse.functions import labels, text
from placepulse.registry import query
from placepulse.registry.fixtures import (
    LABEL_CASE,
    REVIEWS_SQL,
    STARRED_SQL,
    TITLED_SQL,
    reviews,
    starred,
    table,
    titled,
)
from placepulse.session import spread

CORPUS_SQL = """corpus AS (
    SELECT 'documents' AS origin, doc_id AS text_id, CAST(0 AS BIGINT) AS turn, text AS t FROM documents
    UNION ALL SELECT 'pages', page_id, 0, url || ' ' || html FROM pages
    UNION ALL SELECT 'conversations', conv_id, turn, text FROM conversations)"""


def corpus(spark: SparkSession, sf: str) -> DataFrame:
    """All texts: documents, pages with their address, conversation turns."""
    zero = F.lit(0).cast("bigint").alias("turn")
    docs = spread(table(spark, sf, "documents"), "doc_id")
    pages = spread(table(spark, sf, "pages"), "page_id")
    turns = spread(table(spark, sf, "conversations"), "conv_id", "turn")
    parts = [
        docs.select(F.lit("documents").alias("origin"), F.col("doc_id").alias("text_id"), zero, F.col("text").alias("t")),
        pages.select(F.lit("pages").alias("origin"), F.col("page_id").alias("text_id"), zero, F.concat_ws(" ", "url", "html").alias("t")),
        turns.select(F.lit("conversations").alias("origin"), F.col("conv_id").alias("text_id"), "turn", F.col("text").alias("t")),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# The rules in the dialect of the checking engine: no look-around, no back-references.
SQL_SPACE = (
    r"\t-\r\x1c-\x20\x85\xa0\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)


def _sql(pattern: str) -> str:
    """A pattern with white space spelled out, as a quoted SQL string."""
    plain = pattern.removeprefix(text.UNICODE).replace(text.SPACE, SQL_SPACE).replace("++", "+")
    return "'" + plain.replace("'", "''") + "'"


_RULES: dict[str, list[str]] = {
    "html": ["regexp_replace(t, '<[^>]+>', ' ', 'g')"],
    "urls": [f"regexp_replace(t, '{text.URL}', ' ', 'g')"],
    "emails": [r"regexp_replace(t, '\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b', ' ', 'g')"],
    "phones": [f"regexp_replace(t, {_sql(text.PHONE)}, ' ', 'g')"],
    "social": [
        f"regexp_replace(regexp_replace(t, '{text.MENTION}', ' ', 'g'), '{text.HASHTAG}', ' ', 'g')"
    ],
    "accents": ["strip_accents(t)"],
    "special": [f"regexp_replace(t, {_sql(text.NOT_KEPT)}, ' ', 'g')"],
    "repeats": [
        "string_split(t, '')",
        "array_to_string(list_filter(t, lambda c, i: i <= 2 OR c <> t[i - 1] OR c <> t[i - 2] OR c = chr(10)), '')",
    ],
    "punct": [
        "regexp_replace(regexp_replace(regexp_replace(t, '[.]{2,}', '.', 'g'), '[!]{2,}', '!', 'g'), '[?]{2,}', '?', 'g')"
    ],
    "space": [f"trim(regexp_replace(t, '[{SQL_SPACE}]+', ' ', 'g'))"],
    "lower": ["lower(t)"],
    "second": [
        f"regexp_replace(coalesce(t, ''), {_sql(text.LINK_WORD)}, '', 'g')",
        f"regexp_replace(t, '[^{SQL_SPACE}]+@[^{SQL_SPACE}]+', '', 'g')",
        # A number is dropped when no word character touches it. Neighbours share a separator, so
        # one pass finds every other number of a row of them.
        *[f"regexp_replace(t, '(^|[^{text.WORD}]){text.DIGIT}{{10,}}($|[^{text.WORD}])', '\\1\\2', 'g')"] * 2,
        f"trim(regexp_replace(t, '[{SQL_SPACE}]+', ' ', 'g'))",
    ],
}
_CHAIN = ("html", "urls", "emails", "phones", "social", "accents", "special", "repeats", "punct", "space", "lower")


def rule_ctes(rules: tuple[str, ...] | list[str], source: str) -> tuple[str, str]:
    """Common table expressions applying rules to column ``t`` of ``source``, and the last name."""
    steps = [step for rule in rules for step in _RULES[rule]]
    ctes, last = [], source
    for number, step in enumerate(steps):
        name = f"{source}_{number}"
        ctes.append(f"{name} AS (SELECT * REPLACE ({step} AS t) FROM {last})")
        last = name
    return ",\n".join(ctes), last


def clean_sql(source: str) -> tuple[str, str]:
    """The cleaning chain on column ``t`` of ``source``; the result has null for empty text."""
    ctes, last = rule_ctes(_CHAIN, source)
    return f"{ctes}, {source}_clean AS (SELECT * REPLACE (nullif(t, '') AS t) FROM {last})", f"{source}_clean"


def _text_query(name: str, function: Callable[[Column], Column], ctes: str, last: str) -> None:
    sql = f"WITH {CORPUS_SQL}, {ctes} SELECT origin, text_id, turn, t AS result FROM {last}"

    @query(name, sql)
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return corpus(spark, sf).select("origin", "text_id", "turn", function(F.col("t")).alias("result"))


for _name, _function, _rule in (
    ("t1_strip_html", text.strip_html, "html"),
    ("t2_strip_urls", text.strip_urls, "urls"),
    ("t3_strip_emails", text.strip_emails, "emails"),
    ("t4_strip_phones", text.strip_phones, "phones"),
    ("t5_strip_social", text.strip_social, "social"),
    ("t6_fold_accents", text.fold_accents, "accents"),
    ("t7_strip_special", text.strip_special, "special"),
    ("t8_squeeze_repeats", text.squeeze_repeats, "repeats"),
    ("t9_squeeze_punct", text.squeeze_punct, "punct"),
    ("t10_squeeze_space", text.squeeze_space, "space"),
    ("t11_lower", text.lower, "lower"),
    ("t13_clean_again", text.clean_again, "second"),
):
    _text_query(_name, _function, *rule_ctes([_rule], "corpus"))
_text_query("t12_clean_text", text.clean_text, *clean_sql("corpus"))


@query(
    "t14_text_length",
    f"WITH {CORPUS_SQL} SELECT origin, text_id, turn, CAST(length(t) AS INTEGER) AS text_length FROM corpus",
)
def text_length(spark: SparkSession, sf: str) -> DataFrame:
    return corpus(spark, sf).select("origin", "text_id", "turn", text.text_length(F.col("t")).alias("text_length"))


@query(
    "t15_word_count",
    f"""WITH {CORPUS_SQL} SELECT origin, text_id, turn,
    CAST(len(regexp_extract_all(t, '[^{SQL_SPACE}]+')) AS INTEGER) AS word_count FROM corpus""",
)
def word_count(spark: SparkSession, sf: str) -> DataFrame:
    return corpus(spark, sf).select("origin", "text_id", "turn", text.word_count(F.col("t")).alias("word_count"))


@query(
    "t16_full_review",
    f"""WITH {TITLED_SQL} SELECT review_id,
    coalesce(CASE WHEN rating_review > 1 THEN title END, '') || ' ' || coalesce(text_review, '') AS full_review
    FROM titled""",
)
def full_review(spark: SparkSession, sf: str) -> DataFrame:
    title = F.when(F.col("rating_review") > 1, F.col("title"))
    return titled(spark, sf).select("review_id", text.full_review(title, F.col("text_review")).alias("full_review"))


@query(
    "t17_parse_stars",
    """SELECT o_orderkey, CAST(split_part(o_orderpriority, '-', 1) AS INTEGER) AS stars FROM orders""",
)
def parse_stars(spark: SparkSession, sf: str) -> DataFrame:
    stars = labels.parse_stars(F.translate("o_orderpriority", "-", " "))
    return table(spark, sf, "orders").select("o_orderkey", stars.alias("stars"))


@query(
    "t18_sentiment_label",
    f"""SELECT l_orderkey, l_linenumber, {LABEL_CASE.format("l_linenumber")} AS sentiment FROM lineitem""",
)
def sentiment_label(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem")
    return lines.select("l_orderkey", "l_linenumber", labels.sentiment_label(F.col("l_linenumber")).alias("sentiment"))


@query(
    "t19_sentiment3",
    """SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber IN (4, 5) THEN 'Positive'
    WHEN l_linenumber = 3 THEN 'Neutral' WHEN l_linenumber IN (1, 2) THEN 'Negative' END AS sentiment
    FROM lineitem""",
)
def sentiment3(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem")
    return lines.select("l_orderkey", "l_linenumber", labels.sentiment3(F.col("l_linenumber")).alias("sentiment"))


@query(
    "t20_display_label",
    f"""WITH {STARRED_SQL} SELECT review_id,
    upper(left(predicted_sentiment_label, 1)) || lower(substr(predicted_sentiment_label, 2)) AS shown FROM starred""",
)
def display_label(spark: SparkSession, sf: str) -> DataFrame:
    return starred(spark, sf).select("review_id", labels.display_label(F.col("predicted_sentiment_label")).alias("shown"))


@query(
    "t21_is_blank",
    f"""WITH {CORPUS_SQL} SELECT origin, text_id, turn,
    coalesce(NOT regexp_matches(t, '[^{SQL_SPACE}]'), true) AS blank
    FROM corpus""",
)
def is_blank(spark: SparkSession, sf: str) -> DataFrame:
    return corpus(spark, sf).select("origin", "text_id", "turn", text.is_blank(F.col("t")).alias("blank"))


@query(
    "x1_review_features",
    f"""WITH {REVIEWS_SQL} SELECT review_id, CAST(length(text_review) AS INTEGER) AS text_length,
    CAST(len(regexp_extract_all(text_review, '[^{SQL_SPACE}]+')) AS INTEGER) AS word_count,
    {LABEL_CASE.format("rating_review")} AS sentiment FROM reviews""",
)
def review_features(spark: SparkSession, sf: str) -> DataFrame:
    return reviews(spark, sf).select(
        "review_id",
        text.text_length(F.col("text_review")).alias("text_length"),
        text.word_count(F.col("text_review")).alias("word_count"),
        labels.sentiment_label(F.col("rating_review")).alias("sentiment"),
    )
