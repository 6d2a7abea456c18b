"""The given tables seen as reviews, on both engines.

``documents`` stand for reviews, ``nation`` names for attractions and order priorities for star
labels. The rating is a fixed uneven function of the text length, so equal texts agree in it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from placepulse.functions.labels import parse_stars, sentiment_label
from placepulse.session import spread


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def rating(n_chars: Column) -> Column:
    rest = n_chars % 20
    return (
        F.when(rest == 0, 1).when(rest == 1, 2).when(rest <= 4, 3).when(rest <= 10, 4).otherwise(5)
    )


RATING_SQL = """CAST(CASE WHEN n_chars % 20 = 0 THEN 1 WHEN n_chars % 20 = 1 THEN 2
    WHEN n_chars % 20 <= 4 THEN 3 WHEN n_chars % 20 <= 10 THEN 4 ELSE 5 END AS INTEGER)"""


def reviews(spark: SparkSession, sf: str) -> DataFrame:
    """``review_id, text_review, source, detected_language, rating_review``."""
    docs = spread(table(spark, sf, "documents"), "doc_id")
    return docs.select(
        F.col("doc_id").alias("review_id"),
        F.col("text").alias("text_review"),
        "source",
        F.col("lang").alias("detected_language"),
        rating(F.col("n_chars")).alias("rating_review"),
    )


REVIEWS_SQL = f"""reviews AS (SELECT doc_id AS review_id, text AS text_review, source,
    lang AS detected_language, {RATING_SQL} AS rating_review FROM documents)"""


def titled(spark: SparkSession, sf: str) -> DataFrame:
    """Reviews with the title of their attraction."""
    names = table(spark, sf, "nation").select(F.col("n_nationkey").alias("_at"), F.col("n_name").alias("title"))
    tagged = reviews(spark, sf).withColumn("_at", (F.col("review_id") % 25).cast("int"))
    return tagged.join(names, "_at").drop("_at")


TITLED_SQL = f"""{REVIEWS_SQL}, titled AS (SELECT r.*, n.n_name AS title
    FROM reviews r JOIN nation n ON n.n_nationkey = r.review_id % 25)"""


def attractions(spark: SparkSession, sf: str) -> DataFrame:
    """The attractions known so far: the nations of three of the five regions."""
    known = table(spark, sf, "nation").where("n_regionkey < 3")
    return known.select((F.col("n_nationkey") + 1).cast("bigint").alias("id"), F.col("n_name").alias("title"))


ATTRACTIONS_SQL = """attractions AS (SELECT CAST(n_nationkey + 1 AS BIGINT) AS id, n_name AS title
    FROM nation WHERE n_regionkey < 3)"""


def aliases(spark: SparkSession, sf: str) -> DataFrame:
    """Nations of region 4 are other names of their customers' region: an alias per nation."""
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    joined = nation.join(region, nation.n_regionkey == region.r_regionkey).where("n_regionkey = 4")
    return joined.select(F.col("n_name").alias("from_title"), F.col("r_name").alias("to_title"))


ALIASES_SQL = """aliases AS (SELECT n_name AS from_title, r_name AS to_title
    FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_regionkey = 4)"""


def published(spark: SparkSession, sf: str) -> DataFrame:
    """Keys of the reviews published before: the texts that have been judged for quality."""
    judged = table(spark, sf, "labels").select(F.col("doc_id").alias("review_id"))
    return reviews(spark, sf).join(judged, "review_id", "left_semi").select("text_review", "source")


PUBLISHED_SQL = """published AS (SELECT text_review, source FROM reviews
    WHERE review_id IN (SELECT doc_id FROM labels))"""


def starred(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as labelled rows: ``review_id, stars, predicted_sentiment_label``, and a guess."""
    orders = table(spark, sf, "orders")
    stars = parse_stars(F.translate("o_orderpriority", "-", " "))
    guess = F.when(F.col("o_orderstatus") == "F", stars).otherwise(stars % 5 + 1)
    return orders.select(
        F.col("o_orderkey").alias("review_id"),
        stars.alias("stars"),
        sentiment_label(stars).alias("predicted_sentiment_label"),
        (stars - 1).alias("label"),
        (guess - 1).alias("prediction"),
        "o_custkey",
        "o_totalprice",
    )


LABEL_CASE = """CASE {0} WHEN 5 THEN 'Very Positive' WHEN 4 THEN 'Positive' WHEN 3 THEN 'Neutral'
    WHEN 2 THEN 'Negative' WHEN 1 THEN 'Very Negative' ELSE 'unknown' END"""

STARRED_SQL = f"""starred0 AS (SELECT *, CAST(split_part(o_orderpriority, '-', 1) AS INTEGER) AS stars FROM orders),
starred AS (SELECT o_orderkey AS review_id, stars, {LABEL_CASE.format("stars")} AS predicted_sentiment_label,
    stars - 1 AS label, CASE WHEN o_orderstatus = 'F' THEN stars - 1 ELSE stars % 5 END AS prediction,
    o_custkey, o_totalprice FROM starred0)"""
