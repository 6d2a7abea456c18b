"""Declared schemas and the fixed vocabularies shared by all operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The five sentiment classes, in the order of their ids 0..4.
LABELS = ("Very Negative", "Negative", "Neutral", "Positive", "Very Positive")
UNKNOWN_LABEL = "unknown"
UNKNOWN_LANGUAGE = "unknown"
NO_TEXT_LABEL = "No Text"

# The length limits of the two filters and the encoder width.
CLEANED_MIN_EXCLUSIVE = 10
TEXT_MIN, TEXT_MAX = 20, 1000
MAX_TOKENS = 512
SEED = 42


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


RAW_REVIEWS = _struct(("text_review", T.StringType()), ("rating_review", T.IntegerType()))
CLEANED_REVIEWS = _struct(("rating_review", T.IntegerType()), ("cleaned_text", T.StringType()))
LANGUAGE_DISTRIBUTION = _struct(("detected_language", T.StringType()), ("count", T.LongType()))
ENHANCED_REVIEWS = _struct(
    ("rating_review", T.IntegerType()),
    ("cleaned_text", T.StringType()),
    ("text_length", T.IntegerType()),
    ("word_count", T.IntegerType()),
    ("predicted_rating", T.IntegerType()),
    ("predicted_sentiment_label", T.StringType()),
)
NEW_REVIEWS = _struct(("title", T.StringType()), ("text_review", T.StringType()))
SCORED_REVIEWS = _struct(
    ("source", T.StringType()),
    ("title", T.StringType()),
    ("text_review", T.StringType()),
    ("predicted_sentiment", T.StringType()),
)
ATTRACTIONS = _struct(("id", T.LongType()), ("title", T.StringType()))
REVIEWS = _struct(
    ("attraction_id", T.LongType()),
    ("source", T.StringType()),
    ("text_review", T.StringType()),
    ("predicted_sentiment", T.StringType()),
)
LABEL_MAP = _struct(("label_id", T.IntegerType()), ("label", T.StringType()))
TITLE_ALIASES = _struct(("from_title", T.StringType()), ("to_title", T.StringType()))


def label_vocab(spark: SparkSession) -> DataFrame:
    """The ordered five-label vocabulary as a table ``(label_id, label)``."""
    return spark.createDataFrame(list(enumerate(LABELS)), LABEL_MAP)


def label_to_id(label: Column) -> Column:
    """Label text to its id; null for anything outside the vocabulary."""
    position = F.array_position(F.array(*[F.lit(name) for name in LABELS]), label)
    return F.nullif(position, F.lit(0)).cast("int") - F.lit(1)


def id_to_label(label_id: Column) -> Column:
    """Label id to its text; null for an id outside 0..4."""
    return F.get(F.array(*[F.lit(name) for name in LABELS]), label_id)
