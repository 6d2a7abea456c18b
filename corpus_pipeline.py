"""The corpus pipeline: documents to packed training sequences, one operator per stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from placepulse.llm import exact_dedup, mixing, near_dedup, packing, quality
from placepulse.llm.common import saved, table

#: No SQL: perplexities, fitted rates and best-fit packing are not SQL's to say.
ORACLE_SQL = None


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity exceeds their language's threshold go."""
    return quality.drop_low_quality(docs, table(spark, sf_dir, "labels"))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one document stays."""
    return exact_dedup.drop_copies(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return near_dedup.drop_near_duplicates(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document is used as often as its fitted rate says."""
    return mixing.apply_rates(docs, table(spark, sf_dir, "labels"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of the permitted lengths."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality", quality_stage),
    ("exact_dedup", exact_stage),
    ("near_dedup", near_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents, each written as Parquet and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), name)
    return docs
