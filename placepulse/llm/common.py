"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from placepulse.operators.joins import fits_broadcast
from placepulse.session import scratch_path

#: White space and words as all operators here see them: ASCII blanks, everything else is a word.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared scratch folder and read back with its columns prunable."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Number of words, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def small_side(df: DataFrame) -> DataFrame:
    """Mark a join side for broadcast if its measured size allows it; otherwise it is shuffled."""
    return F.broadcast(df) if fits_broadcast(df) else df


def without(rows: DataFrame, dropped: DataFrame, keys: dict[str, Column]) -> DataFrame:
    """``rows`` but for those whose ``keys`` (name in ``dropped`` -> value in ``rows``) are dropped; nulls are equal.

    The row travels as one struct, so its own names can't meet those used here.
    """
    listed = small_side(dropped.select(*(F.col(name).alias(f"_dropped_{name}") for name in keys)).distinct())
    held = rows.select(F.struct("*").alias("_whole"), *(value.alias(f"_own_{name}") for name, value in keys.items()))
    condition = F.lit(True)
    for name in keys:
        condition = condition & F.col(f"_dropped_{name}").eqNullSafe(F.col(f"_own_{name}"))
    return held.join(listed, condition, "left_anti").select("_whole.*")
