"""Exact deduplication by skew-safe combining.

Copies are merged three times, each time comparing full content next to the digest: inside a
task, among the tasks that share a salt, and among the salts. A text that fills a third of the
table reaches the last stage as at most ``salts`` rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from placepulse.llm.common import SPACE, saved, without
from placepulse.operators.joins import HOT_SHARE

SALTS = 16


def normalised(text: Column) -> Column:
    """Runs of ASCII white space as one space; null as the empty text."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def find_copies(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    salts: int = SALTS,
    digest: Callable[[Column], Column] = sha256,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when their normalised forms are identical. The smallest id of a group stays.
    Null and empty texts are one group. Null ids never win over others; a group without any id
    has a null ``keep_id``. Rows that repeat the id which stays are that document and are all
    ``kept``. An empty table gives an empty result; other columns are not read. ``digest`` may be
    weak: different texts under one digest are told apart by their content.
    """
    base = docs.select(
        F.col(id_column).alias("_id"), normalised(F.col(text_column)).alias("_text")
    ).withColumn("_digest", digest(F.col("_text")))
    # A task sees a text once after its own merge, whatever salt its partition has.
    merged = (
        base.withColumn("_salt", F.spark_partition_id() % salts)
        .groupBy("_digest", "_text", "_salt")
        .agg(F.min("_id").alias("_keep"), F.count(F.lit(1)).alias("_n"))
    )
    winners = (
        merged.repartition("_digest")
        .groupBy("_digest", "_text")
        .agg(F.min("_keep").alias("_keep"), F.sum("_n").alias("_n"))
    )
    texts = F.count(F.lit(1)).over(Window.partitionBy("_digest"))
    # From here a digest stands for its text; the text itself goes on only where digests collide.
    groups = saved(
        winners.withColumn("_text", F.when(texts > 1, F.col("_text"))).where("_n > 1 OR _text IS NOT NULL"),
        "copies",
    )
    plain = groups.where("_text IS NULL").drop("_text")
    collided = groups.where("_text IS NOT NULL")
    some = not collided.isEmpty()
    members = base.select("_id", "_digest", sha256(F.col("_text")).alias("_sha"))
    if some:
        alike = base.join(collided.select("_digest").distinct(), "_digest", "left_semi")
        members = without(members, collided, {"_digest": F.col("_digest")})
    found = _looked_up(members, plain)
    if some:
        rest = alike.join(collided, ["_digest", "_text"])
        found = found.unionByName(rest.select("_id", "_keep", "_n", sha256(F.col("_text")).alias("_sha")))
    keep = F.when(F.col("_n").isNull(), F.col("_id")).otherwise(F.col("_keep"))
    return found.select(
        F.col("_id").alias("doc_id"),
        keep.alias("keep_id"),
        F.coalesce("_n", F.lit(1)).cast("bigint").alias("group_size"),
        F.col("_id").eqNullSafe(keep).alias("kept"),
        F.col("_sha").alias("text_sha256"),
    )


def _looked_up(members: DataFrame, groups: DataFrame) -> DataFrame:
    """``_id, _keep, _n, _sha`` of all members; without a group the middle two are null.

    Groups with more than a thousandth of all grouped rows, of which there are fewer than a thousand, are
    broadcast. Their members need no other partner and are spread over the shuffle of the rest.
    """
    total = groups.agg(F.sum("_n")).scalar()
    hot = groups.where(F.col("_n") > total * HOT_SHARE).toDF("_digest", "_hot_keep", "_hot_n")
    marked = members.join(F.broadcast(hot), "_digest", "left")
    anywhere = F.concat(F.lit("-"), F.spark_partition_id().cast("string"))
    marked = marked.withColumn("_digest", F.when(F.col("_hot_n").isNull(), F.col("_digest")).otherwise(anywhere))
    joined = marked.join(groups, "_digest", "left")
    # A hot group may have no id to keep, so its size decides.
    keep = F.when(F.col("_hot_n").isNull(), F.col("_keep")).otherwise(F.col("_hot_keep"))
    return joined.select("_id", keep.alias("_keep"), F.coalesce("_hot_n", "_n").alias("_n"), "_sha")


def drop_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    A dropped row is named by its id and digest, so an id used for two texts loses only the copy.
    """
    gone = saved(find_copies(docs, id_column, text_column).where("NOT kept"), "dropped")
    keys = {"doc_id": F.col(id_column), "text_sha256": sha256(normalised(F.col(text_column)))}
    return without(docs, gone, keys)
