"""Connected components of a table of links, without leaving Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placepulse.llm.common import saved


def components(links: DataFrame) -> DataFrame:
    """``id, component`` for every end of ``links(a, b)``: the smallest id reachable.

    Every round gives a node the least label among its neighbours and then the label of its
    label, so long chains shorten by more than half. Labels are only ever joined and combined by
    minimum: a node with very many links is pre-aggregated like any other key.
    """
    both = saved(
        links.select("a", "b").union(links.select("b", "a")).where("a <> b").distinct().toDF("a", "b"), "links"
    )
    labels = saved(both.groupBy("a").agg(F.min("b").alias("m")).select(
        F.col("a").alias("id"), F.least("a", "m").alias("component")), "labels")
    while True:
        seen = both.join(labels.toDF("b", "_label"), "b").groupBy("a").agg(F.min("_label").alias("_near"))
        near = labels.join(seen.withColumnRenamed("a", "id"), "id", "left").select(
            "id", F.col("component").alias("_old"), F.least("component", "_near").alias("component")
        )
        hop = labels.toDF("component", "_hop")
        after = near.join(hop, "component", "left").select(
            "id", "_old", F.least("component", "_hop").alias("component")
        )
        after = saved(after, "labels")
        labels = after.drop("_old")
        if after.where("_old <> component").isEmpty():
            return labels
