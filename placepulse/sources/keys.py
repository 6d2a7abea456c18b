"""An index of the keys a stored table holds, so that a batch is compared without reading the table.

Next to every part of the table lie the 128-bit hashes of its keys, in buckets by the leading hash and
sorted. A batch reads two numbers per known key, only from the buckets that its own hashes
fall into; no text of the table is read or moved. Parts not indexed yet are indexed when the index
is next asked, so a run that failed between the two writes leaves nothing behind that matters.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placepulse.operators.columns import fingerprint
from placepulse.operators.joins import fits_broadcast, lookup_join
from placepulse.session import durable
from placepulse.sources.tables import TableStore

BUCKETS = 16
_SCHEMA = "one BIGINT, two BIGINT, part STRING, bucket INT"


class KeyIndex:
    """Keys of one table of a store. Keys with a null match nothing."""

    def __init__(
        self, store: TableStore, table: str = "reviews", keys: Sequence[str] = ("text_review", "source"), buckets: int = BUCKETS
    ):
        self.store, self.table, self.keys, self.buckets = store, table, list(keys), buckets

    def _hashed(self, rows: DataFrame) -> DataFrame:
        """``one, two, bucket`` of rows whose key has no null."""
        present = F.lit(True)
        for key in self.keys:
            present = present & F.col(key).isNotNull()
        one, two = fingerprint(*self.keys)
        bucket = F.pmod(one, F.lit(self.buckets)).cast("int").alias("bucket")
        return rows.where(present).select(one.alias("one"), two.alias("two"), bucket)

    def sync(self, without_part: str | None = None) -> list[str]:
        """Index the parts that are not yet; the folders of all parts, on request without one."""
        spark, folders = self.store.spark, []
        for part in self.store.parts(self.table):
            if part[0] == without_part:
                continue
            folder = self.store.key_folder(self.table, part)
            if not self.store.complete(folder):
                rows = self._hashed(spark.read.parquet(self.store.folder(self.table, part)).select(*self.keys))
                # One exchange: rows of a bucket meet, equal ones are dropped and the rest is sorted there.
                dealt = rows.repartition("bucket").distinct().sortWithinPartitions("bucket", "one")
                dealt.write.mode("overwrite").partitionBy("bucket").parquet(folder)
            folders.append(folder)
        return folders

    def known(self, batch: DataFrame, without_part: str | None = None) -> DataFrame:
        """``one, two`` of the batch's keys that the table holds; one row per key, at most as many as the batch has."""
        folders = self.sync(without_part)
        asked = durable(self._hashed(batch).distinct())
        # At most one number per bucket.
        buckets = [row["bucket"] for row in asked.select("bucket").distinct().collect()]
        spark = self.store.spark
        if not folders or not buckets:
            return spark.createDataFrame([], "one BIGINT, two BIGINT")
        reader = spark.read.schema(_SCHEMA).option("basePath", folders[0].rsplit("/", 1)[0])
        held = reader.parquet(*folders).where(F.col("bucket").isin(buckets)).select("one", "two")
        asked = asked.select("one", "two")
        return held.join(F.broadcast(asked) if fits_broadcast(asked) else asked, ["one", "two"], "left_semi").distinct()

    def unseen(self, batch: DataFrame, without_part: str | None = None) -> DataFrame:
        """Rows of the batch whose key the table does not hold. Copies inside of the batch all stay."""
        one, two = fingerprint(*self.keys)
        present = F.lit(True)
        for key in self.keys:
            present = present & F.col(key).isNotNull()
        # A key with a null gets no hash and so never matches.
        named = batch.withColumns({"_one": F.when(present, one), "_two": F.when(present, two)})
        found = durable(self.known(batch, without_part)).select(F.col("one").alias("_one"), F.col("two").alias("_two"))
        return lookup_join(named, found, ["_one", "_two"], "left_anti").select(*batch.columns)
