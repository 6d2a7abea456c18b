"""Score and publish new files as they arrive: the batch job under Structured Streaming.

Each run takes the files not yet seen, in batches, and stops. What was read is recorded in the
stream's checkpoint, and a batch is published under its own number, so a run that fails half way
repeats its last batch without publishing anything twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placepulse.plans.publishing import Scorer, publish_reviews, score_new_reviews
from placepulse.session import job_scratch
from placepulse.sources.keys import KeyIndex
from placepulse.sources.tables import TableStore

BATCH = T.StructType(
    [
        T.StructField("title", T.StringType()),
        T.StructField("text_review", T.StringType()),
        T.StructField("source", T.StringType()),
    ]
)


def run_available(
    spark: SparkSession,
    input_path: str,
    checkpoint: str,
    store: TableStore,
    aliases: DataFrame,
    scorer: Scorer,
    files_per_batch: int = 1000,
) -> None:
    """Process everything that has arrived (Parquet with title, text_review, source), then stop.

    What is known already is looked up in the index of the published keys.
    """
    published = KeyIndex(store)

    def publish(batch: DataFrame, number: int) -> None:
        part = f"batch-{number:09d}"
        # What an earlier try of this batch may have published does not count as known.
        # The batch is the files themselves, read again where its keys are looked up; publishing keeps what was scored.
        with job_scratch(spark):
            batch = batch.where(F.col("text_review").isNotNull())
            scored = score_new_reviews(batch, published, scorer, without_part=part)
            publish_reviews(scored, store, aliases, mode="append", part=part)

    stream = (
        spark.readStream.schema(BATCH).option("maxFilesPerTrigger", files_per_batch).parquet(input_path)
    )
    query = (
        stream.writeStream.foreachBatch(publish)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
