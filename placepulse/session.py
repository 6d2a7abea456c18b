"""Session defaults, the two ways intermediate results are made durable, and how long they last."""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_JOB: ContextVar[str | None] = ContextVar("job", default=None)


def build_session(app: str = "placepulse", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs rely on; a cluster's own settings win."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.checkpoint.compress": "true",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``, else one below the warehouse.

    A cluster whose warehouse is a local folder must name one: its machines share no other.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named:
            named = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
            local = named.startswith(("file:", "/")) and not context.master.startswith("local[")
            if local and context.master != "local":
                raise ValueError("name a shared folder in spark.checkpoint.dir")
        context.setCheckpointDir(named)
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared checkpoint folder, inside of a job below the job's folder."""
    return f"{_JOB.get() or checkpoint_root(spark)}/{name}-{uuid.uuid4().hex}"


def _file_system(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsc.hadoopConfiguration())


@contextmanager
def job_scratch(spark: SparkSession) -> Iterator[str]:
    """A job whose intermediate results are removed when it ends or fails.

    Inside, ``durable`` and ``scratch_path`` use a folder of the job's own. What leaves the job must be written
    elsewhere: a DataFrame that reads an intermediate result can't be used afterwards. Jobs may be
    nested and may run side by side in several threads.
    """
    folder = f"{checkpoint_root(spark)}/job-{uuid.uuid4().hex}"
    token = _JOB.set(folder)
    try:
        yield folder
    finally:
        _JOB.reset(token)
        path, fs = _file_system(spark, folder)
        fs.delete(path, True)


def sweep_scratch(spark: SparkSession, older_than: float = 7 * 86_400.0) -> int:
    """Remove folders of jobs that were killed before they could, unchanged for so many seconds; their number.

    Every session has a folder of its own below the named one; those of all sessions are looked at, and
    nothing but folders of jobs is touched.
    """
    own, fs = _file_system(spark, checkpoint_root(spark).rstrip("/"))
    latest, removed = (time.time() - older_than) * 1000, 0
    for job in fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(own.getParent(), "*/job-*")) or []:
        if job.getModificationTime() < latest and fs.delete(job.getPath(), True):
            removed += 1
    return removed


def durable(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and keep it in reliable storage, cutting its lineage.

    Used where a result is read several times: a lost executor costs a re-read, not a re-run. Inside
    of a job it is a Parquet table, whose columns are pruned when read; else a checkpoint.
    """
    spark = df.sparkSession
    if _JOB.get() is None:
        checkpoint_root(spark)
        return df.checkpoint(eager=True)
    path = scratch_path(spark, "kept")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Give a scan of few, small files enough partitions to use every core.

    A scan that already has a task per core, as any large table does, is returned unchanged,
    so this adds no shuffle at scale.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= 2 * cores:
        return df
    return df.repartition(cores, *keys)
