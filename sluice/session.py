"""Folders that all executors share, and lineage cuts that survive executor loss."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_local_dir: str | None = None


def shared_dir(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; a temporary folder only in local mode."""
    global _local_dir
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    if _local_dir is None:
        _local_dir = tempfile.mkdtemp(prefix="sluice-")
    return _local_dir


def plain_unions(spark: SparkSession) -> None:
    """Keep unions from relying on the partitioning of their inputs.

    Spark 4.1 pairs up the partitions of inputs it takes for equally partitioned, and
    fails ("Can't zip RDDs") when adaptive execution has changed one of them since.
    """
    spark.conf.set("spark.sql.unionOutputPartitioning", "false")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no other call returns."""
    app = spark.sparkContext.applicationId
    return f"{shared_dir(spark)}/sluice/{app}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str = "staged") -> DataFrame:
    """Write the rows to the shared folder once and go on from there.

    For frames that several actions read, and that take longer to compute than to read.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Remove a folder below the shared one that nothing reads any more."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


# Rows that a Python worker gets at a time while long texts are read.
TEXT_ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    """Hand Python workers at most ``TEXT_ROWS`` rows at a time, which keeps them small when texts are long.

    A setting of the session: functions of texts return plans that run later.
    """
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(setting)) <= TEXT_ROWS:
        spark.conf.set(setting, str(TEXT_ROWS))


def durable(df: DataFrame) -> DataFrame:
    """Checkpoint to the shared folder, so a lost executor does not recompute the lineage."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Inside, the shuffle files of a query go when it has ended, not when the driver happens to collect garbage.

    It holds for frames that are made inside. A frame that is run again shuffles again, so what
    several queries need is written down first.
    """
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "true")
    try:
        yield
    finally:
        spark.conf.set(setting, before)


class Steps:
    """Intermediate frames, each written to the shared folder and removed when nothing needs it any more."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, {}

    def keep(self, name: str, df: DataFrame) -> DataFrame:
        self.paths[name] = scratch_path(self.spark, name)
        df.write.parquet(self.paths[name])
        return self.spark.read.schema(df.schema).parquet(self.paths[name])

    def drop(self, *names: str) -> None:
        for name in names:
            discard(self.spark, self.paths.pop(name))
