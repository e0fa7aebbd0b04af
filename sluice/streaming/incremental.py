"""Incremental batches: every file is read exactly once, kept in a stream checkpoint.

Each call processes what arrived since the last one and returns. Writes carry the batch
number, so a batch that is repeated after a failure replaces itself.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.operators.clean import split_blank
from sluice.operators.quality.checks import Check, verify
from sluice.operators.quality.states import MetricStore
from sluice.sinks.keyed import KeyedTable
from sluice.sinks.tables import point_table_at
from sluice.sinks.upsert import upsert


def new_files(spark: SparkSession, path: str, schema, fmt: str = "parquet", **options) -> DataFrame:
    """A stream over the files below ``path`` (a folder or a pattern)."""
    return spark.readStream.schema(schema).format(fmt).options(**options).load(path)


def run_available(stream: DataFrame, checkpoint: str, handle: Callable[[DataFrame, int], None]) -> None:
    """Hand all new data to ``handle(frame, batch number)`` and wait for the end."""
    query = (
        stream.writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(handle)
        .start()
    )
    query.awaitTermination()


def _append_batch(df: DataFrame, batch: int, target: str) -> None:
    df.write.mode("overwrite").parquet(f"{target}/batch={batch}")


def read_new(spark: SparkSession, path: str, schema, target: str, checkpoint: str, fmt: str = "parquet", **options) -> None:
    """Copy rows of new files to ``target``, one ``batch=`` folder per batch."""
    run_available(
        new_files(spark, path, schema, fmt, **options), checkpoint,
        lambda df, batch: _append_batch(df, batch, target),
    )


def _drop_versions(spark: SparkSession, root: str, keep: set[str]) -> None:
    """Remove version folders; the last two stay, for those who still read the one before."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    store = path.getFileSystem(spark._jsc.hadoopConfiguration())
    for entry in store.listStatus(path):
        name = entry.getPath().getName()
        if name.startswith("version=") and name.removeprefix("version=") not in keep:
            store.delete(entry.getPath(), True)


def upsert_new(
    spark: SparkSession,
    path: str,
    schema,
    table: str,
    root: str,
    checkpoint: str,
    keys: Sequence[str],
    order_by: str,
    not_blank: Sequence[str] = (),
    fmt: str = "parquet",
    **options,
) -> None:
    """Drop rows with blank required columns, merge the rest into ``table`` by key.

    Plain Parquet has no row updates: each batch writes a new version folder and then
    points the table at it. A repeated batch finds its version in place and stops.
    """

    def merge(df: DataFrame, batch: int) -> None:
        spark_ = df.sparkSession
        version = f"{root}/version={batch}"
        good = split_blank(df, not_blank).good
        if not spark_.catalog.tableExists(table):
            empty = spark_.createDataFrame([], schema)
            upsert(empty, good, keys, order_by).write.mode("overwrite").parquet(version)
            spark_.catalog.createTable(table, path=version, source="parquet", schema=good.schema)
            return
        place = spark_.sql(f"DESCRIBE EXTENDED {table}").where("col_name = 'Location'").first()["data_type"]
        if place.rstrip("/").endswith(f"/version={batch}"):
            return
        upsert(spark_.table(table), good, keys, order_by).write.mode("overwrite").parquet(version)
        point_table_at(spark_, table, version)
        _drop_versions(spark_, root, {place.rstrip("/").rpartition("=")[2], str(batch)})

    run_available(new_files(spark, path, schema, fmt, **options), checkpoint, merge)
    # Batches run in a session of their own; this one may remember the old location.
    if spark.catalog.tableExists(table):
        spark.catalog.refreshTable(table)


def merge_new(
    spark: SparkSession, path: str, schema, table: KeyedTable, checkpoint: str,
    not_blank: Sequence[str] = (), fmt: str = "parquet", **options,
) -> None:
    """Drop rows with blank required columns, merge the rest into a keyed table.

    A batch rewrites only the files that may hold its keys. A repeated batch finds its number
    in the table and stops.
    """

    def merge(df: DataFrame, batch: int) -> None:
        KeyedTable(df.sparkSession, table.root).upsert(split_blank(df, not_blank).good, batch)

    run_available(new_files(spark, path, schema, fmt, **options), checkpoint, merge)


def log_quality(
    spark: SparkSession, path: str, schema, checks: Sequence[Check], log: str, checkpoint: str,
    fmt: str = "parquet", **options,
) -> None:
    """Check every batch of new files and keep the result rows, with a timestamp, in a log."""

    def run(df: DataFrame, batch: int) -> None:
        _append_batch(verify(df, checks, F.current_timestamp()), batch, log)

    run_available(new_files(spark, path, schema, fmt, **options), checkpoint, run)


def measure_new(spark: SparkSession, path: str, schema, store: MetricStore, checkpoint: str, fmt: str = "parquet", **options) -> None:
    """Keep the metric states of every batch of new files; ``store.read()`` gives the metrics of all of them."""
    run_available(new_files(spark, path, schema, fmt, **options), checkpoint, store.add)
