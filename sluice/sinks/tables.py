"""Writers and table maintenance on Spark's own file tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sluice.session import plain_unions, staged
from sluice.types import Quarantined, Split


def save_table(
    df: DataFrame,
    table: str,
    path: str | None = None,
    fmt: str = "parquet",
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    num_files: int | None = None,
    comment: str | None = None,
    reads_target: bool = False,
    skip_empty: bool = True,
    **options,
) -> bool:
    """Save as a catalog table; an empty frame is skipped and False returned.

    ``skip_empty=False`` writes it like any other, so an overwritten table ends up empty.
    Looking for a first row starts the plan once more; where it shuffles a lot before
    that row, pass ``staged(df)``.
    ``reads_target`` says that ``df`` reads the table being replaced: the rows then go
    to the shared scratch folder first, because Spark refuses to overwrite its input.
    """
    spark = df.sparkSession
    if skip_empty and df.isEmpty():
        return False
    if reads_target:
        df = staged(df)
    if num_files is not None:
        df = df.coalesce(num_files)
    elif partition_by:
        # Few files per partition value; adaptive execution splits large values again.
        df = df.hint("rebalance", *partition_by)
    writer = df.write.format(fmt).mode(mode).options(**options)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
    if comment is not None:
        text = comment.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"COMMENT ON TABLE {table} IS '{text}'")
    return True


def save_tables(
    frames: Mapping[str, DataFrame],
    prefix: str = "",
    base_path: str | None = None,
    partition_by: Mapping[str, Sequence[str]] | None = None,
    **kwargs,
) -> list[str]:
    """One table per frame; returns the names of those that had rows."""
    saved = []
    for name, df in frames.items():
        path = None if base_path is None else f"{base_path}/{name}"
        if save_table(df, prefix + name, path, partition_by=(partition_by or {}).get(name, ()), **kwargs):
            saved.append(prefix + name)
    return saved


@contextmanager
def partition_size(spark: SparkSession, target_bytes: int = 128_000_000) -> Iterator[None]:
    """Partitions that adaptive execution sizes are about that large in jobs that run inside."""
    setting = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(setting)
    spark.conf.set(setting, str(target_bytes))
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def repartition_by_size(df: DataFrame) -> DataFrame:
    """Output partitions of about equal size, measured at run time; write inside ``partition_size`` to choose it."""
    return df.hint("rebalance")


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", sep: str = ",", partition_by=(), **options) -> None:
    writer = (
        df.write.mode(mode)
        .option("header", True)
        .option("sep", sep)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .options(**options)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.csv(path)


def quarantine(df: DataFrame, error_col: str, file_col: str, path: str, sep: str = ";") -> DataFrame:
    """Gate before the load: rows without errors pass, without the error column.

    If any row has an error, all rows are written as CSV below ``path``, one folder per
    source file, and Quarantined is raised. The gate has to see all rows before the
    first may pass: give it ``staged(df)`` unless reading ``df`` twice is cheap.
    """
    if df.where(F.coalesce(F.col(error_col), F.lit("")) != "").isEmpty():
        return df.drop(error_col)
    write_csv(df.hint("rebalance", file_col), path, sep=sep, partition_by=[file_col])
    raise Quarantined(path)


def write_audited(
    df: DataFrame, error_col: str, file_col: str, target: str, rejects: str, mode: str = "errorifexists", sep: str = ";"
) -> DataFrame:
    """Write, audit, publish: the rows go to a hidden folder once and are counted on the way.

    Without errors the folder becomes ``target`` and is returned, read without the error column (whose
    empty values stay in the files). If any row has an error, the written rows are exported as ``quarantine``
    does, the folder is removed and Quarantined raised. The input is read once; a failure before the end
    leaves at most a hidden folder that no reader sees. ``mode``: errorifexists, or overwrite, which moves
    the old folder away first and removes it last.
    """
    spark = df.sparkSession
    paths = spark._jvm.org.apache.hadoop.fs.Path
    place = paths(target.rstrip("/"))
    store = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if mode not in ("errorifexists", "overwrite"):
        raise ValueError(f"unsupported mode {mode}")
    if store.exists(place) and mode != "overwrite":
        raise FileExistsError(target)
    mark = uuid.uuid4().hex
    hidden = paths(place.getParent(), f"_audit-{place.getName()}-{mark}")
    seen = Observation(f"audit-{mark}")
    bad = F.coalesce(F.col(f"`{error_col}`"), F.lit("")) != ""
    df.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(bad).alias("errors")).write.parquet(hidden.toString())
    if seen.get["errors"]:
        written = spark.read.schema(df.schema).parquet(hidden.toString())
        write_csv(written.hint("rebalance", file_col), rejects, sep=sep, partition_by=[file_col])
        store.delete(hidden, True)
        raise Quarantined(rejects)
    old = paths(place.getParent(), f"_old-{place.getName()}-{mark}")
    replaced = store.exists(place) and store.rename(place, old)
    if not store.rename(hidden, place):
        raise OSError(f"{hidden} cannot be published as {target}")
    if replaced:
        store.delete(old, True)
    return spark.read.schema(df.drop(error_col).schema).parquet(target)


def point_table_at(spark: SparkSession, table: str, path: str) -> None:
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
    spark.catalog.refreshTable(table)


def drop_table(spark: SparkSession, table: str) -> None:
    """Drop a table. Spark removes the files of managed tables; external files stay."""
    spark.sql(f"DROP TABLE IF EXISTS {table} PURGE")


def insert_into(df: DataFrame, table: str, overwrite: bool = False) -> None:
    """Append by column position, as INSERT INTO does."""
    df.write.insertInto(table, overwrite=overwrite)


def retention_split(df: DataFrame, date_col: str, fmt: str | None, cutoff: Column) -> Split:
    """``good`` stays in the table, ``bad`` (older than the cutoff) goes to the archive.

    ``fmt`` is the pattern of text or integer dates, None for date and timestamp
    columns. Rows without a readable date stay.
    """
    c = F.col(date_col)
    day = F.to_date(c) if fmt is None else F.try_to_date(c.cast("string"), fmt)
    old = F.coalesce(day < cutoff, F.lit(False))
    return Split(df.where(~old), df.where(old))


def months_before(today: Column, months: int) -> Column:
    return F.add_months(today, -months)


def archive_old(
    df: DataFrame, table: str, date_col: str, fmt: str | None, cutoff: Column, archive_path: str, path: str, run: str
) -> bool:
    """Move old rows of an external table to gzip CSV below ``archive_path/run=<run>``; False if there are none.

    The rest is written beside the table, to ``path`` with the run's name, and the table
    then points there. A run that failed in between can be repeated: its archive
    folder and its new files replace those of the first attempt. ``df`` reads the table.
    """
    spark = df.sparkSession
    keep, old = retention_split(df, date_col, fmt, cutoff)
    if old.isEmpty():
        return False
    beside = f"{path.rstrip('/')}-{run}"
    write_csv(old, f"{archive_path}/run={run}", compression="gzip")
    keep.write.mode("overwrite").parquet(beside)
    point_table_at(spark, table, beside)
    return True


def replace_partitions(df: DataFrame, table: str) -> None:
    """Overwrite the partitions that ``df`` has rows of; all others stay."""
    spark, setting = df.sparkSession, "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "dynamic")
    try:
        df.select(*spark.table(table).columns).write.insertInto(table, overwrite=True)
    finally:
        spark.conf.set(setting, before)


def partition_values(df: DataFrame, cols: Sequence[str], limit: int | None = None) -> DataFrame:
    """Rows (column_name, value) of all distinct values.

    With ``limit`` the columns with that many distinct values or more are not listed; each
    has one row instead whose value is null and ``left_out`` their exact number.
    """
    counts = df.select(*cols).unpivot([], [F.col(c).cast("string").alias(c) for c in cols], "column_name", "value")
    values = counts.groupBy("column_name", "value").agg(F.lit(1).alias("one"))
    if limit is None:
        return values.select("column_name", "value")
    plain_unions(df.sparkSession)
    sizes = values.groupBy("column_name").agg(F.count("value").alias("n"))
    few = values.join(sizes.where(F.col("n") < limit), "column_name", "left_semi")
    many = sizes.where(F.col("n") >= limit)
    return few.select("column_name", "value", F.lit(None).cast("long").alias("left_out")).unionByName(
        many.select("column_name", F.lit(None).cast("string").alias("value"), F.col("n").alias("left_out"))
    )
