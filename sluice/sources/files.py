"""Readers: files, folders of files, text lines, catalog tables, file metadata."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.types import EmptyInput

# Option spellings of other CSV readers -> Spark's (fixed values).
OPTION_ALIASES = {"separator": "sep", "withHeader": "header", "escaper": "escape", "quoteChar": "quote"}


def read_files(
    spark: SparkSession,
    path: str | list[str],
    fmt: str = "parquet",
    schema=None,
    **options,
) -> DataFrame:
    """Load one or more paths. Give ``schema`` for text formats: inferring it reads the data twice."""
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    for key, value in options.items():
        reader = reader.option(OPTION_ALIASES.get(key, key), value)
    return reader.load(path)


def frame_name(prefix: str) -> str:
    """Name of a frame made from a folder name: letters, digits and underscores only."""
    return re.sub(r"[^A-Za-z0-9_]", "", prefix)


def read_many(
    spark: SparkSession, paths: Mapping[str, str], fmt: str = "parquet", schema=None, **options
) -> dict[str, DataFrame]:
    """One frame per prefix, keyed by the cleaned prefix name."""
    return {frame_name(k): read_files(spark, p, fmt, schema, **options) for k, p in paths.items()}


def folders_below(spark: SparkSession, parent: str, nested: bool = False) -> dict[str, list[str]]:
    """The folders right below ``parent`` by their cleaned name, as the file system lists them; hidden ones do not count.

    With ``nested``, folders that hold further ones are opened instead, and names join the cleaned names on the way
    with ``_``; folders of partition values (``column=value``) belong to the folder that they are in. Folders whose
    names differ in other characters only share a name. A listing has one entry per folder and file.
    """
    place = spark._jvm.org.apache.hadoop.fs.Path(parent)
    store = place.getFileSystem(spark._jsc.hadoopConfiguration())
    found: dict[str, list[str]] = {}

    def walk(path, names: list[str]) -> None:
        inner = [
            s.getPath() for s in store.listStatus(path)
            if s.isDirectory() and not s.getPath().getName().startswith(("_", ".")) and "=" not in s.getPath().getName()
        ]
        for child in inner if nested or not names else []:
            walk(child, [*names, frame_name(child.getName())])
        if names and not (nested and inner):
            found.setdefault("_".join(names), []).append(path.toString())

    walk(place, [])
    return dict(sorted(found.items()))


def discover(
    spark: SparkSession, parent: str, fmt: str = "parquet", schema=None, nested: bool = False, view: str | None = None, **options
) -> dict[str, DataFrame]:
    """One frame per folder below ``parent`` (see ``folders_below``): folders that arrive later appear by themselves.

    ``view`` also registers each as the temporary view ``<view>_<name>``. Without any folder there are no frames.
    """
    frames = {
        name: read_files(spark, paths, fmt, schema, **options)
        for name, paths in folders_below(spark, parent, nested).items()
    }
    if view is not None:
        for name, df in frames.items():
            df.createOrReplaceTempView(f"{view}_{name}")
    return frames


def read_prefixes(spark: SparkSession, parent: str, fmt: str = "parquet", schema=None, **options) -> DataFrame:
    """All folders below ``parent`` as one scan, however deep their files lie.

    The column ``prefix`` holds the cleaned name of the folder right below ``parent``; it
    is empty for files in ``parent`` itself.
    """
    df = read_files(spark, parent, fmt, schema, recursiveFileLookup=True, **options)
    place = spark._jvm.org.apache.hadoop.fs.Path(parent)
    place = place.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(place).toUri().getRawPath()
    # Schemes and hosts may be written in several ways; the paths behind them are equal.
    path = F.regexp_replace(F.col("_metadata.file_path"), "^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "")
    below = F.split(F.substring(path, len(place.rstrip("/")) + 2, 1 << 20), "/")
    folder = F.when(F.size(below) > 1, F.url_decode(below[0])).otherwise("")
    return df.withColumn("prefix", F.regexp_replace(folder, "[^A-Za-z0-9_]", ""))


def require_rows(df: DataFrame) -> DataFrame:
    """Pass the frame on, or raise EmptyInput. Reads no further than the first row."""
    if df.isEmpty():
        raise EmptyInput("input has no rows")
    return df


def read_or_stop(spark: SparkSession, path: str, fmt: str = "parquet", schema=None, **options) -> DataFrame:
    """Like read_files, but a missing path or an empty input raises EmptyInput."""
    from pyspark.errors import AnalysisException

    try:
        df = read_files(spark, path, fmt, schema, **options)
    except AnalysisException as err:
        if err.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise EmptyInput(path) from err
        raise
    return require_rows(df)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per text line, column ``value``."""
    return spark.read.text(path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def with_source_file(df: DataFrame, name: str = "source_file") -> DataFrame:
    """Add the path of the file behind each row; call it directly on a file scan."""
    return df.withColumn(name, F.col("_metadata.file_path"))


def source_files(df: DataFrame) -> DataFrame:
    """Distinct paths of the files behind a file scan."""
    return df.select(F.col("_metadata.file_path").alias("source_file")).distinct()


def freshness(df: DataFrame, group: str, ts: str, key: str, expected: Column) -> DataFrame:
    """Per group the newest entry, its timestamp and whether it is of the expected date."""
    newest = df.groupBy(group).agg(
        F.max(F.struct(ts, key)).alias("m"),
    )
    return newest.select(
        group,
        F.col(f"m.{key}").alias("newest_key"),
        F.col(f"m.{ts}").alias("newest_ts"),
        (F.to_date(F.col(f"m.{ts}")) == expected).alias("is_current"),
    )


def late_groups(fresh: DataFrame, group: str) -> DataFrame:
    return fresh.where(~F.col("is_current")).select(group)


def file_freshness(df: DataFrame, group: Column, expected: Column) -> DataFrame:
    """Freshness of the files of a scan, by their modification time."""
    files = df.select(
        group.alias("prefix"),
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_modification_time").alias("modified"),
    )
    return freshness(files, "prefix", "modified", "path", expected)


def load_tables(spark: SparkSession, folder: str, names: Sequence[str]) -> list[DataFrame]:
    return [read_files(spark, f"{folder}/{n}.parquet") for n in names]
