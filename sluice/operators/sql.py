"""SQL over named frames, metrics, assertions and whole-frame functions."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.skew import spread_join
from sluice.types import RuleViolation


@contextmanager
def _views(spark: SparkSession, frames: Mapping[str, DataFrame]) -> Iterator[None]:
    """The frames as temporary views; views of the same names are there again afterwards."""
    known = {t.name for t in spark.catalog.listTables() if t.isTemporary}
    before = {name: spark.table(name) for name in frames if name in known}
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
    try:
        yield
    finally:
        for name in frames:
            if name in before:
                before[name].createOrReplaceTempView(name)
            else:
                spark.catalog.dropTempView(name)


def run_sql(
    spark: SparkSession, sql: str, args: Mapping[str, Any] | Sequence[Any] | None = None, **frames: DataFrame
) -> DataFrame:
    """Run SQL. ``{name}`` stands for a frame, ``:name`` or ``?`` for a value.

    Values are bound, not pasted, and ``IDENTIFIER(:name)`` takes a table name.
    Python's format fields cannot be combined with positional values.
    """
    if args is not None and not isinstance(args, Mapping) and frames:
        with _views(spark, frames):
            return spark.sql(sql, args=list(args))
    return spark.sql(sql, args=args if args is None or isinstance(args, Mapping) else list(args), **frames)


def run_sql_file(spark: SparkSession, path: str, args: Mapping[str, Any] | None = None, **frames) -> DataFrame:
    """Like run_sql, with the statement read from a text file Spark can reach."""
    text = spark.read.text(path, wholetext=True).first()
    return run_sql(spark, text[0], args, **frames)


def enrich(left: DataFrame, right: DataFrame, on: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Left join that adds ``cols`` of ``right``."""
    return spread_join(left, right.select(*on, *cols), on, "left")


_AGGREGATES: dict[str, Callable[[str], str]] = {
    "count": lambda x: f"count({x})",
    "count_distinct": lambda x: f"count(DISTINCT {x})",
    "avg": lambda x: f"avg({x})",
    "sum": lambda x: f"sum({x})",
    "min": lambda x: f"min({x})",
    "max": lambda x: f"max({x})",
}


def metrics(
    df: DataFrame,
    dimensions: Mapping[str, str],
    measures: Mapping[str, tuple[str, str] | tuple[str, str, Sequence[str]]],
) -> DataFrame:
    """Business metric: dimensions ``{name: sql}``, measures ``{name: (kind, sql, filters)}``."""
    aggs = []
    for name, (kind, sql, *rest) in measures.items():
        text = _AGGREGATES[kind](sql)
        filters = rest[0] if rest else ()
        if filters:
            text += " FILTER (WHERE " + " AND ".join(f"({f})" for f in filters) + ")"
        aggs.append(F.expr(text).alias(name))
    return df.groupBy(*[F.expr(sql).alias(name) for name, sql in dimensions.items()]).agg(*aggs)


_SIGNS: dict[str, Callable[[Column, int], Column]] = {
    "gt": lambda n, t: n > t,
    "gte": lambda n, t: n >= t,
    "eq": lambda n, t: n == t,
    "lte": lambda n, t: n <= t,
    "lt": lambda n, t: n < t,
}


def assert_query(df: DataFrame, sign: str = "gt", threshold: int = 0) -> DataFrame:
    """One row: number of rows found, and whether ``count <sign> threshold``, which means failure."""
    return df.agg(F.count(F.lit(1)).alias("found")).select(
        "found", F.lit(sign).alias("sign"), _SIGNS[sign](F.col("found"), threshold).alias("failed")
    )


def raise_if(df: DataFrame, sign: str = "gt", threshold: int = 0, message: str = "assertion failed") -> None:
    """Raise when the assertion fails; against zero only the first row is read."""
    if threshold == 0 and sign in ("gt", "eq", "lte"):
        empty = df.isEmpty()
        failed = not empty if sign == "gt" else empty
    else:
        failed = assert_query(df, sign, threshold).first()["failed"]
    if failed:
        raise RuleViolation(message)


def python_step(df: DataFrame, fn: Callable[..., DataFrame], **kwargs) -> DataFrame:
    """Apply a function of the whole frame."""
    return df.transform(lambda d: fn(d, **kwargs))


def build_dimension(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """DISTINCT over computed columns."""
    return df.select(*[c.alias(n) for n, c in columns.items()]).distinct()
