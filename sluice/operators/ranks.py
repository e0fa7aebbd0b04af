"""Ranks and running totals over whole tables, without a task that holds them all.

The rows are laid out in ranges of the order, of about equal size. Within a range, ranks and
totals come from a window; what lies ahead of a range is a sum over the totals of the ranges
before it, a table of one row per range and group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.session import staged


def running(df: DataFrame, order: Sequence[Column | str], by: Sequence[str] = (), value: str | None = None) -> DataFrame:
    """The rows with ``rank`` (from 1) and ``before`` (sum of ``value`` over the rows ahead; without ``value``, their number).

    Both count within equal ``by`` values, in the given ``order``. Rows that ``by`` and ``order`` do not tell
    apart come in any order, and very many such rows stay together: add a column that splits them.
    The rows are written to the shared folder once, in their ranges, so a lost task finds the same ranges.
    """
    keys = [F.col(f"`{c}`") for c in by]
    weight = F.col(f"`{value}`") if value else F.lit(1)
    laid = staged(df.repartitionByRange(*keys, *order).withColumn("_range", F.spark_partition_id()), "ranges")
    totals = laid.groupBy(*keys, "_range").agg(F.count(F.lit(1)).alias("_rows"), F.sum(weight).alias("_sum"))
    ahead = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ahead = totals.select(
        *[k.alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_range").alias("_r"),
        F.coalesce(F.sum("_rows").over(ahead), F.lit(0)).alias("_rows"), F.coalesce(F.sum("_sum").over(ahead), F.lit(0)).alias("_sum"),
    )
    inside = Window.partitionBy(*keys, "_range").orderBy(*order)
    here = laid.withColumns({
        "rank": F.row_number().over(inside),
        "before": F.coalesce(F.sum(weight).over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
    })
    same = F.col("_range") == F.col("_r")
    for i, k in enumerate(keys):
        same = same & k.eqNullSafe(F.col(f"_k{i}"))
    return here.join(ahead, same).select(
        *[F.col(f"`{c}`") for c in df.columns], (F.col("rank") + F.col("_rows")).alias("rank"), (F.col("before") + F.col("_sum")).alias("before")
    )


def quantiles(df: DataFrame, columns: Sequence[str], shares: Sequence[float]) -> DataFrame:
    """Exact quantiles of all filled rows (column_name, share, value), interpolated between the two rows they lie between.

    The rows are first counted by value, so that only different values are laid out in order. A column without
    filled rows gives no rows. NaN comes last.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").cast("double").alias("value")) for c in columns])
    filled = df.select(F.explode(pairs).alias("pair")).select("pair.*").where(F.col("value").isNotNull())
    counts = filled.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    placed = running(counts, ["value"], ["column_name"], "n")
    ends = placed.groupBy("column_name").agg((F.max(F.col("before") + F.col("n")) - 1).alias("last"))
    place = F.col("share") * F.col("last")
    low, high = F.floor(place), F.ceil(place)
    held = lambda i: (F.col("before") <= i) & (i < F.col("before") + F.col("n"))
    wanted = placed.join(F.broadcast(ends), "column_name").withColumn("share", F.explode(F.array(*[F.lit(float(s)) for s in shares])))
    found = wanted.where(held(low) | held(high)).groupBy("column_name", "share").agg(
        F.max(F.when(held(low), F.col("value"))).alias("low"), F.max(F.when(held(high), F.col("value"))).alias("high"),
        F.max(place - low).alias("part"),
    )
    between = F.col("low") + (F.col("high") - F.col("low")) * F.col("part")
    return found.select("column_name", "share", F.when(F.col("part") == 0, F.col("low")).otherwise(between).alias("value"))
