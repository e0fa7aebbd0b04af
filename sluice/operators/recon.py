"""Reconciliation of a source with a target, and row counts that cost no extra job."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.session import plain_unions


# Sums match if they differ by half a cent at most, or by what the order of additions can make.
CENT, ROUNDING = 0.005, 1e-12


@dataclass(frozen=True)
class Labels:
    """Who compares what, as written to the result rows."""

    pipeline_name: str
    glue_name: str
    source_location: str
    target_location: str


def _filtered(df: DataFrame, condition: str | None) -> DataFrame:
    return df.where(condition) if condition else df


def _result(df: DataFrame, labels: Labels, ts: Column | None) -> DataFrame:
    """Counts are equal or not; sums (doubles, or decimals where exact) agree or not."""
    s, t = F.col("s"), F.col("t")
    same = s.eqNullSafe(t) if "exact" not in df.columns else F.when(F.col("exact"), F.col("xs").eqNullSafe(F.col("xt"))).otherwise(_agree(s, t))
    _text = lambda c: _amount(F.col(c), F.col(f"x{c}")) if "exact" in df.columns else F.col(c).cast("string")
    return df.select(
        F.lit(labels.pipeline_name).alias("pipeline_name"),
        F.lit(labels.glue_name).alias("glue_name"),
        F.lit(labels.source_location).alias("source_location"),
        F.lit(labels.target_location).alias("target_location"),
        _text("s").alias("source_count"),
        _text("t").alias("target_count"),
        "measure_column",
        F.when(same, "Y").otherwise("N").alias("match_flag"),
        F.lit("N").alias("notification_sent"),
        (F.current_timestamp() if ts is None else ts).alias("reconc_ts"),
    )


def reconcile_counts(
    src: DataFrame,
    tgt: DataFrame,
    labels: Labels,
    src_filter: str | None = None,
    tgt_filter: str | None = None,
    ts: Column | None = None,
) -> DataFrame:
    """One row: row counts of both sides and whether they match."""
    plain_unions(src.sparkSession)
    zero = F.lit(0).cast("long")
    s = _filtered(src, src_filter).agg(F.count(F.lit(1)).alias("s")).withColumn("t", zero)
    t = _filtered(tgt, tgt_filter).agg(F.count(F.lit(1)).alias("t")).withColumn("s", zero)
    both = s.unionByName(t).agg(F.sum("s").alias("s"), F.sum("t").alias("t"))
    return _result(both.withColumn("measure_column", F.lit("")), labels, ts)


def _is_exact(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, (T.IntegralType, T.DecimalType))


def _total(df: DataFrame, name: str) -> Column:
    """Sum of a column: of integers and decimals exactly, of others as doubles, which no value is too small or large for."""
    c = F.col(name)
    if isinstance(df.schema[name].dataType, T.IntegralType):
        c = c.cast("decimal(38,0)")
    return F.sum(c if _is_exact(df, name) else c.cast("double"))


def _amount(c: Column, exact: Column) -> Column:
    """A sum as text with two decimals."""
    return F.coalesce(exact.cast("string"), F.round(c, 2).try_cast("decimal(38,2)").cast("string"), c.cast("string"))


def _agree(a: Column, b: Column) -> Column:
    """Equal to the cent, or as equal as doubles that were added in another order are."""
    near = F.abs(a - b) <= F.greatest(F.lit(CENT), F.greatest(F.abs(a), F.abs(b)) * ROUNDING)
    return (a.isNull() & b.isNull()) | F.coalesce(near & ~F.isnan(a) & ~F.isnan(b), F.lit(False))


def reconcile_measures(
    src: DataFrame,
    tgt: DataFrame,
    pairs: Sequence[tuple[str, str]],
    labels: Labels,
    src_filter: str | None = None,
    tgt_filter: str | None = None,
    ts: Column | None = None,
) -> DataFrame:
    """One row per (source column, target column): both sums and whether they match."""

    def side(df: DataFrame, cols: Sequence[str], keep: str) -> DataFrame:
        one = df.agg(*[_total(df, c).alias(f"v{i}") for i, c in enumerate(cols)])
        cells = F.array(*[
            F.struct(F.lit(i).alias("i"), F.col(f"v{i}").cast("double").alias("v"), (F.col(f"v{i}") if _is_exact(df, c) else F.lit(None)).try_cast("decimal(38,2)").alias("x"))
            for i, c in enumerate(cols)
        ])
        rows = one.select(F.inline(cells))
        values = {"s": F.lit(None).cast("double"), "t": F.lit(None).cast("double"), "xs": F.lit(None).cast("decimal(38,2)"), "xt": F.lit(None).cast("decimal(38,2)")}
        values |= {keep: F.col("v"), f"x{keep}": F.col("x")}
        return rows.select("i", *[c.alias(n) for n, c in values.items()])

    plain_unions(src.sparkSession)
    s = side(_filtered(src, src_filter), [a for a, _ in pairs], "s")
    t = side(_filtered(tgt, tgt_filter), [b for _, b in pairs], "t")
    both = s.unionByName(t).groupBy("i").agg(*[F.max(c).alias(c) for c in ("s", "t", "xs", "xt")])
    names = F.array(*[F.lit(a) for a, _ in pairs])
    exact = F.array(*[F.lit(_is_exact(src, a) and _is_exact(tgt, b)) for a, b in pairs])
    place = F.col("i") + 1
    both = both.withColumns({"measure_column": F.element_at(names, place), "exact": F.element_at(exact, place)})
    return _result(both, labels, ts)


def pending(df: DataFrame, pipeline: str) -> DataFrame:
    """Results of a pipeline nobody was told about yet."""
    return df.where((F.col("pipeline_name") == pipeline) & (F.col("notification_sent") == "N"))


def mark_sent(df: DataFrame, pipeline: str) -> DataFrame:
    """The whole result table with the pipeline's rows marked as sent."""
    sent = F.when(F.col("pipeline_name") == pipeline, "Y").otherwise(F.col("notification_sent"))
    return df.withColumn("notification_sent", sent)


def observe_counts(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count rows as they pass, whenever an action runs; ``observation.get["rows"]`` afterwards."""
    observation = Observation(name)
    return df.observe(observation, F.count(F.lit(1)).alias("rows")), observation
