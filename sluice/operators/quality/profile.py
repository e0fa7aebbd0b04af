"""Column profiles, percentiles and histograms of whole frames."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.operators.quality import analyzers as A
from sluice.session import plain_unions

# Tasks that merge the sketches of all tasks before the last one does.
MERGERS = 256
# Accuracy of quantile sketches: ranks are off by about 0.3 percent.
QUANTILE_SIZE = 800


def _is_text(f: T.StructField) -> bool:
    return isinstance(f.dataType, T.StringType)


def _is_plain(f: T.StructField) -> bool:
    return isinstance(f.dataType, (T.StringType, T.BooleanType, T.NumericType))


def _native(f: T.StructField) -> str:
    if isinstance(f.dataType, T.BooleanType):
        return "Boolean"
    if isinstance(f.dataType, T.IntegralType):
        return "Integral"
    if isinstance(f.dataType, T.NumericType):
        return "Fractional"
    return "String" if _is_text(f) else "Unknown"


def profile_columns(df: DataFrame, columns: Sequence[str] | None = None, percentiles: bool = False) -> DataFrame:
    """One row per column from a single scan of the frame.

    The type of text columns is inferred from their values; the numeric figures are
    filled for numeric columns and for text columns that turn out numeric. All figures
    are mergeable (distinct counts and quantiles as sketches), and are merged in two
    steps: at most MERGERS partial rows reach the last task, however many tasks scan.
    """
    fields = [f for f in df.schema if columns is None or f.name in columns]
    points = [k / 100 for k in range(1, 101)] if percentiles else [0.25, 0.5, 0.75]
    quartiles = (24, 49, 74) if percentiles else (0, 1, 2)
    ranks = ", ".join(f"{p}D" for p in points)
    inputs = [f"spark_partition_id() % {MERGERS} AS _b"]
    numbers, partial, final, cells = ["*"], ["count(1) AS rows"], ["coalesce(sum(rows), 0L) AS rows"], []
    for i, f in enumerate(fields):
        c, x, k = f"c{i}", f"x{i}", f"k{i}"
        inputs += [f"{A.quote(f.name)} AS {c}"]
        partial += [f"count({c}) AS n{i}"]
        final += [f"coalesce(sum(n{i}), 0L) AS n{i}"]
        if _is_plain(f):
            partial += [f"hll_sketch_agg(if({c} IS NULL, NULL, xxhash64({c}))) AS d{i}"]
            final += [f"hll_sketch_estimate(hll_union_agg(d{i})) AS d{i}"]
        else:
            final += [f"CAST(NULL AS BIGINT) AS d{i}"]
        kind = f"'{_native(f)}'"
        if _is_text(f):
            inputs += [f"{A.value_class(A.quote(f.name))} AS {k}"]
            # A failed cast costs far more than a good one, so only numbers are cast.
            numbers += [f"if({k} IN ('integral', 'fractional'), try_cast({c} AS DOUBLE), NULL) AS {x}"]
            partial += [f"count_if({k} = '{kind}') AS {kind}{i}" for kind in A.CLASSES]
            final += [f"sum({kind}{i}) AS {kind}{i}" for kind in A.CLASSES]
            kind = (
                f"CASE WHEN n{i} = 0 THEN 'Unknown' "
                f"WHEN string{i} > 0 OR (boolean{i} > 0 AND fractional{i} + integral{i} > 0) THEN 'String' "
                f"WHEN boolean{i} > 0 THEN 'Boolean' WHEN fractional{i} > 0 THEN 'Fractional' ELSE 'Integral' END"
            )
        elif isinstance(f.dataType, T.NumericType):
            numbers += [f"double({c}) AS {x}"]
        numeric = f"({kind} IN ('Integral', 'Fractional') AND nx{i} > 0)"
        figures = {"mean_col": f"sum{i} / nx{i}", "maximum": f"max{i}", "minimum": f"min{i}", "sum_col": f"sum{i}"}
        if _is_text(f) or isinstance(f.dataType, T.NumericType):
            partial += [
                f"count({x}) AS nx{i}", f"sum({x}) AS sum{i}", f"min({x}) AS min{i}", f"max({x}) AS max{i}",
                f"named_struct('n', count({x}), 'm', avg({x}), 'v', var_pop({x})) AS v{i}",
                f"kll_sketch_agg_double({x}, {QUANTILE_SIZE}) AS q{i}",
            ]
            final += [
                f"sum(nx{i}) AS nx{i}", f"sum(sum{i}) AS sum{i}", f"min(min{i}) AS min{i}", f"max(max{i}) AS max{i}",
                f"collect_list(v{i}) AS v{i}", f"kll_merge_agg_double(q{i}) AS q{i}",
            ]
            # Variance within the partial rows plus variance between them.
            spread = f"p.n * (p.v + pow(p.m - sum{i} / nx{i}, 2))"
            figures["stdDev_col"] = (
                f"sqrt(aggregate(v{i}, 0D, (a, p) -> a + if(p.n > 0, {spread}, 0D)) / nx{i})"
            )
            quantiles = f"if({numeric}, kll_sketch_get_quantile_double(q{i}, array({ranks})), NULL)"
        else:
            final += [f"0L AS nx{i}", *[f"CAST(NULL AS DOUBLE) AS {g}{i}" for g in ("sum", "min", "max")]]
            figures["stdDev_col"], quantiles = "CAST(NULL AS DOUBLE)", "CAST(NULL AS ARRAY<DOUBLE>)"
        cells.append(
            f"named_struct('column', {A.text_literal(f.name)}, 'dataType', {kind}, "
            f"'isDataTypeInferred', {str(_is_text(f)).lower()}, 'completeness', try_divide(n{i}, rows), "
            f"'approximateNumDistinctValues', d{i}, "
            + "".join(f"'{out}', if({numeric}, {value}, NULL), " for out, value in figures.items())
            + f"'rows', rows, 'percentiles', {quantiles})"
        )
    merged = df.selectExpr(*inputs).selectExpr(*numbers).groupBy("_b").agg(*map(F.expr, partial)).selectExpr(*final)
    rows = merged.selectExpr(f"inline(array({', '.join(cells)}))")
    return rows.selectExpr("*", *[f"get(percentiles, {q}) AS approxQ{j + 1}" for j, q in enumerate(quartiles)])


def _labels(df: DataFrame, database: str, table: str, timestamp: Column | None) -> DataFrame:
    return df.withColumns(
        {
            "timestamp": F.current_timestamp() if timestamp is None else timestamp,
            "database": F.lit(database),
            "table": F.lit(table),
        }
    )


def profile(
    df: DataFrame, database: str = "", table: str = "", timestamp: Column | None = None,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """The column profile as a result table."""
    rows = profile_columns(df, columns).drop("rows", "percentiles")
    return _labels(rows, database, table, timestamp)


def percentile_table(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """100 percentiles per numeric column: the number in ``value_float``, its value in ``count_col``."""
    rows = profile_columns(df, columns, percentiles=True).where(F.col("percentiles").isNotNull())
    rows = rows.select("column", F.posexplode("percentiles").alias("i", "v"))
    return rows.select(
        F.col("column").alias("column_name"),
        F.lit("approxPercentile").alias("metric_type"),
        F.lit("").alias("value_str"),
        (F.col("i") + 1).cast("double").alias("value_float"),
        F.col("v").alias("count_col"),
        F.lit(None).cast("double").alias("ratio"),
    )


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows (column_name, value, n) of all listed columns, from one scan."""
    text = df.selectExpr(*[f"coalesce(string({A.quote(c)}), '{A.NULL_BIN}') AS {A.quote(c)}" for c in columns])
    return text.unpivot([], list(columns), "column_name", "value").groupBy("column_name", "value").agg(
        F.count(F.lit(1)).alias("n")
    )


def histogram_table(
    df: DataFrame, columns: Sequence[str] | None = None, limit: int | None = None
) -> DataFrame:
    """Value counts of all text, boolean and number columns: ``histogram`` rows for numbers, else ``category``.

    Numeric values stand in ``value_float``; text values and the null bin in ``value_str``.
    With ``limit`` a column with more distinct values has one row instead, of the type
    ``leftOut``, whose ``count_col`` is their exact number.
    """
    plain_unions(df.sparkSession)
    chosen = [f.name for f in df.schema if _is_plain(f) and (columns is None or f.name in columns)]
    numeric = [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]
    counts = value_counts(df, chosen)
    rows = df.agg(F.count(F.lit(1)).alias("rows"))
    is_num = F.col("column_name").isin(numeric) if numeric else F.lit(False)
    is_null = F.col("value") == A.NULL_BIN
    many = None
    if limit is not None:
        sizes = counts.groupBy("column_name").agg(F.count(F.lit(1)).alias("n"))
        many = sizes.where(F.col("n") > limit).select(
            "column_name", F.lit("leftOut").alias("metric_type"), F.lit("").alias("value_str"),
            F.lit(None).cast("double").alias("value_float"), F.col("n").cast("double").alias("count_col"),
            F.lit(None).cast("double").alias("ratio"),
        )
        counts = counts.join(sizes.where(F.col("n") <= limit), "column_name", "left_semi")
    listed = counts.select(
        "column_name",
        F.when(is_num, "histogram").otherwise("category").alias("metric_type"),
        F.when(is_num & ~is_null, "").otherwise(F.col("value")).alias("value_str"),
        F.when(is_num, F.col("value").try_cast("double")).alias("value_float"),
        F.col("n").cast("double").alias("count_col"),
        (F.col("n") / rows.scalar()).alias("ratio"),
    )
    return listed if many is None else listed.unionByName(many)


def bucket_table(
    df: DataFrame, database: str = "", table: str = "", timestamp: Column | None = None,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Histograms and percentiles as one result table."""
    both = histogram_table(df, columns).unionByName(percentile_table(df, columns))
    return _labels(both, database, table, timestamp)


def sketch(df: DataFrame, groups: Sequence[str], columns: Sequence[str], k: int = QUANTILE_SIZE) -> DataFrame:
    """One mergeable KLL quantile sketch per group and numeric column; store it, merge it later."""
    return df.groupBy(*groups).agg(
        *[F.kll_sketch_agg_double(F.col(c).cast("double"), k).alias(c) for c in columns]
    )


def merge_sketches(sketches: DataFrame, columns: Sequence[str], quantiles: Sequence[float]) -> DataFrame:
    """Quantiles of the union of the sketched groups: rows (column_name, quantile, value)."""
    merged = sketches.agg(*[F.kll_merge_agg_double(c).alias(c) for c in columns])
    parts = [
        merged.select(
            F.lit(c).alias("column_name"),
            F.lit(float(q)).alias("quantile"),
            F.kll_sketch_get_quantile_double(F.col(c), F.lit(float(q))).alias("value"),
        )
        for c in columns
        for q in quantiles
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)
