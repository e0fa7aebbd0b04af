"""Metrics of a growing table, from states that each batch leaves and that merge without the rows.

A batch leaves one row per metric that plain aggregates give (counts, sums, moments, extremes or a
sketch), and the counts of the values of each set of columns that a frequency metric asks for.
Merged, they are the states of the union of the batches: no old row is read again.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.operators.quality import analyzers as A
from sluice.session import plain_unions

# Size of a quantile sketch (its default elsewhere in this package).
QUANTILE_SIZE = 200

STATE = "metric string, how string, n bigint, figures array<double>, hll binary, kll binary"


def _name(m: A.Metric) -> str:
    return json.dumps([m.name, list(m.columns)])


def _state(m: A.Metric) -> str:
    """SQL text of the state of a metric: a struct of the fields of ``STATE``."""
    c = [A.number(x) for x in m.columns]
    kind = m.name.split(".")[0].split("-")[0]
    n, figures, hll, kll, how = "count(1)", "array()", "NULL", "NULL", kind
    if kind in ("Completeness", "Compliance", "DataType", "DataTypeShare"):
        # The share times its base is a count again.
        share = f"coalesce({m.scalar}, 0D)"
        if kind == "DataTypeShare" and not m.scalar.endswith("count(1))"):
            n = f"count({A.quote(m.columns[0])})"
        how, figures = "share", f"array(round({share} * {n}))"
    elif kind in ("Maximum", "MaxLength", "Minimum", "MinLength"):
        how, figures = kind[:3].lower(), f"array(double({m.scalar}))"
    elif kind in ("Mean", "Sum"):
        n, figures = f"count({c[0]})", f"array(double(sum({c[0]})))"
    elif kind == "StandardDeviation":
        n, figures = f"count({c[0]})", f"array(avg({c[0]}), var_pop({c[0]}) * count({c[0]}))"
    elif kind == "Correlation":
        both = f"{c[0]}, {c[1]}"
        n = f"regr_count({both})"
        figures = f"array(regr_avgy({both}), regr_avgx({both}), regr_syy({both}), regr_sxx({both}), regr_sxy({both}))"
    elif kind == "ApproxCountDistinct":
        hll = f"hll_sketch_agg({A.quote(m.columns[0])})"
    elif kind == "ApproxQuantile":
        n, kll = f"count({c[0]})", f"kll_sketch_agg_double({c[0]}, {QUANTILE_SIZE})"
    elif kind != "Size":
        raise ValueError(f"metric {m.name} has no state")
    return (
        f"named_struct('metric', {A.text_literal(_name(m))}, 'how', '{how}', 'n', bigint({n}), "
        f"'figures', CAST({figures} AS array<double>), 'hll', CAST({hll} AS binary), 'kll', CAST({kll} AS binary))"
    )


# The value of merged states by how they merge; ``parts`` lists (n, figures) of the batches that have values.
_PARTS = "filter(parts, p -> p.n > 0)"
_MEAN = "aggregate(live, 0D, (s, p) -> s + p.n * p.figures[{0}]) / total"
_SPREAD = "aggregate(live, 0D, (s, p) -> s + p.figures[{k}] + p.n * (p.figures[{i}] - mean{i}) * (p.figures[{j}] - mean{j}))"
_VALUE = f"""CASE
  WHEN how = 'Size' THEN double(total)
  WHEN how = 'share' THEN try_divide(figure, total)
  WHEN how = 'max' THEN highest
  WHEN how = 'min' THEN lowest
  WHEN total = 0 THEN NULL
  WHEN how = 'Sum' THEN figure
  WHEN how = 'Mean' THEN figure / total
  WHEN how = 'StandardDeviation' THEN sqrt({_SPREAD.format(k=1, i=0, j=0)} / total)
  WHEN how = 'Correlation' THEN try_divide({_SPREAD.format(k=4, i=0, j=1)},
    sqrt({_SPREAD.format(k=2, i=0, j=0)}) * sqrt({_SPREAD.format(k=3, i=1, j=1)}))
END"""


class MetricStore:
    """States of metrics in a shared folder, one sub-folder per batch; a repeated batch replaces itself."""

    def __init__(self, spark: SparkSession, root: str, metrics: Sequence[A.Metric | list[A.Metric]]):
        self.spark, self.root, self.metrics = spark, root.rstrip("/"), A._flatten(metrics)
        plain_unions(spark)
        if any(m.frame is not None or (m.scalar is not None and not isinstance(m.scalar, str)) for m in self.metrics):
            raise ValueError("metrics of frames and of Column conditions have no states; give the condition as text")
        self.scalars = list({_name(m): m for m in self.metrics if m.scalar is not None}.values())
        sets = dict.fromkeys(tuple(sorted(set(m.columns))) for m in self.metrics if m.grouped is not None)
        # A set within another one is counted with it.
        self.sets = [s for s in sets if not any(set(s) < set(o) for o in sets)]

    def add(self, df: DataFrame, batch: int) -> None:
        """Keep the states of one batch of rows."""
        if self.scalars:
            rows = df.agg(*[F.expr(_state(m)).alias(f"s{i}") for i, m in enumerate(self.scalars)])
            rows.selectExpr(f"inline(array({', '.join(f's{i}' for i in range(len(self.scalars)))}))").write.mode("overwrite").parquet(
                f"{self.root}/states/batch={batch}"
            )
        if self.sets:
            self._counted(df).write.mode("overwrite").parquet(f"{self.root}/values/batch={batch}")

    def _counted(self, df: DataFrame) -> DataFrame:
        """Rows (columns, key, n): the values of each set as text, from one scan."""
        columns = list(dict.fromkeys(c for s in self.sets for c in s))
        text = df.select(*[F.col(A.quote(c)).cast("string").alias(c) for c in columns])
        grouped = text.groupingSets([[F.col(A.quote(c)) for c in s] for s in self.sets], *[F.col(A.quote(c)) for c in columns])
        counts = grouped.agg(F.grouping_id().alias("_set"), F.count(F.lit(1)).alias("n"))
        number = lambda s: sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in s)
        name = key = F
        for i, s in enumerate(self.sets):
            mine = F.col("_set") == number(s)
            name = name.when(mine, json.dumps(s))
            key = key.when(mine, F.array(*[F.col(A.quote(c)) for c in s]))
        return counts.select(name.alias("columns"), key.alias("key"), "n")

    def _states(self, kind: str, schema: str, batches: Sequence[int] | None) -> DataFrame:
        if batches is not None:
            return self.spark.read.schema(schema).parquet(*[f"{self.root}/{kind}/batch={b}" for b in batches])
        return self.spark.read.schema(schema).parquet(f"{self.root}/{kind}")

    def fold(self, batches: Sequence[int], into: int) -> None:
        """Write batches as one new batch, value counts added up, states side by side; the old ones can be removed then."""
        self._states("states", STATE, batches).write.mode("overwrite").parquet(f"{self.root}/states/batch={into}")
        if self.sets:
            self._values(batches).write.mode("overwrite").parquet(f"{self.root}/values/batch={into}")

    def _values(self, batches: Sequence[int] | None) -> DataFrame:
        rows = self._states("values", "columns string, key array<string>, n bigint", batches)
        return rows.groupBy("columns", "key").agg(F.sum("n").alias("n"))

    def read(self, batches: Sequence[int] | None = None) -> DataFrame:
        """Rows (entity, instance, name, value) of the union of all batches, or of some."""
        parts: list[DataFrame] = []
        if self.scalars:
            merged = self._states("states", STATE, batches).groupBy("metric", "how").agg(
                F.sum("n").alias("total"), F.sum(F.get("figures", F.lit(0))).alias("figure"),
                F.max(F.get("figures", F.lit(0))).alias("highest"), F.min(F.get("figures", F.lit(0))).alias("lowest"),
                F.collect_list(F.when(F.col("how").isin("StandardDeviation", "Correlation"), F.struct("n", "figures"))).alias("parts"),
                F.expr("hll_union_agg(hll)").alias("hll"), F.expr("kll_merge_agg_double(kll)").alias("kll"),
            ).withColumn("live", F.expr(_PARTS))
            merged = merged.withColumn("mean0", F.expr(f"if(size(live) > 0, {_MEAN.format(0)}, NULL)")).withColumn(
                "mean1", F.expr(f"if(size(live) > 0 AND how = 'Correlation', {_MEAN.format(1)}, NULL)")
            )
            for i, m in enumerate(self.metrics):
                if m.scalar is None:
                    continue
                value = _VALUE
                if m.name == "ApproxCountDistinct":
                    value = "double(hll_sketch_estimate(hll))"
                elif m.name.startswith("ApproxQuantile"):
                    value = f"if(total > 0, kll_sketch_get_quantile_double(kll, {m.name.rpartition('-')[2]}D), NULL)"
                own = merged.where(F.col("metric") == _name(m))
                parts.append(own.selectExpr(f"{i} AS id", f"{value} AS value"))
        if self.sets:
            values = self._values(batches)
            for s in self.sets:
                mine = values.where(F.col("columns") == json.dumps(s)).select(*[F.get("key", F.lit(i)).alias(c) for i, c in enumerate(s)], F.col("n").alias("_rows"))
                wanted = [
                    (i, m) for i, m in enumerate(self.metrics)
                    if m.grouped is not None and s == next(o for o in self.sets if set(m.columns) <= set(o))
                ]
                parts.append(A._frequency_rows(mine, wanted, "_rows"))
        return A.labelled(reduce(lambda a, b: a.unionByName(b), parts), self.metrics)
