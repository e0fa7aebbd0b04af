"""Data-quality analyzers: many metrics of one frame, few passes over it.

All metrics that plain aggregates can give share one ``agg`` over one scan. Metrics
about value frequencies share another: one aggregation over grouping sets counts the values
of every set of columns that a metric asks for, and one more turns the counts into all the
metrics. The result is one lazy frame with a row per metric.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.session import plain_unions

# Text classes for type detection (fixed patterns).
FRACTIONAL = r"^[-+]? ?(\d+\.\d*|\.\d+)$"
INTEGRAL = r"^[-+]? ?\d+$"
BOOLEANS = ("true", "false")
CLASSES = ("null", "fractional", "integral", "boolean", "string")
# Histogram bin that holds the nulls (fixed value).
NULL_BIN = "NullValue"


@dataclass(frozen=True)
class Metric:
    """What to compute.

    ``scalar`` is an aggregate over the rows, as SQL text or a Column. ``grouped`` is
    SQL text of an aggregate over the frequency table of ``columns``, whose ``_n`` holds
    the counts (null groups included); ``_n@0`` are the counts of the first of the columns
    alone, and ``_w@0`` counts the rows of its values that have all the columns. ``frame``
    computes the single value from the frequency table in its own way. Exactly one of the
    three is set.
    """

    name: str
    entity: str
    columns: tuple[str, ...]
    scalar: Column | str | None = None
    grouped: str | None = None
    frame: Callable[[DataFrame], DataFrame] | None = None

    @property
    def instance(self) -> str:
        return ",".join(self.columns) if self.columns else "*"


def _cols(columns: str | Sequence[str]) -> tuple[str, ...]:
    return (columns,) if isinstance(columns, str) else tuple(columns)


def quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def text_literal(value: str) -> str:
    """SQL text literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def number(column: str) -> str:
    """SQL text: the value as a double, null for one that is no number; sums of it cannot overflow."""
    return f"try_cast({quote(column)} AS double)"


# Names of number types in a schema.
NUMBER_TYPES = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")

# Metrics of numbers: where the column holds none, they have no value.
NUMERIC = ("Maximum", "Minimum", "Mean", "Sum", "StandardDeviation", "Correlation", "ApproxQuantile")


def _entity(cols: tuple[str, ...]) -> str:
    return "Dataset" if not cols else "Column" if len(cols) == 1 else "Multicolumn"


def _scalar(name: str, columns: str | Sequence[str], value: str) -> Metric:
    cols = _cols(columns)
    return Metric(name, _entity(cols), cols, scalar=value)


def size() -> Metric:
    return _scalar("Size", (), "count(1)")


def completeness(column: str) -> Metric:
    return _scalar("Completeness", column, f"try_divide(count({quote(column)}), count(1))")


def compliance(instance: str, predicate: str | Column) -> Metric:
    """Share of the rows where the predicate is true; unknown counts as false."""
    if isinstance(predicate, str):
        return _scalar("Compliance", instance, f"try_divide(count_if({predicate}), count(1))")
    return Metric("Compliance", "Column", (instance,), scalar=F.try_divide(F.count_if(predicate), F.count(F.lit(1))))


def approx_count_distinct(column: str) -> Metric:
    return _scalar("ApproxCountDistinct", column, f"approx_count_distinct({quote(column)})")


def approx_quantile(column: str, q: float, relative_error: float = 0.01) -> Metric:
    value = f"percentile_approx({number(column)}, {q}, {round(1 / relative_error)})"
    return _scalar(f"ApproxQuantile-{q}", column, value)


def correlation(a: str, b: str) -> Metric:
    return _scalar("Correlation", (a, b), f"corr({number(a)}, {number(b)})")


def maximum(column: str) -> Metric:
    return _scalar("Maximum", column, f"max({number(column)})")


def minimum(column: str) -> Metric:
    return _scalar("Minimum", column, f"min({number(column)})")


def max_length(column: str) -> Metric:
    return _scalar("MaxLength", column, f"max(length({quote(column)}))")


def min_length(column: str) -> Metric:
    return _scalar("MinLength", column, f"min(length({quote(column)}))")


def mean(column: str) -> Metric:
    return _scalar("Mean", column, f"avg({number(column)})")


def total(column: str) -> Metric:
    return _scalar("Sum", column, f"sum({number(column)})")


def standard_deviation(column: str) -> Metric:
    return _scalar("StandardDeviation", column, f"stddev_pop({number(column)})")


def value_class(expression: str) -> str:
    """SQL text: type class of a value, judged by its text.

    Text with a character no number has is sorted out before the patterns are tried.
    """
    t = f"string({expression})"
    return (
        f"CASE WHEN {t} IS NULL THEN 'null' WHEN {t} IN {BOOLEANS} THEN 'boolean' "
        f"WHEN translate({t}, '0123456789+-. ', '') <> '' THEN 'string' "
        f"WHEN {t} RLIKE {text_literal(INTEGRAL)} THEN 'integral' "
        f"WHEN {t} RLIKE {text_literal(FRACTIONAL)} THEN 'fractional' ELSE 'string' END"
    )


def data_type(column: str) -> list[Metric]:
    """One ratio per type class."""
    kind = value_class(quote(column))
    return [_scalar(f"DataType.{k}", column, f"try_divide(count_if({kind} = '{k}'), count(1))") for k in CLASSES]


def type_share(column: str, kinds: Sequence[str], of_filled: bool = True) -> Metric:
    """Share of values of the given classes, among the non-null ones unless told otherwise."""
    listed = ", ".join(f"'{k}'" for k in kinds)
    base = f"count({quote(column)})" if of_filled else "count(1)"
    value = f"try_divide(count_if({value_class(quote(column))} IN ({listed})), {base})"
    return _scalar(f"DataTypeShare.{'|'.join(kinds)}", column, value)


def _present(cols: Sequence[str]) -> str:
    """Groups that count as values: at least one column is not null."""
    return "(_n IS NOT NULL AND (" + " OR ".join(f"{quote(c)} IS NOT NULL" for c in cols) + "))"


def _frequency(name: str, columns: str | Sequence[str], value: str) -> Metric:
    cols = _cols(columns)
    return Metric(name, _entity(cols), cols, grouped=value)


def _distinct(columns: str | Sequence[str]) -> str:
    return f"count_if({_present(_cols(columns))})"


def _once(columns: str | Sequence[str]) -> str:
    return f"count_if({_present(_cols(columns))} AND _n = 1)"


def count_distinct(columns: str | Sequence[str]) -> Metric:
    return _frequency("CountDistinct", columns, _distinct(columns))


def distinctness(columns: str | Sequence[str]) -> Metric:
    return _frequency("Distinctness", columns, f"try_divide({_distinct(columns)}, sum(_n))")


def uniqueness(columns: str | Sequence[str]) -> Metric:
    return _frequency("Uniqueness", columns, f"try_divide({_once(columns)}, sum(_n))")


def unique_value_ratio(columns: str | Sequence[str]) -> Metric:
    return _frequency("UniqueValueRatio", columns, f"try_divide({_once(columns)}, {_distinct(columns)})")


def entropy(column: str, base: float | None = None) -> Metric:
    """-sum p ln p over the non-null values, p taken over all rows; ``base`` changes the unit.

    With N rows this is (ln N * sum n - sum n ln n) / N, a single aggregate.
    """
    there = _present([column])
    value = f"(ln(sum(_n)) * sum(if({there}, _n, 0)) - sum(if({there}, _n * ln(_n), 0D))) / sum(_n)"
    name = "Entropy" if base is None else f"Entropy-{base}"
    return _frequency(name, column, value if base is None else f"({value}) / ln({float(base)}D)")


def number_of_bins(column: str) -> Metric:
    """Histogram bins: distinct values, the nulls being one of them."""
    return _frequency("Histogram.bins", column, "count(_n)")


def bin_value(column: str, value: str, what: str = "ratio") -> Metric:
    """Count (``abs``) or ratio of one histogram bin."""
    # Underscores are written as escapes, so that the value cannot be taken for the name of a count.
    literal = text_literal(value).replace("_", "\\u005f")
    hit = f"coalesce(string({quote(column)}), '{NULL_BIN}') = {literal}"
    n = f"sum(if({hit}, _n, 0))"
    return _frequency(f"Histogram.{what}.{value}", column, n if what == "abs" else f"try_divide({n}, sum(_n))")


def mutual_information(a: str, b: str) -> Metric:
    """sum p(x,y) ln(p(x,y) / p(x)p(y)) over pairs without nulls.

    The logarithm is split, so the marginals are sums over the counts of each column alone
    and nothing is joined.
    """
    pair = f"({quote(a)} IS NOT NULL AND {quote(b)} IS NOT NULL)"
    sides = " ".join(f"- sum(_w@{i} * ln(_n@{i}))" for i in (0, 1))
    value = f"(sum(if({pair}, _n * ln(_n), 0D)) + sum(if({pair}, _n, 0)) * ln(sum(_n)) {sides}) / sum(_n)"
    return Metric("MutualInformation", "Multicolumn", (a, b), grouped=value)


def contained(column: str, allowed: DataFrame, label: str) -> Metric:
    """Share of rows whose value is null or in the first column of ``allowed``; each different value is looked up once."""
    listed = allowed.select(F.col(f"`{allowed.columns[0]}`").cast("string").alias("_allowed")).where("_allowed IS NOT NULL").distinct()

    def compute(freq: DataFrame) -> DataFrame:
        found = freq.join(listed, F.col(f"`{column}`").cast("string") == F.col("_allowed"), "left")
        return found.selectExpr(f"try_divide(sum(if({quote(column)} IS NULL OR _allowed IS NOT NULL, _n, 0)), sum(_n)) AS value")

    return Metric(f"Compliance.{label}", "Column", (column,), frame=compute)


def histogram(df: DataFrame, column: str) -> DataFrame:
    """Every value with its count and ratio, nulls as the bin NullValue."""
    bins = df.groupBy(F.coalesce(F.col(column).cast("string"), F.lit(NULL_BIN)).alias("value")).agg(
        F.count(F.lit(1)).alias("count")
    )
    rows = df.agg(F.count(F.lit(1)).alias("rows"))
    return bins.select("value", "count", (F.col("count") / rows.scalar()).alias("ratio"))


def frequencies(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Frequency table of a set of columns; counts are combined before the shuffle."""
    return df.groupBy(*[F.col(f"`{c}`") for c in columns]).agg(F.count(F.lit(1)).alias("_n"))


def _flatten(metrics: Sequence[Metric | list[Metric]]) -> list[Metric]:
    out: list[Metric] = []
    for m in metrics:
        out.extend(m if isinstance(m, list) else [m])
    return out


def _rows(df: DataFrame, named: Sequence[tuple[int, Column | str]]) -> DataFrame:
    """Aggregate, then turn the single row into rows (id, value)."""
    one = df.agg(
        *[F.expr(f"double({c}) AS _m{i}") if isinstance(c, str) else c.cast("double").alias(f"_m{i}") for i, c in named]
    )
    cells = ", ".join(f"{i}, _m{i}" for i, _ in named)
    return one.selectExpr(f"stack({len(named)}, {cells}) AS (id, value)")


# Columns of one aggregation over grouping sets; Spark numbers the sets in 64 bits.
MOST_GROUPED = 60


def _passes(wanted: Sequence[tuple[int, Metric]]) -> list[list[tuple[int, Metric]]]:
    """Metrics of one pass each, so that a pass groups by ``MOST_GROUPED`` columns at most, or by those of one metric."""
    out: list[list[tuple[int, Metric]]] = []
    columns: set[str] = set()
    for i, m in wanted:
        if not out or len(columns | set(m.columns)) > MOST_GROUPED:
            out.append([])
            columns = set()
        out[-1].append((i, m))
        columns |= set(m.columns)
    return out


def _frequency_rows(df: DataFrame, wanted: Sequence[tuple[int, Metric]], rows: str | None = None) -> DataFrame:
    """All ``grouped`` metrics from one scan: the counts of every set of columns, then one aggregate over them.

    ``rows`` names a column that tells how many rows a row of ``df`` stands for.
    """
    columns = list(dict.fromkeys(c for _, m in wanted for c in m.columns))
    place = {c: i for i, c in enumerate(columns)}

    def number(cols: Sequence[str]) -> int:
        """As ``grouping_id`` has it: a bit for each column that is not in the set, the first one highest."""
        return sum(1 << (len(columns) - 1 - i) for c, i in place.items() if c not in cols)

    counts = {"_n": "count(1)" if rows is None else f"sum({rows})"}
    cells: dict[str, str] = {}

    def cell(count: str, cols: Sequence[str]) -> str:
        name = f"{count}_{number(cols)}"
        cells[name] = f"if(_set = {number(cols)}, {count}, NULL) AS {name}"
        return name

    sets: dict[int, tuple[str, ...]] = {}
    named: list[tuple[int, Column | str]] = []
    for i, m in wanted:
        sets.setdefault(number(m.columns), m.columns)
        own, w = cell("_n", m.columns), "_w" + "_".join(str(place[c]) for c in m.columns)

        def side(found: re.Match) -> str:
            column = m.columns[int(found[2])]  # noqa: B023
            sets.setdefault(number([column]), (column,))
            if found[1] == "w":
                all_there = " AND ".join(f"{quote(c)} IS NOT NULL" for c in m.columns)  # noqa: B023
                counts[w] = f"count_if({all_there})" if rows is None else f"sum(if({all_there}, {rows}, 0L))"
            return cell("_n" if found[1] == "n" else w, [column])  # noqa: B023

        text = re.sub(r"\b_(n|w)@(\d+)", side, m.grouped)
        named.append((i, re.sub(r"\b_n\b", own, text)))
    grouped = df.groupingSets([[F.col(quote(c)) for c in cols] for cols in sets.values()], *[F.col(quote(c)) for c in columns])
    freq = grouped.agg(F.grouping_id().alias("_set"), *[F.expr(f"{value} AS {name}") for name, value in counts.items()])
    return _rows(freq.selectExpr(*map(quote, columns), *cells.values()), named)


def measure(df: DataFrame, metrics: Sequence[Metric]) -> DataFrame:
    """Rows (id, value), ``id`` being the position in ``metrics``."""
    plain_unions(df.sparkSession)
    parts: list[DataFrame] = []
    scalars = [(i, m.scalar) for i, m in enumerate(metrics) if m.scalar is not None]
    if scalars:
        parts.append(_rows(df, scalars))
    grouped = [(i, m) for i, m in enumerate(metrics) if m.grouped is not None]
    parts += [_frequency_rows(df, wanted) for wanted in _passes(grouped)]
    parts += [
        m.frame(frequencies(df, m.columns)).selectExpr(f"{i} AS id", "double(value) AS value")
        for i, m in enumerate(metrics) if m.frame is not None
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)


def labelled(values: DataFrame, metrics: Sequence[Metric]) -> DataFrame:
    """Rows (id, value) as (entity, instance, name, value)."""
    label = lambda texts: f"element_at(array({', '.join(map(text_literal, texts))}), id + 1)"
    return values.selectExpr(
        f"{label([m.entity for m in metrics])} AS entity",
        f"{label([m.instance for m in metrics])} AS instance",
        f"{label([m.name for m in metrics])} AS name",
        "value",
    )


def analyze(df: DataFrame, metrics: Sequence[Metric | list[Metric]]) -> DataFrame:
    """Rows (entity, instance, name, value), one per metric."""
    flat = _flatten(metrics)
    return labelled(measure(df, flat), flat)
