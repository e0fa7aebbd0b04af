"""Data-quality checks: named constraints over metrics, verified in one run."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.operators.quality import analyzers as A

Assertion = Callable[[Column], Column]

# Statuses and messages of result rows (fixed values).
SUCCESS, FAILURE = "Success", "Failure"
LEVELS = {"error": "Error", "warning": "Warning"}
MISSED = "does not meet the constraint requirement!"
NO_VALUE = "Empty state, all input values were null."
NO_NUMBER = "Empty state, column {} holds no numbers."


def assertion(op: str = "eq", value: float = 100, lower: float = 0, upper: float = 1) -> Assertion:
    """Assertion by name: eq, neq, gt, gte, lt, lte or between (inclusive)."""
    return {
        "eq": lambda x: x == value,
        "neq": lambda x: x != value,
        "gt": lambda x: x > value,
        "gte": lambda x: x >= value,
        "lt": lambda x: x < value,
        "lte": lambda x: x <= value,
        "between": lambda x: (x >= lower) & (x <= upper),
    }[op]


def is_one(x: Column) -> Column:
    return x == 1


@dataclass(frozen=True)
class Constraint:
    name: str
    metric: A.Metric
    holds: Assertion


class Check:
    """A named group of constraints with a level: ``error`` or ``warning``.

    Every method adds constraints and returns the check. An assertion is a function of
    the metric as a Column, for example ``lambda x: x >= 0.9``.
    """

    def __init__(self, level: str = "error", name: str = "check"):
        if level not in LEVELS:
            raise ValueError(f"invalid level {level}")
        self.level, self.name = level, name
        self.constraints: list[Constraint] = []

    def _add(self, label: str, metric: A.Metric, holds: Assertion) -> Check:
        self.constraints.append(Constraint(f"{label}({metric.instance})", metric, holds))
        return self

    def _share(self, label: str, condition: Column | str, holds: Assertion) -> Check:
        return self._add("Compliance", A.compliance(label, condition), holds)

    def has_size(self, holds: Assertion) -> Check:
        return self._add("Size", A.size(), holds)

    def is_complete(self, column: str) -> Check:
        return self.has_completeness(column, is_one)

    def has_completeness(self, column: str, holds: Assertion) -> Check:
        return self._add("Completeness", A.completeness(column), holds)

    def is_unique(self, column: str) -> Check:
        return self.has_uniqueness(column, is_one)

    def has_uniqueness(self, columns: str | Sequence[str], holds: Assertion) -> Check:
        return self._add("Uniqueness", A.uniqueness(columns), holds)

    def has_distinctness(self, columns: str | Sequence[str], holds: Assertion) -> Check:
        return self._add("Distinctness", A.distinctness(columns), holds)

    def has_unique_value_ratio(self, columns: str | Sequence[str], holds: Assertion) -> Check:
        return self._add("UniqueValueRatio", A.unique_value_ratio(columns), holds)

    def has_number_of_distinct_values(self, column: str, holds: Assertion) -> Check:
        return self._add("HistogramBins", A.number_of_bins(column), holds)

    def has_histogram_value(self, column: str, value: str, holds: Assertion, what: str = "ratio") -> Check:
        """Assert on the count (``abs``) or ``ratio`` of one value of the histogram."""
        metric = A.bin_value(column, value, what)
        self.constraints.append(Constraint(f"Histogram({column},{value},{what})", metric, holds))
        return self

    def has_entropy(self, column: str, holds: Assertion) -> Check:
        return self._add("Entropy", A.entropy(column), holds)

    def has_mutual_information(self, a: str, b: str, holds: Assertion) -> Check:
        return self._add("MutualInformation", A.mutual_information(a, b), holds)

    def has_approx_quantile(self, column: str, q: float, holds: Assertion) -> Check:
        return self._add(f"ApproxQuantile-{q}", A.approx_quantile(column, q), holds)

    def has_min_length(self, column: str, holds: Assertion) -> Check:
        return self._add("MinLength", A.min_length(column), holds)

    def has_max_length(self, column: str, holds: Assertion) -> Check:
        return self._add("MaxLength", A.max_length(column), holds)

    def has_min(self, column: str, holds: Assertion) -> Check:
        return self._add("Minimum", A.minimum(column), holds)

    def has_max(self, column: str, holds: Assertion) -> Check:
        return self._add("Maximum", A.maximum(column), holds)

    def has_mean(self, column: str, holds: Assertion) -> Check:
        return self._add("Mean", A.mean(column), holds)

    def has_sum(self, column: str, holds: Assertion) -> Check:
        return self._add("Sum", A.total(column), holds)

    def has_standard_deviation(self, column: str, holds: Assertion) -> Check:
        return self._add("StandardDeviation", A.standard_deviation(column), holds)

    def has_approx_count_distinct(self, column: str, holds: Assertion) -> Check:
        return self._add("ApproxCountDistinct", A.approx_count_distinct(column), holds)

    def has_correlation(self, a: str, b: str, holds: Assertion) -> Check:
        return self._add("Correlation", A.correlation(a, b), holds)

    def satisfies(self, predicate: str, name: str, holds: Assertion = is_one) -> Check:
        return self._share(name, predicate, holds)

    def has_pattern(self, column: str, pattern: str, holds: Assertion = is_one) -> Check:
        return self._share(f"{column} like {pattern}", F.col(column).cast("string").rlike(pattern), holds)

    def has_data_type(self, column: str, kind: str, holds: Assertion = is_one) -> Check:
        """``kind``: null, boolean, string, numeric, fractional or integer."""
        classes = {
            "null": ("null",),
            "boolean": ("boolean",),
            "string": ("string",),
            "numeric": ("fractional", "integral"),
            "fractional": ("fractional",),
            "integer": ("integral",),
        }[kind]
        return self._add(f"DataType.{kind}", A.type_share(column, classes, kind != "null"), holds)

    def is_positive(self, column: str, holds: Assertion = is_one) -> Check:
        return self._share(f"{column} > 0", f"coalesce({A.quote(column)}, 1) > 0", holds)

    def is_non_negative(self, column: str, holds: Assertion = is_one) -> Check:
        return self._share(f"{column} >= 0", f"coalesce({A.quote(column)}, 0) >= 0", holds)

    def is_less_than(self, a: str, b: str, holds: Assertion = is_one) -> Check:
        return self._share(f"{a} < {b}", f"{A.quote(a)} < {A.quote(b)}", holds)

    def is_less_than_or_equal_to(self, a: str, b: str, holds: Assertion = is_one) -> Check:
        return self._share(f"{a} <= {b}", f"{A.quote(a)} <= {A.quote(b)}", holds)

    def is_greater_than(self, a: str, b: str, holds: Assertion = is_one) -> Check:
        return self._share(f"{a} > {b}", f"{A.quote(a)} > {A.quote(b)}", holds)

    def is_greater_than_or_equal_to(self, a: str, b: str, holds: Assertion = is_one) -> Check:
        return self._share(f"{a} >= {b}", f"{A.quote(a)} >= {A.quote(b)}", holds)

    def is_contained_in(self, column: str, values: Sequence | DataFrame, holds: Assertion = is_one) -> Check:
        """Values or null; a frame (its first column) for more values than an expression should hold."""
        c = F.col(column)
        if isinstance(values, DataFrame):
            return self._add("Compliance", A.contained(column, values, f"{column} in {values.columns[0]}"), holds)
        label = f"{column} in {','.join(map(str, values))}"
        return self._share(label, c.isNull() | c.isin(list(values)), holds)

    def is_in_interval(
        self, column: str, lower: float, upper: float, include_lower: bool = True, include_upper: bool = True,
        holds: Assertion = is_one,
    ) -> Check:
        c = F.col(column)
        low = c >= lower if include_lower else c > lower
        high = c <= upper if include_upper else c < upper
        left, right = "[" if include_lower else "(", "]" if include_upper else ")"
        return self._share(f"{column} in {left}{lower};{upper}{right}", c.isNull() | (low & high), holds)

    def all_between(
        self, columns: Sequence[str], lower: float = 0, upper: float = 1, null_value: str = "keep",
        holds: Assertion = is_one,
    ) -> Check:
        """Nulls fail with ``keep`` and pass with ``discard``."""
        for name in columns:
            c = F.col(name)
            cond = c.between(lower, upper)
            if null_value == "discard":
                cond = c.isNull() | cond
            self._share(f"Is between {name}:{lower}-{upper}", cond, holds)
        return self

    def have_completeness(self, columns: Sequence[str], holds: Assertion = is_one) -> Check:
        for c in columns:
            self.has_completeness(c, holds)
        return self

    def all_positives(self, columns: Sequence[str], holds: Assertion = is_one) -> Check:
        for c in columns:
            self.is_positive(c, holds)
        return self

    def all_non_negatives(self, columns: Sequence[str], holds: Assertion = is_one) -> Check:
        for c in columns:
            self.is_non_negative(c, holds)
        return self


def _no_value(metric: A.Metric, numbers: set[str]) -> str:
    """Why a metric may have no value."""
    other = [c for c in metric.columns if c not in numbers]
    if metric.name.split("-")[0] in A.NUMERIC and other:
        return NO_NUMBER.format(other[0])
    return NO_VALUE


def verify(df: DataFrame, checks: Sequence[Check], timestamp: Column | None = None) -> DataFrame:
    """Result rows, one per constraint.

    Equal metrics are computed once. The frames after the measurement have at most one
    row per constraint, so the window that gives the status of a check is tiny.
    """
    listed = [(c, k) for c in checks for k in c.constraints]
    numbers = {c for c, kind in df.dtypes if kind.split("(")[0] in A.NUMBER_TYPES}
    metrics: list[A.Metric] = []
    position: dict[tuple, int] = {}
    use = []
    for _, k in listed:
        # Equal names do not make equal metrics: what is computed has to be the same.
        own = k.metric.scalar if isinstance(k.metric.scalar, str) else id(k.metric.scalar)
        key = (k.metric.name, k.metric.columns, own, k.metric.grouped, k.metric.name.startswith("Compliance.") and id(k.metric.frame))
        if key not in position:
            position[key] = len(metrics)
            metrics.append(k.metric)
        use.append(position[key])
    values = A.measure(df, metrics)
    text = A.text_literal
    # Per metric, the constraints that use it.
    users = [
        "array("
        + ", ".join(
            f"named_struct('nr', {i}, 'check_nr', {checks.index(c)}, 'check', {text(c.name)}, "
            f"'check_level', '{LEVELS[c.level]}', 'constraint', {text(k.name)}, 'no_value', {text(_no_value(k.metric, numbers))})"
            for i, (c, k) in enumerate(listed)
            if use[i] == m
        )
        + ")"
        for m in range(len(metrics))
    ]
    value, holds = F.col("value"), None
    for i, (_, k) in enumerate(listed):
        mine = F.expr(f"nr = {i}")
        holds = F.when(mine, k.holds(value)) if holds is None else holds.when(mine, k.holds(value))
    rows = values.selectExpr("value", f"inline(element_at(array({', '.join(users)}), id + 1))")
    rows = rows.withColumn("ok", F.coalesce(holds, F.lit(False)))
    out = rows.selectExpr(
        "`check`",
        "check_level",
        f"if(bool_and(ok) OVER (PARTITION BY check_nr), '{SUCCESS}', check_level) AS check_status",
        "`constraint`",
        f"if(ok, '{SUCCESS}', '{FAILURE}') AS constraint_status",
        f"CASE WHEN value IS NULL THEN no_value WHEN NOT ok THEN 'Value: ' || value || ' {MISSED}' ELSE '' END "
        "AS constraint_message",
        "value",
    )
    return out if timestamp is None else out.withColumn("timestamp", timestamp)
