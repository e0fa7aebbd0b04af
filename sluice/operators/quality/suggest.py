"""Constraint suggestions from profiles and histograms."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.operators.quality import analyzers as A
from sluice.operators.quality.profile import profile_columns, value_counts
from sluice.operators.ranks import running
from sluice.session import plain_unions, staged

# Defaults published with the method (Schelter et al., VLDB 2018, and its open-source code).
Z = 1.96
MIN_COMPLETENESS = 0.2
MAX_UNIQUE_CATEGORICAL = 0.1
MAX_UNIQUE_FRACTIONAL = 0.4
COVERAGE = 0.9
# Values that a suggestion writes out. It refers to a longer range as ``values(column, rule)``, whose rows
# ``suggested_values`` gives; which rules apply does not depend on it.
WRITTEN_OUT = 10_000

RULES = (
    "CompleteIfComplete",
    "RetainCompleteness",
    "RetainType",
    "CategoricalRange",
    "FractionalCategoricalRange",
    "NonNegativeNumbers",
)


def _bound(p: str, n: str) -> str:
    """SQL text: lower end of the confidence interval of a share, cut to two decimals, as text."""
    return f"format_number(floor(({p} - {Z} * sqrt({p} * (1 - {p}) / {n})) * 100) / 100, 2)"


def _rule(name: str, applies: str, constraint: str, code: str) -> str:
    """SQL text: the suggestion as a struct, or null where the rule does not apply."""
    return f"if({applies}, named_struct('rule', '{name}', 'constraint', {constraint}, 'code', {code}), NULL)"


def _expand(df: DataFrame, rules: Sequence[str]) -> DataFrame:
    """One row per column and rule that applies."""
    found = f"filter(array({', '.join(rules)}), r -> r IS NOT NULL)"
    return df.selectExpr("column", f"inline({found})").select("column", "rule", "constraint", "code")


def _profile_rules() -> dict[str, str]:
    name, low = "column", _bound("completeness", "rows")
    kind = "if(dataType = 'Integral', 'integer', lower(dataType))"
    return {
        "CompleteIfComplete": _rule(
            "CompleteIfComplete", "completeness = 1",
            f"format_string('\\'%s\\' is not null', {name})", f"format_string('.is_complete(\"%s\")', {name})",
        ),
        "RetainCompleteness": _rule(
            "RetainCompleteness", f"completeness > {MIN_COMPLETENESS} AND completeness < 1",
            f"format_string('completeness of \\'%s\\' is at least %s', {name}, {low})",
            f"format_string('.has_completeness(\"%s\", lambda x: x >= %s)', {name}, {low})",
        ),
        "RetainType": _rule(
            "RetainType", "isDataTypeInferred AND dataType IN ('Integral', 'Fractional', 'Boolean')",
            f"format_string('\\'%s\\' has type %s', {name}, dataType)",
            f"format_string('.has_data_type(\"%s\", \"%s\")', {name}, {kind})",
        ),
        "NonNegativeNumbers": _rule(
            "NonNegativeNumbers", "dataType IN ('Integral', 'Fractional') AND minimum >= 0",
            f"format_string('\\'%s\\' has no negative values', {name})",
            f"format_string('.is_non_negative(\"%s\")', {name})",
        ),
    }


def _category_rules() -> dict[str, str]:
    low = _bound("covered", "rows")

    def listed(rule: str, number: str, held: str, more: str, tail: str) -> tuple[str, str]:
        """Constraint and code; a range that is not written out is named."""
        constraint = f"format_string('\\'%s\\' has value range %s', column, coalesce({held}, concat('of ', {number}, ' values')))"
        code = f"format_string('.is_contained_in(\"%s\", %s%s)%s', column, coalesce(concat('[', {held}, ']'), concat('values(\"', column, '\", \"{rule}\")')), {tail}, if({held} IS NULL, concat('  # ', {number}, ' values'), ''))"
        return f"concat({constraint}, {more})", code

    return {
        "CategoricalRange": _rule(
            "CategoricalRange", f"once <= {MAX_UNIQUE_CATEGORICAL}",
            *listed("CategoricalRange", "all_number", "all_values", "''", "''"),
        ),
        "FractionalCategoricalRange": _rule(
            "FractionalCategoricalRange", f"once <= {MAX_UNIQUE_FRACTIONAL} AND covered < 1",
            *listed(
                "FractionalCategoricalRange", "top_number", "top_values",
                f"format_string(' for at least %s of the rows', {low})", f"format_string(', lambda x: x >= %s', {low})",
            ),
        ),
    }


# Values in order of frequency, quoted and joined; ``{}`` is the list of (rank, value) structs.
_LISTED = "array_join(transform(array_sort({}), s -> '\\'' || s.value || '\\''), ', ')"


def _ranked_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The values of text columns that mostly repeat, by falling frequency: rank, count, and whether they are needed to cover the column.

    Columns whose values are all numbers or all booleans are left out. Value counts, ranks and shares are
    exact for any number of values; no task ranks a whole column.
    """
    counts = staged(value_counts(df, columns), "values")
    there = f"value <> {A.text_literal(A.NULL_BIN)}"
    kind = f"if({there}, {A.value_class('value')}, NULL)"
    columns_ = counts.selectExpr("column_name", "n", f"{there} AS there", f"{kind} AS kind").groupBy("column_name").agg(
        F.expr("sum(n) AS rows"), F.expr("count_if(there AND n = 1) / nullif(count_if(there), 0) AS once"),
        F.expr("bool_or(kind = 'string') OR (bool_or(kind = 'boolean') AND bool_or(kind <> 'boolean')) AS is_text"),
    ).where(f"is_text AND once <= {max(MAX_UNIQUE_CATEGORICAL, MAX_UNIQUE_FRACTIONAL)}")
    chosen = counts.where(there).join(columns_.select("column_name", "rows", "once"), "column_name")
    ranked = running(chosen, [F.desc("n"), F.asc("value")], ["column_name"], "n")
    return ranked.selectExpr("column_name AS column", "value", "n", "rows", "once", "rank", f"before < rows * {COVERAGE} AS top")


def _categories(df: DataFrame, columns: Sequence[str], most: int) -> DataFrame:
    """Per text column whose values mostly repeat: share of values seen once, coverage, and value lists of up to ``most`` values."""
    pair = "named_struct('rank', rank, 'value', value)"
    return _ranked_values(df, columns).groupBy("column").agg(
        F.expr("max(once) AS once"), F.expr("max(rows) AS rows"), F.expr("sum(if(top, n, 0)) / max(rows) AS covered"),
        F.expr("count(1) AS all_number"), F.expr("count_if(top) AS top_number"),
        F.expr(f"collect_list(if(rank <= {most}, {pair}, NULL)) AS all_list"),
        F.expr(f"collect_list(if(rank <= {most} AND top, {pair}, NULL)) AS top_list"),
    ).selectExpr(
        "*", f"if(all_number <= {most}, {_LISTED.format('all_list')}, NULL) AS all_values",
        f"if(top_number <= {most}, {_LISTED.format('top_list')}, NULL) AS top_values",
    )


def suggested_values(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """The value ranges that ``suggest`` suggests, as rows (column, rule, rank, value, n), however many there are."""
    plain_unions(df.sparkSession)
    text = [c for c, t in df.dtypes if t == "string" and (columns is None or c in columns)]
    if not text:
        return df.sparkSession.createDataFrame([], "column string, rule string, rank bigint, value string, n bigint")
    ranked = _ranked_values(df, text)
    covered = ranked.groupBy("column").agg(F.expr("sum(if(top, n, 0)) < max(rows) AS short")).withColumnRenamed("column", "_column")
    rules = (
        f"filter(array(if(once <= {MAX_UNIQUE_CATEGORICAL}, 'CategoricalRange', NULL), "
        f"if(once <= {MAX_UNIQUE_FRACTIONAL} AND short AND top, 'FractionalCategoricalRange', NULL)), r -> r IS NOT NULL)"
    )
    return ranked.join(covered, F.col("column") == F.col("_column")).selectExpr(
        "column", f"explode({rules}) AS rule", "rank", "value", "n"
    )


def suggest(
    df: DataFrame, rules: Sequence[str] = RULES, columns: Sequence[str] | None = None, most_listed: int = WRITTEN_OUT
) -> DataFrame:
    """Rows (column, rule, constraint, code) for every rule that applies.

    The profile is computed once for all rules that read it, the value counts once for
    the other two; these are written to the shared folder while the plan is built. A range of
    more than ``most_listed`` values is not written out: its code calls ``values(column, rule)``,
    for which the rows of ``suggested_values`` are to be given.
    """
    plain_unions(df.sparkSession)
    parts: list[DataFrame] = []
    chosen = [r for name, r in _profile_rules().items() if name in rules]
    if chosen:
        parts.append(_expand(profile_columns(df, columns), chosen))
    chosen = [r for name, r in _category_rules().items() if name in rules]
    if chosen:
        text = [c for c, t in df.dtypes if t == "string" and (columns is None or c in columns)]
        if text:
            parts.append(_expand(_categories(df, text, most_listed), chosen))
    if not parts:
        return df.sparkSession.createDataFrame([], "column string, rule string, constraint string, code string")
    return reduce(lambda a, b: a.unionByName(b), parts)
