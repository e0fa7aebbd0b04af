"""Row-level validation. Every operator keeps all rows and appends to the error array."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions import text
from sluice.functions.errors import ERRORS, add_error, with_errors
from sluice.session import plain_unions
from sluice.skew import spread_join
from sluice.types import is_blank

# Messages users of the data see (fixed values).
MANDATORY = "is mandatory"
MANDATORY_IF = "is mandatory for this plan type"
INVALID = "is invalid"
LOCKED = "lock date already passed for this Version and Value Type"
DUPLICATE = "This row has duplicate"
NO_AREA = "functional area cannot be derived"
NO_CENTRE = "Profit Centre cannot be derived"

# Years a date can have: the list of those in the data stays small.
CALENDAR = (0, 9999)


def require(df: DataFrame, cols: Sequence[str], errors: str = ERRORS) -> DataFrame:
    for c in cols:
        df = add_error(df, is_blank(c), f"{c} {MANDATORY}", errors)
    return with_errors(df, errors)


def require_if(
    df: DataFrame,
    rules: DataFrame,
    on: Sequence[str],
    candidates: Sequence[str],
    errors: str = ERRORS,
) -> DataFrame:
    """``rules`` names, per value of ``on``, the mandatory columns as a comma list.

    Several rule rows for one key are merged, so rows never multiply.
    """
    wanted = rules.select(
        *on, F.explode(F.transform(F.split("mandatory_columns", ","), F.trim)).alias("_c")
    ).where(F.col("_c").isin(list(candidates)))
    # One flag per candidate: the merged rule row has a fixed width.
    merged = wanted.groupBy(*on).agg(
        *[F.max(F.col("_c") == c).alias(f"_need_{i}") for i, c in enumerate(candidates)]
    )
    out = spread_join(df, merged, on)
    for i, c in enumerate(candidates):
        empty = F.col(c).isNull() | (F.col(c).cast("string") == "")
        out = add_error(out, F.col(f"_need_{i}") & empty, f"{c} {MANDATORY_IF}", errors)
    return out.drop(*[f"_need_{i}" for i in range(len(candidates))])


def lookup(
    df: DataFrame,
    field: str,
    ref: DataFrame,
    ref_col: str,
    errors: str = ERRORS,
    when: Column | None = None,
) -> DataFrame:
    """``<field> is invalid`` where a filled value is not among the reference values.

    Reference values that are all digits lose their leading zeros first. With ``when``
    only the rows it selects are checked.
    """
    known = (
        ref.select(text.strip_zeros(F.col(ref_col).cast("string")).alias("_k"))
        .distinct()
        .withColumn("_known", F.lit(True))
    )
    probe = df.withColumn("_f", F.col(field).cast("string"))
    out = spread_join(probe, known, [("_f", "_k")])
    failed = ~is_blank(field) & F.col("_known").isNull()
    if when is not None:
        failed = failed & when
    return add_error(out, failed, f"{field} {INVALID}", errors).drop("_f", "_known")


def conditional_lookup(
    df: DataFrame,
    field: str,
    ref: DataFrame,
    ref_col: str,
    conditional_column: str,
    value: str = "P",
    errors: str = ERRORS,
) -> DataFrame:
    return lookup(df, field, ref, ref_col, errors, when=F.col(conditional_column) == value)


def check_lock(
    df: DataFrame,
    calendar: DataFrame,
    keys: Sequence[str | tuple[str, str]],
    lock_col: str,
    today: Column,
    errors: str = ERRORS,
) -> DataFrame:
    """Flag rows whose combination of keys has a lock date before ``today``."""
    right = [k if isinstance(k, str) else k[1] for k in keys]
    is_text = dict(calendar.dtypes)[lock_col] == "string"
    day = F.try_to_date(F.col(lock_col), "yyyy-MM-dd") if is_text else F.col(lock_col)
    locks = calendar.groupBy(*right).agg(F.min(day).alias("_lock"))
    out = spread_join(df, locks, keys)
    return add_error(out, F.col("_lock") < today, LOCKED, errors).drop("_lock")


def flag_duplicates(df: DataFrame, keys: Sequence[str], errors: str = ERRORS) -> DataFrame:
    """Flag every row whose key occurs more than once; null keys form a key of their own.

    Counts are aggregated inside each task first and only repeated keys are joined
    back, so no task ever holds all rows of a key.
    """
    repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    out = spread_join(df, repeated, list(keys), null_safe=True)
    return add_error(out, F.col("_n").isNotNull(), DUPLICATE, errors).drop("_n")


def check_matches(
    df: DataFrame,
    ref: DataFrame,
    key: str,
    ref_key: str,
    attr: str,
    ref_attr: str,
    message: str,
    where: Column | None = None,
    prefix: str = "",
    errors: str = ERRORS,
) -> DataFrame:
    """Message where ``attr`` differs from the attribute of the referenced object.

    An object listed with several attributes fails if any of them differs, which for a
    given value is a question about the smallest and the largest one. Empty attributes
    never fail.
    """
    value = F.regexp_replace(F.col(ref_attr), prefix, "") if prefix else F.col(ref_attr)
    if prefix or dict(ref.dtypes)[ref_attr] == "string":
        value = F.nullif(value, F.lit(""))
    owners = ref.groupBy(ref_key).agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"))
    out = spread_join(df, owners, [(key, ref_key)])
    failed = (F.col(attr) != F.col("_lo")) | (F.col(attr) != F.col("_hi"))
    if where is not None:
        failed = failed & where
    return add_error(out, failed, message, errors).drop("_lo", "_hi")


def validity_periods(
    ref: DataFrame,
    key: str,
    valid_from: str,
    valid_to: str,
    value: Column,
    years: DataFrame,
) -> DataFrame:
    """Cut validity intervals into one row per key and year, as a short candidate list.

    ``years`` is the one-row frame of the distinct years that occur in the data: a
    reference row is repeated for those of them that it covers, never for other years.
    Within a year an interval is only its first and last period, where 0 stands for
    "began earlier" and 99 for "ends later". That leaves at most 13 x 13 different
    intervals per key and year, whatever the number of reference rows, and for each of
    them the value with the latest start wins. The list is in order of preference.
    """
    frm, to = text.year_month(F.col(valid_from)), text.year_month(F.col(valid_to))
    y1, y2 = F.floor(F.col("_f") / 100).cast("int"), F.floor(F.col("_t") / 100).cast("int")
    spans = (
        ref.select(
            F.col(key).alias("_key"),
            frm.alias("_f"),
            to.alias("_t"),
            value.alias("_v"),
            F.substring(F.col(valid_from), 1, 10).alias("_start"),
        )
        .where((F.coalesce(F.col("_v"), F.lit("")) != "") & (F.col("_f") <= F.col("_t")))
        .withColumn("_years", years.scalar())
        .withColumn("_year", F.explode(F.filter("_years", lambda y: (y >= y1) & (y <= y2))))
    )
    cut = spans.select(
        "_key",
        "_year",
        F.when(y1 < F.col("_year"), 0).otherwise(F.col("_f") % 100).alias("_cf"),
        F.when(y2 > F.col("_year"), 99).otherwise(F.col("_t") % 100).alias("_ct"),
        "_start",
        "_v",
    )
    best = cut.groupBy("_key", "_year", "_cf", "_ct").agg(F.max(F.struct("_start", "_v")).alias("b"))
    return best.groupBy("_key", "_year").agg(
        F.sort_array(
            F.collect_list(
                F.struct(F.col("b._start").alias("s"), F.col("b._v").alias("v"), F.col("_cf").alias("cf"),
                         F.col("_ct").alias("ct"))
            ),
            asc=False,
        ).alias("_periods")
    )


def effective_lookup(
    df: DataFrame,
    ref: DataFrame,
    key: str,
    ref_key: str,
    year: str,
    period_from: str,
    period_to: str,
    value: Column,
    out: str,
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
    years_of: DataFrame | None = None,
) -> DataFrame:
    """Add ``out``: the value of the reference row whose validity covers the row's periods.

    One equi-join on key and year against a side with one row per key and year: rows
    neither multiply nor vanish, and no pair outside the year is ever formed. Of
    several covering intervals the latest start wins. ``years_of`` is a frame with the
    same years that is cheaper to read than ``df``.
    """
    years = years_in(df if years_of is None else years_of, year)
    periods = validity_periods(ref, ref_key, valid_from, valid_to, value, years)
    joined = spread_join(df.withColumn("_year", _int(year)), periods, [(key, "_key"), ("_year", "_year")])
    found = _covering(F.col("_periods"), period_from, period_to)
    return joined.withColumn(out, found).drop("_year", "_periods")


def _int(column: str) -> Column:
    return text.to_int(F.col(column).cast("string"))


def years_in(df: DataFrame, year: str) -> DataFrame:
    """One row: the distinct calendar years of a column."""
    return df.select(_int(year).alias("_year")).agg(
        F.array_sort(F.collect_set(F.when(F.col("_year").between(*CALENDAR), F.col("_year")))).alias("years")
    )


def _covering(periods: Column, period_from: str, period_to: str) -> Column:
    """The value of the first of ``periods`` that covers the row's periods."""
    return F.get(F.filter(periods, lambda p: (p["cf"] <= _int(period_from)) & (p["ct"] >= _int(period_to))), F.lit(0))["v"]


@dataclass
class Rule:
    """One source of a derived value.

    ``when`` selects the rows the rule may fill. ``ref`` is looked up by ``key`` =
    ``ref_key`` and gives ``value``; with ``year`` the lookup is effective-dated by
    the given year and period columns.
    """

    when: Column
    ref: DataFrame
    key: str
    ref_key: str
    value: Column
    year: str | None = None
    period_from: str = "period_from"
    period_to: str = "period_to"
    order_by: str | None = None


def derive_cascade(
    df: DataFrame,
    rules: Sequence[Rule],
    out: str,
    message: str,
    errors: str = ERRORS,
    applies: Column | None = None,
) -> DataFrame:
    """Fill ``out``: the given value, else the first rule that yields one, else a message.

    Rows outside ``applies`` pass unchanged. The reference sides of all rules with one key
    column are unioned with the number of their rule and reduced to one row per key, so the
    input is joined once per key column and each of its rows comes out exactly once. The
    years of the data are taken once per year column.
    """
    applies = F.lit(True) if applies is None else F.coalesce(applies, F.lit(False))
    plain_unions(df.sparkSession)
    by_key: dict[str, list[int]] = {}
    for i, rule in enumerate(rules):
        by_key.setdefault(rule.key, []).append(i)
    years = {y: years_in(df, y) for y in {r.year for r in rules if r.year is not None}}
    res = df.withColumn("_applies", applies)
    values: dict[int, Column] = {}
    for key, numbers in by_key.items():
        sides, cells = None, []
        for i in numbers:
            rule = rules[i]
            side = _rule_side(rule, years.get(rule.year)).withColumn("_rule", F.lit(i))
            sides = side if sides is None else sides.unionByName(side, allowMissingColumns=True)
            own = F.col("_rule") == i
            if rule.year is None:
                cells.append(F.max(F.when(own, F.col("_v"))).alias(f"_v{i}"))
                values[i] = F.col(f"_v{i}")
            else:
                cells.append(F.map_from_entries(F.collect_list(F.when(own, F.struct("_year", "_periods")))).alias(f"_v{i}"))
                values[i] = _covering(F.try_element_at(F.col(f"_v{i}"), _int(rule.year)), rule.period_from, rule.period_to)
        res = spread_join(res, sides.groupBy("_key").agg(*cells), [(key, "_key")])
    found = [
        F.when(F.coalesce(rule.when, F.lit(False)), F.nullif(F.trim(values[i]), F.lit(""))) for i, rule in enumerate(rules)
    ]
    given = F.nullif(F.trim(F.col(out)), F.lit(""))
    res = res.withColumn("_found", F.coalesce(given, *found))
    res = add_error(res, F.col("_applies") & F.col("_found").isNull(), message, errors)
    res = res.withColumn(out, F.when(F.col("_applies"), F.col("_found")).otherwise(F.col(out)))
    return res.drop("_applies", "_found", *[f"_v{i}" for i in range(len(rules))])


def _rule_side(rule: Rule, years: DataFrame | None) -> DataFrame:
    """What a rule looks up: ``_key`` with ``_v``, or with ``_year`` and ``_periods``."""
    if rule.year is not None:
        return validity_periods(rule.ref, rule.ref_key, "valid_from", "valid_to", rule.value, years)
    value = F.nullif(F.trim(rule.value), F.lit(""))
    pick = F.max(value) if rule.order_by is None else F.max_by(value, F.col(rule.order_by))
    return rule.ref.where(value.isNotNull()).groupBy(F.col(rule.ref_key).alias("_key")).agg(pick.alias("_v"))


def route_columns(df: DataFrame, col: str, branches: Mapping[object, Mapping[str, Column]]) -> DataFrame:
    """Branches that only set columns: the values of a branch where ``col`` has its value, from one scan.

    A column that a branch does not set keeps its value there, or is null if it is new; so it is in rows that
    belong to no branch.
    """
    names = dict.fromkeys(name for columns in branches.values() for name in columns)
    out = {}
    for name in names:
        chosen = F.col(f"`{name}`") if name in df.columns else F.lit(None)
        for value, columns in branches.items():
            if name in columns:
                chosen = F.when(F.col(f"`{col}`") == F.lit(value), columns[name]).otherwise(chosen)
        out[name] = chosen
    return df.withColumns(out)


def route(
    df: DataFrame,
    col: str,
    branches: Mapping[str, Callable[[DataFrame], DataFrame]],
) -> DataFrame:
    """Rows with ``col`` = value go through that branch's function, all others (and nulls) pass.

    For branches with different plans, each of which scans the input; branches that only set columns go through
    ``route_columns``.
    """
    rest = ~F.col(col).isin(list(branches)) | F.col(col).isNull()
    plain_unions(df.sparkSession)
    out = df.where(rest)
    for value, fn in branches.items():
        out = out.unionByName(fn(df.where(F.col(col) == value)), allowMissingColumns=True)
    return out
