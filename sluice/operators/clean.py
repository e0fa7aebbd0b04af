"""Projections, filters and cleansing."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions import text
from sluice.sinks.upsert import latest
from sluice.types import RuleViolation, Split, is_blank, split_on


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename by mapping; other names get underscores for spaces."""
    return df.withColumnsRenamed({c: mapping.get(c, c.replace(" ", "_")) for c in df.columns})


def snake_spaces(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.replace(" ", "_") for c in df.columns])


def add_columns(df: DataFrame, values: Mapping[str, object], now: Column | None = None) -> DataFrame:
    """Add constants; the value ``current_timestamp`` becomes yyyyMMddHHmmss text."""
    stamp = F.date_format(F.current_timestamp() if now is None else now, "yyyyMMddHHmmss")
    is_now = lambda v: isinstance(v, str) and v.lower() == "current_timestamp"
    return df.withColumns({n: stamp if is_now(v) else F.lit(v) for n, v in values.items()})


def select_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*cols)


def first_columns(df: DataFrame, n: int | None = None) -> DataFrame:
    """The first ``n`` columns; all without ``n``."""
    return df.select(*[F.col(f"`{c}`") for c in df.columns[:n]])


def drop_duplicates(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] | str | None = None) -> DataFrame:
    """One row per key: any one, or the one with the largest ``order_by``."""
    return df.dropDuplicates(list(keys)) if order_by is None else latest(df, keys, order_by)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")


def assert_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    if not duplicate_keys(df, keys).isEmpty():
        raise RuleViolation(f"several rows share one value of {', '.join(keys)}")
    return df


def fill_blank(df: DataFrame) -> DataFrame:
    """Empty text for nulls, in text columns only."""
    return df.na.fill("")


def to_int(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.withColumns({c: text.to_int(F.col(c)) for c in cols if c})


def split_blank(df: DataFrame, cols: Sequence[str]) -> Split:
    """Reject a row once if any listed column is null or blank."""
    flag = F.lit(False)
    for c in cols:
        flag = flag | is_blank(c)
    return split_on(df, flag)


def truncate_values(df: DataFrame, n: int, cols: Sequence[str] | str = "*") -> DataFrame:
    """First ``n`` characters of the listed columns."""
    names = df.columns if cols == "*" else list(cols)
    return df.withColumns({c: F.substring(F.col(c).cast("string"), 1, n) for c in names})


def split_range(df: DataFrame, col: str, lo, hi) -> Split:
    """Keep values between ``lo`` and ``hi`` inclusive; nulls are rejected."""
    inside = F.coalesce(F.col(col).between(lo, hi), F.lit(False))
    return split_on(df, ~inside)


def set_schema(df: DataFrame, ddl: str) -> DataFrame:
    """Column i gets type and name i of the DDL; further columns are dropped."""
    fields = T.StructType.fromDDL(ddl).fields
    if len(fields) > len(df.columns):
        raise ValueError(f"schema has {len(fields)} columns, frame has {len(df.columns)}")
    return df.select(
        *[F.col(f"`{c}`").try_cast(f.dataType).alias(f.name) for c, f in zip(df.columns, fields)]
    )


def schema_differences(df: DataFrame, ddl: str) -> list[str]:
    """Expected columns that are missing or differ in type or nullability; extra columns are fine."""
    have = {f.name: f for f in df.schema}
    out = []
    for want in T.StructType.fromDDL(ddl):
        got = have.get(want.name)
        if got is None:
            out.append(f"column {want.name} was not found")
        elif (got.dataType, got.nullable) != (want.dataType, want.nullable):
            out.append(
                f"column {want.name} is {got.dataType.simpleString()} nullable={got.nullable}, "
                f"expected {want.dataType.simpleString()} nullable={want.nullable}"
            )
    return out


def assert_schema(df: DataFrame, ddl: str) -> DataFrame:
    problems = schema_differences(df, ddl)
    if problems:
        raise RuleViolation(problems[0])
    return df


def conform(df: DataFrame, ddl: str) -> Split:
    """Split rows by whether every expected column holds a value of its expected type.

    Bad rows keep their original columns. Good rows carry the expected types; extra
    columns pass through. A missing column raises.
    """
    fields = T.StructType.fromDDL(ddl).fields
    missing = [f.name for f in fields if f.name not in df.columns]
    if missing:
        raise RuleViolation(f"missing columns: {', '.join(missing)}")
    flag = F.lit(False)
    for f in fields:
        c = F.col(f.name)
        flag = flag | (c.isNotNull() & c.try_cast(f.dataType).isNull())
        if not f.nullable:
            flag = flag | c.isNull()
    good, bad = split_on(df, flag)
    return Split(good.withColumns({f.name: F.col(f.name).try_cast(f.dataType) for f in fields}), bad)


def ensure_columns(df: DataFrame, cols: Sequence[str], default: str = "") -> DataFrame:
    missing = {c: F.lit(default) for c in cols if c not in df.columns}
    return df.withColumns(missing) if missing else df


# Suffixes of the marker columns, in order of priority (fixed values).
CHANGE_MARKS = ("isadded", "isupdated", "isdeleted")


def change_flags(df: DataFrame, fixed: Sequence[str], dynamic: Sequence[str]) -> DataFrame:
    """Fixed columns, dynamic columns and a ``<name>_flag`` per dynamic column."""
    marks = [f"{c}_atr_{m}" for c in dynamic for m in CHANGE_MARKS]
    df = ensure_columns(df, [*fixed, *dynamic, *marks])
    flags = []
    for c in dynamic:
        flag = F.lit("None")
        for m in reversed(CHANGE_MARKS):
            flag = F.when(F.col(f"{c}_atr_{m}").cast("string") == "1", m).otherwise(flag)
        flags.append(flag.alias(f"{c}_flag"))
    return df.select(*fixed, *dynamic, *flags)


@dataclass
class CleanSpec:
    """Settings of the whole cleansing chain; an empty setting skips its step."""

    mapping: Mapping[str, str] = field(default_factory=dict)
    select: Sequence[str] = ()
    keys: Sequence[str] = ()
    order_by: Sequence[str] | str | None = None
    ints: Sequence[str] = ()
    max_columns: int | None = None
    not_blank: Sequence[str] = ()


def clean_all(df: DataFrame, spec: CleanSpec) -> Split:
    """Rename, select, dedup, cast, truncate, reject blanks, fill, in that order."""
    df = rename_columns(df, spec.mapping)
    if spec.select:
        df = select_columns(df, spec.select)
    if spec.keys:
        df = drop_duplicates(df, spec.keys, spec.order_by)
    df = first_columns(to_int(df, spec.ints), spec.max_columns)
    good, bad = split_blank(df, spec.not_blank)
    return Split(fill_blank(good), bad)
