"""Hashing, masking and reversible anonymisation, all as built-in expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# column -> (type, pattern or None); type is date, datetime, int, decimal or string
Spec = Mapping[str, tuple[str, str | None]]

# Substitution alphabet: character i of the first text becomes character i of the second (fixed values).
PLAIN = "abcdefghijklmnopqrstuvwxyz0123456789"
CIPHER = "nmlkjihgfedcbazyxwvutsrqpo8456123907"
# What masked dates and times show (fixed values).
MASK_DATE = "1900-01-01"
MASK_TIME = "1900-01-01 00:00:00"


def obfuscate(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """md5 hex digests."""
    return df.withColumns({c: F.md5(F.col(c).cast("string")) for c in cols})


def _integral(df: DataFrame, name: str) -> T.DataType:
    """The type of an integer column; long for one that holds integers as anything else."""
    kind = df.schema[name].dataType
    return kind if isinstance(kind, T.IntegralType) else T.LongType()


def _mask_int(c: Column, kind: T.DataType, seed: int) -> Column:
    """Other digits, as many, with the same sign; at most the largest number of the type."""
    number = c.try_cast("decimal(20,0)")
    low = F.rpad(F.lit("1"), F.length(F.abs(number).cast("string")), "0").cast("decimal(20,0)")
    digits = low + F.pmod(F.xxhash64(c, F.lit(seed)).cast("decimal(20,0)"), low * 9)
    bits = {"tinyint": 8, "smallint": 16, "int": 32}.get(kind.simpleString(), 64)
    most = F.least(digits, F.lit(2 ** (bits - 1) - 1).cast("decimal(20,0)"))
    return F.when(number < 0, -most).when(number >= 0, most).cast(kind)


def _plain_number(c: Column) -> Column:
    """Text of a number without an exponent, as short as it can be."""
    text = c.cast("string")
    exact = F.regexp_replace(c.try_cast("decimal(38,18)").cast("string"), r"(\.\d*?)0+$", "$1")
    exact = F.when(exact.endswith("."), F.concat(exact, F.lit("0"))).otherwise(exact)
    whole = F.concat(c.try_cast("decimal(38,0)").cast("string"), F.lit(".0"))
    return F.when(text.contains("E"), F.coalesce(exact, whole)).otherwise(text)


def mask(df: DataFrame, spec: Spec, seed: int = 0) -> DataFrame:
    """Hide values, keep their shape. Integers keep type, sign and number of digits, repeatably."""
    out = {}
    for name, (kind, pattern) in spec.items():
        c = F.col(name)
        text = c.cast("string")
        if kind == "date":
            day = F.lit(MASK_DATE).cast("date")
            out[name] = day if pattern is None else F.date_format(day, pattern)
        elif kind == "datetime":
            time = F.lit(MASK_TIME).cast("timestamp_ntz")
            out[name] = time if pattern is None else F.date_format(time, pattern)
        elif kind == "int":
            out[name] = _mask_int(c, _integral(df, name), seed)
        elif kind == "decimal":
            out[name] = F.regexp_replace(_plain_number(c), "[0-9a-zA-Z]", "1").try_cast("double")
        else:
            out[name] = F.regexp_replace(text, "[0-9a-zA-Z]", "x")
    return df.withColumns(out)


def substitute(c: Column) -> Column:
    """Swap letters and digits in pairs; a leading 0 of the result becomes 7."""
    return F.regexp_replace(F.translate(F.lower(c.cast("string")), PLAIN, CIPHER), "^0", "7")


def _shift(day: Column) -> Column:
    """Days to add to a date: year + month + day."""
    return F.year(day) + F.month(day) + F.dayofmonth(day)


def anonymize(df: DataFrame, spec: Spec) -> DataFrame:
    """Replace values by a fixed substitution; dates move by year + month + day days."""
    out = {}
    for name, (kind, pattern) in spec.items():
        c = F.col(name)
        if kind == "date":
            day = F.to_date(c) if pattern is None else F.try_to_date(c.cast("string"), pattern)
            moved = F.date_add(day, _shift(day))
            out[name] = moved if pattern is None else F.date_format(moved, pattern)
        elif kind == "datetime":
            time = (
                c.cast("timestamp_ntz")
                if pattern is None
                else F.try_to_timestamp(c.cast("string"), F.lit(pattern)).cast("timestamp_ntz")
            )
            moved = time + F.make_dt_interval(_shift(F.to_date(time)))
            out[name] = moved if pattern is None else F.date_format(moved, pattern)
        elif kind == "int":
            out[name] = substitute(c).try_cast(_integral(df, name))
        elif kind == "decimal":
            out[name] = substitute(_plain_number(c)).try_cast("double")
        else:
            out[name] = substitute(c)
    return df.withColumns(out)
