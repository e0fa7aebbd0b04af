"""Equi-joins by column names, for sides that may hold very frequent keys.

A shuffled join sends all rows of one key to one partition. Spark's adaptive execution
measures the partitions after the shuffle and splits the large ones over several tasks,
at the borders of map outputs, so it copes with any number of frequent keys, on both
sides of an inner join and on the left side of the others. It also broadcasts a side
that turns out small. So nothing is sampled, salted or broadcast here; the join only
has to stay one that Spark can split: an equi-join with the many rows on the left.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def spread_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str | tuple[str, str]],
    how: str = "left",
    residual=None,
    null_safe: bool = False,
) -> DataFrame:
    """Join ``left`` with ``right``; ``how`` is inner, left, left_semi or left_anti.

    ``on`` lists column names or (left name, right name) pairs of equal type. The
    result has all left columns and, unless semi or anti, the right columns that are
    not keys. ``residual(right column getter)`` may add a non-equi condition.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type {how}")
    pairs = [(c, c) if isinstance(c, str) else tuple(c) for c in on]
    for lk, rk in pairs:
        lt, rt = left.schema[lk].dataType, right.schema[rk].dataType
        if lt != rt:
            raise TypeError(f"join key types differ: {lk} {lt.simpleString()}, {rk} {rt.simpleString()}")
    names = {c: f"_r{i}" for i, c in enumerate(right.columns)}
    r = right.select(*[F.col(f"`{c}`").alias(a) for c, a in names.items()])
    cond = None
    for lk, rk in pairs:
        a, b = F.col(f"`{lk}`"), F.col(names[rk])
        equal = a.eqNullSafe(b) if null_safe else a == b
        cond = equal if cond is None else cond & equal
    if residual is not None:
        cond = cond & residual(lambda c: F.col(names[c]))
    keys = {rk for _, rk in pairs}
    keep = [F.col(f"`{c}`") for c in left.columns]
    if how in ("inner", "left"):
        keep += [F.col(a).alias(c) for c, a in names.items() if c not in keys]
    return left.join(r, cond, how).select(*keep)
