"""Join and set-operation forms the other operators are built from."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.session import plain_unions
from sluice.skew import spread_join

On = Sequence[str | tuple[str, str]]


def inner(left: DataFrame, right: DataFrame, on: On) -> DataFrame:
    return spread_join(left, right, on, "inner")


def left_outer(left: DataFrame, right: DataFrame, on: On, many: str = "left") -> DataFrame:
    """Left join. ``many`` names the side that may hold very frequent keys.

    An outer join cannot spread the rows of its right side. With ``many="right"`` the
    matches come from an inner join that starts at the right side, and the left rows
    without a match are added.
    """
    if many == "left":
        return spread_join(left, right, on, "left")
    plain_unions(left.sparkSession)
    pairs = [(c, c) if isinstance(c, str) else c for c in on]
    lkeys, rkeys = [p[0] for p in pairs], [p[1] for p in pairs]
    others = [c for c in right.columns if c not in rkeys]
    keyed = left.withColumns({f"_k{i}": F.col(k) for i, k in enumerate(lkeys)})
    matched = spread_join(right, keyed, [(r, f"_k{i}") for i, r in enumerate(rkeys)], "inner")
    single = anti(left, right, on)
    return matched.select(*left.columns, *others).unionByName(single, allowMissingColumns=True)


def semi(left: DataFrame, right: DataFrame, on: On) -> DataFrame:
    """Left rows with a partner; the right side is reduced to its keys first."""
    keys = [c if isinstance(c, str) else c[1] for c in on]
    return spread_join(left, right.select(*keys).distinct(), on, "left_semi")


def anti(left: DataFrame, right: DataFrame, on: On) -> DataFrame:
    keys = [c if isinstance(c, str) else c[1] for c in on]
    return spread_join(left, right.select(*keys).distinct(), on, "left_anti")


def semi_greater(left: DataFrame, right: DataFrame, on: On, left_col: str, right_col: str) -> DataFrame:
    """Left rows with a partner of the same key whose ``right_col`` exceeds ``left_col``.

    Such a partner exists exactly when the largest one exceeds it, so the right side
    is one pre-aggregated row per key.
    """
    keys = [c if isinstance(c, str) else c[1] for c in on]
    top = right.groupBy(*keys).agg(F.max(right_col).alias("_top"))
    return spread_join(left, top, on, "left_semi", residual=lambda r: r("_top") > F.col(left_col))


def semi_differs(left: DataFrame, right: DataFrame, on: On, left_col: str, right_col: str) -> DataFrame:
    """Left rows with a partner of the same key whose ``right_col`` differs from ``left_col``."""
    keys = [c if isinstance(c, str) else c[1] for c in on]
    ends = right.groupBy(*keys).agg(F.min(right_col).alias("_lo"), F.max(right_col).alias("_hi"))
    return spread_join(
        left, ends, on, "left_semi",
        residual=lambda r: (r("_lo") != F.col(left_col)) | (r("_hi") != F.col(left_col)),
    )


def join_distinct(left: DataFrame, right: DataFrame, on: On, cols: Sequence[str] = ()) -> DataFrame:
    """Left join to the distinct rows of a projection of the right side."""
    keys = [c if isinstance(c, str) else c[1] for c in on]
    return spread_join(left, right.select(*keys, *cols).distinct(), on, "left")


def union_by_name(*frames: DataFrame, fill_missing: bool = False) -> DataFrame:
    out = frames[0]
    plain_unions(out.sparkSession)
    for df in frames[1:]:
        out = out.unionByName(df, allowMissingColumns=fill_missing)
    return out


def _place(df: DataFrame, column: str):
    """SQL text: a point in time or a number as a whole or fractional number."""
    c = "`" + column.replace("`", "``") + "`"
    kind = dict(df.dtypes)[column]
    if kind.startswith("timestamp"):
        return f"unix_micros(CAST({c} AS timestamp))"
    return f"bigint(unix_date({c}))" if kind == "date" else f"double({c})"


def interval_join(left: DataFrame, right: DataFrame, on: On, left_ends: tuple[str, str], right_ends: tuple[str, str]) -> DataFrame:
    """Pairs of rows with equal keys whose intervals meet, both ends included; a point is an interval with equal ends.

    Time is cut into bins, on several levels: an interval belongs to the level whose bins are the next power of
    two above its length, so it reaches into two of them at most. Two intervals meet in the bins of the longer
    one's level; each row goes to the bins of its own level and of the higher ones that occur. So whatever the
    lengths, a row is repeated twice per level at most, and no pair outside a bin is formed: it is an equi-join on
    key, level and bin. A pair that shares two bins counts in the later beginning one. Null ends and ends in the
    wrong order meet nothing. The result has all left columns and the right ones that are not keys.
    """
    pairs = [(c, c) if isinstance(c, str) else tuple(c) for c in on]
    taken = {c.lower() for c in (*left.columns, *right.columns)}
    mark = "_b"
    while any(c.startswith(mark) for c in taken):
        mark += "_"

    def placed(df: DataFrame, ends: tuple[str, str]) -> DataFrame:
        low, high = (_place(df, c) for c in ends)
        sized = df.selectExpr("*", f"{low} AS {mark}low", f"{high} AS {mark}high").where(f"{mark}low <= {mark}high")
        return sized.selectExpr("*", f"int(greatest(0, ceil(log2({mark}high - {mark}low + 1)))) AS {mark}own")

    a, b = placed(left, left_ends), placed(right, right_ends)
    # 64 levels at most; both sides need to know those of the other.
    levels = a.select(f"{mark}own").union(b.select(f"{mark}own")).agg(F.array_sort(F.collect_set(f"{mark}own")).alias("l"))

    def binned(df: DataFrame) -> DataFrame:
        leveled = df.withColumn(f"{mark}levels", levels.scalar())
        leveled = leveled.withColumn(f"{mark}level", F.explode(F.filter(f"{mark}levels", lambda level: level >= F.col(f"{mark}own"))))
        first, last = (f"bigint(floor({mark}{end} / pow(2D, {mark}level)))" for end in ("low", "high"))
        return leveled.selectExpr("*", f"{first} AS {mark}first", f"explode(sequence({first}, {last})) AS {mark}bin")

    others = {c: f"{mark}r{i}" for i, c in enumerate(right.columns)}
    b = binned(b).select(
        *[F.col(f"`{c}`").alias(n) for c, n in others.items()], *[F.col(f"{mark}{c}").alias(f"{mark}other_{c}") for c in ("low", "high", "own", "level", "first", "bin")]
    )
    same = (F.col(f"{mark}level") == F.col(f"{mark}other_level")) & (F.col(f"{mark}bin") == F.col(f"{mark}other_bin"))
    for lk, rk in pairs:
        same = same & (F.col(f"`{lk}`") == F.col(others[rk]))
    met = (F.col(f"{mark}low") <= F.col(f"{mark}other_high")) & (F.col(f"{mark}other_low") <= F.col(f"{mark}high"))
    once = (F.col(f"{mark}level") == F.greatest(f"{mark}own", f"{mark}other_own")) & (F.col(f"{mark}bin") == F.greatest(f"{mark}first", f"{mark}other_first"))
    keys = {rk for _, rk in pairs}
    return binned(a).join(b, same & met & once).select(
        *[F.col(f"`{c}`") for c in left.columns], *[F.col(n).alias(c) for c, n in others.items() if c not in keys]
    )


def value_at(
    df: DataFrame, ref: DataFrame, key: str, at: str, ref_key: str, valid_from: str, valid_to: str, value: str, out: str
) -> DataFrame:
    """Add ``out``: the value that is valid at a point in time or a number, null without one; of several the latest start wins, then the largest value.

    Each different key and point is looked up once, by ``interval_join``, so rows neither multiply nor vanish.
    """
    points = df.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{at}`").alias("_at")).distinct()
    spans = ref.select(
        F.col(f"`{ref_key}`").alias("_rkey"), F.col(f"`{valid_from}`").alias("_from"), F.col(f"`{valid_to}`").alias("_to"), F.col(f"`{value}`").alias("_value")
    )
    met = interval_join(points, spans, [("_key", "_rkey")], ("_at", "_at"), ("_from", "_to"))
    best = met.groupBy("_key", "_at").agg(F.max(F.struct("_from", "_value")).alias("_best"))
    return spread_join(df, best.select("_key", "_at", F.col("_best._value").alias(out)), [(key, "_key"), (at, "_at")])


# Copies of one row that a single task writes out.
COPIES_PER_TASK = 100_000


def multiset_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """EXCEPT ALL: every left row minus as many copies as the right side holds.

    Copies are counted, not carried, through the shuffle. Rows with very many copies
    left are written out by several tasks.
    """
    plain_unions(left.sparkSession)
    cols = left.columns
    signed = left.withColumn("_n", F.lit(1)).union(right.select(*cols).withColumn("_n", F.lit(-1)))
    rest = signed.groupBy(*cols).agg(F.sum("_n").alias("_n")).where("_n > 0")

    def copies(df: DataFrame) -> DataFrame:
        return df.withColumn("_i", F.explode(F.sequence(F.lit(1).cast("long"), "_n"))).select(*cols)

    few = copies(rest.where(F.col("_n") <= COPIES_PER_TASK))
    shares = rest.where(F.col("_n") > COPIES_PER_TASK).withColumn(
        "_part", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_n") - 1) / COPIES_PER_TASK)))
    )
    shares = shares.withColumn(
        "_n", F.least(F.lit(COPIES_PER_TASK).cast("long"), F.col("_n") - F.col("_part") * COPIES_PER_TASK)
    )
    return few.unionByName(copies(shares.repartition("_part", *cols)))


def set_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """EXCEPT: both sides are made distinct before they meet."""
    return left.distinct().subtract(right.select(*left.columns).distinct())
