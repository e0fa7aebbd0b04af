"""Point grids: binning, roll-up, neighbourhoods, compaction and radius joins.

Cells at resolution r are squares of 2**-r degrees, numbered by row and column. The
number of a cell is ``row * 2**32 + column``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.text import EARTH_RADIUS_KM, distance
from sluice.skew import spread_join

SHIFT = 32
MASK = (1 << SHIFT) - 1


def _row(cell: Column) -> Column:
    return F.shiftright(cell, SHIFT)


def _col(cell: Column) -> Column:
    return cell.bitwiseAND(F.lit(MASK))


def _cell(row: Column, col: Column) -> Column:
    return F.shiftleft(row.cast("long"), SHIFT) + col.cast("long")


def cell_of(lat: Column, lng: Column, res: int) -> Column:
    n = 1 << res
    row = F.least(F.floor((lat + 90) * n), F.lit(180 * n - 1))
    col = F.pmod(F.floor((lng + 180) * n), F.lit(360 * n))
    return _cell(row, col)


def parent_of(cell: Column, levels: int = 1) -> Column:
    return _cell(F.shiftright(_row(cell), levels), F.shiftright(_col(cell), levels))


def with_cell(df: DataFrame, lat: str, lng: str, res: int, name: str = "cell") -> DataFrame:
    return df.withColumn(name, cell_of(F.col(lat), F.col(lng), res))


def bin_points(df: DataFrame, lat: str, lng: str, res: int) -> DataFrame:
    """Rows (cell, n); counts are combined before the shuffle."""
    return df.groupBy(cell_of(F.col(lat), F.col(lng), res).alias("cell")).agg(F.count(F.lit(1)).alias("n"))


def roll_up(cells: DataFrame, levels: int = 1) -> DataFrame:
    """Rows (cell, n) of cells ``levels`` resolutions coarser."""
    return cells.groupBy(parent_of(F.col("cell"), levels).alias("cell")).agg(F.sum("n").alias("n"))


def ring(cell: Column, k: int, res: int) -> Column:
    """Cells at most ``k`` rows and columns away, itself included; columns wrap around the globe."""
    n = 1 << res
    offsets = F.array(
        *[
            F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"))
            for i in range(-k, k + 1)
            for j in range(-k, k + 1)
        ]
    )
    moved = F.transform(
        offsets,
        lambda o: F.struct(
            (_row(cell) + o["i"]).alias("row"), F.pmod(_col(cell) + o["j"], F.lit(360 * n)).alias("col")
        ),
    )
    inside = F.filter(moved, lambda m: (m["row"] >= 0) & (m["row"] < 180 * n))
    return F.array_distinct(F.transform(inside, lambda m: _cell(m["row"], m["col"])))


def ring_sum(cells: DataFrame, k: int, res: int) -> DataFrame:
    """Rows (cell, n, ring_n): per occupied cell the points in its neighbourhood.

    Every cell hands its count to its neighbours, one aggregate adds them up: there is
    no self-join, and the input has one row per cell already.
    """
    given = cells.select("cell", "n", F.explode(ring(F.col("cell"), k, res)).alias("to"))
    own = F.when(F.col("to") == F.col("cell"), F.col("n"))
    sums = given.groupBy(F.col("to").alias("cell")).agg(F.max(own).alias("n"), F.sum("n").alias("ring_n"))
    return sums.where(F.col("n").isNotNull())


def compact(cells: DataFrame, levels: int) -> DataFrame:
    """Replace complete sets of child cells by their parent, up to ``levels`` times.

    Rows (level, cell): level 0 is the input resolution. An ancestor is complete when
    all 4**level cells below it are present, so one aggregate over the ancestors of
    each cell finds them all at once; those whose own parent is complete are dropped.
    """
    chain = F.array(
        *[
            F.struct(F.lit(i).alias("level"), parent_of(F.col("cell"), i).alias("cell"))
            for i in range(levels + 1)
        ]
    )
    up = cells.select("cell").distinct().select(F.inline(chain))
    full = (
        up.groupBy("level", "cell")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") == F.expr("shiftleft(1L, level * 2)"))
        .select("level", "cell")
    )
    above = full.select((F.col("level") - 1).alias("level"), F.col("cell").alias("parent"))
    named = full.withColumn("parent", parent_of(F.col("cell"), 1))
    return named.join(above, ["level", "parent"], "left_anti").select("level", "cell")


def _locations(df: DataFrame, lat: str, lng: str, tag: str) -> DataFrame:
    return df.groupBy(F.col(lat).alias(f"lat_{tag}"), F.col(lng).alias(f"lng_{tag}")).agg(
        F.count(F.lit(1)).alias(f"n_{tag}")
    )


def within(
    a: DataFrame, b: DataFrame, radius_km: float, lat: str = "lat", lng: str = "lng"
) -> DataFrame:
    """Pairs of distinct locations at most ``radius_km`` apart, with the number of points at each.

    Rows (lat_a, lng_a, n_a, lat_b, lng_b, n_b, km). Points at one place are counted
    first, so copies never multiply. Latitude is cut into bands of the radius; each
    band has its own column width, wide enough that a partner lies at most one column
    away. Only cells that share a candidate meet in the equi-join.
    """
    angle = radius_km / EARTH_RADIUS_KM
    step = math.degrees(angle)
    bands = math.ceil(180 / step)

    def band(c: Column) -> Column:
        return F.least(F.floor((c + 90) / step), F.lit(bands - 1)).cast("int")

    def columns(row: Column) -> Column:
        """Number of columns of a band, from the widest reach at its latitude nearest a pole."""
        edge = F.greatest(F.abs(row * step - 90), F.abs((row + 1) * step - 90))
        reach = F.lit(math.sin(angle)) / F.cos(F.radians(F.least(edge, F.lit(90.0))))
        width = F.degrees(F.asin(F.least(reach, F.lit(1.0)))) * 1.000001
        return F.when(edge + step >= 90, 1).otherwise(F.greatest(F.lit(1), F.floor(360 / width))).cast("int")

    def column(value: Column, n: Column) -> Column:
        return F.pmod(F.floor((value + 180) * n / 360), n).cast("int")

    left = _locations(a, lat, lng, "a").withColumn("_band", band(F.col("lat_a")))
    left = left.withColumn("_col", column(F.col("lng_a"), columns(F.col("_band"))))
    right = _locations(b, lat, lng, "b")
    right = right.withColumn(
        "_band", F.explode(F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda d: band(F.col("lat_b")) + d))
    ).where((F.col("_band") >= 0) & (F.col("_band") < bands))
    right = right.withColumn("_n", columns(F.col("_band"))).withColumn(
        "_col",
        F.explode(
            F.array_distinct(
                F.transform(
                    F.array(F.lit(-1), F.lit(0), F.lit(1)),
                    lambda d: F.pmod(column(F.col("lng_b"), F.col("_n")) + d, F.col("_n")),
                )
            )
        ),
    ).drop("_n")
    pairs = spread_join(left, right, ["_band", "_col"], "inner")
    km = distance(F.col("lat_a"), F.col("lng_a"), F.col("lat_b"), F.col("lng_b"), "km")
    return (
        pairs.withColumn("km", km)
        .where(F.col("km") <= radius_km)
        .select("lat_a", "lng_a", "n_a", "lat_b", "lng_b", "n_b", "km")
    )
