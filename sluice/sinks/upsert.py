"""Keyed tables over plain Parquet: latest row per key, upsert, insert-only merge."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.session import plain_unions


def _holds_map(t: T.DataType) -> bool:
    if isinstance(t, T.StructType):
        return any(_holds_map(f.dataType) for f in t)
    return _holds_map(t.elementType) if isinstance(t, T.ArrayType) else isinstance(t, T.MapType)


def _row_hash(df: DataFrame) -> Column:
    """A hash of all columns; maps, which have no order, by their entries as sorted text."""
    parts = []
    for f in df.schema:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.MapType):
            c = F.to_json(F.array_sort(F.transform(F.map_entries(c), lambda e: F.to_json(e))))
        elif _holds_map(f.dataType):
            c = F.to_json(F.struct(c))
        parts.append(c)
    return F.xxhash64(*parts)


def _same_key(keys: Sequence[str], renamed: str) -> Column:
    """Key columns equal, null keys with each other; the other side's are prefixed."""
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(f"`{k}`").eqNullSafe(F.col(f"`{renamed}{k}`"))
    return cond


def _keys_of(df: DataFrame, keys: Sequence[str], prefix: str) -> DataFrame:
    return df.select(*[F.col(f"`{k}`").alias(prefix + k) for k in keys])


def _unseen(news: DataFrame, base: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``news`` whose key ``base`` does not have; the keys of both are met before rows are."""
    met = _keys_of(base, keys, "_b").join(news.select(*keys), _same_key(keys, "_b"), "left_semi")
    return news.join(met, _same_key(keys, "_b"), "left_anti")


def latest(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] | str) -> DataFrame:
    """The row with the largest ``order_by`` per key; ties fall to a hash of the row.

    Spark keeps only the best row per key inside each map task before the shuffle
    (WindowGroupLimit), so a very frequent key sends one row per task.
    """
    order = [order_by] if isinstance(order_by, str) else list(order_by)
    w = Window.partitionBy(*keys).orderBy(
        *[F.col(c).desc_nulls_last() for c in order], _row_hash(df).desc()
    )
    return df.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def upsert(
    base: DataFrame, delta: DataFrame, keys: Sequence[str], order_by: Sequence[str] | str
) -> DataFrame:
    """Merge ``delta`` into ``base`` (one row per key); the larger ``order_by`` wins.

    On equal ``order_by`` the delta wins; null keys are a key like any other. The delta is reduced to one row per key, so
    the base passes a single left join that replaces rows in place, and its keys a semi
    join that tells which delta rows are new. Spark runs both without shuffling the
    base when the measured size of the delta allows a broadcast.
    """
    plain_unions(base.sparkSession)
    keys, columns = list(keys), base.columns
    order = [order_by] if isinstance(order_by, str) else list(order_by)
    news = latest(delta, keys, order).select(*columns)
    renamed = news.select(*[F.col(f"`{k}`").alias(f"_n{k}") for k in keys], F.struct(*columns).alias("_new"))
    met = base.join(renamed, _same_key(keys, "_n"), "left")
    rank = lambda prefix: F.struct(*[F.col(prefix + c) for c in order])
    newer = F.col("_new").isNotNull() & ~(rank("") > rank("_new."))
    merged = met.select(
        *[F.col(c) if c in keys else F.when(newer, F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c) for c in columns]
    )
    return merged.unionByName(_unseen(news, base, keys))


def insert_new(
    base: DataFrame, delta: DataFrame, keys: Sequence[str], order_by: Sequence[str] | str | None = None
) -> DataFrame:
    """Append delta rows with unseen keys, one per key; existing rows stay as they are."""
    plain_unions(base.sparkSession)
    keys = list(keys)
    news = delta.dropDuplicates(keys) if order_by is None else latest(delta, keys, order_by)
    return base.unionByName(_unseen(news, base, keys).select(*base.columns))


def snapshot_and_history(
    history: DataFrame, keys: Sequence[str], order_by: Sequence[str] | str
) -> tuple[DataFrame, DataFrame]:
    """(current rows, all versions) over the same files."""
    return latest(history, keys, order_by), history
