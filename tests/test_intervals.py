"""Interval joins against all pairs, and values at points in time."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from sluice.operators import joins as j


def spans(rng, count, most):
    """Points, short and very long intervals, open ends, ends in the wrong order, hot and null keys."""
    rows = []
    for i in range(count):
        low = rng.randint(-most, most)
        high = low + rng.choice([0, 0, 1, 3, rng.randint(0, 50), rng.randint(0, most), -2])
        key = rng.choice(["hot"] * 5 + ["a", "b", None])
        rows.append((i, key, None if rng.random() < 0.05 else low, None if rng.random() < 0.05 else high))
    return rows


def pairs_of(a, b):
    return sorted(
        (i, k) for i, x, lo, hi in a for k, y, low, high in b
        if x is not None and x == y and None not in (lo, hi, low, high) and lo <= hi and low <= high and lo <= high and low <= hi
    )


@pytest.mark.parametrize("kind", ["bigint", "double", "timestamp", "timestamp_ntz", "date"])
def test_every_meeting_pair_once(spark, kind):
    rng = random.Random(kind)
    a, b = spans(rng, 150, 2000), spans(rng, 120, 2000)
    cast = {
        "timestamp": "timestamp_seconds({} * 3600)", "timestamp_ntz": "CAST(timestamp_seconds({} * 3600) AS timestamp_ntz)", "date": "date_add(DATE '2001-01-01', int({}))",
        "bigint": "{}", "double": "{} / 8D",
    }[kind]
    make = lambda rows: spark.createDataFrame(rows, "id int, k string, low long, high long").selectExpr(
        "id", "k", f"{cast.format('low')} AS low", f"{cast.format('high')} AS high")
    left, right = make(a), make(b).selectExpr("id AS other", "k AS _b_key", "low AS _blow", "high AS until")
    out = j.interval_join(left, right, [("k", "_b_key")], ("low", "high"), ("_blow", "until"))
    assert out.columns == ["id", "k", "low", "high", "other", "_blow", "until"]
    assert sorted((r.id, r.other) for r in out.collect()) == pairs_of(a, b)
    assert j.interval_join(left.limit(0), right, [("k", "_b_key")], ("low", "high"), ("_blow", "until")).count() == 0


def test_no_pair_outside_a_bin(spark):
    """Short intervals that never meet in a long table: the join forms few pairs, not all of a key."""
    points = spark.range(20_000).selectExpr("1 AS k", "id * 1000 AS t")
    short = spark.range(20_000).selectExpr("1 AS k", "id * 1000 + 400 AS low", "id * 1000 + 600 AS high", "id AS n")
    out = j.interval_join(points, short, ["k"], ("t", "t"), ("low", "high"))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan and out.count() == 0


def test_value_at_points(spark):
    day = lambda n: dt.date(2020, 1, 1) + dt.timedelta(n)
    rng = random.Random(3)
    ref = [(rng.choice(["a", "b", None]), day(s), day(s + rng.randint(0, 400)), f"v{i}") for i, s in enumerate(rng.choices(range(500), k=60))]
    ref += [("a", None, day(3), "open"), ("b", day(9), None, "open")]
    data = [(i, rng.choice(["a", "b", "c", None]), day(rng.randint(0, 900))) for i in range(300)] + [(300, "a", None), (0, "a", day(5)), (0, "a", day(5))]
    got = j.value_at(
        spark.createDataFrame(data, "id int, k string, at date"), spark.createDataFrame(ref, "k string, since date, until date, v string"),
        "k", "at", "k", "since", "until", "v", "found",
    )

    def best(k, at):
        held = [(s, v) for x, s, u, v in ref if k is not None and x == k and None not in (s, u, at) and s <= at <= u]
        return max(held)[1] if held else None

    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(repr((i, k, at, best(k, at))) for i, k, at in data)


def test_interval_join_keeps_a_hot_key_in_several_tasks(spark):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "20", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        points = spark.range(20_000).selectExpr("7 AS k", "id AS t")
        windows = spark.range(1000).selectExpr("7 AS k", "id * 20 AS low", "id * 20 + 30 AS high")
        out = j.interval_join(points, windows, ["k"], ("t", "t"), ("low", "high"))
        per = [r["n"] for r in out.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n"), F.max(F.hash("t", "low"))).collect()]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert sum(per) == sum(len([w for w in (t // 20, t // 20 - 1) if 0 <= w < 1000 and 20 * w <= t <= 20 * w + 30]) for t in range(20_000))
    assert max(per) <= sum(per) / 5
