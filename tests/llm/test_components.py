"""Connected components of graphs with hubs."""

import random

import pytest
from pyspark.sql import functions as F

from sluice.llm import components as c

SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
}


@pytest.fixture
def small_pieces(spark):
    old = {k: spark.conf.get(k) for k in SKEW}
    for k, v in SKEW.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def test_no_task_reads_over_a_fifth_of_a_hub(spark, small_pieces, monkeypatch):
    monkeypatch.setattr(c, "MANY_EDGES", 1)
    edges = spark.range(1, 60_001, 1, 30).select(F.col("id").alias("a"), F.lit(0).cast("long").alias("b"))
    star = c._large_star(edges, 60_000)
    sizes = star.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n"), F.max(F.hash("a", "b"))).collect()
    assert sum(r["n"] for r in sizes) == 60_000 and max(r["n"] for r in sizes) <= 12_000


@pytest.mark.parametrize("many", [1, 1 << 20])
def test_components(spark, monkeypatch, many):
    monkeypatch.setattr(c, "MANY_EDGES", many)
    rng = random.Random(many)
    edges = [(0, i) for i in range(1, 300)] + [(i, i + 1) for i in range(1000, 1040)] + [(rng.randrange(2000, 2300), rng.randrange(2000, 2300)) for _ in range(200)]
    edges += [(5, None), (None, 6), (7, 7), (1, 0)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None:
            low, high = sorted((root(a), root(b)))
            parent[high] = low
    got = {r.node: r.component for r in c.components(spark.createDataFrame(edges, "x int, y int")).collect()}
    assert got == {x: root(x) for x in parent if root(x) != x}
