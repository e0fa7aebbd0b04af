"""Joins with very frequent keys give the same rows as plain joins."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from sluice.operators import joins as j
from sluice.operators import validate as v
from sluice.skew import spread_join


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share key 7, a sixth have no key."""
    k = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 6 == 1, None).otherwise(F.col("id") % 40).cast("int")
    return spark.range(0, 3000, 1, 12).select("id", k.alias("k"))


@pytest.fixture(scope="module")
def right(spark):
    rows = [(i, f"v{i}") for i in range(0, 40, 2)] + [(7, "a"), (7, "b"), (None, "none")]
    return spark.createDataFrame(rows, "k int, v string")


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("null_safe", [False, True])
def test_equal_to_plain_join(skewed, right, how, null_safe):
    got = spread_join(skewed, right, ["k"], how, null_safe=null_safe)
    r = right.withColumnRenamed("k", "rk")
    cond = F.col("k").eqNullSafe(F.col("rk")) if null_safe else F.col("k") == F.col("rk")
    want = skewed.join(r, cond, how)
    want = want.drop("rk") if how in ("inner", "left") else want
    assert got.columns == want.columns
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect()))


# A third of the rows share key 7; the payload does not compress.
def hot():
    return F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k")


def noise():
    return F.md5(F.col("id").cast("string"))


SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
}


@pytest.fixture
def small_pieces(spark):
    """No broadcast, and partitions count as skewed from a few KB on."""
    old = {k: spark.conf.get(k) for k in SKEW}
    for k, v in SKEW.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def task_sizes(df, counted="true"):
    """(rows of the largest task, number of tasks with rows), of the rows that are counted"""
    read = F.max(F.hash(*df.columns))  # all columns are carried through the shuffle
    per_task = df.groupBy(F.spark_partition_id().alias("p")).agg(F.expr(f"count_if({counted})").alias("n"), read.alias("h")).where("n > 0 AND h IS NOT NULL")
    return per_task.agg(F.max("n"), F.count(F.lit(1))).first()



@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
def test_a_hot_key_is_split_over_tasks(spark, small_pieces, how):
    left = spark.range(0, 60_000, 1, 30).select(hot(), noise().alias("x"))
    right = spark.range(0, 60_000, 1, 4).select(F.col("id").alias("k"), noise().alias("y"))
    most, tasks = task_sizes(spread_join(left, right, ["k"], how), "k = 7")
    assert tasks >= 5 and most <= 20_000 / 3


def test_a_key_hot_on_both_sides_is_split(spark, small_pieces):
    left = spark.range(0, 30_000, 1, 20).select(hot(), noise().alias("x"))
    right = spark.range(0, 300, 1, 20).select(hot(), noise().alias("y"))
    out = spread_join(left, right, ["k"], "inner")
    most, tasks = task_sizes(out, "k = 7")
    assert tasks >= 3 and most < 10_000 * 100 / 2
    assert out.count() == left.join(right, "k").count()


def test_many_equally_frequent_keys_spread_by_themselves(spark, small_pieces):
    left = spark.range(0, 101_000, 1, 20).select((F.col("id") % 1010).alias("k"), F.col("id").alias("x"))
    right = spark.range(1010).select(F.col("id").alias("k"), F.col("id").alias("y"))
    most, tasks = task_sizes(spread_join(left, right, ["k"]))
    assert tasks >= 40 and most <= 3 * 101_000 / 40


def test_joins_add_nothing_to_a_plain_join(spark):
    part = spark.read.parquet("/root/testdata/sf0.01/part.parquet")
    lines = spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet")
    plan = j.left_outer(lines, part, [("l_partkey", "p_partkey")])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("FileScan") == 2 and "Aggregate" not in plan


def test_key_types_must_match(skewed, right):
    with pytest.raises(TypeError):
        spread_join(skewed, right.withColumn("k", F.col("k").cast("long")), ["k"])


def test_only_needed_columns_are_read(spark):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    customer = spark.read.parquet("/root/testdata/sf0.001/customer.parquet")
    out = j.inner(orders, customer, [("o_custkey", "c_custkey")]).select("o_orderkey", "c_name")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "o_totalprice" not in plan and "c_acctbal" not in plan


def test_semi_greater_matches_exists(spark, skewed):
    right = skewed.select("k", (F.col("id") % 100).alias("x"))
    left = skewed.withColumn("lim", F.col("id") % 120)
    got = {r["id"] for r in j.semi_greater(left, right, ["k"], "lim", "x").collect()}
    top = {r["k"]: r["m"] for r in right.groupBy("k").agg(F.max("x").alias("m")).collect()}
    want = {r["id"] for r in left.collect() if r["k"] is not None and top[r["k"]] > r["lim"]}
    assert got == want


def test_multiset_difference_with_many_copies(spark, monkeypatch):
    monkeypatch.setattr(j, "COPIES_PER_TASK", 10)
    left = spark.range(1000).select(F.when(F.col("id") < 700, 1).otherwise(F.col("id")).alias("a"), F.lit(None).cast("string").alias("b"))
    right = spark.range(333).select(F.lit(1).cast("long").alias("a"), F.lit(None).cast("string").alias("b"))
    got = Counter(map(tuple, j.multiset_difference(left, right).collect()))
    assert got == Counter(map(tuple, left.exceptAll(right).collect()))
    assert got[(1, None)] == 367


def test_set_difference(spark):
    left = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (3, "c")], "x int, y string")
    right = spark.createDataFrame([(2, None), (3, "d")], "x int, y string")
    assert Counter(map(tuple, j.set_difference(left, right).collect())) == Counter([(1, "a"), (3, "c")])


def test_duplicates_flagged_with_a_hot_null_key(spark, skewed):
    out = v.flag_duplicates(skewed, ["k"])
    assert out.count() == skewed.count()
    counts = Counter(r["k"] for r in skewed.collect())
    for r in out.collect():
        assert (r["errors"] == [v.DUPLICATE]) == (counts[r["k"]] > 1)


def test_empty_left_side_and_empty_tasks(spark, skewed, right):
    assert spread_join(skewed.where("id < 0"), right, ["k"], "left").count() == 0
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        one = skewed.where("id = 3")
        assert spread_join(one, right, ["k"], "left").count() == 2
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_left_outer_with_a_frequent_key_on_the_right(spark, skewed):
    left = spark.createDataFrame([(7, "seven"), (8, "eight"), (99, "none"), (None, "null"), (7, "again")], "c int, name string")
    got = j.left_outer(left, skewed, [("c", "k")], many="right")
    want = left.join(skewed, left["c"] == skewed["k"], "left").drop("k")
    assert sorted(got.columns) == sorted(want.columns)
    assert Counter(map(tuple, got.select(*want.columns).collect())) == Counter(map(tuple, want.collect()))
