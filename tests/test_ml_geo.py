import math
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from sluice.operators import geo, ml


def test_label_table_is_dense_and_sorted(spark):
    df = spark.range(2000).select(F.when(F.col("id") % 50 != 0, F.concat(F.lit("v"), F.col("id").cast("string"))).alias("c"))
    table = {r["value"]: r["code"] for r in ml.label_table(df, "c").collect()}
    assert [v for v, _ in sorted(table.items(), key=lambda kv: kv[1])] == sorted(table)
    assert sorted(table.values()) == list(range(len(table)))
    assert ml.MISSING in table


def test_split_is_complete_and_repeatable(spark):
    df = spark.range(4000)
    weights = {"train": 0.7, "validation": 0.15, "test": 0.15}
    parts = {n: {r["id"] for r in p.collect()} for n, p in ml.split(df, "id", weights, 1).items()}
    assert sum(map(len, parts.values())) == 4000 == len(set().union(*parts.values()))
    assert len(parts["train"]) / 4000 == pytest.approx(0.7, abs=0.03)
    again = ml.split(df.repartition(7), "id", weights, 1)
    assert {r["id"] for r in again["test"].collect()} == parts["test"]


def test_impute_mean(spark):
    df = spark.createDataFrame([(1.0,), (None,), (3.0,)], "x double")
    assert rows(ml.impute_mean(df, ["x"])) == [(1.0,), (2.0,), (3.0,)]


@pytest.fixture(scope="module")
def points(spark):
    rng = random.Random(1)
    data = [(rng.gauss(y * 3, 1.0), rng.gauss(0, 1.0), float(y)) for y in (0, 1) for _ in range(150)]
    return spark.createDataFrame(data, "a double, b double, y double").cache()


def test_models_learn(points):
    logistic = ml.fit_logistic(points, ["a", "b"], "y", max_iter=30)
    assert ml.auc(logistic.transform(ml.assemble(points, ["a", "b"])), "y") > 0.95
    forest = ml.fit_forest(points, ["a", "b"], "y", n_estimators=5, seed=1)
    scored = ml.score(points, forest, ["a", "b"], ["y"])
    assert scored.columns == ["y", "prediction"]
    metrics = {r["metric"]: r["score"] for r in ml.class_metrics(scored, "y", "prediction").collect()}
    assert metrics["accuracy"] > 0.9 and metrics["f1"] > 0.9


def test_grid_samples_stay_in_range():
    class Estimator:
        def getParam(self, name):
            return name

    grid = ml.sample_grid(Estimator(), {"i": ("integer", 2, 4), "c": ("continuous", 0.1, 0.2), "k": ("categorical", "xy")}, 20, 5)
    assert len(grid) == 20
    assert all(2 <= g["i"] <= 4 and 0.1 <= g["c"] <= 0.2 and g["k"] in "xy" for g in grid)


def test_metrics_with_a_class_never_predicted(spark):
    df = spark.createDataFrame([("a", "a"), ("b", "a"), ("c", "c"), ("b", "c")], "y string, p string")
    got = {r["metric"]: r["score"] for r in ml.class_metrics(df, "y", "p").collect()}
    assert got["accuracy"] == 0.5
    assert got["precision"] == pytest.approx((0.5 + 0 + 0.5) / 3)
    assert got["recall"] == pytest.approx((1 + 0 + 1) / 3)
    assert rows(ml.one_vs_rest(df, "y", "p")) == [("a", 2, 1, 0, 1), ("b", 2, 0, 2, 0), ("c", 2, 1, 0, 1)]


def _km(a, b):
    p, q = math.radians(a[0]), math.radians(b[0])
    h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(b[1] - a[1]) / 2) ** 2
    return 2 * geo.EARTH_RADIUS_KM * math.asin(min(1.0, math.sqrt(h)))


@pytest.mark.parametrize("radius", [50.0, 700.0, 4000.0, 12000.0])
def test_radius_join_against_brute_force(spark, radius):
    """Random places, the poles, and both sides of the date line."""
    rng = random.Random(int(radius))
    near = [(89.9, 10.0), (89.8, -170.0), (-90.0, 0.0), (-89.99, 179.0), (0.0, 180.0), (0.1, -180.0), (0.1, 179.9), (45.0, -179.95)]
    a = near + [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(150)] + near[:2]
    b = near + [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(150)]
    out = geo.within(spark.createDataFrame(a, "lat double, lng double"), spark.createDataFrame(b, "lat double, lng double"), radius)
    got = {(r["lat_a"], r["lng_a"], r["lat_b"], r["lng_b"]): r["n_a"] * r["n_b"] for r in out.collect()}
    want = {(*p, *q): a.count(p) * b.count(q) for p in set(a) for q in set(b) if _km(p, q) <= radius - 1e-6}
    assert set(want) <= set(got)
    assert all(_km(k[:2], k[2:]) <= radius + 1e-6 for k in got)
    assert all(got[k] == n for k, n in want.items())


def test_compact_covers_the_same_cells(spark):
    cells = {(r, c) for r in range(16) for c in range(16)} | {(20, 20), (21, 21), (0, 16), (0, 17), (1, 16), (1, 17)}
    df = spark.createDataFrame([((r << 32) + c,) for r, c in cells] * 2, "cell long")
    got = geo.compact(df, 5).collect()
    covered = [
        ((x["cell"] >> 32) * 2 ** x["level"] + i, (x["cell"] & geo.MASK) * 2 ** x["level"] + j)
        for x in got for i in range(2 ** x["level"]) for j in range(2 ** x["level"])
    ]
    assert len(covered) == len(set(covered)) and set(covered) == cells
    assert sorted(x["level"] for x in got) == [0, 0, 1, 4]


def test_rings_wrap_and_stop_at_the_poles(spark):
    df = spark.createDataFrame([(89.5, 179.5), (89.5, -179.5), (88.5, 179.5), (0.0, 0.0)], "lat double, lng double")
    cells = geo.bin_points(df, "lat", "lng", 0)
    assert sorted(r["ring_n"] for r in geo.ring_sum(cells, 1, 0).collect()) == [1, 3, 3, 3]
    assert geo.roll_up(cells, 8).agg(F.sum("n")).first()[0] == 4
