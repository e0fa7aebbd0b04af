"""Metric states of batches against metrics of the union; folders, audits and branches."""

import pytest
from conftest import CRATES
from pyspark.sql import functions as F

from sluice.operators import validate as v
from sluice.operators.quality import analyzers as a
from sluice.operators.quality.states import MetricStore
from sluice.sinks import tables as k
from sluice.sources import files as s
from sluice.types import Quarantined

TYPES = "crate string, weight double, place string, sealed string, price double"
METRICS = [
    a.size(), a.completeness("weight"), a.compliance("heavy", "weight > 5"), a.maximum("weight"), a.minimum("price"), a.mean("weight"),
    a.total("price"), a.standard_deviation("weight"), a.correlation("weight", "price"), a.data_type("sealed"), a.max_length("place"), a.min_length("sealed"),
    a.type_share("sealed", ["boolean"]), a.count_distinct(["crate", "place"]), a.distinctness("crate"), a.uniqueness(["crate", "weight"]),
    a.unique_value_ratio("weight"), a.entropy("place"), a.entropy("place", 2), a.number_of_bins("sealed"), a.bin_value("sealed", "true"),
    a.bin_value("sealed", "NullValue", "abs"), a.mutual_information("place", "sealed"), a.mutual_information("sealed", "place"), a.bin_value("place", "_n"),
]


def values(df):
    return {(r.entity, r.instance, r.name): r.value for r in df.collect()}


def near(x, y):
    return x == y if x is None or y is None else x == pytest.approx(y, rel=1e-9, abs=1e-12)


@pytest.mark.parametrize("cuts", [(0, 10), (0, 3, 3, 7, 10), tuple(range(11)), (0, 0)])
def test_states_of_batches_are_those_of_the_union(spark, tmp_path, cuts):
    store = MetricStore(spark, str(tmp_path / "m"), METRICS)
    for batch, (low, high) in enumerate(zip(cuts, cuts[1:])):
        store.add(spark.createDataFrame(CRATES[low:high], TYPES), batch)
        store.add(spark.createDataFrame(CRATES[low:high], TYPES), batch)  # a repeated batch replaces itself
    want = values(a.analyze(spark.createDataFrame(CRATES[: cuts[-1]], TYPES), METRICS))
    got = values(store.read())
    assert got.keys() == want.keys()
    assert {key: (got[key], want[key]) for key in want if not near(got[key], want[key])} == {}
    if len(cuts) > 3:
        store.fold([0, 1], 100)
        merged = values(store.read([100, *range(2, len(cuts) - 1)]))
        assert all(near(merged[key], want[key]) for key in want)
        some = values(a.analyze(spark.createDataFrame(CRATES[: cuts[1]], TYPES), METRICS))
        assert all(near(x, some[key]) for key, x in values(store.read([0])).items())


def test_sketches_merge(spark, tmp_path):
    metrics = [a.approx_count_distinct("x"), a.approx_quantile("x", 0.5), a.approx_quantile("x", 0.9)]
    store = MetricStore(spark, str(tmp_path / "m"), metrics)
    df = spark.range(30_000).selectExpr("id % 10000 AS x")
    for batch in range(3):
        store.add(df.where(F.col("x") % 3 == batch), batch)
    got = values(store.read())
    assert got["Column", "x", "ApproxCountDistinct"] == pytest.approx(10_000, rel=0.05)
    assert got["Column", "x", "ApproxQuantile-0.5"] == pytest.approx(5000, abs=300) and got["Column", "x", "ApproxQuantile-0.9"] == pytest.approx(9000, abs=300)


def test_metrics_without_a_state_are_refused(spark, tmp_path):
    with pytest.raises(ValueError):
        MetricStore(spark, str(tmp_path / "m"), [a.compliance("heavy", F.col("weight") > 5)])


def test_many_columns_go_in_several_passes(spark, monkeypatch):
    monkeypatch.setattr(a, "MOST_GROUPED", 2)
    df = spark.createDataFrame(CRATES, TYPES)
    frequency = [m for m in a._flatten(METRICS) if m.grouped is not None]
    got = values(a.analyze(df, frequency))
    monkeypatch.undo()
    assert got == pytest.approx(values(a.analyze(df, frequency)), nan_ok=True)


# Folders


def test_folders_are_listed_and_named(spark, tmp_path):
    root = str(tmp_path / "in")
    row = spark.range(3)
    for name in ("b-2", "a", "a_/x", "deep/one", "deep/two", "_hidden", ".also", "deep/parts/day=1"):
        row.write.parquet(f"{root}/{name}")
    assert list(s.folders_below(spark, root)) == ["a", "a_", "b2", "deep"]
    nested = s.folders_below(spark, root, nested=True)
    assert list(nested) == ["a", "a__x", "b2", "deep_one", "deep_parts", "deep_two"]
    frames = s.discover(spark, root, nested=True, view="seen")
    assert {n: df.count() for n, df in frames.items()} == dict.fromkeys(nested, 3)
    assert spark.table("seen_b2").count() == 3 and frames["deep_parts"].columns == ["id", "day"]
    row.write.parquet(f"{root}/a-")  # differs from "a" in other characters only
    assert s.discover(spark, root, nested=True)["a"].count() == 6
    (tmp_path / "none").mkdir()
    assert s.discover(spark, str(tmp_path / "none")) == {}


# Write, audit, publish


def test_audit_publishes_or_exports(spark, tmp_path):
    target, rejects = str(tmp_path / "t"), str(tmp_path / "r")
    good = spark.range(10).selectExpr("id", "concat('f', id % 2) AS file", "'' AS errors")
    out = k.write_audited(good, "errors", "file", target, rejects)
    assert out.columns == ["id", "file"] and out.count() == 10 and not (tmp_path / "r").exists()
    with pytest.raises(FileExistsError):
        k.write_audited(good, "errors", "file", target, rejects)
    bad = spark.range(20).selectExpr("id", "concat('f', id % 2) AS file", "if(id = 7, 'wrong', NULL) AS errors")
    with pytest.raises(Quarantined):
        k.write_audited(bad, "errors", "file", target, rejects, "overwrite")
    assert spark.read.csv(rejects, header=True, sep=";").count() == 20
    assert spark.read.parquet(target).count() == 10
    assert k.write_audited(bad.where("id <> 7"), "errors", "file", target, rejects, "overwrite").count() == 19
    assert sorted(p.name for p in tmp_path.iterdir()) == ["r", "t"]


def test_a_failed_write_publishes_nothing(spark, tmp_path):
    target = str(tmp_path / "t")
    broken = spark.range(10).selectExpr("id", "'f' AS file", "if(id = 9, raise_error('lost'), '') AS errors")
    with pytest.raises(Exception, match="lost"):
        k.write_audited(broken, "errors", "file", target, str(tmp_path / "r"))
    assert not (tmp_path / "t").exists() and not (tmp_path / "r").exists()


# Branches


def test_route_columns_equals_route(spark):
    df = spark.createDataFrame([(1, "p"), (2, "f"), (3, None), (4, "x")], "id int, s string")
    branches = {"p": {"note": F.lit("pending"), "id": F.col("id") * 10}, "f": {"note": F.col("s")}}
    one = v.route_columns(df, "s", branches)
    many = v.route(df, "s", {value: lambda d, c=columns: d.withColumns(c) for value, columns in branches.items()})
    assert sorted(map(repr, map(tuple, one.select("id", "s", "note").collect()))) == sorted(map(repr, map(tuple, many.select("id", "s", "note").collect())))
    assert one._jdf.queryExecution().executedPlan().toString().count("Scan") == 1
