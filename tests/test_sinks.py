import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from sluice.operators import recon as r
from sluice.operators.quality.checks import Check
from sluice.session import durable, scratch_path, shared_dir
from sluice.sinks import tables as k
from sluice.sinks import upsert as u
from sluice.streaming import incremental as inc
from sluice.types import Quarantined


@pytest.fixture(scope="module")
def base(spark):
    return spark.createDataFrame([(1, "a", 1), (2, "b", 5), (3, "c", 1)], "id int, v string, ver int")


@pytest.fixture(scope="module")
def delta(spark):
    return spark.createDataFrame([(1, "A", 2), (1, "AA", 3), (2, "late", 4), (9, "new", 1)], "id int, v string, ver int")


def test_upsert(base, delta):
    once = u.upsert(base, delta, ["id"], "ver")
    assert rows(once) == [(1, "AA", 3), (2, "b", 5), (3, "c", 1), (9, "new", 1)]
    assert rows(u.upsert(once, delta, ["id"], "ver")) == rows(once)


def test_insert_new(base, delta):
    assert rows(u.insert_new(base, delta, ["id"], "ver")) == rows(base.union(delta.where("id = 9")))
    assert u.insert_new(base, delta, ["id"]).count() == 4


def test_ties_are_settled_the_same_way(spark):
    df = spark.createDataFrame([(1, x, 7) for x in "abcdef"], "id int, v string, ver int")
    first = rows(u.latest(df, ["id"], "ver"))
    assert all(rows(u.latest(df.repartition(n), ["id"], "ver")) == first for n in (1, 3, 5))


def test_latest_reduces_inside_the_map_tasks(spark):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    plan = u.latest(events, ["user_id"], "ts")._jdf.queryExecution().executedPlan().toString()
    partial, exchange = plan.find("row_number(), 1, Partial"), plan.find("Exchange hashpartitioning")
    assert partial > exchange > 0  # the partial step is below the shuffle


def test_quarantine(spark, tmp_path):
    df = spark.createDataFrame([(1, "f1", ""), (2, "f1", "bad"), (3, "f2", "")], "id int, file string, err string")
    clean = k.quarantine(df.where("err = ''"), "err", "file", str(tmp_path / "none"))
    assert clean.columns == ["id", "file"] and clean.count() == 2
    with pytest.raises(Quarantined) as info:
        k.quarantine(df, "err", "file", str(tmp_path / "q"))
    back = spark.read.csv(info.value.path, header=True, sep=";")
    assert rows(back.select("file", "id")) == [("f1", "1"), ("f1", "2"), ("f2", "3")]


def test_save_table_skips_empty_frames(spark, tmp_path, base):
    assert not k.save_table(base.where("id > 99"), "sluice_test_none", str(tmp_path / "t"))
    assert not spark.catalog.tableExists("sluice_test_none")
    assert k.save_table(base, "sluice_test_base", str(tmp_path / "b"), comment="it's a \\ table")
    assert spark.sql("DESCRIBE EXTENDED sluice_test_base").where("col_name = 'Comment'").first()["data_type"] == "it's a \\ table"
    k.drop_table(spark, "sluice_test_base")
    assert not spark.catalog.tableExists("sluice_test_base")


def test_retention_keeps_unreadable_dates(spark):
    df = spark.createDataFrame([(20200101,), (20230101,), (None,), (99,)], "d int")
    keep, old = k.retention_split(df, "d", "yyyyMMdd", F.lit("2022-01-01").cast("date"))
    assert rows(old) == [(20200101,)] and keep.count() == 3


def test_partition_values_limit(spark):
    df = spark.range(50).selectExpr("id", "id % 3 AS m")
    got = k.partition_values(df, ["id", "m"], limit=10)
    assert rows(got) == sorted([("id", None, 50), ("m", "0", None), ("m", "1", None), ("m", "2", None)], key=repr)
    assert rows(k.partition_values(df, ["m"])) == [("m", "0"), ("m", "1"), ("m", "2")]
    assert k.partition_values(df, ["id"]).count() == 50


@pytest.mark.parametrize("days", [[1, 2], [1, 9], [8, 9]])
def test_archive_twice(spark, tmp_path, days):
    spark.sql("DROP TABLE IF EXISTS sluice_test_archive")
    path, archive = str(tmp_path / "t"), str(tmp_path / "a")
    df = spark.createDataFrame([(d, dt.date(2024, 1, d)) for d in days], "id int, d date")
    k.save_table(df, "sluice_test_archive", path)
    cutoff, old = F.lit("2024-01-05").cast("date"), [d for d in days if d < 5]
    for run in ("one", "two"):
        k.archive_old(spark.table("sluice_test_archive"), "sluice_test_archive", "d", None, cutoff, archive, path, run)
        assert sorted(r[0] for r in spark.table("sluice_test_archive").collect()) == [d for d in days if d >= 5]
        if old:
            assert sorted(int(r["id"]) for r in spark.read.csv(archive, header=True).collect()) == old
    spark.sql("DROP TABLE sluice_test_archive")


def test_empty_overwrite_is_possible(spark, tmp_path, base):
    k.save_table(base, "sluice_test_empty", str(tmp_path / "e"))
    k.save_table(base.where("id > 99"), "sluice_test_empty", str(tmp_path / "e"), skip_empty=False)
    assert spark.table("sluice_test_empty").count() == 0
    k.drop_table(spark, "sluice_test_empty")


def test_null_keys_and_map_columns(spark):
    base = spark.createDataFrame([(None, "a", 1), (1, "b", 1)], "id int, v string, ver int")
    delta = spark.createDataFrame([(None, "n", 2), (None, "m", 1), (2, "c", 1)], "id int, v string, ver int")
    once = u.upsert(base, delta, ["id"], "ver")
    assert rows(once) == rows(u.upsert(once, delta, ["id"], "ver")) == sorted([(None, "n", 2), (1, "b", 1), (2, "c", 1)], key=repr)
    new = u.insert_new(base, delta, ["id"], "ver")
    assert rows(new) == rows(u.insert_new(new, delta, ["id"], "ver")) == sorted([(None, "a", 1), (1, "b", 1), (2, "c", 1)], key=repr)
    maps = spark.sql(
        "SELECT id, map('x', id, 'y', 2L) AS m, array(map('z', id)) AS l, 1 AS ver FROM range(3) "
        "UNION ALL SELECT 0, map('y', 2L, 'x', 0L), array(map('z', 0L)), 1"
    )
    assert u.latest(maps, ["id"], "ver").count() == 3


def test_prefixes_are_the_folders_below_the_parent(spark, tmp_path):
    from sluice.sources.files import read_prefixes

    for place in ("alpha/day=1", "beta-2/day=1/hour=3"):
        spark.range(2).write.parquet(str(tmp_path / place))
    got = read_prefixes(spark, str(tmp_path)).groupBy("prefix").count()
    assert rows(got) == [("alpha", 2), ("beta2", 2)]


def test_reconciliation(spark):
    a = spark.createDataFrame([(1, 1.11), (2, 2.22)], "n int, x double")
    b = spark.createDataFrame([(3, 3.33)], "n int, x double")
    labels = r.Labels("p", "g", "s", "t")
    row = r.reconcile_counts(a, b, labels, "n > 1").first()
    assert (row["source_count"], row["target_count"], row["match_flag"]) == ("1", "1", "Y")
    got = {x["measure_column"]: x["match_flag"] for x in r.reconcile_measures(a, b, [("n", "n"), ("x", "x"), ("x", "n")][:2], labels).collect()}
    assert got == {"n": "Y", "x": "Y"}
    log = r.reconcile_counts(a, b, labels)
    assert log.first()["match_flag"] == "N"
    assert r.pending(r.mark_sent(log, "p"), "p").count() == 0
    assert r.pending(r.mark_sent(log, "other"), "p").count() == 1


def test_sums_of_small_large_and_whole_numbers(spark):
    labels, pair = r.Labels("p", "g", "s", "t"), [("x", "x")]
    flag = lambda a, b: r.reconcile_measures(a, b, pair, labels).first()["match_flag"]
    tiny = spark.range(100_000).selectExpr("0.0000004D AS x")
    assert flag(tiny, tiny.union(tiny)) == "N" and flag(tiny, tiny.repartition(7)) == "Y"
    huge = spark.range(3).selectExpr("1e300D AS x")
    assert flag(huge, huge) == "Y" and flag(huge, huge.limit(2)) == "N"
    longs = spark.range(3).selectExpr("9000000000000000000L AS x")
    assert flag(longs, longs.limit(2).union(spark.sql("SELECT 8999999999999999999L AS x"))) == "N" and flag(longs, longs) == "Y"


def test_observed_counts(spark):
    df, seen = r.observe_counts(spark.range(17), "seventeen")
    df.collect()
    assert seen.get["rows"] == 17


def test_shared_dir_is_the_configured_one(spark):
    assert scratch_path(spark, "x").startswith(shared_dir(spark))
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
    assert durable(spark.range(5)).count() == 5


def test_incremental_upsert_reads_files_once(spark, tmp_path):
    src, root, ckpt = (str(tmp_path / n) for n in ("in", "root", "ckpt"))
    schema = "id int, v string, ver int"
    spark.sql("DROP TABLE IF EXISTS sluice_test_inc")

    def deliver(data):
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(src)
        inc.upsert_new(spark, src, schema, "sluice_test_inc", root, ckpt, ["id"], "ver", ["v"])

    deliver([(1, "a", 1), (1, "b", 2), (2, " ", 1)])
    assert rows(spark.table("sluice_test_inc")) == [(1, "b", 2)]
    deliver([(1, "old", 1), (3, "c", 1)])
    assert rows(spark.table("sluice_test_inc")) == [(1, "b", 2), (3, "c", 1)]
    inc.upsert_new(spark, src, schema, "sluice_test_inc", root, ckpt, ["id"], "ver", ["v"])
    assert spark.table("sluice_test_inc").count() == 2


def test_quality_log_grows(spark, tmp_path):
    src, log, ckpt = (str(tmp_path / n) for n in ("in", "log", "ckpt"))
    for day in range(2):
        spark.createDataFrame([(day, dt.date(2024, 1, 1 + day))], "id int, d date").write.mode("append").parquet(src)
        inc.log_quality(spark, src, "id int, d date", [Check("error", "c").is_complete("id")], log, ckpt)
    out = spark.read.parquet(log)
    assert out.count() == 2 and out.select("batch").distinct().count() == 2
