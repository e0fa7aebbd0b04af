import itertools

import pytest
from pyspark.sql import functions as F

from sluice.functions.errors import add_error, errors_text
from sluice.operators import validate as v


@pytest.fixture(scope="module")
def plans(spark):
    data = [
        (1, "P", "", "100", "", "K1", "2020", "1", "3"),
        (2, "P", "FA", "100", "", "K1", "2020", "1", "3"),
        (3, "P", "", "999", "5001", "K9", "2020", "1", "3"),
        (4, "P", None, "999", "", "K1", "2020", "4", "6"),
        (5, "P", "", "999", "", "K9", "2020", "1", "3"),
        (6, "B", "", "999", "", "K9", "2020", "1", "3"),
        (7, None, "", "999", "", "K9", "2020", "1", "3"),
        (8, "X", "", "999", "", "K9", "2020", "1", "3"),
    ]
    return spark.createDataFrame(
        data, "id int, account_type string, functional_area string, gl_account string, order_no string, "
        "cost_center string, fiscal_year string, period_from string, period_to string")


def test_messages_accumulate(spark):
    df = spark.createDataFrame([(1, None, " "), (2, "a", "b")], "id int, x string, y string")
    out = errors_text(add_error(v.require(df, ["x", "y"]), F.col("id") == 1, "also"))
    assert [r["errors"] for r in out.orderBy("id").collect()] == ["x is mandatory, y is mandatory, also", ""]


def test_null_error_column_is_not_lost(spark):
    df = spark.createDataFrame([(1, None)], "id int, errors array<string>")
    assert v.require(df.withColumn("x", F.lit(None).cast("string")), ["x"]).first()["errors"] == ["x is mandatory"]


def test_require_if_merges_rule_rows(spark):
    df = spark.createDataFrame([(1, "A", None, ""), (2, "B", None, ""), (3, None, None, None)], "id int, t string, a1 string, a2 string")
    rules = spark.createDataFrame([("A", "a1"), ("A", "a2, a1"), ("B", "a2")], "t string, mandatory_columns string")
    out = {r["id"]: r["errors"] for r in v.require_if(df, rules, ["t"], ["a1", "a2"]).collect()}
    assert out == {
        1: ["a1 is mandatory for this plan type", "a2 is mandatory for this plan type"],
        2: ["a2 is mandatory for this plan type"], 3: [],
    }


def test_lookup(spark):
    df = spark.createDataFrame([(1, "7"), (2, "x"), (3, " "), (4, None), (5, "0")], "id int, f string")
    ref = spark.createDataFrame([("007",), ("7",), ("00",), (None,)], "k string")
    out = {r["id"]: r["errors"] for r in v.lookup(df, "f", ref, "k").collect()}
    assert out == {1: [], 2: ["f is invalid"], 3: [], 4: [], 5: []}


def test_lock_keeps_earlier_errors(spark):
    df = spark.createDataFrame([(1, 2020, ["old"]), (2, 2021, []), (3, None, [])], "id int, y int, errors array<string>")
    cal = spark.createDataFrame([(2020, "2020-01-01"), (2020, "2030-01-01"), (2021, "2030-01-01")], "year int, lock_dt string")
    out = v.check_lock(df, cal, [("y", "year")], "lock_dt", F.lit("2024-01-01").cast("date"))
    assert {r["id"]: r["errors"] for r in out.collect()} == {1: ["old", v.LOCKED], 2: [], 3: []}


def test_check_matches(spark):
    df = spark.createDataFrame([(1, "K", "P1"), (2, "K", "P2"), (3, "E", "P1"), (4, "?", "P1"), (5, "T", "P1")], "id int, k string, pc string")
    ref = spark.createDataFrame([("K", "SAPP1"), ("E", "SAP"), ("T", "SAPP1"), ("T", "SAPP2")], "rk string, sr string")
    out = v.check_matches(df, ref, "k", "rk", "pc", "sr", "differs", prefix="SAP")
    assert {r["id"] for r in out.where("size(errors) > 0").collect()} == {2, 5}


def test_effective_lookup_against_brute_force(spark):
    """All intervals with ends in 2019-2021 against all periods, compared one by one."""
    ends = [f"{y}-{m:02d}-15" for y in (2019, 2020, 2021) for m in (1, 5, 12)] + ["9999-12-31"]
    spans = [(i, a, b, f"v{i}") for i, (a, b) in enumerate(itertools.product(ends, ends)) if a <= b]
    asks = [(y, f, t) for y in (2018, 2019, 2020, 2021, 2022) for f in (1, 5, 6, 12) for t in (5, 12, 16) if f <= t]
    ref = spark.createDataFrame([("all", *s[1:]) for s in spans] + [(f"k{s[0]}", *s[1:]) for s in spans],
                                "rk string, valid_from string, valid_to string, val string")
    keys = ["all", "none", None] + [f"k{s[0]}" for s in spans]
    df = spark.createDataFrame(
        [(i, k, str(y), f"{f:02d}", str(t)) for i, (k, (y, f, t)) in enumerate(itertools.product(keys, asks))],
        "id int, k string, fy string, pf string, pt string")
    out = v.effective_lookup(df, ref, "k", "rk", "fy", "pf", "pt", F.col("val"), "out")
    got = {r["id"]: r["out"] for r in out.collect()}
    assert len(got) == df.count()
    ym = lambda s: int(s[:4]) * 100 + int(s[5:7])
    for i, (k, (y, f, t)) in enumerate(itertools.product(keys, asks)):
        fits = [s for s in spans if (k == "all" or k == f"k{s[0]}") and ym(s[1]) <= y * 100 + f and ym(s[2]) >= y * 100 + t]
        if not fits:
            assert got[i] is None
        else:
            latest = max(s[1] for s in fits)
            assert got[i] in {s[3] for s in fits if s[1] == latest}


def test_cascade_keeps_every_row_once(spark, plans):
    gl = spark.createDataFrame([("100", "GL"), ("100", "GL")], "gl_account string, fa string")
    orders = spark.createDataFrame([("5001", "SAPORD")], "order_number string, fa string")
    centers = spark.createDataFrame([("K1", "2019-01-01", "2020-06-30", "SAPCC"), ("K1", "2015-01-01", "9999-12-31", "SAPOLD")],
                                    "cost_center string, valid_from string, valid_to string, fa string")
    rules = [
        v.Rule(F.lit(True), gl, "gl_account", "gl_account", F.col("fa")),
        v.Rule(F.col("order_no").startswith("5"), orders, "order_no", "order_number", v.text.after_last(F.col("fa"), "SAP")),
        v.Rule(F.length("order_no") == 0, centers, "cost_center", "cost_center", v.text.after_last(F.col("fa"), "SAP"), year="fiscal_year"),
    ]
    out = v.derive_cascade(plans, rules, "functional_area", v.NO_AREA, applies=F.col("account_type") == "P")
    got = {r["id"]: (r["functional_area"], r["errors"]) for r in out.collect()}
    assert out.count() == plans.count() == len(got)
    assert got == {
        1: ("GL", []), 2: ("FA", []), 3: ("ORD", []), 4: ("CC", []), 5: (None, [v.NO_AREA]),
        6: ("", []), 7: ("", []), 8: ("", []),
    }


def test_route_passes_unknown_categories(plans):
    out = v.route(plans, "account_type", {"P": lambda d: d.withColumn("note", F.lit("p"))})
    assert out.count() == plans.count()
    assert {r["id"] for r in out.where("note IS NULL").collect()} == {6, 7, 8}
