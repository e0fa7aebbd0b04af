import datetime as dt
from collections import Counter

import pytest
from conftest import rows
from pyspark.sql import functions as F

from sluice.functions import text
from sluice.operators import clean as c
from sluice.operators import privacy as p
from sluice.operators import sql as q
from sluice.types import EmptyInput, RuleViolation
from sluice.sources import files as s


def same_rows(parts, df):
    return sum((Counter(map(tuple, x.collect())) for x in parts), Counter()) == Counter(map(tuple, df.collect()))


@pytest.fixture(scope="module")
def gaps(spark):
    return spark.createDataFrame([(1, "a", " "), (2, None, "x"), (3, "", ""), (4, "b", "y"), (4, "b", "y")], "id int, u string, w string")


def test_split_blank_rejects_once(gaps):
    split = c.split_blank(gaps, ["u", "w"])
    assert [r["id"] for r in split.good.collect()] == [4, 4]
    assert same_rows(split, gaps)


def test_split_range_keeps_every_row(spark):
    df = spark.createDataFrame([(1,), (5,), (None,), (9,)], "x int")
    split = c.split_range(df, "x", 1, 5)
    assert rows(split.good) == [(1,), (5,)]
    assert same_rows(split, df)


def test_to_int_truncates_and_forgives(spark):
    df = spark.createDataFrame([("12.5",), ("x",), (None,), (" 7 ",), ("-3.9",)], "a string")
    assert [r["a"] for r in c.to_int(df, ["a"]).collect()] == [12, None, None, 7, -3]


def test_set_schema_takes_nested_types(spark):
    df = spark.createDataFrame([("1.234", "2", "drop")], "a string, b string, c string")
    out = c.set_schema(df, "x DECIMAL(10,2), y BIGINT")
    assert out.dtypes == [("x", "decimal(10,2)"), ("y", "bigint")]
    with pytest.raises(ValueError):
        c.set_schema(df, "a INT, b INT, c INT, d INT")


def test_conform(spark):
    df = spark.createDataFrame([("1", "x"), ("z", "y"), (None, "w")], "id string, extra string")
    good, bad = c.conform(df, "id INT NOT NULL")
    assert rows(good) == [(1, "x")]
    assert rows(bad) == [("z", "y"), (None, "w")] or len(rows(bad)) == 2
    with pytest.raises(RuleViolation):
        c.conform(df, "missing INT")


def test_assert_schema(spark):
    df = spark.createDataFrame([(1, "x")], "id int, s string")
    assert c.assert_schema(df, "id INT") is df
    with pytest.raises(RuleViolation, match="id is int"):
        c.assert_schema(df, "id BIGINT")
    with pytest.raises(RuleViolation, match="not found"):
        c.assert_schema(df, "other INT")


def test_unique_assertion(gaps):
    with pytest.raises(RuleViolation):
        c.assert_unique(gaps, ["id"])
    assert c.assert_unique(gaps.distinct(), ["id"]).count() == 4


def test_change_flags_priority_and_empty_list(spark):
    df = spark.createDataFrame([(1, "1", "1", "0"), (2, "0", "1", "1"), (3, "", None, "1"), (4, None, "0", "")],
                               "id int, c_atr_isadded string, c_atr_isupdated string, c_atr_isdeleted string")
    assert [r["c_flag"] for r in c.change_flags(df, ["id"], ["c"]).collect()] == ["isadded", "isupdated", "isdeleted", "None"]
    assert c.change_flags(df, ["id"], []).columns == ["id"]


def test_empty_input(spark, tmp_path):
    with pytest.raises(EmptyInput):
        s.require_rows(spark.range(0))
    with pytest.raises(EmptyInput):
        s.read_or_stop(spark, str(tmp_path / "none"))
    assert s.frame_name("part-2/ab c") == "part2abc"


def test_query_assertions(spark):
    """The two documented cases: no bad rows pass ``gt`` and fail ``eq``."""
    df = spark.createDataFrame([("1", 10, "A"), ("2", 20, "B")], "passenger_id string, age bigint, cabin string")
    bad = q.run_sql(spark, "SELECT * FROM {p} WHERE age <= 0", p=df)
    q.raise_if(bad, "gt")
    with pytest.raises(RuleViolation):
        q.raise_if(bad, "eq")
    with pytest.raises(RuleViolation):
        q.raise_if(df, "gte", 2)
    q.raise_if(df, "lt", 2)


def test_sql_file(spark, tmp_path):
    (tmp_path / "q.sql").write_text("SELECT count(*) AS n\nFROM {d} WHERE id >= :lo")
    assert q.run_sql_file(spark, str(tmp_path / "q.sql"), {"lo": 3}, d=spark.range(5)).first()["n"] == 2


def test_zero_keeps_a_digit(spark):
    df = spark.createDataFrame([("007",), ("0",), ("000",), ("0a",)], "a string")
    assert [r[0] for r in df.select(text.strip_zeros(F.col("a"))).collect()] == ["7", "0", "0", "0a"]


def test_points(spark):
    df = spark.createDataFrame([("POINT (11.5 48.1)",), ("POINT(-3 4)",), ("nonsense",), (None,)], "p string")
    got = [tuple(r) for r in df.select(text.point_lat(F.col("p")), text.point_lng(F.col("p"))).collect()]
    assert got == [(48.1, 11.5), (4.0, -3.0), (None, None), (None, None)]


def test_distance_units(spark):
    args = [F.lit(float(x)) for x in (0, 0, 0, 180)]
    r = spark.range(1).select(*[text.distance(*args, unit) for unit in ("rads", "km", "m")]).first()
    assert r[0] == pytest.approx(3.14159265, abs=1e-6)
    assert r[1] * 1000 == pytest.approx(r[2])


@pytest.fixture(scope="module")
def pii(spark):
    data = [(12345, dt.date(2020, 2, 28), dt.datetime(2020, 2, 28, 10, 11, 12), "88 Hello-St. 0", 12.5), (None,) * 5]
    return spark.createDataFrame(data, "emp_id int, emp_date date, emp_datetime timestamp_ntz, emp_address string, emp_deci double")


def test_anonymize(pii):
    spec = {"emp_id": ("int", None), "emp_date": ("date", None), "emp_datetime": ("datetime", None), "emp_address": ("string", None), "emp_deci": ("decimal", None)}
    first, second = p.anonymize(pii, spec).collect()
    assert first["emp_id"] == 45612
    shift = dt.timedelta(days=2020 + 2 + 28)
    assert first["emp_date"] == dt.date(2020, 2, 28) + shift
    assert first["emp_datetime"] == dt.datetime(2020, 2, 28, 10, 11, 12) + shift
    assert first["emp_address"] == "70 gjccz-vu. 8"
    assert first["emp_deci"] == 45.2
    assert all(v is None for v in second)


def test_substitution_is_its_own_inverse_except_for_leading_zeros(spark):
    df = spark.createDataFrame([("hello world 12345679",), ("abcxyz-0",)], "a string")
    twice = df.select(p.substitute(p.substitute(F.col("a"))).alias("a"))
    assert rows(twice) == rows(df)


def test_mask(pii, spark):
    spec = {"emp_id": ("int", None), "emp_address": ("string", None), "emp_deci": ("decimal", None)}
    first = p.mask(pii, spec).first()
    assert len(str(first["emp_id"])) == 5
    assert first["emp_address"] == "xx xxxxx-xx. x"
    assert first["emp_deci"] == 11.1
    nums = spark.range(1, 3000).select(F.col("id").cast("int").alias("n"), F.length(F.col("id").cast("string")).alias("d"))
    assert p.mask(nums, {"n": ("int", None)}, seed=3).where("length(n) <> d").count() == 0


def test_wide_numbers_are_masked_and_anonymized(spark):
    df = spark.createDataFrame(
        [(1234567890, 123456789012, 12345678.9), (-12, -(2**63), 0.0001), (None, None, None), (2147483647, 9223372036854775807, -1e30), (0, 5, 10.0)],
        "i int, l long, d double",
    )
    spec = {"i": ("int", None), "l": ("int", None), "d": ("decimal", None)}
    masked = p.mask(df, spec, seed=1)
    assert [masked.schema[c].dataType for c in "il"] == [df.schema[c].dataType for c in "il"]
    for a, b in zip(df.collect(), masked.collect()):
        for x, y in zip(a[:2], b[:2]):
            assert (x is None) == (y is None) and (x is None or ((x < 0) == (y < 0) and len(str(abs(x))) == len(str(abs(y)))))
        assert (a[2] is None) == (b[2] is None)
    hidden = p.anonymize(df, spec).collect()
    assert tuple(hidden[2]) == (None, None, None) and hidden[1]["i"] == -45
    assert all(v is not None for i in (0, 3) for v in (hidden[i]["l"], hidden[i]["d"])) and hidden[1]["d"] is not None
