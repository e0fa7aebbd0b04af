import math
from collections import Counter

import numpy as np
import pytest
from conftest import CRATES, rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from sluice.operators.quality import analyzers as a
from sluice.operators.quality import checks as x
from sluice.operators.quality import profile as pr
from sluice.operators.quality import suggest as g
from sluice.operators.ranks import quantiles, running
from sluice.plans import PLANS, SQL, Tables


def figures():
    """The metrics of the rows of the fixture, computed plainly."""
    n, weights = len(CRATES), [r[1] for r in CRATES if r[1] is not None]
    crates, places, values = (Counter(c) for c in ([r[0] for r in CRATES], [r[2] for r in CRATES], weights))
    once = lambda c: sum(v == 1 for v in c.values())
    mean = sum(weights) / len(weights)
    pairs = [(r[1], r[4]) for r in CRATES if r[1] is not None and r[4] is not None]
    mx, my = (sum(p[i] for p in pairs) / len(pairs) for i in (0, 1))
    cov = sum((x - mx) * (y - my) for x, y in pairs)
    spread = math.sqrt(sum((x - mx) ** 2 for x, _ in pairs) * sum((y - my) ** 2 for _, y in pairs))
    return [
        (a.size(), n), (a.completeness("weight"), len(weights) / n), (a.uniqueness("crate"), once(crates) / n),
        (a.distinctness("crate"), len(crates) / n), (a.unique_value_ratio("weight"), once(values) / len(values)),
        (a.number_of_bins("weight"), len(values) + 1), (a.entropy("place"), -sum(c / n * math.log(c / n) for c in places.values())),
        (a.approx_quantile("weight", 0.5), sorted(weights)[(len(weights) - 1) // 2]), (a.min_length("crate"), 2), (a.max_length("place"), 4),
        (a.minimum("weight"), min(weights)), (a.maximum("weight"), max(weights)), (a.mean("weight"), mean), (a.total("weight"), sum(weights)),
        (a.standard_deviation("weight"), math.sqrt(sum((w - mean) ** 2 for w in weights) / len(weights))),
        (a.approx_count_distinct("weight"), len(values)), (a.compliance("big", "weight > 8"), sum(w > 8 for w in weights) / n),
        (a.compliance("cheap", "price < weight"), sum(y < x for x, y in pairs) / n), (a.correlation("weight", "price"), cov / spread),
    ]


def test_metric_values(crates):
    want = figures()
    got = {(r["name"], r["instance"]): r["value"] for r in a.analyze(crates, [m for m, _ in want]).collect()}
    for m, value in want:
        assert got[(m.name, m.instance)] == pytest.approx(value, abs=1e-9), m.name


def test_entropy_base_and_mutual_information(crates):
    got = {r["name"]: r["value"] for r in a.analyze(crates, [a.entropy("place", 2), a.mutual_information("crate", "crate")]).collect()}
    entropy = lambda i, base: -sum(c / len(CRATES) * math.log(c / len(CRATES), base) for c in Counter(r[i] for r in CRATES).values())
    assert got["Entropy-2"] == pytest.approx(entropy(2, 2))
    assert got["MutualInformation"] == pytest.approx(entropy(0, math.e))


def test_scalars_share_one_scan_and_one_exchange(crates):
    plan = a.measure(crates.limit(100), [a.size(), a.mean("weight"), a.total("price"), a.max_length("crate")])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Aggregate(keys=[], functions=[") == 2  # partial and final of a single aggregate


def test_checks(crates):
    check = (
        x.Check("error", "crates").has_size(lambda v: v == 10).is_unique("weight")
        .has_completeness("weight", lambda v: v >= 0.8).has_entropy("place", lambda v: v > 1)
        .has_approx_quantile("weight", 0.5, lambda v: v == 7).has_correlation("weight", "price", lambda v: v == 1)
        .is_positive("weight").is_non_negative("weight").is_less_than("price", "weight", lambda v: v == 0.2)
        .is_in_interval("price", 2.5, 31.0).has_pattern("crate", "K[1-7]").has_data_type("sealed", "boolean")
        .has_data_type("crate", "string").is_contained_in("place", ["dock", "yard"], lambda v: v == 0.8)
        .has_histogram_value("place", "dock", lambda v: v == 5, "abs").has_approx_count_distinct("weight", lambda v: v == 6)
    )
    got = x.verify(crates, [check, x.Check("warning", "fine").has_size(lambda v: v > 0)]).collect()
    failed = {r["constraint"] for r in got if r["constraint_status"] == "Failure"}
    assert failed == {"Uniqueness(weight)", "Correlation(weight,price)"}
    assert {(r["check"], r["check_level"], r["check_status"]) for r in got} == {("crates", "Error", "Error"), ("fine", "Warning", "Success")}
    assert all(("does not meet" in r["constraint_message"]) == (r["constraint_status"] == "Failure") for r in got)


def test_equal_labels_are_judged_apart(spark):
    df = spark.range(1, 11).selectExpr("id", "'a' AS s", "9000000000000000000L AS big")
    two = x.Check("error", "same").satisfies("id >= 0", "rule"), x.Check("error", "same").satisfies("id < 0", "rule")
    one = x.Check("error", "lists").is_contained_in("s", ["a", "b"]).is_contained_in("s", ["a,b"])
    got = x.verify(df, [*two, one]).collect()
    assert sorted(r["check_status"] for r in got if r["check"] == "same") == ["Error", "Success"]
    assert sorted(r["value"] for r in got if r["check"] == "lists") == [0.0, 1.0]
    odd = {r["constraint"]: r for r in x.verify(df, [x.Check("error", "o").has_max("s", lambda v: v > 0).has_sum("big", lambda v: v == 9e19)]).collect()}
    assert odd["Sum(big)"]["constraint_status"] == "Success"
    assert odd["Maximum(s)"]["value"] is None and "holds no numbers" in odd["Maximum(s)"]["constraint_message"]


def test_empty_input_fails_checks(spark):
    df = spark.createDataFrame([], "v double")
    got = {r["constraint"]: r for r in x.verify(df, [x.Check("error", "e").has_mean("v", lambda v: v > 0).has_size(lambda v: v == 0)]).collect()}
    assert got["Size(*)"]["constraint_status"] == "Success"
    assert got["Mean(v)"]["constraint_message"].startswith("Empty state")


def test_named_assertions(spark):
    ops = {"eq": 3, "neq": 4, "gt": 2, "gte": 3, "lt": 4, "lte": 3}
    df = spark.range(3)
    for op, v in ops.items():
        row = x.verify(df, [x.Check("error", op).has_size(x.assertion(op, v))]).first()
        assert row["constraint_status"] == "Success", op


def test_approximate_figures_are_close(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet")
    exact = df.selectExpr("count(DISTINCT l_orderkey)", "percentile(l_extendedprice, array(0.25, 0.5, 0.75))").first()
    row = pr.profile_columns(df, ["l_extendedprice", "l_orderkey"])
    by = {r["column"]: r for r in row.collect()}
    assert by["l_orderkey"]["approximateNumDistinctValues"] == pytest.approx(exact[0], rel=0.1)
    for q, v in zip(("approxQ1", "approxQ2", "approxQ3"), exact[1]):
        assert by["l_extendedprice"][q] == pytest.approx(v, rel=0.02)


def test_merged_sketches_match_quantiles(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet")
    got = pr.merge_sketches(pr.sketch(df, ["l_returnflag"], ["l_extendedprice"]), ["l_extendedprice"], [0.25, 0.5])
    exact = df.selectExpr("percentile(l_extendedprice, array(0.25, 0.5))").first()[0]
    for r, v in zip(sorted(got.collect(), key=lambda r: r["quantile"]), exact):
        assert r["value"] == pytest.approx(v, rel=0.05)


def test_percentile_table(spark):
    df = spark.range(1, 1001).selectExpr("id", "string(id) AS t", "if(id % 2 = 0, 'a', 'b') AS w")
    got = pr.percentile_table(df).collect()
    assert {r["column_name"] for r in got} == {"id", "t"}
    assert len(got) == 200
    assert next(r["count_col"] for r in got if r["column_name"] == "id" and r["value_float"] == 50.0) == pytest.approx(500, abs=10)


def test_inferred_types(spark):
    df = spark.createDataFrame([("1", "1.5", "true", "x", None, "1"), ("-2", "3", "false", "4", None, "true")],
                               "i string, f string, b string, s string, n string, m string")
    got = {r["column"]: r["dataType"] for r in pr.profile_columns(df).collect()}
    assert got == {"i": "Integral", "f": "Fractional", "b": "Boolean", "s": "String", "n": "Unknown", "m": "String"}


def test_histograms_of_all_columns_and_with_a_limit(spark):
    df = spark.range(1000).selectExpr("id", "id % 119 AS m", "id % 120 AS n", "if(id = 0, NULL, 'x') AS t")
    everything = {r["column_name"]: r["n"] for r in pr.histogram_table(df).groupBy("column_name").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert everything == {"id": 1000, "m": 119, "n": 120, "t": 2}
    got = pr.histogram_table(df, limit=119)
    assert {r["column_name"]: r["count_col"] for r in got.where("metric_type = 'leftOut'").collect()} == {"id": 1000, "n": 120}
    assert got.where("column_name = 'm'").agg({"count_col": "sum"}).first()[0] == 1000


def test_buckets(spark):
    df = spark.range(50).selectExpr("id % 5 AS m", "if(id < 10, 'a', 'b') AS t")
    got = pr.bucket_table(df, "db", "tab").collect()
    assert {(r["column_name"], r["metric_type"]) for r in got} == {("m", "histogram"), ("m", "approxPercentile"), ("t", "category")}
    assert len(got) == 5 + 100 + 2 and all((r["database"], r["table"]) == ("db", "tab") for r in got)


def test_long_value_ranges_are_counted(spark):
    df = spark.range(400).selectExpr("concat('v', id % 100) AS many", "concat('w', id % 3) AS few")
    got = {r["column"]: r["code"] for r in g.suggest(df, ["CategoricalRange"], most_listed=50).collect()}
    assert "100 values" in got["many"] and "'w0', 'w1', 'w2'" in got["few"]


def brute_ranges(values, coverage=0.9):
    """The values by rank, and how many of them cover the column."""
    counts = Counter(v for v in values if v is not None)
    ranked = sorted(counts, key=lambda v: (-counts[v], v))
    before, top = 0, 0
    for v in ranked:
        if before >= coverage * len(values):
            break
        top, before = top + 1, before + counts[v]
    return ranked, counts, top


@pytest.mark.parametrize("wide", [12_000, 200_000])
def test_ranges_of_any_width(spark, wide):
    """Frequencies that fall, many ties, nulls: the same rules and values as for narrow columns."""
    df = spark.range(wide * 3).selectExpr(
        f"concat('v', if(id < {wide} * 2, id % {wide}, pow(id % 997, 2) % {wide})) AS w", "if(id % 50 = 0, NULL, concat('n', id % 7)) AS narrow", "id"
    )
    values = {c: [r[0] for r in df.select(c).collect()] for c in ("w", "narrow")}
    found = {(r["column"], r["rule"]): r["code"] for r in g.suggest(df, ["CategoricalRange", "FractionalCategoricalRange"]).collect()}
    ranges = {}
    for r in g.suggested_values(df).collect():
        ranges.setdefault((r["column"], r["rule"]), {})[r["rank"]] = (r["value"], r["n"])
    for c, column in values.items():
        ranked, counts, top = brute_ranges(column)
        whole, part = ((c, rule) for rule in ("CategoricalRange", "FractionalCategoricalRange"))
        assert ranges[whole] == {i + 1: (v, counts[v]) for i, v in enumerate(ranked)}
        assert ranges[part] == {i + 1: (v, counts[v]) for i, v in enumerate(ranked[:top])}
        assert (whole in found) and (part in found)
    assert f"# {wide} values" in found["w", "CategoricalRange"] and "'n0'" in found["narrow", "CategoricalRange"]
    listed = g.suggested_values(df)
    check = x.Check("error", "wide")
    for (c, rule), code in found.items():
        eval("check" + code, {"check": check, "values": lambda c, rule: listed.where(f"column = '{c}' AND rule = '{rule}'").select("value")})
    failing = x.Check("error", "too few").is_contained_in("w", listed.where("rank <= 10 AND column = 'w'").select("value"), lambda x: x >= 0.5)
    assert [r["constraint_status"] for r in x.verify(df, [check]).collect()] == ["Success"] * 4
    assert [r["constraint_status"] for r in x.verify(df, [failing]).collect()] == ["Failure"]


def test_running_ranks(spark):
    """Against a plain window, with groups of very different sizes, null keys, ties and negative values."""
    df = spark.range(5000).selectExpr("if(id < 4000, 'a', if(id < 4900, NULL, string(id % 3))) AS k", "id % 13 AS o", "id", "id % 7 - 3 AS v")
    got = running(df, [F.desc("o"), "id"], ["k"], "v")
    order = Window.partitionBy("k").orderBy(F.desc("o"), "id")
    want = df.withColumn("rank", F.row_number().over(order)).withColumn(
        "before", F.coalesce(F.sum("v").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    assert rows(got) == rows(want)
    everything = running(df, ["o", "id"]).collect()
    assert sorted(r["rank"] for r in everything) == list(range(1, 5001)) and all(r["before"] == r["rank"] - 1 for r in everything)
    assert running(df.limit(0), ["id"]).count() == 0


def test_exact_quantiles(spark):
    """Against the sorted values: heavy ties, gaps, negative values, a column without values."""
    values = [None if i % 11 == 0 else (7.25 if i % 3 == 0 else -i * i / 8) for i in range(3000)]
    df = spark.createDataFrame([(v, i % 5, None) for i, v in enumerate(values)], "a double, `b.c` int, d double").repartition(7)
    shares = [0, 0.1, 0.25, 0.5, 0.9, 1]
    got = {(r["column_name"], r["share"]): r["value"] for r in quantiles(df, ["a", "b.c", "d"], shares).collect()}
    want = {}
    for name, column in (("a", sorted(v for v in values if v is not None)), ("b.c", sorted(i % 5 for i in range(3000)))):
        for s in shares:
            at = s * (len(column) - 1)
            low, high = column[math.floor(at)], column[math.ceil(at)]
            want[name, float(s)] = pytest.approx(low + (high - low) * (at - math.floor(at)), abs=1e-9)
    assert got == want


def test_quantile_queries_return_the_exact_values(spark, tmp_path):
    """a06 and p04 return the exact quantiles beside the judgement of the sketched ones, also for tables without values."""
    kinds = "l_orderkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string"
    items = [(i, i % 7, None if i % 4 == 0 else i % 50 + 1.0, None if i % 9 == 0 else round(i * 1.37, 2), 0.0, 0.0, "ARN"[i % 3], "OF"[i % 2]) for i in range(1, 2001)]
    for name, rows_ in (("full", items), ("empty", [])):
        spark.createDataFrame(rows_, kinds).write.parquet(f"{tmp_path}/{name}/lineitem.parquet")
    exact = lambda i, q: round(float(np.quantile([r[i] for r in items if r[i] is not None], q)), 4)
    run = lambda plan, folder: {tuple(r[:-3]): (r["n"], r["exact"], r["is_near"]) for r in plan(Tables(spark, f"{tmp_path}/{folder}")).collect()}
    n = {i: sum(r[i] is not None for r in items) for i in (2, 3)}
    a06 = {(f"ApproxQuantile-{q}",): (n[3], pytest.approx(exact(3, q), abs=1e-4), True) for q in (0.1, 0.5, 0.9)}
    p04 = {(c, str(q)): (n[i], pytest.approx(exact(i, q), abs=1e-4), True) for c, i in (("l_quantity", 2), ("l_extendedprice", 3)) for q in (0.25, 0.5, 0.75)}
    assert run(PLANS["a06_approx_quantile"], "full") == a06 and run(PLANS["p04_mergeable_sketches"], "full") == p04
    assert set(run(PLANS["a06_approx_quantile"], "empty").values()) == {(0, None, True)}
    for name in ("a06_approx_quantile", "p04_mergeable_sketches"):
        assert "quantile_cont" in SQL[name]


def test_suggested_code_runs_and_holds(spark):
    """Each suggested check is run on the data it was made from."""
    df = spark.read.parquet("/root/testdata/sf0.01/orders.parquet").selectExpr(
        "o_orderkey", "o_totalprice", "if(o_orderstatus = 'P', NULL, o_orderpriority) AS p", "o_orderstatus", "string(year(o_orderdate)) AS y")
    check = x.Check("error", "suggested")
    found = g.suggest(df).collect()
    assert {r["rule"] for r in found} == set(g.RULES)
    for r in found:
        eval("check" + r["code"], {"check": check})
    assert x.verify(df, [check]).where("constraint_status = 'Failure'").count() == 0


def test_profile_of_nothing_and_of_empty_tasks(spark):
    schema = "a int, t string, d date"
    got = {r["column"]: r for r in pr.profile_columns(spark.createDataFrame([], schema)).collect()}
    assert got["a"]["dataType"] == "Integral" and got["a"]["mean_col"] is None and got["t"]["dataType"] == "Unknown"
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        row = {r["column"]: r for r in pr.profile_columns(spark.createDataFrame([(4, "7", None)], schema)).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert (row["a"]["mean_col"], row["a"]["stdDev_col"], row["a"]["approxQ2"]) == (4.0, 0.0, 4.0)
    assert row["t"]["dataType"] == "Integral" and row["t"]["maximum"] == 7.0 and row["d"]["completeness"] == 0.0


def test_figures_do_not_depend_on_the_partitions(spark):
    df = spark.range(1000).selectExpr("double(id * id) AS x")
    one, many = (pr.profile_columns(df.repartition(n)).first() for n in (1, 40))
    for k in ("mean_col", "stdDev_col", "sum_col", "minimum", "maximum"):
        assert one[k] == pytest.approx(many[k], rel=1e-12)
    assert one["stdDev_col"] == pytest.approx(df.selectExpr("stddev_pop(x)").first()[0], rel=1e-12)
