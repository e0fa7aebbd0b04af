"""Plans for analyzers (A), checks (X), profiles (P), suggestions (G) and reconciliation (R)."""

from __future__ import annotations

from pyspark.sql import functions as F

from sluice.operators import recon as r
from sluice.operators.quality import analyzers as a
from sluice.operators.quality import checks as x
from sluice.operators.quality import profile as pr
from sluice.operators.quality import suggest as g
from sluice.operators.quality.states import MetricStore
from sluice.operators.ranks import quantiles
from sluice.plans.registry import Tables, plan
from sluice.session import staged

# Line items with gaps and some values as text, as SQL and as a frame.
MIXED = """
(SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_linestatus,
   CASE WHEN l_linenumber <> 3 THEN l_returnflag END AS flag,
   CASE WHEN l_quantity > 5 THEN l_quantity END AS qty,
   CASE WHEN l_linenumber = 1 THEN l_linenumber::VARCHAR WHEN l_linenumber = 2 THEN printf('%.2f', l_tax)
        WHEN l_linenumber = 4 THEN 'true' WHEN l_linenumber = 5 THEN l_returnflag END AS txt
 FROM lineitem)"""


def _mixed(t: Tables):
    n = F.col("l_linenumber")
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linestatus",
        F.when(n != 3, F.col("l_returnflag")).alias("flag"),
        F.when(F.col("l_quantity") > 5, F.col("l_quantity")).alias("qty"),
        F.when(n == 1, n.cast("string")).when(n == 2, F.col("l_tax").cast("decimal(4,2)").cast("string"))
        .when(n == 4, "true").when(n == 5, F.col("l_returnflag")).alias("txt"),
    )


def _freq(cols: str, expr: str, source: str = MIXED) -> str:
    there = " OR ".join(f"{c} IS NOT NULL" for c in cols.split(", "))
    return f"(SELECT {expr} FROM (SELECT {cols}, count(*) AS n, ({there}) AS there FROM {source} GROUP BY {cols}))"


DISTINCT = "count(*) FILTER (WHERE there)"
ONCE = "count(*) FILTER (WHERE there AND n = 1)"
ENTROPY = f"""(SELECT -sum(n / t * ln(n / t)) FROM (SELECT count(*)::DOUBLE AS n, (SELECT count(*) FROM {MIXED})::DOUBLE AS t
 FROM {MIXED} WHERE flag IS NOT NULL GROUP BY flag))"""
MUTUAL = f"""(WITH j AS (SELECT flag, l_linestatus AS s, count(*)::DOUBLE AS n FROM {MIXED} GROUP BY ALL),
 t AS (SELECT sum(n) AS t FROM j), x AS (SELECT flag, sum(n) AS nx FROM j GROUP BY flag), y AS (SELECT s, sum(n) AS ny FROM j GROUP BY s)
 SELECT sum(n / t * ln((n / t) / ((nx / t) * (ny / t)))) FROM j JOIN x ON j.flag = x.flag JOIN y ON j.s = y.s, t)"""


def _class_sql(c: str) -> str:
    return (
        f"CASE WHEN {c} IS NULL THEN 'null' WHEN regexp_matches({c}, '^[-+]? ?([0-9]+\\.[0-9]*|\\.[0-9]+)$') THEN 'fractional' "
        f"WHEN regexp_matches({c}, '^[-+]? ?[0-9]+$') THEN 'integral' WHEN {c} IN ('true', 'false') THEN 'boolean' ELSE 'string' END"
    )


def _type_share(kind: str, filled: bool) -> str:
    where = "WHERE txt IS NOT NULL" if filled else ""
    return f"(SELECT avg((k IN ({kind}))::INT) FROM (SELECT {_class_sql('txt')} AS k FROM {MIXED} {where}))"


def _from(expr: str) -> str:
    return f"(SELECT {expr} FROM {MIXED})"


# id: (entity, instance, name, metric, SQL of its value)
ANALYZERS = {
    "a01_size": ("Dataset", "*", "Size", lambda: a.size(), _from("count(*)")),
    "a02_completeness": ("Column", "flag", "Completeness", lambda: a.completeness("flag"), _from("count(flag) / count(*)")),
    "a03_compliance": ("Column", "large", "Compliance", lambda: a.compliance("large", "qty > 30"), _from("avg(coalesce((qty > 30)::INT, 0))")),
    "a05_count_distinct": ("Multicolumn", "flag,qty", "CountDistinct", lambda: a.count_distinct(["flag", "qty"]), _freq("flag, qty", DISTINCT)),
    "a07_correlation": ("Multicolumn", "qty,l_extendedprice", "Correlation", lambda: a.correlation("qty", "l_extendedprice"), _from("corr(qty, l_extendedprice)")),
    "a09_distinctness": ("Multicolumn", "flag,qty,l_tax", "Distinctness", lambda: a.distinctness(["flag", "qty", "l_tax"]), _freq("flag, qty, l_tax", f"{DISTINCT} / sum(n)")),
    "a10_uniqueness": ("Multicolumn", "l_orderkey,l_linenumber", "Uniqueness", lambda: a.uniqueness(["l_orderkey", "l_linenumber"]), _freq("l_orderkey, l_linenumber", f"{ONCE} / sum(n)")),
    "a11_unique_value_ratio": ("Column", "l_extendedprice", "UniqueValueRatio", lambda: a.unique_value_ratio("l_extendedprice"), _freq("l_extendedprice", f"{ONCE} / {DISTINCT}")),
    "a12_entropy": ("Column", "flag", "Entropy", lambda: a.entropy("flag"), ENTROPY),
    "a13_mutual_information": ("Multicolumn", "flag,l_linestatus", "MutualInformation", lambda: a.mutual_information("flag", "l_linestatus"), MUTUAL),
    "a15_maximum": ("Column", "qty", "Maximum", lambda: a.maximum("qty"), _from("max(qty)")),
    "a16_minimum": ("Column", "qty", "Minimum", lambda: a.minimum("qty"), _from("min(qty)")),
    "a17_max_length": ("Column", "txt", "MaxLength", lambda: a.max_length("txt"), _from("max(length(txt))")),
    "a18_min_length": ("Column", "txt", "MinLength", lambda: a.min_length("txt"), _from("min(length(txt))")),
    "a19_mean": ("Column", "qty", "Mean", lambda: a.mean("qty"), _from("avg(qty)")),
    "a20_sum": ("Column", "l_extendedprice", "Sum", lambda: a.total("l_extendedprice"), _from("sum(l_extendedprice)")),
    "a21_standard_deviation": ("Column", "qty", "StandardDeviation", lambda: a.standard_deviation("qty"), _from("stddev_pop(qty)")),
}


def _one_metric(metric):
    def run(t: Tables):
        return a.analyze(_mixed(t), [metric()]).withColumn("value", F.round("value", 6))

    return run


def _metric_sql(entity: str, instance: str, name: str, value: str) -> str:
    return f"SELECT '{entity}' AS entity, '{instance}' AS instance, '{name}' AS name, round(({value})::DOUBLE, 6) AS value"


for _id, (_entity, _instance, _name, _metric, _value) in ANALYZERS.items():
    plan(_id, _metric_sql(_entity, _instance, _name, _value))(_one_metric(_metric))


def _is_near(value, exact, share: float):
    return F.abs(value - exact) <= share * exact


def _ranks_near(got, df, column: str, ranks: dict[str, float], off: float = 0.02):
    """Rows (name, n, is_near): whether the share of rows below and up to each value is near its rank, among ``n`` filled rows.

    The values are few; every row is placed among them, and only the numbers of rows per place are added up.
    """
    listed = got.agg(F.array_sort(F.collect_list(F.struct("value", "name")))).scalar()
    x, last = F.col(f"`{column}`"), len(ranks)
    value = lambda i: F.get("listed", F.lit(i))["value"]

    def place_of(before, low: int, high: int):
        """How many of the values from ``low`` to ``high`` are not ahead of x, found by halves."""
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(before(value(middle)), place_of(before, low, middle)).otherwise(place_of(before, middle + 1, high))

    below, upto = place_of(lambda v: x < v, 0, last), place_of(lambda v: x <= v, 0, last)
    places = df.where(x.isNotNull()).select(x, listed.alias("listed")).select(below.alias("p"), upto.alias("q"))
    placed = places.groupBy("p", "q").agg(F.count(F.lit(1)).alias("n"))
    counts = placed.agg(F.collect_list(F.struct("p", "q", "n"))).scalar()
    held = lambda side: F.aggregate(
        F.filter("counts", lambda c: c[side] <= F.col("place")), F.lit(0).cast("long"), lambda total, c: total + c["n"])
    rank = F.element_at(F.create_map(*[F.lit(v) for pair in ranks.items() for v in pair]), F.col("name"))
    n = F.aggregate("counts", F.lit(0).cast("long"), lambda total, c: total + c["n"])
    near = (held("p") <= (rank + off) * n) & (held("q") >= (rank - off) * n)
    known = got.withColumns({"listed": listed, "counts": counts})
    known = known.withColumn("place", F.array_position(F.transform("listed", lambda v: v["name"]), F.col("name")) - 1)
    return known.select("name", n.alias("n"), near.alias("is_near"))


@plan("a04_approx_count_distinct", " UNION ALL ".join(
    f"SELECT '{c}' AS instance, 'ApproxCountDistinct' AS name, (SELECT count(DISTINCT {c}) FROM {MIXED}) AS exact, true AS is_near"
    for c in ("l_orderkey", "flag")))
def approx_distinct(t: Tables):
    df = _mixed(t)
    one = lambda c: df.agg(F.countDistinct(c)).scalar()
    got = a.analyze(df, [a.approx_count_distinct("l_orderkey"), a.approx_count_distinct("flag")])
    got = got.withColumn("exact", F.when(F.col("instance") == "flag", one("flag")).otherwise(one("l_orderkey")))
    return got.select("instance", "name", "exact", _is_near(F.col("value"), F.col("exact"), 0.1).alias("is_near"))


QUANTILES = (0.1, 0.5, 0.9)


@plan("a06_approx_quantile", " UNION ALL ".join(
    f"SELECT 'ApproxQuantile-{q}' AS name, count(l_extendedprice) AS n, round(quantile_cont(l_extendedprice, {q}), 4) AS exact, true AS is_near FROM {MIXED}"
    for q in QUANTILES))
def approx_quantile(t: Tables):
    df = _mixed(t)
    got = a.analyze(df, [a.approx_quantile("l_extendedprice", q) for q in QUANTILES])
    near = _ranks_near(got.select("name", "value"), df, "l_extendedprice", {f"ApproxQuantile-{q}": q for q in QUANTILES})
    exact = quantiles(df, ["l_extendedprice"], QUANTILES).select(
        F.concat(F.lit("ApproxQuantile-"), F.col("share").cast("string")).alias("name"), F.round("value", 4).alias("exact"))
    return near.join(F.broadcast(exact), "name", "left").select("name", "n", "exact", "is_near")


@plan("a06_quantile_values")
def quantile_values(t: Tables):
    return a.analyze(_mixed(t), [a.approx_quantile("l_extendedprice", q) for q in QUANTILES])


@plan("a08_data_type", " UNION ALL ".join(
    f"SELECT 'Column' AS entity, 'txt' AS instance, 'DataType.{k}' AS name, "
    f"round((SELECT avg((k = '{k}')::INT) FROM (SELECT {_class_sql('txt')} AS k FROM {MIXED})), 6) AS value"
    for k in a.CLASSES
))
def data_type(t: Tables):
    return a.analyze(_mixed(t), [a.data_type("txt")]).withColumn("value", F.round("value", 6))


@plan("a14_histogram", f"""
SELECT coalesce(qty::VARCHAR, 'NullValue') AS value, count(*) AS count,
  round(count(*) / (SELECT count(*) FROM lineitem), 8) AS ratio FROM {MIXED} GROUP BY 1""")
def histogram(t: Tables):
    return a.histogram(_mixed(t), "qty").withColumn("ratio", F.round("ratio", 8))


@plan("a22_analysis_run", " UNION ALL ".join(_metric_sql(e, i, n, v) for e, i, n, _, v in ANALYZERS.values()))
def analysis_run(t: Tables):
    return a.analyze(_mixed(t), [metric() for *_, metric, _ in ANALYZERS.values()]).withColumn("value", F.round("value", 6))


@plan("a22_states_of_batches", " UNION ALL ".join(_metric_sql(e, i, n, v) for e, i, n, _, v in ANALYZERS.values()))
def states_of_batches(t: Tables):
    """As before, from the states of four batches, none of which is read again; the last one is empty."""
    store = MetricStore(t.spark, t.scratch("states"), [metric() for *_, metric, _ in ANALYZERS.values()])
    for batch in range(4):
        store.add(_mixed(t).where(F.col("l_orderkey") % 3 == batch), batch)
    return store.read().withColumn("value", F.round("value", 6))


# ---- checks

IN_ROWS = "avg(coalesce(({})::INT, 0))"


def _share(cond: str) -> str:
    return _from(IN_ROWS.format(cond))


# id: (builder, constraint, SQL of the value, SQL of the assertion)
CHECKS = {
    "x01_has_size": (lambda c: c.has_size(lambda v: v > 1000), "Size(*)", _from("count(*)"), "v > 1000"),
    "x02_is_unique": (lambda c: c.is_unique("l_extendedprice"), "Uniqueness(l_extendedprice)", _freq("l_extendedprice", f"{ONCE} / sum(n)"), "v = 1"),
    "x03_has_completeness": (lambda c: c.has_completeness("flag", lambda v: v >= 0.8), "Completeness(flag)", _from("count(flag) / count(*)"), "v >= 0.8"),
    "x04_has_uniqueness": (lambda c: c.has_uniqueness(["l_orderkey", "l_linenumber"], lambda v: v > 0.5), "Uniqueness(l_orderkey,l_linenumber)", _freq("l_orderkey, l_linenumber", f"{ONCE} / sum(n)"), "v > 0.5"),
    "x05_has_distinctness": (lambda c: c.has_distinctness(["flag", "qty"], lambda v: v < 0.01), "Distinctness(flag,qty)", _freq("flag, qty", f"{DISTINCT} / sum(n)"), "v < 0.01"),
    "x06_has_unique_value_ratio": (lambda c: c.has_unique_value_ratio("l_extendedprice", lambda v: v > 0.9), "UniqueValueRatio(l_extendedprice)", _freq("l_extendedprice", f"{ONCE} / {DISTINCT}"), "v > 0.9"),
    "x07_has_number_of_distinct_values": (lambda c: c.has_number_of_distinct_values("flag", lambda v: v == 4), "HistogramBins(flag)", _freq("flag", "count(*)"), "v = 4"),
    "x08_has_histogram_values": (lambda c: c.has_histogram_value("flag", "R", lambda v: v < 0.5), "Histogram(flag,R,ratio)", _share("flag = 'R'"), "v < 0.5"),
    "x09_has_entropy": (lambda c: c.has_entropy("flag", lambda v: v > 0.5), "Entropy(flag)", ENTROPY, "v > 0.5"),
    "x10_has_mutual_information": (lambda c: c.has_mutual_information("flag", "l_linestatus", lambda v: v < 0.5), "MutualInformation(flag,l_linestatus)", MUTUAL, "v < 0.5"),
    "x12_has_min_length": (lambda c: c.has_min_length("txt", lambda v: v == 1), "MinLength(txt)", _from("min(length(txt))"), "v = 1"),
    "x13_has_max_length": (lambda c: c.has_max_length("txt", lambda v: v == 3), "MaxLength(txt)", _from("max(length(txt))"), "v = 3"),
    "x14_has_min": (lambda c: c.has_min("qty", lambda v: v == 6), "Minimum(qty)", _from("min(qty)"), "v = 6"),
    "x15_has_max": (lambda c: c.has_max("qty", lambda v: v <= 50), "Maximum(qty)", _from("max(qty)"), "v <= 50"),
    "x16_has_mean": (lambda c: c.has_mean("qty", lambda v: (v > 10) & (v < 20)), "Mean(qty)", _from("avg(qty)"), "v > 10 AND v < 20"),
    "x17_has_sum": (lambda c: c.has_sum("l_quantity", lambda v: v > 0), "Sum(l_quantity)", _from("sum(l_quantity)"), "v > 0"),
    "x18_has_standard_deviation": (lambda c: c.has_standard_deviation("qty", lambda v: v < 20), "StandardDeviation(qty)", _from("stddev_pop(qty)"), "v < 20"),
    "x20_has_correlation": (lambda c: c.has_correlation("qty", "l_tax", lambda v: v == 1), "Correlation(qty,l_tax)", _from("corr(qty, l_tax)"), "v = 1"),
    "x21_satisfies": (lambda c: c.satisfies("qty > 30", "large", lambda v: v > 0.1), "Compliance(large)", _share("qty > 30"), "v > 0.1"),
    "x22_has_pattern": (lambda c: c.has_pattern("txt", "^[ANR]$", lambda v: v < 1), "Compliance(txt like ^[ANR]$)", _share("regexp_matches(txt, '^[ANR]$')"), "v < 1"),
    "x23_has_data_type": (lambda c: c.has_data_type("txt", "numeric", lambda v: v > 0.9), "DataType.numeric(txt)", _type_share("'fractional', 'integral'", True), "v > 0.9"),
    "x24_is_positive": (lambda c: c.is_positive("l_tax"), "Compliance(l_tax > 0)", _share("coalesce(l_tax, 1) > 0"), "v = 1"),
    "x25_is_non_negative": (lambda c: c.is_non_negative("qty"), "Compliance(qty >= 0)", _share("coalesce(qty, 0) >= 0"), "v = 1"),
    "x26_is_less_than": (lambda c: c.is_less_than("l_discount", "l_tax", lambda v: v > 0.2), "Compliance(l_discount < l_tax)", _share("l_discount < l_tax"), "v > 0.2"),
    "x27_is_less_than_or_equal_to": (lambda c: c.is_less_than_or_equal_to("qty", "l_quantity"), "Compliance(qty <= l_quantity)", _share("qty <= l_quantity"), "v = 1"),
    "x28_is_greater_than": (lambda c: c.is_greater_than("l_extendedprice", "qty", lambda v: v > 0.8), "Compliance(l_extendedprice > qty)", _share("l_extendedprice > qty"), "v > 0.8"),
    "x29_is_greater_than_or_equal_to": (lambda c: c.is_greater_than_or_equal_to("l_quantity", "qty"), "Compliance(l_quantity >= qty)", _share("l_quantity >= qty"), "v = 1"),
    "x30_is_contained_in": (lambda c: c.is_contained_in("flag", ["A", "N", "R"]), "Compliance(flag in A,N,R)", _share("flag IS NULL OR flag IN ('A', 'N', 'R')"), "v = 1"),
    "x31_is_in_interval": (lambda c: c.is_in_interval("qty", 6, 50, True, False), "Compliance(qty in [6;50))", _share("qty IS NULL OR (qty >= 6 AND qty < 50)"), "v = 1"),
}


def _check_sql(name: str, level: str, rows: list[tuple[str, str, str]]) -> str:
    values = " UNION ALL ".join(
        f"SELECT '{c}' AS c, ({v})::DOUBLE AS v" for c, v, _ in rows
    )
    ok = " ".join(f"WHEN c = '{c}' THEN {cond}" for c, _, cond in rows)
    return f"""
WITH m AS ({values}), s AS (SELECT c, v, coalesce(CASE {ok} END, false) AS ok FROM m)
SELECT '{name}' AS "check", '{level}' AS check_level,
  CASE WHEN bool_and(ok) OVER () THEN 'Success' ELSE '{level}' END AS check_status,
  c AS "constraint", CASE WHEN ok THEN 'Success' ELSE 'Failure' END AS constraint_status, round(v, 6) AS value FROM s"""


def _verified(df):
    return df.drop("constraint_message").withColumn("value", F.round("value", 6))


def _one_check(build):
    def run(t: Tables):
        return _verified(x.verify(_mixed(t), [build(x.Check("warning", "single"))]))

    return run


for _id, (_build, _name, _value, _cond) in CHECKS.items():
    plan(_id, _check_sql("single", "Warning", [(_name, _value, _cond)]))(_one_check(_build))


def _judged(df):
    return df.drop("constraint_message", "value")


def _judged_sql(name: str, constraint: str, value: str, cond: str) -> str:
    return f"SELECT * EXCLUDE (value) FROM ({_check_sql(name, 'Error', [(constraint, value, cond)])})"


@plan("x11_has_approx_quantile", _judged_sql("quantile", "ApproxQuantile-0.5(qty)", _from("quantile_disc(qty, 0.5)"), "v > 5"))
def has_approx_quantile(t: Tables):
    return _judged(x.verify(_mixed(t), [x.Check("error", "quantile").has_approx_quantile("qty", 0.5, lambda v: v > 5)]))


@plan("x19_has_approx_count_distinct", _judged_sql("distinct", "ApproxCountDistinct(l_orderkey)", _from("count(DISTINCT l_orderkey)"), "v > 10"))
def has_approx_count_distinct(t: Tables):
    return _judged(x.verify(_mixed(t), [x.Check("error", "distinct").has_approx_count_distinct("l_orderkey", lambda v: v > 10)]))


@plan("x37_equal_labels_and_names", f"""
WITH s AS (SELECT avg((l_quantity >= 1)::INT) AS a, avg((l_quantity < 25)::INT) AS b, sum(9000000000000000000::DOUBLE) AS total FROM {MIXED}),
v AS (SELECT 'Compliance(rule)' AS c, 'Error' AS level, a = 1 AS ok, a AS v FROM s
  UNION ALL SELECT 'Compliance(rule)', 'Error', b = 1, b FROM s
  UNION ALL SELECT 'Maximum(l_linestatus)', 'Warning', false, NULL FROM s
  UNION ALL SELECT 'Sum(big)', 'Warning', total > 9.3e18, NULL FROM s)
SELECT c AS "constraint", level AS check_level, CASE WHEN ok AND level = 'Error' THEN 'Success' ELSE level END AS check_status,
  CASE WHEN ok THEN 'Success' ELSE 'Failure' END AS constraint_status, round(v, 6) AS value FROM v""")
def equal_labels_and_names(t: Tables):
    df = _mixed(t).withColumn("big", F.lit(9 * 10**18).cast("long"))
    good = x.Check("error", "same").satisfies("l_quantity >= 1", "rule")
    bad = x.Check("error", "same").satisfies("l_quantity < 25", "rule")
    odd = x.Check("warning", "same").has_max("l_linestatus", lambda v: v > 0).has_sum("big", lambda v: v > 9.3e18)
    out = x.verify(df, [good, bad, odd])
    value = F.when(F.col("constraint") != "Sum(big)", F.round("value", 6))
    return out.select("constraint", "check_level", "check_status", "constraint_status", value.alias("value"))


@plan("x32_all_between", _check_sql("fan", "Error", [
    ("Compliance(Is between l_discount:0-0.05)", _share("l_discount BETWEEN 0 AND 0.05"), "v >= 0.4"),
    ("Compliance(Is between qty:0-0.05)", _share("qty BETWEEN 0 AND 0.05"), "v >= 0.4"),
    ("Compliance(Is between qty:0-60)", _share("qty IS NULL OR qty BETWEEN 0 AND 60"), "v = 1")]))
def all_between(t: Tables):
    check = x.Check("error", "fan").all_between(["l_discount", "qty"], 0, 0.05, holds=x.assertion("gte", 0.4))
    return _verified(x.verify(_mixed(t), [check.all_between(["qty"], 0, 60, "discard")]))


@plan("x33_have_completeness", _check_sql("fan", "Error", [
    ("Completeness(flag)", _from("count(flag) / count(*)"), "v BETWEEN 0.5 AND 1"),
    ("Completeness(txt)", _from("count(txt) / count(*)"), "v BETWEEN 0.5 AND 1")]))
def have_completeness(t: Tables):
    check = x.Check("error", "fan").have_completeness(["flag", "txt"], x.assertion("between", lower=0.5, upper=1))
    return _verified(x.verify(_mixed(t), [check]))


@plan("x34_all_positives", _check_sql("fan", "Warning", [
    ("Compliance(l_tax > 0)", _share("l_tax > 0"), "v = 1"), ("Compliance(l_quantity > 0)", _share("l_quantity > 0"), "v = 1")]))
def all_positives(t: Tables):
    return _verified(x.verify(_mixed(t), [x.Check("warning", "fan").all_positives(["l_tax", "l_quantity"])]))


@plan("x35_all_non_negatives", _check_sql("fan", "Warning", [
    ("Compliance(l_tax >= 0)", _share("l_tax >= 0"), "v = 1"), ("Compliance(qty >= 0)", _share("coalesce(qty, 0) >= 0"), "v = 1")]))
def all_non_negatives(t: Tables):
    return _verified(x.verify(_mixed(t), [x.Check("warning", "fan").all_non_negatives(["l_tax", "qty"])]))


@plan("x36_verification_run", _check_sql("everything", "Error", [(n, v, c) for _, n, v, c in CHECKS.values()]))
def verification_run(t: Tables):
    check = x.Check("error", "everything")
    for build, *_ in CHECKS.values():
        check = build(check)
    return _verified(x.verify(_mixed(t), [check]))


# ---- profiles and suggestions

PROFILE_COLUMNS = ["flag", "qty", "l_linenumber", "l_linestatus", "num"]


def _profiled(t: Tables):
    return _mixed(t).withColumn("num", F.col("l_quantity").cast("int").cast("string"))


def _profile_sql() -> str:
    src = f"(SELECT *, l_quantity::INT::VARCHAR AS num FROM {MIXED})"
    kinds = {"flag": "String", "qty": "Fractional", "l_linenumber": "Integral", "l_linestatus": "String", "num": "Integral"}
    rows = []
    for c, kind in kinds.items():
        inferred = c in ("flag", "l_linestatus", "num")
        x_ = f"{c}::DOUBLE" if kind != "String" else "NULL::DOUBLE"
        rows.append(
            f"SELECT '{c}' AS \"column\", '{kind}' AS \"dataType\", {str(inferred).lower()} AS \"isDataTypeInferred\", "
            f"round(count({c}) / count(*), 6) AS completeness, round(avg({x_}), 6) AS mean_col, max({x_}) AS maximum, "
            f"min({x_}) AS minimum, sum({x_}) AS sum_col, round(stddev_pop({x_}), 6) AS \"stdDev_col\", "
            f"'db' AS database, 'items' AS \"table\" FROM {src}"
        )
    return " UNION ALL ".join(rows)


@plan("p01_column_profile", _profile_sql())
def column_profile(t: Tables):
    out = pr.profile(_profiled(t), "db", "items", columns=PROFILE_COLUMNS)
    # Approximate figures are tested elsewhere.
    out = out.drop("timestamp", "approximateNumDistinctValues", "approxQ1", "approxQ2", "approxQ3")
    return out.withColumns({c: F.round(c, 6) for c in ("completeness", "mean_col", "stdDev_col")})


FULL = {"o_orderkey": "Integral", "o_custkey": "Integral", "o_orderstatus": "String", "o_totalprice": "Fractional", "o_orderpriority": "String"}


@plan("p01_column_profile_full", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", '{kind}' AS \"dataType\", count({c}) / count(*) AS completeness, count(DISTINCT {c}) AS exact, true AS is_near FROM orders"
    for c, kind in FULL.items()))
def column_profile_full(t: Tables):
    exact = t.orders.agg(*[F.countDistinct(c).alias(c) for c in FULL]).unpivot([], list(FULL), "column", "exact")
    got = pr.profile(t.orders, "db", "orders").join(exact, "column")
    near = _is_near(F.col("approximateNumDistinctValues"), F.col("exact"), 0.1)
    return got.select("column", "dataType", "completeness", "exact", near.alias("is_near"))


@plan("p02_percentiles", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, 100 AS percentiles, count({c}) AS n, true AS is_near FROM (SELECT *, l_quantity::INT::VARCHAR AS num FROM {MIXED})"
    for c in ("qty", "l_extendedprice", "num")))
def percentiles(t: Tables):
    out, df = None, _profiled(t)
    got = staged(pr.percentile_table(df, ["qty", "l_extendedprice", "num"]), "percentiles")
    for c in ("qty", "l_extendedprice", "num"):
        own = got.where(F.col("column_name") == c).select(F.col("value_float").cast("int").cast("string").alias("name"), F.col("count_col").alias("value"))
        near = _ranks_near(own, df.withColumn(c, F.col(c).cast("double")), c, {str(i): i / 100 for i in range(1, 101)})
        one = near.agg(F.lit(c).alias("column_name"), F.count(F.lit(1)).cast("int").alias("percentiles"), F.max("n").alias("n"), F.bool_and("is_near").alias("is_near"))
        out = one if out is None else out.unionByName(one)
    return out


@plan("p02_percentile_rows")
def percentile_rows(t: Tables):
    return pr.percentile_table(_profiled(t), ["qty", "l_extendedprice", "num"])


@plan("p03_histograms", f"""
SELECT 'flag' AS column_name, 'category' AS metric_type, coalesce(flag, 'NullValue') AS value_str, NULL::DOUBLE AS value_float,
  count(*)::DOUBLE AS count_col, round(count(*) / (SELECT count(*) FROM lineitem), 8) AS ratio FROM {MIXED} GROUP BY flag
UNION ALL SELECT 'qty', 'histogram', CASE WHEN qty IS NULL THEN 'NullValue' ELSE '' END, qty, count(*)::DOUBLE,
  round(count(*) / (SELECT count(*) FROM lineitem), 8) FROM {MIXED} GROUP BY qty
UNION ALL SELECT 'l_orderkey', 'histogram', '', l_orderkey::DOUBLE, count(*)::DOUBLE,
  round(count(*) / (SELECT count(*) FROM lineitem), 8) FROM {MIXED} GROUP BY l_orderkey
UNION ALL SELECT 'l_extendedprice', 'histogram', '', l_extendedprice, count(*)::DOUBLE,
  round(count(*) / (SELECT count(*) FROM lineitem), 8) FROM {MIXED} GROUP BY l_extendedprice""")
def histograms(t: Tables):
    out = pr.histogram_table(_mixed(t), ["flag", "qty", "l_orderkey", "l_extendedprice"])
    return out.withColumn("ratio", F.round("ratio", 8))


@plan("p04_mergeable_sketches", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, '{q}' AS name, count({c}) AS n, round(quantile_cont({c}, {q}), 4) AS exact, true AS is_near FROM lineitem"
    for c in ("l_quantity", "l_extendedprice") for q in (0.25, 0.5, 0.75)))
def mergeable_sketches(t: Tables):
    sketches = pr.sketch(t.lineitem, ["l_returnflag", "l_linestatus"], ["l_quantity", "l_extendedprice"])
    got = staged(pr.merge_sketches(sketches, ["l_quantity", "l_extendedprice"], [0.25, 0.5, 0.75]), "quantiles")
    out = None
    for c in ("l_quantity", "l_extendedprice"):
        own = got.where(F.col("column_name") == c).select(F.col("quantile").cast("string").alias("name"), "value")
        near = _ranks_near(own, t.lineitem, c, {str(q): q for q in (0.25, 0.5, 0.75)}).withColumn("column_name", F.lit(c))
        out = near if out is None else out.unionByName(near)
    exact = quantiles(t.lineitem, ["l_quantity", "l_extendedprice"], [0.25, 0.5, 0.75]).select(
        "column_name", F.col("share").cast("string").alias("name"), F.round("value", 4).alias("exact"))
    return out.join(F.broadcast(exact), ["column_name", "name"], "left").select("column_name", "name", "n", "exact", "is_near")


@plan("p04_sketch_rows")
def sketch_rows(t: Tables):
    sketches = pr.sketch(t.lineitem, ["l_returnflag", "l_linestatus"], ["l_quantity", "l_extendedprice"])
    return pr.merge_sketches(sketches, ["l_quantity", "l_extendedprice"], [0.25, 0.5, 0.75])


G_SOURCE = """(SELECT o_orderkey, o_totalprice, CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS priority, o_orderstatus AS status,
 CASE WHEN o_orderkey = 3 THEN 'odd' WHEN o_orderpriority = '1-URGENT' THEN 'rush' ELSE 'calm' END AS pace, year(o_orderdate)::VARCHAR AS y FROM orders)"""


def _suggest_source(t: Tables):
    return t.orders.select(
        "o_orderkey", "o_totalprice", F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).alias("priority"),
        F.col("o_orderstatus").alias("status"),
        F.when(F.col("o_orderkey") == 3, "odd").when(F.col("o_orderpriority") == "1-URGENT", "rush").otherwise("calm").alias("pace"),
        F.year("o_orderdate").cast("string").alias("y"),
    )


def _suggest(rule: str):
    def run(t: Tables):
        return g.suggest(_suggest_source(t), [rule])

    return run


def _list_sql(col: str, having: str = "") -> str:
    return f"(SELECT string_agg('''' || v || '''', ', ' ORDER BY n DESC, v) FROM (SELECT {col} AS v, count(*) AS n FROM {G_SOURCE} WHERE {col} IS NOT NULL GROUP BY 1) {having})"


G_COLUMNS = ("o_orderkey", "o_totalprice", "priority", "status", "pace", "y")
SHARES = " UNION ALL ".join(f"SELECT '{c}' AS c, count({c}) / count(*) AS share, min(TRY_CAST({c} AS DOUBLE)) AS low, count(TRY_CAST({c} AS DOUBLE)) / count({c}) AS numeric FROM {G_SOURCE}" for c in G_COLUMNS)
COMPLETE_SQL = "SELECT c AS \"column\", 'CompleteIfComplete' AS rule, '''' || c || ''' is not null' AS \"constraint\", '.is_complete(\"' || c || '\")' AS code FROM (" + SHARES + ") WHERE share = 1"
RETAIN_SQL = f"""SELECT 'priority' AS "column", 'RetainCompleteness' AS rule, 'completeness of ''priority'' is at least ' || b AS "constraint",
 '.has_completeness("priority", lambda x: x >= ' || b || ')' AS code
FROM (SELECT printf('%.2f', floor((p - 1.96 * sqrt(p * (1 - p) / n)) * 100) / 100) AS b FROM (SELECT count(priority) / count(*) AS p, count(*) AS n FROM {G_SOURCE}))"""
TYPE_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", 'RetainType' AS rule, '''{c}'' has type ' || kind AS \"constraint\", '.has_data_type(\"{c}\", \"' || code || '\")' AS code "
    f"FROM (SELECT CASE WHEN bool_and(regexp_matches({c}, '^[-+]? ?[0-9]+$')) THEN 'Integral' WHEN bool_and(regexp_matches({c}, '^[-+]? ?([0-9]+|[0-9]+\\.[0-9]*|\\.[0-9]+)$')) THEN 'Fractional' "
    f"WHEN bool_and({c} IN ('true', 'false')) THEN 'Boolean' END AS kind, CASE kind WHEN 'Integral' THEN 'integer' ELSE lower(kind) END AS code FROM {G_SOURCE}) WHERE kind IS NOT NULL"
    for c in ("priority", "status", "pace", "y")
)
NONNEG_SQL = "SELECT c AS \"column\", 'NonNegativeNumbers' AS rule, '''' || c || ''' has no negative values' AS \"constraint\", '.is_non_negative(\"' || c || '\")' AS code FROM (" + SHARES + ") WHERE numeric = 1 AND low >= 0"
RANGE_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", 'CategoricalRange' AS rule, '''{c}'' has value range ' || l AS \"constraint\", '.is_contained_in(\"{c}\", [' || l || '])' AS code FROM (SELECT {_list_sql(c)} AS l)"
    for c in ("priority", "status")
)


def _fraction_sql(c: str) -> str:
    counts = f"(SELECT {c} AS v, count(*) AS n, (SELECT count(*) FROM orders) AS t FROM {G_SOURCE} WHERE {c} IS NOT NULL GROUP BY 1)"
    ranked = f"(SELECT v, n, t, coalesce(sum(n) OVER (ORDER BY n DESC, v ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b, avg((n = 1)::INT) OVER () AS once FROM {counts})"
    return f"""SELECT '{c}' AS "column", 'FractionalCategoricalRange' AS rule,
 '''{c}'' has value range ' || l || ' for at least ' || w || ' of the rows' AS "constraint",
 '.is_contained_in("{c}", [' || l || '], lambda x: x >= ' || w || ')' AS code
FROM (SELECT l, printf('%.2f', floor((p - 1.96 * sqrt(p * (1 - p) / t)) * 100) / 100) AS w FROM (
  SELECT string_agg('''' || v || '''', ', ' ORDER BY n DESC, v) AS l, sum(n) / max(t) AS p, max(t) AS t, max(once) AS once
  FROM {ranked} WHERE b < 0.9 * t) WHERE p < 1 AND once <= 0.4)"""


FRACTION_SQL = " UNION ALL ".join(_fraction_sql(c) for c in ("priority", "status", "pace"))
SUGGESTIONS = {
    "g01_complete_if_complete": ("CompleteIfComplete", COMPLETE_SQL),
    "g02_retain_completeness": ("RetainCompleteness", RETAIN_SQL),
    "g03_retain_type": ("RetainType", TYPE_SQL),
    "g04_categorical_range": ("CategoricalRange", RANGE_SQL),
    "g05_fractional_categorical_range": ("FractionalCategoricalRange", FRACTION_SQL),
    "g06_non_negative_numbers": ("NonNegativeNumbers", NONNEG_SQL),
}
for _id, (_rule, _sql) in SUGGESTIONS.items():
    plan(_id, _sql)(_suggest(_rule))


def _values_sql(c: str) -> str:
    counts = f"(SELECT {c} AS v, count(*) AS n, (SELECT count(*) FROM orders) AS t FROM {G_SOURCE} WHERE {c} IS NOT NULL GROUP BY 1)"
    ranked = f"""(SELECT v, n, t, row_number() OVER (ORDER BY n DESC, v) AS rank, avg((n = 1)::INT) OVER () AS once,
      coalesce(sum(n) OVER (ORDER BY n DESC, v ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) < 0.9 * t AS top FROM {counts})"""
    named = f"(SELECT *, sum(CASE WHEN top THEN n ELSE 0 END) OVER () < t AS short FROM {ranked})"
    return f"""SELECT '{c}' AS "column", rule, rank, v AS value, n FROM {named}, (VALUES ('CategoricalRange'), ('FractionalCategoricalRange')) r(rule)
WHERE CASE WHEN rule = 'CategoricalRange' THEN once <= 0.1 ELSE once <= 0.4 AND short AND top END"""


@plan("g08_suggested_values", " UNION ALL ".join(_values_sql(c) for c in ("priority", "status", "pace")))
def suggested_values(t: Tables):
    return g.suggested_values(_suggest_source(t))


@plan("g07_suggestion_run", " UNION ALL ".join(f"SELECT * FROM ({s})" for _, s in SUGGESTIONS.values()))
def suggestion_run(t: Tables):
    return g.suggest(_suggest_source(t))


# ---- reconciliation

LABELS = r.Labels("sales", "load", "raw/orders", "dwh/lineitem")
LABEL_SQL = "'sales' AS pipeline_name, 'load' AS glue_name, 'raw/orders' AS source_location, 'dwh/lineitem' AS target_location"


@plan("r01_count_reconciliation", f"""
SELECT {LABEL_SQL}, s::VARCHAR AS source_count, t::VARCHAR AS target_count, '' AS measure_column,
  CASE WHEN s = t THEN 'Y' ELSE 'N' END AS match_flag, 'N' AS notification_sent
FROM (SELECT (SELECT count(*) FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)) AS s,
             (SELECT count(DISTINCT l_orderkey) FROM lineitem WHERE l_quantity > 0) AS t)""")
def count_reconciliation(t: Tables):
    src = t.orders.join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey"), "left_semi")
    tgt = t.lineitem.where("l_quantity > 0").select("l_orderkey").distinct()
    return r.reconcile_counts(src, tgt, LABELS).drop("reconc_ts")


MEASURES_SQL = f"""
SELECT {LABEL_SQL}, printf('%.2f', s) AS source_count, printf('%.2f', t) AS target_count, c AS measure_column,
  CASE WHEN printf('%.2f', s) = printf('%.2f', t) THEN 'Y' ELSE 'N' END AS match_flag, 'N' AS notification_sent
FROM (SELECT 'o_totalprice' AS c, (SELECT sum(o_totalprice) FROM orders) AS s, (SELECT sum(l_extendedprice) FROM lineitem) AS t
      UNION ALL SELECT 'o_orderkey', (SELECT sum(o_orderkey) FROM orders)::DOUBLE, (SELECT sum(DISTINCT l_orderkey) FROM lineitem)::DOUBLE)"""


def _measures(t: Tables):
    first = r.reconcile_measures(t.orders, t.lineitem, [("o_totalprice", "l_extendedprice")], LABELS)
    keys = t.lineitem.select("l_orderkey").distinct()
    return first.unionByName(r.reconcile_measures(t.orders, keys, [("o_orderkey", "l_orderkey")], LABELS))


@plan("r02_measure_reconciliation", MEASURES_SQL)
def measure_reconciliation(t: Tables):
    return _measures(t).drop("reconc_ts")


@plan("r03_pending_results", f"SELECT measure_column, match_flag, notification_sent FROM ({MEASURES_SQL}) UNION ALL SELECT measure_column, match_flag, 'Y' FROM ({MEASURES_SQL})")
def pending_results(t: Tables):
    log = _measures(t)
    cols = ["measure_column", "match_flag", "notification_sent"]
    return r.pending(log, "sales").select(*cols).unionByName(r.mark_sent(log, "sales").select(*cols))


@plan("r04_row_count_metric", "SELECT 'orders' AS step, count(*) AS rows FROM orders WHERE o_orderstatus = 'F'")
def row_count_metric(t: Tables):
    df, seen = r.observe_counts(t.orders.where("o_orderstatus = 'F'"), "orders")
    df.write.format("noop").mode("overwrite").save()
    return t.spark.createDataFrame([("orders", seen.get["rows"])], "step string, rows long")
