"""Plans for row-level validation (V), joins and set operations (J), privacy (PR)."""

from __future__ import annotations

from pyspark.sql import functions as F

from sluice.functions.errors import errors_text
from sluice.operators import joins as j
from sluice.operators import privacy as p
from sluice.operators import validate as v
from sluice.plans.cleansing import GAPS, _gaps
from sluice.plans.registry import Tables, plan


def _out(df, *cols: str):
    return errors_text(df.select(*cols, "errors"))


@plan("v01_mandatory", f"""
SELECT c_custkey, array_to_string(list_filter([
    CASE WHEN coalesce(trim(c_name), '') = '' THEN 'c_name is mandatory' END,
    CASE WHEN coalesce(trim(c_mktsegment), '') = '' THEN 'c_mktsegment is mandatory' END,
    CASE WHEN c_acctbal IS NULL THEN 'c_acctbal is mandatory' END], lambda x: x IS NOT NULL), ', ') AS errors
FROM {GAPS}""")
def mandatory(t: Tables):
    return _out(v.require(_gaps(t), ["c_name", "c_mktsegment", "c_acctbal"]), "c_custkey")


@plan("v02_mandatory_if", """
WITH o AS (SELECT o_orderkey, o_orderpriority, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END AS amount_1,
                  CASE WHEN o_totalprice < 100000 THEN '' ELSE 'x' END AS amount_2 FROM orders)
SELECT o_orderkey, array_to_string(list_filter([
    CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') AND amount_1 IS NULL THEN 'amount_1 is mandatory for this plan type' END,
    CASE WHEN o_orderpriority IN ('1-URGENT', '5-LOW') AND amount_2 = '' THEN 'amount_2 is mandatory for this plan type' END],
    lambda x: x IS NOT NULL), ', ') AS errors FROM o""")
def mandatory_if(t: Tables):
    df = t.orders.select(
        "o_orderkey", "o_orderpriority",
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("amount_1"),
        F.when(F.col("o_totalprice") < 100000, "").otherwise("x").alias("amount_2"),
    )
    urgent = F.col("o_orderpriority") == "1-URGENT"
    rules = t.orders.select(
        "o_orderpriority",
        F.when(urgent, "amount_1,amount_2").when(F.col("o_orderpriority") == "2-HIGH", "amount_1")
        .when(F.col("o_orderpriority") == "5-LOW", "amount_2, other").alias("mandatory_columns"),
    ).distinct()
    return _out(v.require_if(df, rules, ["o_orderpriority"], ["amount_1", "amount_2"]), "o_orderkey")


@plan("v03_lookup", """
SELECT o_orderkey, CASE WHEN coalesce(trim(f), '') <> '' AND f NOT IN (SELECT c_custkey::VARCHAR FROM customer WHERE c_acctbal >= 0)
       THEN 'f is invalid' ELSE '' END AS errors
FROM (SELECT o_orderkey, CASE o_orderstatus WHEN 'P' THEN ' ' ELSE o_custkey::VARCHAR END AS f FROM orders)""")
def lookup(t: Tables):
    df = t.orders.select(
        "o_orderkey", F.when(F.col("o_orderstatus") == "P", " ").otherwise(F.col("o_custkey").cast("string")).alias("f")
    )
    ref = t.customer.where("c_acctbal >= 0").select(F.format_string("%08d", "c_custkey").alias("id"))
    return _out(v.lookup(df, "f", ref, "id"), "o_orderkey")


@plan("v04_conditional_lookup", """
SELECT l_orderkey, l_linenumber, l_partkey,
  CASE WHEN l_returnflag = 'R' AND l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 10)
       THEN 'l_partkey is invalid' ELSE '' END AS errors FROM lineitem""")
def conditional_lookup(t: Tables):
    out = v.conditional_lookup(t.lineitem, "l_partkey", t.part.where("p_size > 10"), "p_partkey", "l_returnflag", "R")
    return _out(out, "l_orderkey", "l_linenumber", "l_partkey")


@plan("v05_lock_date", """
WITH o AS (SELECT *, year(o_orderdate)::INT AS y FROM orders),
lock AS (SELECT y, o_orderpriority, min(o_orderdate::DATE) AS lock_dt FROM o WHERE o_orderstatus = 'F' GROUP BY ALL)
SELECT o.o_orderkey, CASE WHEN lock.lock_dt < DATE '1998-01-03' THEN
  'lock date already passed for this Version and Value Type' ELSE '' END AS errors
FROM o LEFT JOIN lock ON o.y = lock.y AND o.o_orderpriority = lock.o_orderpriority""")
def lock_date(t: Tables):
    df = t.orders.withColumn("y", F.year("o_orderdate"))
    calendar = df.where("o_orderstatus = 'F'").select(
        F.col("y").alias("year"), F.col("o_orderpriority").alias("plan_typ"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("lock_dt"),
    )
    out = v.check_lock(
        df, calendar, [("y", "year"), ("o_orderpriority", "plan_typ")], "lock_dt", F.lit("1998-01-03").cast("date")
    )
    return _out(out, "o_orderkey")


@plan("v06_duplicate_rows", """
SELECT event_id, CASE WHEN count(*) OVER (PARTITION BY user_id, event_type, d) > 1 THEN 'This row has duplicate' ELSE '' END AS errors
FROM (SELECT event_id, user_id, CASE WHEN value > 10 THEN event_type END AS event_type, ts::DATE AS d FROM events)""")
def duplicate_rows(t: Tables):
    df = t.events.select(
        "event_id", "user_id", F.when(F.col("value") > 10, F.col("event_type")).alias("event_type"),
        F.to_date("ts").alias("d"),
    )
    return _out(v.flag_duplicates(df, ["user_id", "event_type", "d"]), "event_id")


@plan("v08_compare_to_owner", """
SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey, CASE WHEN l_returnflag <> 'N' AND s.s_suppkey IS NOT NULL AND s.s_nationkey <> 3
  AND ('N' || (l_linenumber + 10)) <> ('N' || s.s_nationkey) THEN 'nation is not the same as the one of the supplier' ELSE '' END AS errors
FROM lineitem LEFT JOIN supplier s ON l_suppkey = s_suppkey""")
def compare_to_owner(t: Tables):
    df = t.lineitem.withColumn("nation", F.concat(F.lit("N"), (F.col("l_linenumber") + 10).cast("string")))
    owner = F.when(F.col("s_nationkey") == 3, "SAP").otherwise(F.concat(F.lit("SAPN"), F.col("s_nationkey").cast("string")))
    ref = t.supplier.select("s_suppkey", owner.alias("srkey"))
    out = v.check_matches(
        df, ref, "l_suppkey", "s_suppkey", "nation", "srkey", "nation is not the same as the one of the supplier",
        where=F.col("l_returnflag") != "N", prefix="SAP",
    )
    return _out(out, "l_orderkey", "l_linenumber", "l_suppkey", "l_partkey")


# Validity intervals of two to three owners per customer, some overlapping, some across years.
VALIDITY = """
(SELECT c_custkey AS k, '1995-03-01' AS f, '1997-' || lpad((c_nationkey % 12 + 1)::VARCHAR, 2, '0') || '-28' AS t, 'A' || c_nationkey AS val FROM customer
 UNION ALL SELECT c_custkey, '1997-' || lpad((c_nationkey % 12 + 1)::VARCHAR, 2, '0') || '-01', '9999-12-31', 'B' || c_nationkey FROM customer WHERE c_acctbal > 0
 UNION ALL SELECT c_custkey, '1998-02-01', '1998-09-30', 'C' || c_mktsegment FROM customer WHERE c_acctbal > 5000)"""


def _validity(t: Tables):
    month = F.lpad((F.col("c_nationkey") % 12 + 1).cast("string"), 2, "0")
    nation = F.col("c_nationkey").cast("string")
    c = t.customer
    a = c.select(F.col("c_custkey").alias("k"), F.lit("1995-03-01").alias("valid_from"),
                 F.concat(F.lit("1997-"), month, F.lit("-28")).alias("valid_to"), F.concat(F.lit("SAPA"), nation).alias("val"))
    b = c.where("c_acctbal > 0").select(F.col("c_custkey").alias("k"), F.concat(F.lit("1997-"), month, F.lit("-01")).alias("valid_from"),
                 F.lit("9999-12-31").alias("valid_to"), F.concat(F.lit("SAPB"), nation).alias("val"))
    d = c.where("c_acctbal > 5000").select(F.col("c_custkey").alias("k"), F.lit("1998-02-01").alias("valid_from"),
                 F.lit("1998-09-30").alias("valid_to"), F.concat(F.lit("SAPC"), "c_mktsegment").alias("val"))
    return a.unionByName(b).unionByName(d)


PERIODS = """
(SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority, year(o_orderdate) AS y, month(o_orderdate) AS pf, least(12, month(o_orderdate) + 2) AS pt FROM orders)"""


def _periods(t: Tables):
    m = F.month("o_orderdate")
    return t.orders.select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority",
        F.year("o_orderdate").cast("string").alias("fiscal_year"), F.lpad(m.cast("string"), 2, "0").alias("period_from"),
        F.least(F.lit(12), m + 2).cast("string").alias("period_to"),
    )


EFFECTIVE = f"""
(SELECT o.*, (SELECT max_by(r.val, r.f || r.val) FROM {VALIDITY} r WHERE r.k = o.o_custkey
   AND replace(left(r.f, 7), '-', '')::INT <= o.y * 100 + o.pf AND replace(left(r.t, 7), '-', '')::INT >= o.y * 100 + o.pt) AS val
 FROM {PERIODS} o)"""


@plan("v09_effective_lookup", f"SELECT o_orderkey, val FROM {EFFECTIVE}")
def effective_lookup(t: Tables):
    out = v.effective_lookup(
        _periods(t), _validity(t), "o_custkey", "k", "fiscal_year", "period_from", "period_to",
        v.text.after_last(F.col("val"), "SAP"), "val",
    )
    return out.select("o_orderkey", "val")


@plan("v10_derive_cascade", f"""
SELECT o_orderkey, CASE WHEN o_orderstatus <> 'F' THEN given ELSE coalesce(given, nullif(gl, ''), CASE WHEN y >= 1997 THEN val END) END AS area,
  CASE WHEN o_orderstatus = 'F' AND coalesce(given, nullif(gl, ''), CASE WHEN y >= 1997 THEN val END) IS NULL
       THEN 'functional area cannot be derived' ELSE '' END AS errors
FROM (SELECT e.*, CASE WHEN e.o_orderpriority = '1-URGENT' THEN 'GIVEN' END AS given,
        CASE WHEN e.o_orderpriority = '2-HIGH' AND c.c_nationkey > 12 THEN c.c_mktsegment END AS gl
      FROM {EFFECTIVE} e LEFT JOIN customer c ON e.o_custkey = c.c_custkey)""")
def derive_cascade(t: Tables):
    df = _periods(t).withColumn("area", F.when(F.col("o_orderpriority") == "1-URGENT", "GIVEN"))
    gl = t.customer.where("c_nationkey > 12").select("c_custkey", "c_mktsegment")
    rules = [
        v.Rule(F.col("o_orderpriority") == "2-HIGH", gl, "o_custkey", "c_custkey", F.col("c_mktsegment")),
        v.Rule(F.col("fiscal_year") >= "1997", _validity(t), "o_custkey", "k",
               v.text.after_last(F.col("val"), "SAP"), year="fiscal_year"),
    ]
    out = v.derive_cascade(df, rules, "area", v.NO_AREA, applies=F.col("o_orderstatus") == "F")
    return _out(out, "o_orderkey", "area")


@plan("v11_derive_owner", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_linenumber = 1 THEN 'OWN' WHEN s_acctbal > 0 THEN 'PC' || s_nationkey END AS centre,
  CASE WHEN l_linenumber <> 1 AND coalesce(s_acctbal, 0) <= 0 THEN 'Profit Centre cannot be derived' ELSE '' END AS errors
FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey""")
def derive_owner(t: Tables):
    df = t.lineitem.withColumn("centre", F.when(F.col("l_linenumber") == 1, "OWN"))
    ref = t.supplier.where("s_acctbal > 0").select("s_suppkey", F.concat(F.lit("PC"), F.col("s_nationkey").cast("string")).alias("pc"))
    out = v.derive_cascade(
        df, [v.Rule(F.lit(True), ref, "l_suppkey", "s_suppkey", F.col("pc"))], "centre", v.NO_CENTRE
    )
    return _out(out, "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "centre")


# A window per user from each error, as many hours long as its value says.
ALARMS = "(SELECT user_id, event_id AS alarm, ts AS since, ts + CAST(floor(value) AS INT) * INTERVAL 1 HOUR AS until FROM events WHERE event_type = 'error')"


def _alarms(t: Tables):
    return t.events.where("event_type = 'error'").selectExpr(
        "user_id AS who", "event_id AS alarm", "ts AS since", "timestamp_micros(unix_micros(CAST(ts AS timestamp)) + bigint(floor(value)) * 3600000000) AS until"
    ).withColumns({c: F.col(c).cast(t.events.schema["ts"].dataType) for c in ("since", "until")})


@plan("j06_time_windows", f"""
SELECT event_id, alarm FROM events e JOIN {ALARMS} a ON e.user_id = a.user_id AND e.ts BETWEEN a.since AND a.until""")
def time_windows(t: Tables):
    out = j.interval_join(t.events, _alarms(t), [("user_id", "who")], ("ts", "ts"), ("since", "until"))
    return out.select("event_id", "alarm")


@plan("j06_overlapping_intervals", f"""
SELECT a.alarm, b.alarm AS other FROM {ALARMS} a JOIN {ALARMS} b ON a.user_id = b.user_id AND a.since <= b.until AND b.since <= a.until AND a.alarm < b.alarm""")
def overlapping_intervals(t: Tables):
    a = _alarms(t)
    b = a.selectExpr("who", "alarm AS other", "since AS other_since", "until AS other_until")
    return j.interval_join(a, b, ["who"], ("since", "until"), ("other_since", "other_until")).where("alarm < other").select("alarm", "other")


@plan("v09_valid_at_time", f"""
SELECT event_id, alarm FROM (SELECT e.event_id, a.alarm, row_number() OVER (PARTITION BY e.event_id ORDER BY a.since DESC NULLS LAST, a.alarm DESC) AS nr
  FROM events e LEFT JOIN {ALARMS} a ON e.user_id = a.user_id AND e.ts BETWEEN a.since AND a.until) WHERE nr = 1""")
def valid_at_time(t: Tables):
    out = j.value_at(t.events, _alarms(t), "user_id", "ts", "who", "since", "until", "alarm", "alarm")
    return out.select("event_id", "alarm")


@plan("v12_route_by_category", """
SELECT o_orderkey, o_orderstatus, CASE o_orderstatus WHEN 'P' THEN 'pending' WHEN 'F' THEN o_orderpriority END AS note FROM orders""")
def route(t: Tables):
    df = t.orders.select("o_orderkey", "o_orderstatus", "o_orderpriority")
    out = v.route(
        df, "o_orderstatus",
        {"P": lambda d: d.withColumn("note", F.lit("pending")), "F": lambda d: d.withColumn("note", F.col("o_orderpriority"))},
    )
    return out.select("o_orderkey", "o_orderstatus", "note")


@plan("v12_route_columns", """
SELECT o_orderkey, CASE o_orderstatus WHEN 'P' THEN 'pending' WHEN 'F' THEN o_orderpriority END AS note,
  CASE o_orderstatus WHEN 'F' THEN 0.0 ELSE round(o_totalprice, 2) END AS open FROM orders""")
def route_columns(t: Tables):
    df = t.orders.select("o_orderkey", "o_orderstatus", "o_orderpriority", F.round("o_totalprice", 2).alias("open"))
    out = v.route_columns(df, "o_orderstatus", {"P": {"note": F.lit("pending")}, "F": {"note": F.col("o_orderpriority"), "open": F.lit(0.0)}})
    return out.select("o_orderkey", "note", "open")


# ---- joins and set operations


@plan("j01_inner", """
SELECT o_orderkey, c_name, c_nationkey FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_acctbal > 0""")
def inner(t: Tables):
    out = j.inner(t.orders.select("o_orderkey", "o_custkey"), t.customer.where("c_acctbal > 0"), [("o_custkey", "c_custkey")])
    return out.select("o_orderkey", "c_name", "c_nationkey")


@plan("j02_left", "SELECT c_custkey, o_orderkey FROM customer LEFT JOIN orders ON o_custkey = c_custkey")
def left(t: Tables):
    orders = t.orders.select("o_custkey", "o_orderkey")
    out = j.left_outer(t.customer.select("c_custkey"), orders, [("c_custkey", "o_custkey")], many="right")
    return out.select("c_custkey", "o_orderkey")


@plan("j03_left_semi", "SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')")
def left_semi(t: Tables):
    return j.semi(t.customer.select("c_custkey", "c_name"), t.orders.where("o_orderstatus = 'P'"), [("c_custkey", "o_custkey")])


@plan("j04_semi_with_inequality", """
SELECT o_orderkey, o_totalprice FROM orders o
WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_extendedprice > o_totalprice)""")
def semi_inequality(t: Tables):
    return j.semi_greater(
        t.orders.select("o_orderkey", "o_totalprice"), t.lineitem, [("o_orderkey", "l_orderkey")], "o_totalprice", "l_extendedprice"
    )


@plan("j04_semi_differs", """
SELECT o_orderkey, o_orderstatus FROM orders o
WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_linestatus <> o_orderstatus)""")
def semi_differs(t: Tables):
    return j.semi_differs(
        t.orders.select("o_orderkey", "o_orderstatus"), t.lineitem, [("o_orderkey", "l_orderkey")], "o_orderstatus", "l_linestatus"
    )


@plan("j05_left_anti", "SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 300000)")
def left_anti(t: Tables):
    return j.anti(t.customer.select("c_custkey", "c_name"), t.orders.where("o_totalprice > 300000"), [("c_custkey", "o_custkey")])


@plan("j06_interval_join", f"""
SELECT val, count(*) AS n FROM {EFFECTIVE} WHERE val IS NOT NULL GROUP BY val""")
def interval_join(t: Tables):
    return effective_lookup(t).where("val IS NOT NULL").groupBy("val").agg(F.count(F.lit(1)).alias("n"))


@plan("j07_join_distinct", """
SELECT l_orderkey, l_linenumber, l_partkey, d.p_size FROM lineitem
LEFT JOIN (SELECT DISTINCT p_partkey, p_size FROM part WHERE p_size < 20) d ON l_partkey = p_partkey""")
def join_distinct(t: Tables):
    return j.join_distinct(
        t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey"), t.part.where("p_size < 20"), [("l_partkey", "p_partkey")], ["p_size"]
    )


@plan("j08_union", """
SELECT c_custkey, c_acctbal, 'debt' AS kind, NULL::VARCHAR AS c_mktsegment FROM customer WHERE c_acctbal < 0
UNION ALL SELECT c_custkey, c_acctbal, 'credit', c_mktsegment FROM customer WHERE c_acctbal >= 0""")
def union(t: Tables):
    debt = t.customer.where("c_acctbal < 0").select("c_acctbal", "c_custkey", F.lit("debt").alias("kind"))
    credit = t.customer.where("c_acctbal >= 0").select("c_custkey", F.lit("credit").alias("kind"), "c_acctbal", "c_mktsegment")
    return j.union_by_name(debt, credit, fill_missing=True)


@plan("j09_multiset_difference", """
SELECT l_returnflag, l_linestatus, l_quantity FROM lineitem
EXCEPT ALL SELECT l_returnflag, l_linestatus, l_quantity FROM lineitem WHERE l_discount > 0.02""")
def multiset_difference(t: Tables):
    df = t.lineitem.select("l_returnflag", "l_linestatus", "l_quantity")
    right = t.lineitem.where("l_discount > 0.02").select("l_returnflag", "l_linestatus", "l_quantity")
    return j.multiset_difference(df, right)


@plan("j10_set_difference", """
SELECT o_custkey, o_orderstatus FROM orders EXCEPT SELECT o_custkey, o_orderstatus FROM orders WHERE o_totalprice > 150000""")
def set_difference(t: Tables):
    df = t.orders.select("o_custkey", "o_orderstatus")
    return j.set_difference(df, t.orders.where("o_totalprice > 150000").select("o_custkey", "o_orderstatus"))


# ---- privacy


@plan("pr01_hash_columns", "SELECT c_custkey, md5(c_name) AS c_name, md5(c_nationkey::VARCHAR) AS c_nationkey FROM customer")
def hash_columns(t: Tables):
    return p.obfuscate(t.customer.select("c_custkey", "c_name", "c_nationkey"), ["c_name", "c_nationkey"])


@plan("pr02_mask_dates", """
SELECT o_orderkey, DATE '1900-01-01' AS d, '01/01/1900' AS d2, TIMESTAMP '1900-01-01 00:00:00' AS ts, '19000101000000' AS ts2 FROM orders""")
def mask_dates(t: Tables):
    day = F.to_date("o_orderdate")
    df = t.orders.select("o_orderkey", day.alias("d"), day.alias("d2"), F.col("o_orderdate").alias("ts"), F.col("o_orderdate").alias("ts2"))
    return p.mask(df, {"d": ("date", None), "d2": ("date", "dd/MM/yyyy"), "ts": ("datetime", None), "ts2": ("datetime", "yyyyMMddHHmmss")})


@plan("pr03_mask_int", """
SELECT p_partkey, length(p_size::VARCHAR) AS digits FROM part""")
def mask_int(t: Tables):
    masked = p.mask(t.part.select("p_partkey", "p_size"), {"p_size": ("int", None)}, seed=5)
    return masked.select("p_partkey", F.length(F.col("p_size").cast("string")).cast("long").alias("digits"))


# Numbers with 1 to 15 digits of either sign, and nulls, as SQL.
WIDE = """(SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 0 THEN o_orderkey * 3000000019 * (1 - 2 * (o_orderkey % 2)) END AS big,
  CASE WHEN o_orderkey % 3 = 0 THEN -o_custkey ELSE o_custkey END::INT AS small, o_totalprice * 1000 AS amount FROM orders)"""


def _wide(t: Tables):
    key = F.col("o_orderkey")
    return t.orders.select(
        "o_orderkey", F.when(key % 7 != 0, key * 3000000019 * (1 - 2 * (key % 2))).alias("big"),
        F.when(key % 3 == 0, -F.col("o_custkey")).otherwise(F.col("o_custkey")).cast("int").alias("small"),
        (F.col("o_totalprice") * 1000).alias("amount"),
    )


@plan("pr03_mask_wide_int", f"""
SELECT o_orderkey, length(abs(big)::VARCHAR) AS big_digits, sign(big)::INT AS big_sign, length(abs(small)::VARCHAR) AS small_digits,
  CASE WHEN small < 0 THEN -1 ELSE 1 END AS small_sign FROM {WIDE}""")
def mask_wide_int(t: Tables):
    masked = p.mask(_wide(t), {"big": ("int", None), "small": ("int", None)}, seed=5)
    digits = lambda c: F.length(F.abs(c).cast("string")).cast("long").alias(f"{c}_digits")
    sign = lambda c: F.when(F.col(c) < 0, -1).when(F.col(c) > 0, 1).alias(f"{c}_sign")
    return masked.select("o_orderkey", digits("big"), sign("big"), digits("small"), sign("small"))


@plan("pr04_mask_text", """
SELECT c_custkey, regexp_replace(c_name, '[0-9a-zA-Z]', 'x', 'g') AS c_name,
       regexp_replace(c_acctbal::VARCHAR, '[0-9a-zA-Z]', '1', 'g')::DOUBLE AS c_acctbal FROM customer""")
def mask_text(t: Tables):
    return p.mask(t.customer.select("c_custkey", "c_name", "c_acctbal"), {"c_name": ("string", None), "c_acctbal": ("decimal", None)})


CIPHER_SQL = "regexp_replace(translate(lower({}), 'abcdefghijklmnopqrstuvwxyz0123456789', 'nmlkjihgfedcbazyxwvutsrqpo8456123907'), '^0', '7')"


@plan("pr05_anonymize_values", f"""
SELECT p_partkey, {CIPHER_SQL.format('p_name')} AS p_name, {CIPHER_SQL.format('p_size::VARCHAR')}::INT AS p_size,
       {CIPHER_SQL.format('p_retailprice::VARCHAR')}::DOUBLE AS p_retailprice FROM part""")
def anonymize_values(t: Tables):
    df = t.part.select("p_partkey", "p_name", "p_size", "p_retailprice")
    return p.anonymize(df, {"p_name": ("string", None), "p_size": ("int", None), "p_retailprice": ("decimal", None)})


@plan("pr05_anonymize_wide", f"""
SELECT o_orderkey, {CIPHER_SQL.format('big::VARCHAR')}::BIGINT AS big, {CIPHER_SQL.format('small::VARCHAR')}::INT AS small,
  {CIPHER_SQL.format('amount::VARCHAR')}::DOUBLE AS amount FROM {WIDE}""")
def anonymize_wide(t: Tables):
    return p.anonymize(_wide(t), {"big": ("int", None), "small": ("int", None), "amount": ("decimal", None)})


@plan("pr06_anonymize_date", """
SELECT o_orderkey, d + (year(d) + month(d) + day(d))::INT AS d, strftime(d + (year(d) + month(d) + day(d))::INT, '%d/%m/%Y') AS d2
FROM (SELECT o_orderkey, o_orderdate::DATE AS d FROM orders)""")
def anonymize_date(t: Tables):
    df = t.orders.select("o_orderkey", F.to_date("o_orderdate").alias("d"), F.date_format("o_orderdate", "dd/MM/yyyy").alias("d2"))
    return p.anonymize(df, {"d": ("date", None), "d2": ("date", "dd/MM/yyyy")})


@plan("pr07_anonymize_datetime", """
SELECT event_id, ts + to_days((year(ts) + month(ts) + day(ts))::INT) AS ts,
  strftime(date_trunc('second', ts) + to_days((year(ts) + month(ts) + day(ts))::INT), '%d.%m.%Y %H:%M:%S') AS ts2 FROM events""")
def anonymize_datetime(t: Tables):
    df = t.events.select("event_id", "ts", F.date_format("ts", "dd.MM.yyyy HH:mm:ss").alias("ts2"))
    return p.anonymize(df, {"ts": ("datetime", None), "ts2": ("datetime", "dd.MM.yyyy HH:mm:ss")})
