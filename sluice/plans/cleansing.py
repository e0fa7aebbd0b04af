"""Plans for projections, filters and cleansing (C) and scalar expressions (E)."""

from __future__ import annotations

from pyspark.sql import functions as F

from sluice.functions import text
from sluice.operators import clean as c
from sluice.plans.registry import Tables, plan

# Customers with some segments and names blanked, as SQL.
GAPS = """
(SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN NULL WHEN c_acctbal > 9000 THEN '  ' ELSE c_name END AS c_name,
        CASE WHEN c_nationkey = 7 THEN NULL WHEN c_nationkey = 11 THEN '' ELSE c_mktsegment END AS c_mktsegment,
        CASE WHEN c_nationkey = 3 THEN NULL ELSE c_acctbal END AS c_acctbal FROM customer)"""


def _gaps(t: Tables):
    bal, nation = F.col("c_acctbal"), F.col("c_nationkey")
    return t.customer.select(
        "c_custkey",
        F.when(bal > 9000, "  ").when(~(bal < 0), F.col("c_name")).alias("c_name"),
        F.when(nation == 11, "").when(nation != 7, F.col("c_mktsegment")).alias("c_mktsegment"),
        F.when(nation != 3, bal).alias("c_acctbal"),
    )


def _sides(split, keep: str, reject: str):
    return split.good.withColumn("side", F.lit(keep)).unionByName(split.bad.withColumn("side", F.lit(reject)))


@plan("c01_rename_columns", "SELECT n_nationkey AS id, n_name AS \"nation_name\", n_regionkey FROM nation")
def rename(t: Tables):
    df = t.nation.withColumnRenamed("n_name", "nation name")
    return c.rename_columns(df, {"n_nationkey": "id"})


@plan("c02_whitespace_rename", "SELECT r_regionkey AS region_key, r_name AS the_region_name FROM region")
def whitespace(t: Tables):
    return c.snake_spaces(t.region.toDF("region key", "the region name"))


@plan("c03_add_columns", """
SELECT n_nationkey, 'erp' AS source, 7 AS source_id, '20240102030405' AS loaded FROM nation""")
def add_columns(t: Tables):
    now = F.lit("2024-01-02 03:04:05").cast("timestamp_ntz")
    df = c.add_columns(t.nation, {"source": "erp", "source_id": 7, "loaded": "current_timestamp"}, now)
    return df.select("n_nationkey", "source", "source_id", "loaded")


@plan("c04_select_columns", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem")
def select_columns(t: Tables):
    return c.select_columns(t.lineitem, ["l_orderkey", "l_linenumber", "l_quantity"])


@plan("c05_first_columns", "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber FROM lineitem")
def first_columns(t: Tables):
    return c.first_columns(t.lineitem, 4)


@plan("c06_drop_duplicates", """
SELECT * FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1""")
def drop_duplicates(t: Tables):
    return c.drop_duplicates(t.events, ["user_id", "event_type"], ["ts", "event_id"])


@plan("c06_drop_duplicates_any", "SELECT user_id, event_type, 1::BIGINT AS n FROM events GROUP BY user_id, event_type")
def drop_duplicates_any(t: Tables):
    kept = c.drop_duplicates(t.events, ["user_id", "event_type"])
    return kept.groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))


@plan("c07_duplicate_keys", """
SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem GROUP BY ALL HAVING count(*) > 1""")
def duplicate_keys(t: Tables):
    return c.duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


@plan("c08_fill_blank", f"""
SELECT c_custkey, coalesce(c_name, '') AS c_name, coalesce(c_mktsegment, '') AS c_mktsegment, c_acctbal FROM {GAPS}""")
def fill_blank(t: Tables):
    return c.fill_blank(_gaps(t))


@plan("c09_to_int", """
SELECT o_orderkey, trunc(o_totalprice)::INT AS price, left(o_orderpriority, 1)::INT AS priority,
       NULL::INT AS status FROM orders""")
def to_int(t: Tables):
    df = t.orders.select(
        "o_orderkey", F.col("o_totalprice").cast("string").alias("price"),
        F.substring("o_orderpriority", 1, 1).alias("priority"), F.col("o_orderstatus").alias("status"),
    )
    return c.to_int(df, ["price", "priority", "status"])


@plan("c10_blank_filter", f"""
SELECT *, CASE WHEN coalesce(trim(c_name), '') = '' OR coalesce(trim(c_mktsegment), '') = '' OR c_acctbal IS NULL
               THEN 'bad' ELSE 'good' END AS side FROM {GAPS}""")
def blank_filter(t: Tables):
    return _sides(c.split_blank(_gaps(t), ["c_name", "c_mktsegment", "c_acctbal"]), "good", "bad")


@plan("c11_clean_all", f"""
SELECT c_custkey, name, segment, balance,
  CASE WHEN coalesce(trim(name), '') <> '' AND coalesce(trim(segment), '') <> '' THEN 'good' ELSE 'bad' END AS side FROM (
  SELECT segment, c_custkey, name, trunc(c_acctbal)::INT AS balance FROM (
    SELECT c_custkey, c_name AS name, c_mktsegment AS segment, c_acctbal FROM {GAPS}
    QUALIFY row_number() OVER (PARTITION BY c_mktsegment, c_acctbal ORDER BY c_custkey DESC) = 1))""")
def clean_all(t: Tables):
    spec = c.CleanSpec(
        mapping={"c_name": "name", "c_mktsegment": "segment", "c_acctbal": "balance"},
        select=["c_custkey", "name", "segment", "balance"],
        keys=["segment", "balance"], order_by="c_custkey", ints=["balance"], max_columns=4,
        not_blank=["name", "segment"],
    )
    return _sides(c.clean_all(_gaps(t), spec), "good", "bad")


@plan("c12_truncate_values", "SELECT p_partkey::VARCHAR AS p_partkey, left(p_name, 5) AS p_name, left(p_type, 5) AS p_type FROM part")
def truncate_values(t: Tables):
    return c.truncate_values(t.part.select("p_partkey", "p_name", "p_type"), 5)


@plan("c13_date_range_filter", """
SELECT o_orderkey, d, CASE WHEN d BETWEEN DATE '1996-06-01' AND DATE '1998-03-31' THEN 'good' ELSE 'bad' END AS side
FROM (SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderdate::DATE END AS d FROM orders)""")
def date_range(t: Tables):
    df = t.orders.select("o_orderkey", F.when(F.col("o_orderstatus") != "P", F.to_date("o_orderdate")).alias("d"))
    return _sides(c.split_range(df, "d", F.lit("1996-06-01").cast("date"), F.lit("1998-03-31").cast("date")), "good", "bad")


@plan("c14_positional_schema", """
SELECT c_custkey::VARCHAR AS id, try_cast(c_name AS INT) AS label, c_nationkey::BIGINT AS nation,
       c_acctbal::DECIMAL(12,2) AS balance FROM customer""")
def positional_schema(t: Tables):
    return c.set_schema(t.customer, "id STRING, label INT, nation BIGINT, balance DECIMAL(12,2)")


ORDER_TEXT = """
(SELECT o_orderkey::VARCHAR AS o_orderkey,
        CASE WHEN o_orderstatus = 'P' THEN 'n/a' ELSE printf('%.2f', o_totalprice) END AS o_totalprice,
        CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS o_orderdate,
        o_orderstatus FROM orders)"""


def _order_text(t: Tables):
    return t.orders.select(
        F.col("o_orderkey").cast("string").alias("o_orderkey"),
        F.when(F.col("o_orderstatus") == "P", "n/a")
        .otherwise(F.col("o_totalprice").cast("decimal(18,2)").cast("string")).alias("o_totalprice"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.date_format("o_orderdate", "yyyy-MM-dd")).alias("o_orderdate"),
        "o_orderstatus",
    )


ORDER_DDL = "o_orderkey BIGINT NOT NULL, o_totalprice DOUBLE, o_orderdate DATE NOT NULL"


@plan("c15_conform_good", f"""
SELECT o_orderkey::BIGINT AS o_orderkey, o_totalprice::DOUBLE AS o_totalprice, o_orderdate::DATE AS o_orderdate,
       o_orderstatus FROM {ORDER_TEXT} WHERE o_totalprice <> 'n/a' AND o_orderdate IS NOT NULL""")
def conform_good(t: Tables):
    return c.conform(_order_text(t), ORDER_DDL).good


@plan("c15_conform_bad", f"SELECT * FROM {ORDER_TEXT} WHERE o_totalprice = 'n/a' OR o_orderdate IS NULL")
def conform_bad(t: Tables):
    return c.conform(_order_text(t), ORDER_DDL).bad


@plan("c17_ensure_columns", "SELECT r_regionkey, r_name, '' AS r_comment, '' AS r_owner FROM region")
def ensure_columns(t: Tables):
    return c.ensure_columns(t.region, ["r_name", "r_comment", "r_owner"])


@plan("c18_change_flags", """
SELECT event_id, event_type AS kind, '' AS note,
  CASE WHEN value < 10 THEN 'isadded' WHEN value < 40 THEN 'isupdated' WHEN user_id < 20 THEN 'isdeleted' ELSE 'None' END AS kind_flag,
  'None' AS note_flag
FROM events""")
def change_flags(t: Tables):
    df = t.events.select(
        "event_id", F.col("event_type").alias("kind"),
        (F.col("value") < 10).cast("int").alias("kind_atr_isadded"),
        (F.col("value") < 40).cast("string").alias("kind_atr_isupdated"),
        F.when(F.col("user_id") < 20, "1").otherwise("").alias("kind_atr_isdeleted"),
    )
    df = df.withColumn("kind_atr_isupdated", F.when(F.col("kind_atr_isupdated") == "true", "1").otherwise("0"))
    return c.change_flags(df, ["event_id"], ["kind", "note"])


# ---- scalar expressions


@plan("e04_text_functions", """
SELECT p_partkey, lower(p_brand) || '/' || replace(p_type, 'O', '0') AS tag, substring(p_name, 2, 4) AS mid,
  coalesce(CASE WHEN p_name LIKE '%ring%' THEN trim(' ring ') END, 'none') AS ring,
  length(p_name)::INT AS len, regexp_matches(p_brand, '^Brand#1') AS first_brands, regexp_replace(p_brand, '[0-9]+', 'N') AS brand,
  starts_with(p_name, 'red') AS red, ends_with(p_name, 'bolt') AS bolt, split_part(p_brand, '#', 2) AS num,
  split_part(p_name, ' ', 1) AS word, round(p_retailprice, 1) AS price, p_size BETWEEN 10 AND 20 AS medium
FROM part""")
def text_functions(t: Tables):
    name, brand = F.col("p_name"), F.col("p_brand")
    return t.part.select(
        "p_partkey",
        F.concat(F.lower(brand), F.lit("/"), F.replace("p_type", F.lit("O"), F.lit("0"))).alias("tag"),
        F.substring(name, 2, 4).alias("mid"),
        F.coalesce(F.when(name.like("%ring%"), F.trim(F.lit(" ring "))), F.lit("none")).alias("ring"),
        F.length(name).alias("len"), brand.rlike("^Brand#1").alias("first_brands"),
        F.regexp_replace(brand, "[0-9]+", "N").alias("brand"),
        name.startswith("red").alias("red"), name.endswith("bolt").alias("bolt"),
        text.after_last(brand, "#").alias("num"), F.split(name, " ").getItem(0).alias("word"),
        F.round("p_retailprice", 1).alias("price"), F.col("p_size").between(10, 20).alias("medium"),
    )


@plan("e05_date_functions", """
SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS stamp, (o_orderdate::DATE + 30) AS due,
  (o_orderdate::DATE + INTERVAL 3 MONTH)::DATE AS quarter_later, year(o_orderdate) * 100 + month(o_orderdate) AS ym,
  epoch(o_orderdate)::BIGINT AS seconds, strftime(o_orderdate, '%d/%m/%Y') AS text_day, o_orderdate::DATE AS parsed
FROM orders""")
def date_functions(t: Tables):
    d = F.to_date("o_orderdate")
    return t.orders.select(
        "o_orderkey", F.date_format("o_orderdate", "yyyyMMdd").alias("stamp"), F.date_add(d, 30).alias("due"),
        F.add_months(d, 3).alias("quarter_later"),
        text.year_month(F.date_format("o_orderdate", "yyyy-MM-dd")).cast("long").alias("ym"),
        (F.unix_date(d).cast("long") * 86400).alias("seconds"),
        F.date_format("o_orderdate", "dd/MM/yyyy").alias("text_day"),
        F.try_to_date(F.date_format("o_orderdate", "dd/MM/yyyy"), "dd/MM/yyyy").alias("parsed"),
    )


@plan("e08_composite_key", """
SELECT o_orderkey, lower(o_custkey::VARCHAR || '-' || CASE WHEN o_orderstatus = 'P' THEN '' ELSE o_orderpriority END
       || '-' || strftime(o_orderdate, '%Y%m%d')) AS key FROM orders""")
def composite_key(t: Tables):
    priority = F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority"))
    key = text.composite_key(F.col("o_custkey"), priority, F.date_format("o_orderdate", "yyyyMMdd"))
    return t.orders.select("o_orderkey", key.alias("key"))


POINT = "(user_id * 37 % 170 - 85)::DOUBLE AS lat, (user_id * 101 % 360 - 180)::DOUBLE AS lng"


@plan("e09_distance", f"""
SELECT event_id, round(2 * 6371.007180918475 * asin(least(1.0, sqrt(
    pow(sin((radians(48.0) - radians(lat)) / 2), 2)
    + cos(radians(lat)) * cos(radians(48.0)) * pow(sin((radians(11.0) - radians(lng)) / 2), 2)))), 4) AS km
FROM (SELECT event_id, {POINT} FROM events)""")
def distance(t: Tables):
    lat = (F.col("user_id") * 37 % 170 - 85).cast("double")
    lng = (F.col("user_id") * 101 % 360 - 180).cast("double")
    km = text.distance(lat, lng, F.lit(48.0), F.lit(11.0), "km")
    return t.events.select("event_id", F.round(km, 4).alias("km"))


@plan("e10_point_text", f"SELECT event_id, lat, lng FROM (SELECT event_id, {POINT} FROM events)")
def point_text(t: Tables):
    lat = (F.col("user_id") * 37 % 170 - 85).cast("double")
    lng = (F.col("user_id") * 101 % 360 - 180).cast("double")
    df = t.events.select("event_id", text.to_point(lat, lng).alias("p"))
    return df.select("event_id", text.point_lat(F.col("p")).alias("lat"), text.point_lng(F.col("p")).alias("lng"))
