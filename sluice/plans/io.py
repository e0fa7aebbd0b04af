"""Plans for sources (S), sinks (K) and SQL steps (Q)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from sluice.operators import sql as q
from sluice.operators.joins import inner
from sluice.plans.registry import Tables, plan
from sluice.sinks import tables as k
from sluice.sinks.keyed import KeyedTable
from sluice.sinks import upsert as u
from sluice.sources import files as s
from sluice.types import EmptyInput, Quarantined

ORDERS_SUM = """
SELECT o_orderstatus, count(*) AS orders, round(sum(o_totalprice), 2) AS total
FROM orders GROUP BY o_orderstatus"""


def _orders_sum(df):
    return df.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("total")
    )


# ---- sources


@plan("s01_file_scan", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_totalprice > 400000")
def file_scan(t: Tables):
    df = s.read_files(t.spark, t.path("orders"))
    return df.where("o_totalprice > 400000").select("o_orderkey", "o_custkey", "o_totalprice")


CUSTOMER_DDL = "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING"


@plan("s01_csv_with_schema", "SELECT * FROM customer")
def csv_with_schema(t: Tables):
    path = t.scratch("customer-csv")
    k.write_csv(t.customer, path)
    return s.read_files(t.spark, path, "csv", CUSTOMER_DDL, header=True)


@plan("s01_json_with_schema", "SELECT * FROM customer")
def json_with_schema(t: Tables):
    path = t.scratch("customer-json")
    t.customer.write.json(path)
    return s.read_files(t.spark, path, "json", CUSTOMER_DDL)


@plan("s02_option_aliases", "SELECT n_nationkey, n_name, n_regionkey FROM nation")
def option_aliases(t: Tables):
    path = t.scratch("nation-csv")
    k.write_csv(t.nation, path, sep="|")
    return s.read_files(
        t.spark, path, "csv", "n_nationkey INT, n_name STRING, n_regionkey INT", separator="|", withHeader=True
    )


@plan("s03_multi_prefix", """
SELECT 'nation' AS frame, count(*) AS n FROM nation
UNION ALL SELECT 'partsupplier' AS frame, count(*) AS n FROM supplier
UNION ALL SELECT 'region' AS frame, count(*) AS n FROM region""")
def multi_prefix(t: Tables):
    frames = s.read_many(
        t.spark, {"nation": t.path("nation"), "part-supplier/": t.path("supplier"), "region": t.path("region")}
    )
    out = None
    for name, df in frames.items():
        one = df.agg(F.lit(name).alias("frame"), F.count(F.lit(1)).alias("n"))
        out = one if out is None else out.unionByName(one)
    return out


@plan("s03_prefixes_in_one_scan", """
SELECT CASE WHEN c_acctbal < 0 THEN 'debt2024' ELSE 'credit' END AS prefix, count(*) AS n, round(sum(c_acctbal), 2) AS total
FROM customer GROUP BY 1""")
def prefixes_in_one_scan(t: Tables):
    parent = t.scratch("prefixes")
    t.customer.where("c_acctbal < 0").write.parquet(f"{parent}/debt-2024")
    t.customer.where("NOT c_acctbal < 0").write.parquet(f"{parent}/credit")
    df = s.read_prefixes(t.spark, parent, "parquet", t.customer.schema)
    return df.groupBy("prefix").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("c_acctbal"), 2).alias("total"))


@plan("s03_discovered_folders", """
SELECT 'flat' AS listing, CASE WHEN c_acctbal < 0 THEN 'debt2024' ELSE 'credit' END AS frame, count(*) AS n, round(sum(c_acctbal), 2) AS total FROM customer GROUP BY 2
UNION ALL SELECT 'nested', CASE WHEN c_mktsegment = 'BUILDING' THEN 'by_house' ELSE 'by_rest' END, count(*), round(sum(c_acctbal), 2) FROM customer GROUP BY 2
UNION ALL SELECT 'nested', 'late', count(*), round(sum(s_acctbal), 2) FROM supplier""")
def discovered_folders(t: Tables):
    """No names are given; the folder ``late`` arrives after the first listing, and one below ``by`` has partitions."""
    flat, tree = t.scratch("flat"), t.scratch("tree")
    t.customer.where("c_acctbal < 0").write.parquet(f"{flat}/debt-2024")
    t.customer.where("NOT c_acctbal < 0").write.parquet(f"{flat}/credit")
    building = F.col("c_mktsegment") == "BUILDING"
    t.customer.where(building).write.partitionBy("c_nationkey").parquet(f"{tree}/by/house")
    t.customer.where(~building).write.parquet(f"{tree}/by/rest")
    s.discover(t.spark, tree, nested=True)
    t.supplier.withColumnRenamed("s_acctbal", "c_acctbal").write.parquet(f"{tree}/late")
    out = []
    for listing, frames in (("flat", s.discover(t.spark, flat, view="customers")), ("nested", s.discover(t.spark, tree, nested=True))):
        out += [
            df.agg(F.lit(listing).alias("listing"), F.lit(name).alias("frame"), F.count(F.lit(1)).alias("n"), F.round(F.sum("c_acctbal"), 2).alias("total"))
            for name, df in frames.items()
        ]
    return reduce(lambda a, b: a.unionByName(b), out)


@plan("s04_empty_guard", """
SELECT 'orders' AS input, false AS stopped, count(*) AS n FROM orders
UNION ALL SELECT 'negative orders' AS input, true AS stopped, count(*) AS n FROM orders WHERE o_totalprice < 0""")
def empty_guard(t: Tables):
    out = None
    for name, df in (("orders", t.orders), ("negative orders", t.orders.where("o_totalprice < 0"))):
        try:
            s.require_rows(df)
            stopped = False
        except EmptyInput:
            stopped = True
        one = df.agg(F.lit(name).alias("input"), F.lit(stopped).alias("stopped"), F.count(F.lit(1)).alias("n"))
        out = one if out is None else out.unionByName(one)
    return out


@plan("s05_text_lines", "SELECT props AS value, count(*) AS n FROM events GROUP BY props")
def text_lines(t: Tables):
    path = t.scratch("props")
    t.events.select("props").write.text(path)
    return s.read_lines(t.spark, path).groupBy("value").agg(F.count(F.lit(1)).alias("n"))


@plan("s06_catalog_table", ORDERS_SUM)
def catalog_table(t: Tables):
    k.save_table(t.orders, "sluice_scan_orders", t.scratch("scan-orders"))
    return _orders_sum(s.read_table(t.spark, "sluice_scan_orders"))


@plan("s09_source_files", "SELECT true AS has_files, count(*) AS rows FROM lineitem")
def source_files(t: Tables):
    df = t.lineitem
    per_file = s.with_source_file(df).groupBy("source_file").agg(F.count(F.lit(1)).alias("rows"))
    known = per_file.join(s.source_files(df), "source_file")
    return known.agg((F.count(F.lit(1)) > 0).alias("has_files"), F.sum("rows").alias("rows"))


@plan("s10_freshness", """
WITH m AS (SELECT max(CAST(ts AS DATE)) AS d FROM events),
g AS (SELECT event_type, max(ts) AS newest_ts FROM events GROUP BY event_type)
SELECT g.event_type, e.event_id AS newest_key, g.newest_ts, CAST(g.newest_ts AS DATE) = (SELECT d FROM m) AS is_current
FROM g JOIN events e ON e.event_type = g.event_type AND e.ts = g.newest_ts""")
def freshness(t: Tables):
    today = t.events.agg(F.max(F.to_date("ts"))).scalar()
    return s.freshness(t.events, "event_type", "ts", "event_id", today)


@plan("s10_file_freshness", "SELECT DISTINCT 'lineitem' AS prefix, true AS is_there, false AS late FROM lineitem")
def file_freshness(t: Tables):
    day = t.lineitem.agg(F.max(F.to_date("_metadata.file_modification_time"))).scalar()
    fresh = s.file_freshness(t.lineitem, F.lit("lineitem"), day)
    return fresh.select("prefix", F.col("newest_key").contains("lineitem").alias("is_there"), (~F.col("is_current")).alias("late"))


@plan("s10_late_groups", """
SELECT event_type FROM events GROUP BY event_type HAVING max(ts)::DATE < (SELECT max(ts)::DATE FROM events WHERE event_type = 'click') + 1""")
def late_groups(t: Tables):
    day = F.date_add(t.events.where("event_type = 'click'").agg(F.max(F.to_date("ts"))).scalar(), 1)
    return s.late_groups(s.freshness(t.events, "event_type", "ts", "event_id", day), "event_type")


# ---- sinks


@plan("k01_save_table", ORDERS_SUM)
def save_table(t: Tables):
    k.save_table(t.orders, "sluice_orders", t.scratch("orders"), comment="orders as loaded")
    return _orders_sum(t.spark.table("sluice_orders"))


@plan("k01_overwrite_own_source", """
SELECT o_orderstatus, count(*) AS orders, round(sum(o_totalprice), 2) AS total
FROM orders WHERE o_orderstatus <> 'P' GROUP BY o_orderstatus""")
def overwrite_own_source(t: Tables):
    path = t.scratch("own")
    k.save_table(t.orders, "sluice_own", path)
    k.save_table(t.spark.table("sluice_own").where("o_orderstatus <> 'P'"), "sluice_own", path, reads_target=True)
    return _orders_sum(t.spark.table("sluice_own"))


@plan("k02_save_many", """
SELECT 'sluice_nation' AS saved, count(*) AS n FROM nation
UNION ALL SELECT 'sluice_region' AS saved, count(*) AS n FROM region""")
def save_many(t: Tables):
    names = k.save_tables({"nation": t.nation, "region": t.region}, "sluice_", t.scratch("many"))
    out = None
    for name in names:
        one = t.spark.table(name).agg(F.lit(name).alias("saved"), F.count(F.lit(1)).alias("n"))
        out = one if out is None else out.unionByName(one)
    return out


@plan("k03_partitioned_table", """
SELECT year(o_orderdate) AS o_year, count(*) AS orders, round(sum(o_totalprice), 2) AS total
FROM orders WHERE year(o_orderdate) >= 1997 GROUP BY 1""")
def partitioned_table(t: Tables):
    df = t.orders.withColumn("o_year", F.year("o_orderdate"))
    k.save_table(df, "sluice_by_year", t.scratch("by-year"), partition_by=["o_year"])
    rows = t.spark.table("sluice_by_year").where("o_year >= 1997")
    return rows.groupBy("o_year").agg(
        F.count(F.lit(1)).alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("total")
    )


@plan("k04_file_count", "SELECT CAST(1 AS BIGINT) AS files, count(*) AS n FROM supplier")
def file_count(t: Tables):
    path = t.scratch("one-file")
    k.save_table(t.supplier, "sluice_one_file", path, num_files=1)
    df = s.read_files(t.spark, path).select(F.col("_metadata.file_path").alias("f"))
    return df.agg(F.count_distinct("f").alias("files"), F.count(F.lit(1)).alias("n"))


@plan("k05_size_based_partitions", "SELECT l_returnflag, count(*) AS n FROM lineitem GROUP BY l_returnflag")
def size_based_partitions(t: Tables):
    path = t.scratch("sized")
    with k.partition_size(t.spark, 64_000_000):
        k.repartition_by_size(t.lineitem).write.parquet(path)
    return s.read_files(t.spark, path).groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"))


@plan("k06_quarantine", """
SELECT l_returnflag, count(*) AS n,
       sum(CASE WHEN l_tax = 0 THEN 1 ELSE 0 END)::BIGINT AS with_error, round(sum(l_extendedprice), 2) AS price
FROM lineitem GROUP BY l_returnflag""")
def quarantine(t: Tables):
    path = t.scratch("quarantine")
    df = t.lineitem.withColumn("system_error_message", F.when(F.col("l_tax") == 0, "l_tax is mandatory").otherwise(""))
    try:
        k.quarantine(df, "system_error_message", "l_returnflag", path)
    except Quarantined as err:
        path = err.path
    schema = df.drop("l_returnflag").schema
    back = t.spark.read.schema(schema).csv(path, header=True, sep=";")
    return back.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("system_error_message").alias("with_error"),
        F.round(F.sum("l_extendedprice"), 2).alias("price"),
    )


@plan("k06_write_audit_publish", """
SELECT 'rejected' AS place, l_returnflag, count(*) AS n, sum(CASE WHEN l_tax = 0 THEN 1 ELSE 0 END)::BIGINT AS with_error FROM lineitem GROUP BY l_returnflag
UNION ALL SELECT 'published', l_returnflag, count(*), 0 FROM lineitem WHERE l_tax <> 0 GROUP BY l_returnflag""")
def write_audit_publish(t: Tables):
    """All rows with some errors among them are exported; the good ones alone are published, over an older folder."""
    target, rejects = t.scratch("published"), t.scratch("rejected")
    df = t.lineitem.withColumn("system_error_message", F.when(F.col("l_tax") == 0, "l_tax is mandatory").otherwise(""))
    k.write_audited(df.where("l_tax <> 0 AND l_linenumber = 1"), "system_error_message", "l_returnflag", target, rejects)
    try:
        k.write_audited(df, "system_error_message", "l_returnflag", target, rejects, "overwrite")
    except Quarantined as err:
        back = t.spark.read.schema(df.drop("l_returnflag").schema).csv(err.path, header=True, sep=";")
    good = k.write_audited(df.where("l_tax <> 0"), "system_error_message", "l_returnflag", target, rejects, "overwrite")
    rejected = back.groupBy(F.lit("rejected").alias("place"), "l_returnflag").agg(F.count(F.lit(1)).alias("n"), F.count("system_error_message").alias("with_error"))
    return rejected.unionByName(
        good.groupBy(F.lit("published").alias("place"), "l_returnflag").agg(F.count(F.lit(1)).alias("n"), F.lit(0).cast("long").alias("with_error"))
    )


@plan("k06_gate_without_errors", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def gate_without_errors(t: Tables):
    df = t.supplier.withColumn("system_error_message", F.lit(""))
    return k.quarantine(df, "system_error_message", "s_name", t.scratch("unused"))


def _customer_changes(t: Tables):
    """Debtors are reset and every supplier arrives as a new customer, twice."""
    debtors = t.customer.where("c_acctbal < 0").select(
        "c_custkey", "c_name", F.lit(0.0).alias("c_acctbal"), F.lit(2).alias("version")
    )
    new = t.supplier.select(
        (-F.col("s_suppkey") - 1).alias("c_custkey"), F.col("s_name").alias("c_name"),
        F.col("s_acctbal").alias("c_acctbal"), F.explode(F.array(F.lit(1), F.lit(3))).alias("version"),
    )
    return debtors.unionByName(new)


@plan("k07_upsert", """
SELECT c_custkey, c_name, CASE WHEN c_acctbal < 0 THEN 0.0 ELSE c_acctbal END AS c_acctbal,
       CASE WHEN c_acctbal < 0 THEN 2 ELSE 1 END AS version FROM customer
UNION ALL SELECT -s_suppkey - 1, s_name, s_acctbal, 3 FROM supplier""")
def upsert(t: Tables):
    base = t.customer.select("c_custkey", "c_name", "c_acctbal", F.lit(1).alias("version"))
    return u.upsert(base, _customer_changes(t), ["c_custkey"], "version")


def _order_table(t: Tables) -> KeyedTable:
    """Orders in a keyed table; then the last hundredth of the keys changes, and as many new keys arrive behind them."""
    rows = t.orders.selectExpr("o_orderkey", "o_custkey", "o_orderstatus", "round(o_totalprice, 2) AS total", "1 AS version")
    table = KeyedTable.create(t.spark, t.scratch("orders"), rows, ["o_orderkey"], "version", cells=16)
    last = rows.agg(F.max("o_orderkey")).first()[0]
    tail = rows.where(F.col("o_orderkey") > last - last // 100)
    table.upsert(tail.withColumns({"o_orderstatus": F.lit("X"), "version": F.lit(2)}).unionByName(
        tail.withColumns({"o_orderkey": F.col("o_orderkey") + last, "version": F.lit(2)})
    ))
    return table


TAIL = "(SELECT max(o_orderkey) - max(o_orderkey) // 100 FROM orders)"
CHANGED_ORDERS = f"""SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey > {TAIL} THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
  round(o_totalprice, 2) AS total, CASE WHEN o_orderkey > {TAIL} THEN 2 ELSE 1 END AS version FROM orders
UNION ALL SELECT o_orderkey + (SELECT max(o_orderkey) FROM orders), o_custkey, o_orderstatus, round(o_totalprice, 2), 2 FROM orders WHERE o_orderkey > {TAIL}"""


@plan("k07_keyed_upsert", CHANGED_ORDERS)
def keyed_upsert(t: Tables):
    return _order_table(t).read()


@plan("k07_rewritten_files", f"""
SELECT true AS few_rewritten, 0 AS rows_lost, count(*) AS n FROM ({CHANGED_ORDERS})""")
def rewritten_files(t: Tables):
    """A change of the last hundredth leaves at least three quarters of the files as they are."""
    table = _order_table(t)
    before, after = ({f["path"]: f["rows"] for f in table.manifest(v)["files"]} for v in (0, 1))
    rows = table.read().agg(F.count(F.lit(1)).alias("n"))
    kept = sum(p in after for p in before)
    return rows.select(F.lit(kept >= 0.75 * len(before)).alias("few_rewritten"), (F.lit(sum(after.values())) - F.col("n")).cast("int").alias("rows_lost"), "n")


@plan("k08_keyed_insert", f"""
SELECT o_orderkey, o_custkey, o_orderstatus, round(o_totalprice, 2) AS total, 1 AS version, 0 AS files_gone FROM orders
UNION ALL SELECT o_orderkey + 1 + (SELECT max(o_orderkey) FROM orders), o_custkey, 'new', round(o_totalprice, 2), 3, 0 FROM orders""")
def keyed_insert(t: Tables):
    """Every order arrives again, under its key and under a new one; files are only added."""
    rows = t.orders.selectExpr("o_orderkey", "o_custkey", "o_orderstatus", "round(o_totalprice, 2) AS total", "1 AS version")
    table = KeyedTable.create(t.spark, t.scratch("orders"), rows, ["o_orderkey"], "version", cells=16)
    last = rows.agg(F.max("o_orderkey")).first()[0]
    again = rows.withColumns({"o_orderstatus": F.lit("new"), "version": F.lit(3)})
    table.insert(again.unionByName(again.withColumn("o_orderkey", F.col("o_orderkey") + last + 1)))
    after = {f["path"] for f in table.manifest()["files"]}
    gone = sum(f["path"] not in after for f in table.manifest(0)["files"])
    return table.read().withColumn("files_gone", F.lit(gone))


@plan("k09_version_by_number", "SELECT o_orderkey, o_custkey, o_orderstatus, round(o_totalprice, 2) AS total, 1 AS version FROM orders")
def version_by_number(t: Tables):
    return _order_table(t).read(0)


@plan("k09_version_difference", f"""
SELECT o_orderkey, o_custkey, o_orderstatus, total, version, CASE WHEN o_orderkey > (SELECT max(o_orderkey) FROM orders) THEN 'insert' ELSE 'update' END AS change
FROM ({CHANGED_ORDERS}) WHERE version = 2""")
def version_difference(t: Tables):
    return _order_table(t).changes(0, 1).withColumnRenamed("_change", "change")


@plan("k09_all_versions", f"""
SELECT o_orderkey, o_custkey, o_orderstatus, total, version, version - 1 AS since FROM ({CHANGED_ORDERS})
UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, round(o_totalprice, 2), 1, 0 FROM orders WHERE o_orderkey > {TAIL}""")
def all_versions(t: Tables):
    return _order_table(t).history().withColumnRenamed("_since", "since")


NULL_KEYS = "SELECT nullif(c_nationkey, 3) AS nation, c_mktsegment AS segment, max(c_custkey) AS newest FROM customer GROUP BY ALL"


@plan("k07_upsert_null_keys", f"""
SELECT nation, segment, newest + (segment = 'BUILDING')::INT AS newest FROM ({NULL_KEYS})
UNION ALL SELECT NULL, 'none', 1 FROM (SELECT count(*) FROM customer)""")
def upsert_null_keys(t: Tables):
    # The key of nation 3 is unknown; the same changes are merged twice.
    nation = F.when(F.col("c_nationkey") != 3, F.col("c_nationkey")).alias("nation")
    base = t.customer.groupBy(nation, F.col("c_mktsegment").alias("segment")).agg(F.max("c_custkey").alias("newest"))
    added = t.customer.agg(F.lit(None).cast("int").alias("nation"), F.lit("none").alias("segment"), F.lit(1).cast("long").alias("newest"))
    changes = base.where("segment = 'BUILDING'").withColumn("newest", F.col("newest") + 1).unionByName(added)
    once = u.upsert(base, changes, ["nation", "segment"], "newest")
    return u.upsert(once, changes, ["nation", "segment"], "newest")


@plan("k08_insert_new", """
SELECT c_custkey, c_name, c_acctbal, 1 AS version FROM customer
UNION ALL SELECT -s_suppkey - 1, s_name, s_acctbal, 3 FROM supplier""")
def insert_new(t: Tables):
    base = t.customer.select("c_custkey", "c_name", "c_acctbal", F.lit(1).alias("version"))
    return u.insert_new(base, _customer_changes(t), ["c_custkey"], "version")


@plan("k09_snapshot", """
SELECT event_id, user_id, event_type, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def snapshot(t: Tables):
    current, _ = u.snapshot_and_history(t.events, ["user_id"], ["ts", "event_id"])
    return current.select("event_id", "user_id", "event_type", "value")


@plan("k09_history", """
SELECT user_id, count(*) AS versions, max(ts) AS last_ts FROM events GROUP BY user_id""")
def history(t: Tables):
    _, versions = u.snapshot_and_history(t.events, ["user_id"], ["ts", "event_id"])
    return versions.groupBy("user_id").agg(F.count(F.lit(1)).alias("versions"), F.max("ts").alias("last_ts"))


@plan("k10_partition_values", """
SELECT DISTINCT 'o_orderstatus' AS column_name, o_orderstatus AS value FROM orders
UNION ALL SELECT DISTINCT 'o_orderpriority', o_orderpriority FROM orders
UNION ALL SELECT DISTINCT 'o_orderkey', o_orderkey::VARCHAR FROM orders""")
def partition_values(t: Tables):
    return k.partition_values(t.orders, ["o_orderstatus", "o_orderpriority", "o_orderkey"])


@plan("k10_partition_values_limited", """
SELECT DISTINCT 'o_orderstatus' AS column_name, o_orderstatus AS value, NULL::BIGINT AS left_out FROM orders
UNION ALL SELECT 'o_orderkey', NULL, count(DISTINCT o_orderkey) FROM orders""")
def partition_values_limited(t: Tables):
    return k.partition_values(t.orders, ["o_orderstatus", "o_orderkey"], limit=1000)


@plan("k11_retention", """
SELECT CASE WHEN o_orderdate < DATE '1997-07-01' THEN 'archive' ELSE 'keep' END AS side,
       count(*) AS n, min(o_orderkey) AS first_key, max(o_orderkey) AS last_key
FROM orders GROUP BY 1""")
def retention(t: Tables):
    cutoff = k.months_before(F.lit("1998-01-01").cast("date"), 6)
    text = t.orders.withColumn("day", F.date_format("o_orderdate", "dd/MM/yyyy"))
    keep, old = k.retention_split(text, "day", "dd/MM/yyyy", cutoff)
    both = keep.withColumn("side", F.lit("keep")).unionByName(old.withColumn("side", F.lit("archive")))
    return both.groupBy("side").agg(
        F.count(F.lit(1)).alias("n"), F.min("o_orderkey").alias("first_key"), F.max("o_orderkey").alias("last_key")
    )


@plan("k11_archive_and_rewrite", """
SELECT CASE WHEN o_orderdate < DATE '1997-07-01' THEN 'archive' ELSE 'table' END AS place, count(*) AS n
FROM orders GROUP BY 1""")
def archive_and_rewrite(t: Tables):
    path, archive = t.scratch("retained"), t.scratch("archive")
    k.save_table(t.orders, "sluice_retained", path)
    k.archive_old(
        t.spark.table("sluice_retained"), "sluice_retained", "o_orderdate", None,
        F.lit("1997-07-01").cast("date"), archive, path, run="first",
    )
    # Nothing is old any more: the second run leaves both sides alone.
    k.archive_old(
        t.spark.table("sluice_retained"), "sluice_retained", "o_orderdate", None,
        F.lit("1997-07-01").cast("date"), archive, path, run="second",
    )
    kept = t.spark.table("sluice_retained").agg(F.lit("table").alias("place"), F.count(F.lit(1)).alias("n"))
    old = t.spark.read.schema(t.orders.schema).csv(archive, header=True)
    return kept.unionByName(old.agg(F.lit("archive").alias("place"), F.count(F.lit(1)).alias("n")))


@plan("k03_replace_partitions", """
SELECT o_orderstatus, count(*) AS n, sum(CASE WHEN o_orderstatus = 'P' THEN 0 ELSE o_custkey END) AS keys FROM orders GROUP BY 1""")
def replace_partitions(t: Tables):
    k.save_table(t.orders, "sluice_replaced", t.scratch("replaced"), partition_by=["o_orderstatus"])
    k.replace_partitions(t.orders.where("o_orderstatus = 'P'").withColumn("o_custkey", F.lit(0).cast("long")), "sluice_replaced")
    out = t.spark.table("sluice_replaced").groupBy("o_orderstatus")
    return out.agg(F.count(F.lit(1)).alias("n"), F.sum("o_custkey").alias("keys"))


@plan("k13_drop_table", "SELECT true AS before, false AS after, count(*) AS n FROM region")
def drop_table(t: Tables):
    name = "sluice_to_drop"
    k.save_table(t.region, name, t.scratch("to-drop"))
    before = t.spark.catalog.tableExists(name)
    k.drop_table(t.spark, name)
    after = t.spark.catalog.tableExists(name)
    return t.region.agg(F.lit(before).alias("before"), F.lit(after).alias("after"), F.count(F.lit(1)).alias("n"))


@plan("k14_csv_export", "SELECT n_nationkey, '  ' || n_name || ' ' AS n_name FROM nation")
def csv_export(t: Tables):
    path = t.scratch("spaces")
    k.write_csv(t.nation.select("n_nationkey", F.concat(F.lit("  "), "n_name", F.lit(" ")).alias("n_name")), path)
    return s.read_files(t.spark, path, "csv", "n_nationkey INT, n_name STRING", header=True)


@plan("k15_relocate_table", """
SELECT o_orderstatus, count(*) AS orders, round(sum(o_totalprice), 2) AS total
FROM orders WHERE o_orderstatus = 'O' GROUP BY o_orderstatus""")
def relocate_table(t: Tables):
    first, second = t.scratch("run1"), t.scratch("run2")
    k.save_table(t.orders.where("o_orderstatus = 'F'"), "sluice_moving", first)
    t.orders.where("o_orderstatus = 'O'").write.parquet(second)
    k.point_table_at(t.spark, "sluice_moving", second)
    return _orders_sum(t.spark.table("sluice_moving"))


# ---- SQL steps


@plan("q01_sql_over_frames", """
SELECT n.n_name, count(*) AS orders, round(sum(o.o_totalprice), 2) AS total
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
WHERE o.o_orderdate >= DATE '1997-01-01' GROUP BY n.n_name""")
def sql_over_frames(t: Tables):
    return q.run_sql(
        t.spark,
        """SELECT n.n_name, count(*) AS orders, round(sum(o.o_totalprice), 2) AS total
           FROM {orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey
           JOIN {nation} n ON c.c_nationkey = n.n_nationkey
           WHERE o.o_orderdate >= :since GROUP BY n.n_name""",
        {"since": "1997-01-01"},
        orders=t.orders, customer=t.customer, nation=t.nation,
    )


@plan("q02_prepared_statement", """
SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'P' AND o_totalprice > 300000""")
def prepared_statement(t: Tables):
    return q.run_sql(
        t.spark, "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = ? AND o_totalprice > ?",
        ["P", 300000], orders=t.orders,
    )


@plan("q03_dynamic_table_name", "SELECT r_name, count(*) AS n FROM region GROUP BY r_name")
def dynamic_table_name(t: Tables):
    t.region.createOrReplaceTempView("stg_dim_region")
    return q.run_sql(
        t.spark, "SELECT r_name, count(*) AS n FROM IDENTIFIER(:name) GROUP BY r_name", {"name": "stg_dim_region"}
    )


@plan("q04_insert_select_distinct", """
SELECT c_custkey AS id, 0 AS load FROM customer WHERE c_acctbal < 0
UNION ALL SELECT DISTINCT o_custkey, 1 FROM orders""")
def insert_select_distinct(t: Tables):
    name = "sluice_ids"
    k.save_table(
        t.customer.where("c_acctbal < 0").select(F.col("c_custkey").alias("id"), F.lit(0).alias("load")),
        name, t.scratch("ids"),
    )
    ids = q.run_sql(
        t.spark, "WITH c AS (SELECT DISTINCT o_custkey AS id FROM {o}) SELECT id, 1 AS load FROM c", o=t.orders
    )
    k.insert_into(ids, name)
    return t.spark.table(name)


@plan("q05_create_table_as", "SELECT c_nationkey, count(*) AS n FROM customer GROUP BY c_nationkey")
def create_table_as(t: Tables):
    spark = t.spark
    t.customer.createOrReplaceTempView("sluice_customer_view")
    spark.sql("CREATE DATABASE IF NOT EXISTS sluice_dim LOCATION '" + t.scratch("dim-db") + "'")
    spark.sql("DROP TABLE IF EXISTS sluice_dim.per_nation")
    spark.sql(
        "CREATE TABLE IF NOT EXISTS sluice_dim.per_nation USING parquet LOCATION '" + t.scratch("per-nation") + "' "
        "AS SELECT c_nationkey, count(*) AS n FROM sluice_customer_view GROUP BY c_nationkey"
    )
    return spark.table("sluice_dim.per_nation")


@plan("q06_join_with_like", """
SELECT p_type, count(*) AS n, round(sum(l_extendedprice), 2) AS price
FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_type LIKE '%O%' GROUP BY p_type""")
def join_with_like(t: Tables):
    df = inner(t.lineitem, t.part.where(F.col("p_type").like("%O%")), [("l_partkey", "p_partkey")])
    return df.groupBy("p_type").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("l_extendedprice"), 2).alias("price")
    )


@plan("q07_enrich", """
SELECT o.o_orderkey, o.o_custkey, c.c_name, c.c_mktsegment
FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey""")
def enrich(t: Tables):
    right = t.customer.withColumnRenamed("c_custkey", "o_custkey")
    return q.enrich(t.orders.select("o_orderkey", "o_custkey"), right, ["o_custkey"], ["c_name", "c_mktsegment"])


@plan("q08_dimension", """
SELECT DISTINCT
  lower(user_id::VARCHAR || '-' || event_type || '-' || strftime(ts, '%Y%m%d') || '-'
        || CASE WHEN value > 50 THEN strftime(ts, '%Y%m%d%H%M%S') ELSE '' END) AS business_key,
  user_id::VARCHAR AS employee_id, 'full_time' AS employee_type,
  strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') AS start_date,
  CASE WHEN value > 50 THEN strftime(ts, '%Y-%m-%d') ELSE '' END AS end_date,
  0.0::DOUBLE AS duration
FROM events""")
def dimension(t: Tables):
    from sluice.functions.text import composite_key

    late = F.col("value") > 50
    e = t.events.withColumn("approved", F.when(late, F.date_format("ts", "yyyyMMddHHmmss")))
    return q.build_dimension(
        e,
        {
            "business_key": composite_key(
                F.col("user_id"), F.col("event_type"), F.date_format("ts", "yyyyMMdd"), F.col("approved")
            ),
            "employee_id": F.col("user_id").cast("string"),
            "employee_type": F.lit("full_time"),
            "start_date": F.date_format(F.to_date("ts"), "yyyy-MM-dd HH:mm:ss"),
            "end_date": F.coalesce(F.when(late, F.date_format("ts", "yyyy-MM-dd")), F.lit("")),
            "duration": F.lit(0.0),
        },
    )


@plan("q09_business_metric", """
SELECT l_returnflag AS flag, year(l_shipdate)::INT AS ship_year, count(*) AS n,
  round(sum(l_extendedprice) FILTER (WHERE l_discount > 0.05 AND l_quantity < 24), 2) AS promo,
  round(avg(l_quantity), 4) AS avg_qty, min(l_tax) AS min_tax,
  max(l_extendedprice) FILTER (WHERE l_linestatus = 'O') AS max_open
FROM lineitem GROUP BY 1, 2""")
def business_metric(t: Tables):
    out = q.metrics(
        t.lineitem,
        {"flag": "l_returnflag", "ship_year": "year(l_shipdate)"},
        {
            "n": ("count", "1"),
            "promo": ("sum", "l_extendedprice", ["l_discount > 0.05", "l_quantity < 24"]),
            "avg_qty": ("avg", "l_quantity"),
            "min_tax": ("min", "l_tax"),
            "max_open": ("max", "l_extendedprice", ["l_linestatus = 'O'"]),
        },
    )
    return out.withColumns({"promo": F.round("promo", 2), "avg_qty": F.round("avg_qty", 4)})


@plan("q10_assertion", """
SELECT count(*) AS found, s.sign,
  CASE s.sign WHEN 'gt' THEN count(*) > 5000 WHEN 'gte' THEN count(*) >= 5000 WHEN 'eq' THEN count(*) = 5000
              WHEN 'lte' THEN count(*) <= 5000 ELSE count(*) < 5000 END AS failed
FROM lineitem, (VALUES ('gt'), ('gte'), ('eq'), ('lte'), ('lt')) s(sign)
WHERE l_quantity >= 45 GROUP BY s.sign""")
def assertion(t: Tables):
    rows = t.lineitem.where("l_quantity >= 45")
    out = None
    for sign in ("gt", "gte", "eq", "lte", "lt"):
        one = q.assert_query(rows, sign, 5000)
        out = one if out is None else out.unionByName(one)
    return out


@plan("q11_python_step", """
SELECT o_orderkey, round(o_totalprice * 1.2, 2) AS gross FROM orders""")
def python_step(t: Tables):
    def add_tax(df, rate):
        return df.select("o_orderkey", F.round(F.col("o_totalprice") * (1 + rate), 2).alias("gross"))

    return q.python_step(t.orders, add_tax, rate=0.2)
