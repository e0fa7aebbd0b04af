"""Plans for JSON (F), type detection (T), incremental loads (I), ML data jobs (M) and grids (GEO)."""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from sluice.operators import flatten as fl
from sluice.operators import geo
from sluice.operators import infer as inf
from sluice.operators import ml
from sluice.operators.quality import analyzers as a
from sluice.operators.quality.checks import Check
from sluice.operators.quality.states import MetricStore
from sluice.plans.registry import Tables, plan
from sluice.sinks.keyed import KeyedTable
from sluice.streaming import incremental as inc

# ---- JSON

# Every click event lost its closing brace.
BROKEN = "(SELECT event_id, CASE WHEN event_type = 'click' THEN rtrim(props, '}') ELSE props END AS doc FROM events)"


def _broken(t: Tables):
    cut = F.when(F.col("event_type") == "click", F.rtrim(F.col("props"), F.lit("}"))).otherwise(F.col("props"))
    return t.events.select("event_id", cut.alias("doc"))


@plan("f01_malformed_split", f"SELECT event_id, doc, CASE WHEN json_valid(doc) THEN 'good' ELSE 'bad' END AS side FROM {BROKEN}")
def malformed_split(t: Tables):
    s = fl.split_json(_broken(t), "doc")
    return s.good.withColumn("side", F.lit("good")).unionByName(s.bad.withColumn("side", F.lit("bad")))


def _nested(t: Tables):
    """One document per event: scalars, a nested object and two lists."""
    k = F.get_json_object("props", "$.k").cast("int")
    item = lambda d: F.struct((k + d).alias("@nr"), F.when(k + d > 50, "high").alias("lvl:x"))
    doc = F.struct(
        F.col("event_id").alias("Id"),
        F.struct(F.col("event_type").alias("Kind"), F.struct(F.col("user_id").alias("Id")).alias("User")).alias("Meta"),
        F.when(F.col("value") > 20, F.array(item(0), item(1))).alias("Items"),
        F.array(F.col("event_type")).alias("Tags"),
    )
    return t.events.select("event_id", F.to_json(doc).alias("doc"))


@plan("f02_path_inventory", """
WITH e AS (SELECT event_id, event_type, user_id, value, (props ->> '$.k')::INT AS k FROM events)
SELECT DISTINCT unnest(['/root/Id', '/root/Meta', '/root/Meta/User', '/root/Tags']) AS path FROM e
UNION SELECT '/root/Meta/Kind' FROM e WHERE event_type IS NOT NULL UNION SELECT '/root/Meta/User/Id' FROM e WHERE user_id IS NOT NULL
UNION SELECT unnest(['/root/Items', '/root/Items/@nr']) FROM e WHERE value > 20 AND k IS NOT NULL
UNION SELECT '/root/Items/lvl:x' FROM e WHERE value > 20 AND k + 1 > 50""")
def path_inventory(t: Tables):
    return fl.json_paths(_nested(t), "doc").select("path").distinct()


@plan("f02_paths_with_conflicts", """
SELECT '/root/' || k AS path, t AS type, count(*) > 0 AS found FROM (
  SELECT 'role' AS k, 'string' AS t FROM conversations UNION ALL SELECT 'body', 'string' FROM conversations WHERE turn % 2 = 0
  UNION ALL SELECT 'body', 'object' FROM conversations WHERE turn % 2 = 1
  UNION ALL SELECT 'body/text', 'string' FROM conversations WHERE turn % 2 = 1) GROUP BY ALL""")
def paths_with_conflicts(t: Tables):
    # Every second turn wraps its text in an object.
    plain = F.to_json(F.struct("role", F.col("text").alias("body")))
    wrapped = F.to_json(F.struct("role", F.struct("text").alias("body")))
    docs = t.conversations.select(F.when(F.col("turn") % 2 == 0, plain).otherwise(wrapped).alias("doc"))
    return fl.json_paths(docs, "doc").withColumn("found", F.lit(True))


@plan("f04_flatten_conversations", """
SELECT conv_id::VARCHAR AS root_conv, NULL::VARCHAR AS turns_role, NULL::VARCHAR AS turns_text FROM conversations
UNION SELECT conv_id::VARCHAR, role, text FROM conversations""")
def flatten_conversations(t: Tables):
    # One document per conversation, its turns a list.
    turns = F.array_sort(F.collect_list(F.struct("turn", "role", "text")))
    bare = F.transform(turns, lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text")))
    docs = t.conversations.groupBy("conv_id").agg(bare.alias("turns"))
    docs = docs.select(F.to_json(F.struct(F.col("conv_id").alias("conv"), "turns")).alias("doc"))
    return fl.flatten_json(docs, "doc")


@plan("f04_flatten_custom", """
WITH e AS (SELECT event_id::VARCHAR AS root_id, event_type, user_id::VARCHAR AS user_id, value, (props ->> '$.k')::INT AS k FROM events)
SELECT root_id, event_type AS meta_kind, user_id, NULL::VARCHAR AS items_atr_nr, NULL::VARCHAR AS items_lvl_x, NULL::VARCHAR AS root_tags FROM e
UNION SELECT root_id, event_type, user_id, NULL, NULL, event_type FROM e
UNION SELECT root_id, event_type, user_id, (k + d)::VARCHAR, CASE WHEN k + d > 50 THEN 'high' END, NULL
  FROM e, (VALUES (0), (1)) s(d) WHERE value > 20""")
def flatten_custom(t: Tables):
    return fl.flatten_json(_nested(t), "doc")


@plan("f04_flatten_generic", """
WITH e AS (SELECT event_id::VARCHAR AS id, event_type, user_id::VARCHAR AS user_id, value, (props ->> '$.k')::INT AS k FROM events)
SELECT id, event_type AS kind, user_id, NULL::VARCHAR AS atr_nr, NULL::VARCHAR AS x, NULL::VARCHAR AS tags FROM e
UNION SELECT id, event_type, user_id, NULL, NULL, event_type FROM e
UNION SELECT id, event_type, user_id, (k + d)::VARCHAR, CASE WHEN k + d > 50 THEN 'high' END, NULL
  FROM e, (VALUES (0), (1)) s(d) WHERE value > 20""")
def flatten_generic(t: Tables):
    return fl.flatten_json(_nested(t), "doc", naming="generic", remove=["lvl:"])


@plan("f04_flatten_props", "SELECT DISTINCT event_id, (props ->> '$.k') AS root_k FROM events")
def flatten_props(t: Tables):
    return fl.flatten_json(t.events, "props", keep=["event_id"])


# ---- type detection

TEXT_ORDERS = """(SELECT o_orderkey::VARCHAR AS k, CASE o_orderstatus WHEN 'F' THEN printf('%.2f', o_totalprice) WHEN 'O' THEN o_custkey::VARCHAR ELSE '' END AS amount,
  CASE o_orderstatus WHEN 'P' THEN strftime(o_orderdate, '%Y%m%d') ELSE o_custkey::VARCHAR END AS mixed,
  strftime(o_orderdate, '%Y-%m-%d') AS day, strftime(o_orderdate, '%d/%m/%Y') AS day2, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS stamp,
  upper(strftime(o_orderdate, '%d%b%Y:%H:%M:%S')) AS sas, o_orderpriority AS priority FROM orders)"""


def _text_orders(t: Tables):
    status, cust, date = F.col("o_orderstatus"), F.col("o_custkey").cast("string"), F.col("o_orderdate")
    return t.orders.select(
        F.col("o_orderkey").cast("string").alias("k"),
        F.when(status == "F", F.col("o_totalprice").cast("decimal(18,2)").cast("string")).when(status == "O", cust).otherwise("").alias("amount"),
        F.when(status == "P", F.date_format(date, "yyyyMMdd")).otherwise(cust).alias("mixed"),
        F.date_format(date, "yyyy-MM-dd").alias("day"), F.date_format(date, "dd/MM/yyyy").alias("day2"),
        F.date_format(date, "yyyy-MM-dd HH:mm:ss").alias("stamp"), F.upper(F.date_format(date, "ddMMMyyyy:HH:mm:ss")).alias("sas"),
        F.col("o_orderpriority").alias("priority"),
    )


def _class_sql(c: str) -> str:
    return f"""CASE WHEN trim({c}) = '' THEN ''
      WHEN regexp_matches({c}, '^[0-9]{{4}}-[0-9]+-[0-9]+$') THEN 'yyyy-MM-dd' WHEN regexp_matches({c}, '^[0-9]+/[0-9]+/[0-9]{{4}}$') AND try_strptime({c}, '%d/%m/%Y') IS NOT NULL THEN 'dd/MM/yyyy'
      WHEN regexp_matches({c}, '^[0-9]{{8}}$') AND try_strptime({c}, '%Y%m%d') IS NOT NULL THEN 'yyyyMMdd'
      WHEN regexp_matches({c}, '^[0-9]{{2}}[A-Z]{{3}}[0-9]{{4}}:') THEN 'ddMMMyyyy:HH:mm:ss' WHEN regexp_matches({c}, '^[0-9]{{4}}-[0-9]+-[0-9]+ ') THEN 'yyyy-MM-dd HH:mm:ss'
      WHEN regexp_matches({c}, '^(-?[1-9][0-9]*|0)$') THEN 'bigint' WHEN regexp_matches({c}, '^-?[0-9]+\\.[0-9]+$') THEN 'double' ELSE 'string' END"""


TEXT_COLUMNS = ("k", "amount", "mixed", "day", "day2", "stamp", "sas", "priority")


@plan("t01_cell_classes", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", {_class_sql(c)} AS class, count(*) AS n FROM {TEXT_ORDERS} GROUP BY 1, 2" for c in TEXT_COLUMNS))
def cell_classes(t: Tables):
    return inf.class_counts(_text_orders(t))


@plan("t02_column_types", """
SELECT * FROM (VALUES ('k', 'bigint'), ('amount', 'double'), ('mixed', 'bigint'), ('day', 'yyyy-MM-dd'), ('day2', 'dd/MM/yyyy'),
  ('stamp', 'yyyy-MM-dd HH:mm:ss'), ('sas', 'ddMMMyyyy:HH:mm:ss'), ('priority', 'string')) s("column", type) WHERE (SELECT count(*) FROM orders) > 0""")
def column_types(t: Tables):
    return inf.infer_types(_text_orders(t))


@plan("t03_cast_to_inferred", f"""
SELECT k::BIGINT AS k, nullif(amount, '')::DOUBLE AS amount, mixed::BIGINT AS mixed, day::DATE AS day, day::DATE AS day2,
  stamp::TIMESTAMP AS stamp, stamp::TIMESTAMP AS sas, priority FROM {TEXT_ORDERS}""")
def cast_to_inferred(t: Tables):
    df = _text_orders(t)
    return inf.cast_inferred(df, inf.types_of(inf.infer_types(df)))


LINES = """(SELECT n_nationkey || '|"' || n_name || ', north"|' || n_regionkey || CASE WHEN n_regionkey = 2 THEN '|extra' ELSE '' END AS value FROM nation)"""


def _lines(t: Tables):
    return t.nation.select(
        F.concat(
            F.col("n_nationkey").cast("string"), F.lit('|"'), "n_name", F.lit(', north"|'), F.col("n_regionkey").cast("string"),
            F.when(F.col("n_regionkey") == 2, "|extra").otherwise(""),
        ).alias("value")
    )


@plan("t04_delimiter", f"""
WITH n AS (SELECT length(plain) - length(replace(plain, '|', '')) AS pipes FROM (SELECT regexp_replace(value, '"[^"]*"', '', 'g') AS plain FROM {LINES}))
SELECT 'pipe' AS candidate, pipes::INT AS mode FROM n GROUP BY pipes ORDER BY count(*) DESC, pipes DESC LIMIT 1""")
def delimiter(t: Tables):
    # Each line has one comma, but in quotes; it has two or three pipes.
    return inf.detect_delimiter(_lines(t)).select("candidate", "mode")


@plan("t04_delimiter_and_quoting", "SELECT 'pipe' AS candidate, 3 AS mode, 'minimal' AS quoting FROM (SELECT count(*) FROM orders)")
def delimiter_and_quoting(t: Tables):
    def quoted(c):
        return F.concat(F.lit('"'), F.col(c), F.lit('"'))

    maybe = F.when(F.col("o_orderstatus") == "P", F.col("o_orderpriority")).otherwise(quoted("o_orderpriority"))
    lines = t.orders.select(
        F.concat_ws("|", F.col("o_orderkey").cast("string"), maybe, F.col("o_custkey").cast("string"), F.col("o_totalprice").cast("string")).alias("value")
    )
    found = inf.detect_delimiter(lines)
    name = found.first()["candidate"]
    style = inf.detect_quoting(lines, inf.DELIMITERS[name])
    return found.select("candidate", "mode").withColumn("quoting", style.scalar())


@plan("t05_ragged_lines", f"SELECT value, CASE WHEN value LIKE '%|extra' THEN 'bad' ELSE 'good' END AS side FROM {LINES}")
def ragged_lines(t: Tables):
    s = inf.split_ragged(_lines(t), r"\|")
    return s.good.withColumn("side", F.lit("good")).unionByName(s.bad.withColumn("side", F.lit("bad")))


@plan("t05_split_fields", """
SELECT n_nationkey::VARCHAR AS id, n_name || ', north' AS label, n_regionkey::VARCHAR AS region,
  CASE WHEN n_regionkey = 2 THEN 'bad' ELSE 'good' END AS side FROM nation""")
def split_fields(t: Tables):
    s = inf.split_ragged(_lines(t), r"\|")
    fields = lambda df, side: inf.split_fields(df, r"\|", ["id", "label", "region"]).withColumn("side", F.lit(side))
    return fields(s.good, "good").unionByName(fields(s.bad, "bad"))


# ---- incremental loads


@plan("i01_new_files", "SELECT event_type, 2::BIGINT AS folders, count(*) * 2 AS n FROM events GROUP BY event_type")
def new_files(t: Tables):
    """Two deliveries and a run without news in between."""
    incoming, target, checkpoint = t.scratch("incoming"), t.scratch("target"), t.scratch("stream")
    events = t.events
    for delivery in range(2):
        events.write.mode("append").parquet(incoming)
        for _ in range(2):
            inc.read_new(t.spark, incoming, events.schema, target, checkpoint)
    back = t.spark.read.parquet(target)
    return back.groupBy("event_type").agg(F.count_distinct("batch").alias("folders"), F.count(F.lit(1)).alias("n"))


@plan("i02_incremental_upsert", """
SELECT user_id, event_id, event_type FROM events WHERE event_type <> 'error'
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1""")
def incremental_upsert(t: Tables):
    """Events arrive by type, one delivery after the other; errors come without a type."""
    incoming, root, checkpoint = t.scratch("incoming"), t.scratch("current"), t.scratch("stream")
    name = "sluice_current_events"
    t.spark.sql(f"DROP TABLE IF EXISTS {name}")
    kind = F.col("event_type")
    df = t.events.select("user_id", "event_id", F.when(kind != "error", kind).alias("event_type"))
    for part in (df.where("event_type = 'click'"), df.where("event_type IS NULL OR event_type <> 'click'")):
        part.write.mode("append").parquet(incoming)
        inc.upsert_new(t.spark, incoming, df.schema, name, root, checkpoint, ["user_id"], "event_id", ["event_type"])
    return t.spark.table(name)


@plan("i02_keyed_upsert", """
SELECT user_id, event_id, event_type FROM events WHERE event_type <> 'error'
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1""")
def keyed_upsert(t: Tables):
    """As before, into a keyed table; the second delivery comes in three batches' worth of files."""
    incoming, checkpoint = t.scratch("incoming"), t.scratch("stream")
    kind = F.col("event_type")
    df = t.events.select("user_id", "event_id", F.when(kind != "error", kind).alias("event_type"))
    table = KeyedTable.create(t.spark, t.scratch("current"), df.limit(0), ["user_id"], "event_id", cells=8)
    for part in (df.where("event_type = 'click'"), df.where("event_type IS NULL OR event_type <> 'click'")):
        part.write.mode("append").parquet(incoming)
        inc.merge_new(t.spark, incoming, df.schema, table, checkpoint, ["event_type"])
    return table.read()


@plan("i03_quality_log", """
SELECT 'batch' AS "check", 'Warning' AS check_level, 'Size(*)' AS "constraint", 'Success' AS constraint_status, count(*)::DOUBLE AS value FROM events
UNION ALL SELECT 'batch', 'Warning', 'Completeness(event_type)', 'Success', 1.0""")
def quality_log(t: Tables):
    incoming, log, checkpoint = t.scratch("incoming"), t.scratch("log"), t.scratch("stream")
    events = t.events
    events.write.parquet(incoming)
    check = Check("warning", "batch").has_size(lambda v: v > 0).is_complete("event_type")
    inc.log_quality(t.spark, incoming, events.schema, [check], log, checkpoint)
    return t.spark.read.parquet(log).select("check", "check_level", "constraint", "constraint_status", "value")


@plan("i03_metrics_of_all_batches", """
SELECT 'Dataset' AS entity, '*' AS instance, 'Size' AS name, count(*)::DOUBLE AS value FROM events
UNION ALL SELECT 'Column', 'value', 'Mean', round(avg(value), 6) FROM events
UNION ALL SELECT 'Column', 'value', 'StandardDeviation', round(stddev_pop(value), 6) FROM events
UNION ALL SELECT 'Column', 'user_id', 'CountDistinct', count(DISTINCT user_id)::DOUBLE FROM events
UNION ALL SELECT 'Column', 'event_type', 'Uniqueness', (SELECT count(*) FILTER (WHERE n = 1) FROM (SELECT event_type, count(*) AS n FROM events WHERE event_type IS NOT NULL GROUP BY 1)) / count(*)::DOUBLE FROM events""")
def metrics_of_all_batches(t: Tables):
    """Events arrive in three deliveries; each is measured once, and none is read again."""
    incoming, checkpoint = t.scratch("incoming"), t.scratch("stream")
    metrics = [a.size(), a.mean("value"), a.standard_deviation("value"), a.count_distinct("user_id"), a.uniqueness("event_type")]
    store = MetricStore(t.spark, t.scratch("states"), metrics)
    for part in range(3):
        t.events.where(F.col("event_id") % 3 == part).write.mode("append").parquet(incoming)
        inc.measure_new(t.spark, incoming, t.events.schema, store, checkpoint)
    return store.read().withColumn("value", F.round("value", 6))


# ---- ML data jobs


@plan("m01_indicators", """
SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN 1 ELSE 0 END AS balance_known, CASE WHEN c_mktsegment = 'BUILDING' THEN 1 ELSE 0 END AS building FROM customer""")
def indicators(t: Tables):
    df = t.customer.withColumn("balance", F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")))
    out = ml.add_indicators(df, {"balance_known": F.col("balance").isNotNull(), "building": F.col("c_mktsegment") == "BUILDING"})
    return out.select("c_custkey", "balance_known", "building")


@plan("m02_mean_imputation", """
SELECT event_id, round(coalesce(v, (SELECT avg(v) FROM (SELECT CASE WHEN event_type <> 'view' THEN value END AS v FROM events))), 6) AS v
FROM (SELECT event_id, CASE WHEN event_type <> 'view' THEN value END AS v FROM events)""")
def mean_imputation(t: Tables):
    df = t.events.select("event_id", F.when(F.col("event_type") != "view", F.col("value")).alias("v"))
    return ml.impute_mean(df, ["v"]).withColumn("v", F.round("v", 6))


@plan("m03_label_encoding", """
WITH p AS (SELECT p_partkey, CASE WHEN p_size > 3 THEN p_brand ELSE 'nan' END AS b FROM part),
c AS (SELECT b, row_number() OVER (ORDER BY b) - 1 AS code FROM (SELECT DISTINCT b FROM p))
SELECT p_partkey, code FROM p JOIN c USING (b)""")
def label_encoding(t: Tables):
    df = t.part.select("p_partkey", F.when(F.col("p_size") > 3, F.col("p_brand")).alias("brand"))
    return ml.label_encode(df, "brand", "code").select("p_partkey", "code")


@plan("m04_split", """
SELECT c_custkey, CASE WHEN u < 0.7 THEN 'train' WHEN u < 0.85 THEN 'validation' ELSE 'test' END AS part
FROM (SELECT c_custkey, ('0x' || left(md5('7:' || c_custkey), 8))::BIGINT / 4294967296.0 AS u FROM customer)""")
def split(t: Tables):
    parts = ml.split(t.customer.select("c_custkey"), "c_custkey", {"train": 0.7, "validation": 0.15, "test": 0.15}, seed=7)
    out = None
    for name, df in parts.items():
        one = df.withColumn("part", F.lit(name))
        out = one if out is None else out.unionByName(one)
    return out


def _vectors(t: Tables):
    return t.embeddings.withColumn("target", (F.col("label") % 2).cast("double"))


LEARNED = "SELECT vec_id, (label % 2)::DOUBLE AS target, true AS valid, true AS learned FROM embeddings"


def _learned(t: Tables, scored):
    """Every scored row with its class, whether the prediction is a class, and whether all of them are as good as the most frequent class at least."""
    pairs = scored.join(_vectors(t).select("vec_id", "target"), "vec_id")
    right = F.avg((F.col("prediction") == F.col("target")).cast("int"))
    usual = F.greatest(F.avg("target"), 1 - F.avg("target"))
    learned = pairs.agg((right >= usual).alias("learned")).scalar()
    return pairs.select("vec_id", "target", F.col("prediction").isin(0.0, 1.0).alias("valid"), learned.alias("learned"))


@plan("m05_logistic_regression", LEARNED)
def logistic_regression(t: Tables):
    model = ml.fit_logistic(_vectors(t), "embedding", "target", c=1.0, l1_ratio=0.1, max_iter=20)
    scored = model.transform(ml.assemble(_vectors(t), "embedding"))
    better = F.lit(ml.auc(scored, "target") > 0.5)
    return _learned(t, scored.select("vec_id", "prediction")).withColumn("learned", F.col("learned") & better)


@plan("m06_random_forest", LEARNED)
def random_forest(t: Tables):
    model = ml.fit_forest(_vectors(t), "embedding", "target", n_estimators=10, max_depth=4, seed=1)
    return _learned(t, ml.score(_vectors(t), model, "embedding", ["vec_id"]))


@plan("m07_hyper_parameter_search", LEARNED)
def hyper_parameter_search(t: Tables):
    data = ml.assemble(_vectors(t), "embedding")
    forest = RandomForestClassifier(labelCol="target", seed=3)
    found = ml.tune(
        data, forest, {"numTrees": ("integer", 3, 8), "maxDepth": ("integer", 2, 4), "subsamplingRate": ("continuous", 0.5, 1.0),
                       "impurity": ("categorical", ["gini", "entropy"])},
        MulticlassClassificationEvaluator(labelCol="target", metricName="accuracy"), n=4, parallelism=2, seed=3, key="vec_id",
    )
    return _learned(t, ml.score(_vectors(t), found.model, "embedding", ["vec_id"]))


@plan("m07_trials")
def trials(t: Tables):
    """Each trial's score, and which is the best."""
    data = ml.assemble(_vectors(t), "embedding")
    found = ml.tune(
        data, RandomForestClassifier(labelCol="target", seed=3), {"numTrees": ("integer", 3, 8)},
        MulticlassClassificationEvaluator(labelCol="target", metricName="accuracy"), n=3, parallelism=2, seed=3, key="vec_id",
    )
    rows = [(i, float(score), score == max(found.scores)) for i, score in enumerate(found.scores)]
    return t.spark.createDataFrame(rows, "trial int, accuracy double, best boolean")


@plan("m08_scored_rows")
def scored_rows(t: Tables):
    model = ml.fit_logistic(_vectors(t), "embedding", "target", max_iter=10)
    return ml.score(_vectors(t), model, "embedding", ["vec_id"])


@plan("m08_batch_scoring", LEARNED)
def batch_scoring(t: Tables):
    model = ml.fit_logistic(_vectors(t), "embedding", "target", max_iter=10)
    return _learned(t, ml.score(_vectors(t), model, "embedding", ["vec_id"]))


METRICS_SQL = """
WITH c AS (SELECT k, sum((quality = k AND toxic = k)::INT) AS tp, sum((quality = k)::INT) AS a, sum((toxic = k)::INT) AS p, count(*) AS n
  FROM labels, (VALUES (0), (1)) s(k) GROUP BY k),
r AS (SELECT *, coalesce(tp / nullif(p, 0), 0) AS pr, coalesce(tp / nullif(a, 0), 0) AS re FROM c),
f AS (SELECT *, coalesce(2 * pr * re / nullif(pr + re, 0), 0) AS f1 FROM r)"""


@plan("m09_class_metrics", METRICS_SQL + """
SELECT 'accuracy' AS metric, round(sum(tp) / max(n), 8) AS score FROM f UNION ALL SELECT 'precision', round(avg(pr), 8) FROM f
UNION ALL SELECT 'recall', round(avg(re), 8) FROM f UNION ALL SELECT 'f1', round(avg(f1), 8) FROM f""")
def class_metrics(t: Tables):
    return ml.class_metrics(t.labels, "quality", "toxic").withColumn("score", F.round("score", 8))


@plan("m10_confusion", """
SELECT quality::VARCHAR AS y, count(*) FILTER (WHERE toxic = 0) AS "0", count(*) FILTER (WHERE toxic = 1) AS "1" FROM labels GROUP BY quality""")
def confusion(t: Tables):
    return ml.confusion(t.labels, "quality", "toxic")


@plan("m10_one_vs_rest", METRICS_SQL + """
SELECT k::VARCHAR AS class, (n - a - p + tp)::BIGINT AS tn, (p - tp)::BIGINT AS fp, (a - tp)::BIGINT AS fn, tp::BIGINT AS tp FROM c""")
def one_vs_rest(t: Tables):
    return ml.one_vs_rest(t.labels, "quality", "toxic")


# ---- grids

POINTS = "(SELECT event_id, (user_id * 7919 % 17000) / 100.0 - 85 AS lat, (user_id * 104729 % 36000) / 100.0 - 180 AS lng FROM events)"


def _points(t: Tables):
    return t.events.select(
        "event_id", ((F.col("user_id") * 7919 % 17000) / 100.0 - 85).alias("lat"),
        ((F.col("user_id") * 104729 % 36000) / 100.0 - 180).alias("lng"),
    )


def _cells_sql(scale: str, wrap: int) -> str:
    return f"(SELECT floor((lat + 90) * {scale})::BIGINT AS r, (floor((lng + 180) * {scale})::BIGINT % {wrap}) AS c, count(*) AS n FROM {POINTS} GROUP BY 1, 2)"


@plan("geo01_bin_points", f"SELECT r * 4294967296 + c AS cell, n FROM {_cells_sql('4', 1440)}")
def bin_points(t: Tables):
    return geo.bin_points(_points(t), "lat", "lng", 2)


@plan("geo02_roll_up", f"SELECT (r // 8) * 4294967296 + c // 8 AS cell, sum(n)::BIGINT AS n FROM {_cells_sql('4', 1440)} GROUP BY 1")
def roll_up(t: Tables):
    return geo.roll_up(geo.bin_points(_points(t), "lat", "lng", 2), 3)


@plan("geo03_neighbourhood", f"""
WITH g AS {_cells_sql('1', 360)}
SELECT a.r * 4294967296 + a.c AS cell, a.n, sum(b.n)::BIGINT AS ring_n FROM g a JOIN g b
  ON abs(a.r - b.r) <= 2 AND least(abs(a.c - b.c), 360 - abs(a.c - b.c)) <= 2 GROUP BY ALL""")
def neighbourhood(t: Tables):
    return geo.ring_sum(geo.bin_points(_points(t), "lat", "lng", 0), 2, 0)


@plan("geo04_compact", """
WITH g AS (SELECT DISTINCT o_orderkey // 64 AS r, o_orderkey % 64 AS c FROM orders),
l(level) AS (VALUES (0), (1), (2), (3)),
f AS (SELECT level, r >> level AS r, c >> level AS c FROM g, l GROUP BY ALL HAVING count(*) = 1 << (2 * level)),
k AS (SELECT f.level, f.r, f.c FROM f LEFT JOIN f p ON p.level = f.level + 1 AND p.r = f.r >> 1 AND p.c = f.c >> 1 WHERE p.level IS NULL)
SELECT level, count(*) AS cells, sum(r * 4294967296 + c)::BIGINT AS cell_sum FROM k GROUP BY level""")
def compact(t: Tables):
    k = F.col("o_orderkey")
    cells = t.orders.select(F.floor(k / 64).alias("r"), (k % 64).alias("c")).select(geo._cell(F.col("r"), F.col("c")).alias("cell"))
    return geo.compact(cells, 3).groupBy("level").agg(F.count(F.lit(1)).alias("cells"), F.sum("cell").alias("cell_sum"))


@plan("geo05_radius_join", f"""
WITH p AS (SELECT lat, lng, count(*) AS n FROM {POINTS} GROUP BY ALL),
s AS (SELECT (s_suppkey * 7919 % 17000) / 100.0 - 85 AS lat, (s_suppkey * 104729 % 36000) / 100.0 - 180 AS lng FROM supplier),
q AS (SELECT lat, lng, count(*) AS n FROM s GROUP BY ALL)
SELECT p.lat AS lat_a, p.lng AS lng_a, p.n AS n_a, q.lat AS lat_b, q.lng AS lng_b, q.n AS n_b, round(km, 6) AS km FROM (
  SELECT p, q, 2 * 6371.007180918475 * asin(least(1.0, sqrt(pow(sin((radians(q.lat) - radians(p.lat)) / 2), 2)
    + cos(radians(p.lat)) * cos(radians(q.lat)) * pow(sin((radians(q.lng) - radians(p.lng)) / 2), 2)))) AS km FROM p, q) WHERE km <= 600""")
def radius_join(t: Tables):
    sites = t.supplier.select(
        ((F.col("s_suppkey") * 7919 % 17000) / 100.0 - 85).alias("lat"), ((F.col("s_suppkey") * 104729 % 36000) / 100.0 - 180).alias("lng")
    )
    return geo.within(_points(t), sites, 600.0).withColumn("km", F.round("km", 6))
