import random
from collections import Counter

from pyspark.sql import functions as F

import corpus_pipeline
from sluice.llm.simhash import simhash_near_dedup


def words(text):
    return len((text or "").encode().split())


def test_stages(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    extra = spark.createDataFrame(
        [(90001, None, "en", "src0", 0), (90002, "12 34", "en", "src0", 5), (None, "only here the and of thing", "en", "src1", 9)], docs.schema
    )
    docs = docs.unionByName(extra).unionByName(docs.where("doc_id < 3"))
    outputs = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, "/root/testdata/sf0.001")
        path = str(tmp_path / name)
        out.write.parquet(path)
        result = spark.read.parquet(path)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert result.columns == docs.columns
            assert [f.dataType for f in result.schema] == [f.dataType for f in docs.schema]
        outputs[name] = (docs, result)
        docs = result
    before, after = outputs["language_id"]
    gone = {r.doc_id for r in before.join(after, "doc_id", "left_anti").collect()}
    assert {90001, 90002} <= gone and len(gone) <= 0.02 * before.count() + 3
    before, after = outputs["simhash_near_dedup"]
    roots = {r.component_id for r in simhash_near_dedup(before.where("doc_id is not null")).collect()}
    kept = [r.doc_id for r in after.collect()]
    assert sorted(k for k in kept if k is not None) == sorted(roots) and kept.count(None) == 1
    before, after = outputs["substring_dedup"]
    assert Counter(r.doc_id for r in before.collect()) == Counter(r.doc_id for r in after.collect())
    before, after = outputs["mixing"]
    total = sum(words(r.text) for r in before.collect())
    assert abs(sum(words(r.text) for r in after.collect()) - 1.5 * total) < 0.01 * total
    before, after = outputs["packing"]
    pieces = Counter()
    for r in after.collect():
        pieces[r.doc_id] += r.length
    assert pieces.keys() == {r.doc_id for r in before.collect()}


def test_run(spark):
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert {"doc_id", "sequence_id", "offset", "length"} <= set(out.columns) and out.count() > 0


def test_empty_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, "")
        assert out.count() == 0, name
        if name != "packing":
            assert out.columns == docs.columns


def stage(name):
    return dict(corpus_pipeline.STAGES)[name]


def own(seed, count):
    rng = random.Random(seed)
    return " ".join(f"q{rng.randrange(10**9)}" for _ in range(count))


def test_one_id_with_several_texts(spark):
    """Different texts of one id are different documents in every stage."""
    a, b, line = own(1, 200), own(2, 200), own(3, 40)
    docs = spark.createDataFrame([(1, a), (1, b), (1, b), (2, f"{own(4, 80)}\n{line}\n{own(5, 90)}"), (3, f"{own(6, 100)}\n{line}"), (3, own(7, 200)), (None, a), (None, own(8, 60))], "doc_id long, text string")
    kept = Counter((r.doc_id, r.text) for r in stage("simhash_near_dedup")(spark, docs, "").collect())
    texts = {(r.doc_id, r.text) for r in docs.collect()}
    assert kept == Counter(texts - {(None, a)})
    cut = {(r.doc_id, len(r.text.split())) for r in stage("substring_dedup")(spark, docs.where("doc_id > 1"), "").collect()}
    assert cut == {(2, 210), (3, 100), (3, 200)}


def test_columns_that_clash_with_helpers(spark):
    names = ["key", "kept", "row", "judged", "id", "mark", "spans", "id_of_spans", "mark_of_spans", "copy", "number", "cut", "size", "taken", "mix_source", "_id", "_key", "_lang", "_copy", "plan_id", "target", "blocks", "name", "sid", "shard"]
    source = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60)
    docs = source.withColumns({n: F.lit(i) for i, n in enumerate(names)})
    for name, run in corpus_pipeline.STAGES[:-1]:
        out = run(spark, docs, "")
        assert out.columns == docs.columns, name
        rows = out.collect()
        assert rows and all(r[n] == i for r in rows for i, n in enumerate(names)), name
        assert Counter(r.text for r in rows) == Counter(r.text for r in run(spark, source, "").collect()), name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, "").count() > 0
