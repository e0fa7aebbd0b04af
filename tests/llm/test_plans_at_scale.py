"""Packing of equal lengths and mixing of many sources, at sizes where their plans matter."""

import random
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from sluice.llm import mixing
from sluice.llm.mixing import mix_plan, mixed, targets
from sluice.llm.packing import pack, pack_histogram

WORD_FILE = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("counts", [
    {301: 500}, {2048: 100, 600: 10_000}, {1: 5}, {1: 10_000}, {1025: 77}, {683: 100, 682: 100}, {1024: 3, 1025: 9}, {2047: 4, 1: 3},
    {700: 1000, 300: 50, 7: 3},
])
def test_packs_of_few_lengths(counts):
    """At most two percent, or one sequence, above what one length needs."""
    patterns = pack_histogram(counts)
    assert all(sum(p) <= 2048 and n > 0 for p, n in patterns)
    assert Counter({k: sum(p.count(k) * n for p, n in patterns) for k in counts}) == Counter(counts)
    need = sum(-(-n // (2048 // length)) for length, n in counts.items())
    assert sum(n for _, n in patterns) <= need * 1.02 + 1


def padding(rows):
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        ends = [0, *(o + n for o, n in sorted(parts))]
        assert [o for o, _ in sorted(parts)] == ends[:-1] and ends[-1] <= 2048
    return len(sequences), 1 - sum(r.length for r in rows) / (2048 * len(sequences))


def test_equal_documents_share_sequences(spark):
    text = "the " * 300
    rows = pack(spark.range(500).select(F.col("id").alias("doc_id"), F.lit(text).alias("text")), WORD_FILE).collect()
    assert {r.length for r in rows} == {301}
    assert padding(rows)[0] == 84


def test_copies_beside_other_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    one = docs.where("length(text) > 400").orderBy("doc_id").limit(1)
    copies = one.crossJoin(spark.range(2000)).select((F.col("id") + 10**6).alias("doc_id"), "text")
    alone = pack(docs, WORD_FILE).collect()
    length = next(r.length for r in pack(one, WORD_FILE).collect())
    together = pack(docs.unionByName(copies), WORD_FILE).collect()
    # At most two percent above what the copies need among themselves beside what the others need.
    assert padding(together)[0] <= 1.02 * (padding(alone)[0] + -(-2000 // (2048 // length)))


# Mixing


@pytest.mark.parametrize("shard_blocks, shard_docs", [(1024, 1 << 16), (40, 1 << 16), (1024, 5)])
def test_quotas_are_met_exactly(spark, monkeypatch, shard_blocks, shard_docs):
    """Sources of very different sizes, in one shard or many: near the target, whole blocks, no more than twice a document."""
    monkeypatch.setattr(mixing, "SHARD_BLOCKS", shard_blocks)
    monkeypatch.setattr(mixing, "SHARD_DOCS", shard_docs)
    rng = random.Random(1)
    docs = [(i, "w " * rng.randint(0, 400), rng.choice(["big"] * 12 + ["middle"] * 3 + ["small", "é", None])) for i in range(600)]
    docs += [(9000, "only three words", "tiny"), (9001, None, "void"), (9002, "", "void"), *[(9003, "w " * 50, "copies")] * 40]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    plan = mix_plan(df).collect()
    assert len(plan) == len(docs)
    size, taken, goal = Counter(), Counter(), {}
    for r in plan:
        size[r.mix_source] += r["size"]
        taken[r.mix_source] += r.taken
        goal[r.mix_source] = r.target
        assert 0 <= r.taken <= 2 * r["size"] and r.source_size >= r["size"]
    names = sorted(s for s in size if s is not None) + [None]
    want = dict(zip(names, targets([size[s] for s in names], [(3, 1, 2)[i % 3] for i in range(len(names))])))
    assert goal == pytest.approx(want)
    for s in names:
        assert abs(taken[s] - want[s]) <= max(1.5, 0.01 * want[s]), s
    again = mix_plan(df.repartition(7)).collect()
    assert Counter((r.doc_id, r.taken) for r in again) == Counter((r.doc_id, r.taken) for r in plan)
    words, planned = Counter(), Counter()
    for r in mixed(df).collect():
        words[r.doc_id] += len(r.text.split())
    for r in plan:
        planned[r.doc_id] += r.taken
    assert +words == +planned


def test_quotas_of_two_hundred_thousand_sources(spark):
    docs = spark.range(200_000).selectExpr("id AS doc_id", "repeat('w ', int(20 + id * 7919 % 180)) AS text", "concat('site', id) AS source")
    got = mix_plan(docs).select("size", "target", "taken")
    row = got.agg(F.count(F.lit(1)).alias("n"), F.max(F.abs(F.col("taken") - F.col("target"))).alias("off"), F.sum("target").alias("goal"), F.sum("taken").alias("taken")).first()
    assert row.n == 200_000 and row.off <= 1 and abs(row.taken / row.goal - 1) < 0.005
