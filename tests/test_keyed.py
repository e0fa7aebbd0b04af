"""The keyed table: merges against plain dictionaries, what is rewritten, versions, failures."""

import random

import pytest
from pyspark.sql import functions as F

from sluice.sinks import keyed
from sluice.sinks.keyed import Conflict, KeyedTable
from sluice.streaming.incremental import merge_new

TYPES = "a string, b int, v int, t string, m map<string, int>"
KEYS = ["a", "b"]


def frame(spark, rows):
    return spark.createDataFrame([(*r, {"x": r[2]}) for r in rows], TYPES)


def content(df):
    return {(r.a, r.b): (r.v, r.t, tuple(r.m.items())) for r in df.collect()}


def merged(state, rows, insert=False):
    out = dict(state)
    best = {}
    for a, b, v, t in rows:
        if (a, b) not in best or v > best[a, b][0]:
            best[a, b] = (v, t, (("x", v),))
    for key, row in best.items():
        if key not in out or (not insert and row[0] >= out[key][0]):
            out[key] = row
    return out


def some_rows(rng, count, mark):
    """Keys with nulls, one first key with most of the rows; versions differ within a key."""
    seen, rows = set(), []
    for i in range(count):
        row = (rng.choice(["hot"] * 6 + ["x", "", None]), rng.choice([None, *range(300)]), rng.randint(0, 9))
        if row not in seen:
            seen.add(row)
            rows.append((*row, f"{mark}{i}"))
    return rows


@pytest.mark.parametrize("cells", [1, 7, 64])
def test_merges(spark, tmp_path, cells):
    rng = random.Random(cells)
    first = some_rows(rng, 500, "f")
    table = KeyedTable.create(spark, str(tmp_path / "t"), frame(spark, first), KEYS, "v", cells)
    states = [merged({}, first)]
    assert content(table.read()) == states[0]
    for step in range(4):
        rows = some_rows(rng, 40, f"s{step}-") + ([("new", step * 100 + i, 1, "n") for i in range(20)] if step % 2 else [])
        insert = step == 2
        version = (table.insert if insert else table.upsert)(frame(spark, rows))
        states.append(merged(states[-1], rows, insert))
        assert version == step + 1 and content(table.read()) == states[-1]
        assert table.read().count() == len(states[-1]) == sum(f["rows"] for f in table.manifest()["files"])
    for v, state in enumerate(states):
        assert content(KeyedTable(spark, table.root).read(v)) == state
    ever = {(k, r) for s in states for k, r in s.items()}
    history = [((r.a, r.b), (r.v, r.t, tuple(r.m.items())), r._since) for r in table.history().collect()]
    assert {h[:2] for h in history} == ever and len(history) == len(ever)
    assert all(since == min(v for v, s in enumerate(states) if s.get(k) == r) for k, r, since in history)
    for old, new in ((0, 1), (1, 4), (4, 2)):
        want = {k: (states[new][k], "insert" if k not in states[old] else "update") for k in states[new] if states[old].get(k) != states[new][k]}
        want |= {k: (states[old][k], "delete") for k in states[old] if k not in states[new]}
        got = {(r.a, r.b): ((r.v, r.t, tuple(r.m.items())), r._change) for r in table.changes(old, new).collect()}
        assert got == want
    before = content(table.read())
    table.compact(most=1)
    assert content(table.read()) == before
    table.retain(2)
    assert len(table.versions()) == 2 and content(table.read()) == before


def test_files_without_changed_keys_stay(spark, tmp_path):
    rows = spark.range(20_000).selectExpr("id", "id % 7 AS x", "1 AS v")
    table = KeyedTable.create(spark, str(tmp_path / "t"), rows, ["id"], "v", 32)
    before = {f["path"]: f for f in table.manifest()["files"]}
    assert len(before) >= 30
    table.upsert(spark.range(5000, 5200).selectExpr("id", "0L AS x", "2 AS v"))
    after = {f["path"] for f in table.manifest()["files"]}
    gone = [f for p, f in before.items() if p not in after]
    assert 1 <= len(gone) <= 3 and sum(f["rows"] for f in gone) < 2500
    # New keys only: nothing is rewritten, also where an upsert brings them.
    table.insert(spark.range(5000, 25_000).selectExpr("id", "9L AS x", "9 AS v"))
    table.upsert(spark.range(30_000, 30_500).selectExpr("id", "9L AS x", "9 AS v"))
    assert after <= {f["path"] for f in table.manifest()["files"]}
    got = table.read().agg(F.count("*"), F.expr("count_if(v = 2)"), F.expr("count_if(v = 9)")).first()
    assert tuple(got) == (25_500, 200, 5500)


def test_a_write_that_fails_leaves_the_version_before(spark, tmp_path, monkeypatch):
    rows = spark.range(1000).selectExpr("id", "1 AS v")
    table = KeyedTable.create(spark, str(tmp_path / "t"), rows, ["id"], "v", 4)
    with monkeypatch.context() as patch:
        patch.setattr(keyed.KeyedTable, "_commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            table.upsert(spark.range(10).selectExpr("id", "2 AS v"))
    assert table.versions() == [0] and table.read().where("v = 2").count() == 0
    # Two writers that start from one version: the second one fails and changes nothing.
    last = table.manifest()
    table.upsert(spark.range(10).selectExpr("id", "2 AS v"))
    with pytest.raises(Conflict):
        table._commit(last, [], "upsert", None)
    assert table.versions() == [0, 1] and table.read().count() == 1000 and table.read().where("v = 2").count() == 10


def test_empty_tables_and_deltas(spark, tmp_path):
    rows = spark.range(0).selectExpr("id", "1 AS v")
    table = KeyedTable.create(spark, str(tmp_path / "t"), rows, ["id"], "v")
    assert table.read().count() == 0 and table.history().count() == 0
    table.upsert(rows)
    table.upsert(spark.range(5).selectExpr("id", "1 AS v"))
    table.insert(rows)
    assert table.read().count() == 5 and table.changes(0, 2).count() == 5 and table.changes(2, 3).count() == 0


def test_a_batch_counts_once(spark, tmp_path):
    schema = "id long, v int"
    table = KeyedTable.create(spark, str(tmp_path / "t"), spark.createDataFrame([], schema), ["id"], "v", 4)
    for i in range(3):
        spark.range(i * 10, i * 10 + 15).selectExpr("id", f"{i} AS v").write.mode("append").parquet(str(tmp_path / "in"))
        merge_new(spark, str(tmp_path / "in"), schema, table, str(tmp_path / "stream"), ["id"])
    assert table.read().count() == 35 and table.manifest()["batch"] == 2
    assert table.upsert(spark.range(100).selectExpr("id", "9 AS v"), batch=2) == table.versions()[-1]
    assert table.read().count() == 35
