"""Nearest neighbours and the range join, against brute force."""

import numpy as np
import pytest

from sluice.llm import ann, range_join
from sluice.llm.ann import nearest
from sluice.llm.range_join import near_duplicates

NAN, INF = float("nan"), float("inf")


def embeddings(n=600, width=16, seed=7):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((12, width))
    out = centres[rng.integers(0, 12, n)] + 0.15 * rng.standard_normal((n, width)) * rng.integers(0, 4, n)[:, None]
    out[n // 2 :: 7] = out[3]  # many copies of one
    return (out * rng.uniform(0.5, 3, n)[:, None]).astype(np.float32)


ODD = [(9001, None), (9002, [0.0] * 16), (9003, [None] + [1.0] * 15), (9004, [NAN] + [1.0] * 15), (9005, [INF] + [1.0] * 15), (9006, []), (9020, None)]


@pytest.mark.parametrize("block", [8192, 100])
def test_neighbours_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(ann, "BLOCK", block)
    monkeypatch.setattr(ann, "CHUNK", 20)
    x = embeddings()
    rows = [(i, v.tolist(), "e") for i, v in enumerate(x)] + [(i, v, "odd") for i, v in ODD]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank string")
    got = nearest(df, df.where("vec_id % 20 = 0")).collect()
    d = x.astype(float)
    hits = total = 0
    by_query = {}
    for r in got:
        by_query.setdefault(r.query_id, []).append(r)
    assert sorted(by_query) == list(range(0, 600, 20))
    for q, found in by_query.items():
        found.sort(key=lambda r: r["rank"])
        scores = (d * d[q]).sum(axis=1)
        want = [i for i in sorted(range(600), key=lambda i: (-scores[i], i)) if i != q][:20]
        assert [r["rank"] for r in found] == list(range(1, 21))
        assert [(-r.score, r.vec_id) for r in found] == sorted((-r.score, r.vec_id) for r in found)
        assert np.allclose([r.score for r in found], scores[[r.vec_id for r in found]], rtol=0, atol=1e-12)
        hits += len({r.vec_id for r in found} & set(want))
        total += 20
    assert hits / total >= 0.9


def test_bitmaps_count_collisions(monkeypatch):
    """The rows in enough windows, against a plain count, for numbers of rows that fill no whole word."""
    monkeypatch.setattr(ann, "THRESHOLD", 3)
    rng = np.random.default_rng(5)
    for n, size in ((1, 1), (130, 7), (700, 64)):
        order = np.argsort(rng.random((6, n)), axis=1)
        slabs = -(-n // size)
        low, high = np.sort(rng.integers(0, slabs + 1, (2, 6, 9)), axis=0)
        found = ann._collided(ann._bitmaps(order, size), low, high)
        place = np.argsort(order, axis=1) // size
        want = ((place[:, None] >= low[..., None]) & (place[:, None] < high[..., None])).sum(axis=0) >= 3
        assert (np.unpackbits(found.view(np.uint8), axis=1, count=n) == want).all()


def test_a_bound_ends_a_block_after_one_round(monkeypatch):
    """With the k-th best score of another block, windows open once, and only rows that reach it come back."""
    rng = np.random.default_rng(3)
    x = rng.standard_normal((4000, 32))
    x /= np.sqrt((x * x).sum(axis=1))[:, None]
    ids, rounds, collided = np.arange(4000), [], ann._collided
    monkeypatch.setattr(ann, "_collided", lambda *args: rounds.append(args[1].shape[1]) or collided(*args))
    home, block, asked = x[:2000], x[2000:], x[:100]
    q, r, score = ann.search(home, ids[:2000], asked, ids[:100])
    bounds = np.array([score[q == i].min() for i in range(100)])
    assert sum(rounds) > 300
    rounds.clear()
    q, r, score = ann.search(block, ids[2000:], asked, ids[:100], bounds=bounds)
    assert sum(rounds) == 100
    assert (score >= bounds[q] - 1e-9).all()
    reach = np.minimum((asked @ block.T >= bounds[:, None]).sum(axis=1), 20).sum()
    assert 0.97 * reach <= len(score) <= reach


def test_neighbours_of_little(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (0, [1.0, 0.0]), (7, [2.0, 0.0]), (5, [2.0, 0.0]), (3, [1.0])], "vec_id long, embedding array<float>")
    got = [tuple(r) for r in nearest(df, df.where("vec_id % 20 = 0")).orderBy("rank").collect()]
    assert got == [(0, 1, 5, 2.0), (0, 2, 7, 2.0)]
    assert nearest(df.limit(0), df.limit(0)).count() == 0
    assert nearest(df.where("vec_id = 0"), df.where("vec_id = 0")).count() == 0


def brute_links(rows, cosine=0.98):
    """(id, links, component) in row order for rows (id, vector, label)."""
    def ok(r):
        return r[0] is not None and r[2] is not None and r[1] and all(v is not None and np.isfinite(v) for v in r[1]) and any(r[1])

    n = len(rows)
    links = {i: set() for i in range(n)}
    units = [np.array(r[1], np.float32).astype(float) if ok(r) else None for r in rows]
    units = [u / np.sqrt(u @ u) if u is not None else None for u in units]
    for i in range(n):
        for j in range(i):
            if units[i] is not None and units[j] is not None and rows[i][2] == rows[j][2] and len(units[i]) == len(units[j]):
                if units[i] @ units[j] >= cosine:
                    links[i].add(j)
                    links[j].add(i)
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        out.append((rows[i][0], len(links[i]), min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)))
    return out


@pytest.mark.parametrize(("cell", "chunk"), [(2048, 2048), (40, 2048), (40, 16), (10**6, 25)])
def test_range_join_against_brute_force(spark, monkeypatch, cell, chunk):
    monkeypatch.setattr(range_join, "CELL", cell)
    monkeypatch.setattr(range_join, "CHUNK", chunk)
    x = embeddings(500)
    rows = [(i, v.tolist(), i % 3 if i % 50 else None) for i, v in enumerate(x)]
    rows += [(i, v, 1) for i, v in ODD] + [(10, x[10].tolist(), 1), (None, x[3].tolist(), 1), (8000, [1.0, 2.0], 1), (8001, [2.0, 4.0], 1)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, label int, id string")
    got = near_duplicates(df).collect()
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in got), key=repr) == sorted(brute_links(rows), key=repr)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got if r.vec_id is not None)
    assert near_duplicates(df.limit(0)).count() == 0
