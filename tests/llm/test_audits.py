"""Source divergence, ranked search and toxicity, against brute force and held-out labels."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from sluice.llm import divergence, ranked
from sluice.llm.divergence import source_divergence, terms_in
from sluice.llm.ranked import Search, ranked_search, term_counts
from sluice.llm.toxicity import ToxicityModel, fit, score_toxicity, train, windows

LETTERS = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
TERMS = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}
DOCS = "doc_id long, text string, lang string, source string, term int, n int, rank string, m string, score int"


def corpus(seed=3, count=160):
    rng = random.Random(seed)
    words = ["Alpha", "beta", "Éclair", "élan", "gamma1", "a", "日本語の長い文", "deltadeltadelta", "deltadeltadeltas", "ab", "abcd", "abcde", "ABCDEFGH", "abcdefghi", "ÉÀ", "x9y"]
    weight = [1 / (i + 1) for i in range(len(words))]
    rows = []
    for i in range(count):
        text = " ".join(rng.choices(words, weight, k=rng.randint(0, 40)))
        rows.append((i, text, rng.choice(["en", "en", "fr", None, ""]), rng.choice(["s1", "s2", "s3", "é", None])))
    rows += [(500, None, "en", "s1"), (501, "", "zz", "only"), (502, "rare words here", "zz", "other"), (None, rows[3][1], "en", "s2"), rows[5], rows[5], rows[7]]
    rows += [(600 + i, "y" * 5000 + " " + "x" * (200_000 if i else 100_000), "en", "long") for i in range(4)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "r", "m", 3) for r in rows], DOCS)


def brute_divergence(rows, min_docs, top=50):
    counts, docs = defaultdict(Counter), defaultdict(Counter)
    groups = set()
    for _, text, lang, source in rows:
        found = LETTERS.findall((text or "").translate(LOWER))
        groups.add((lang or "", source or ""))
        counts[lang or "", source or ""].update(found)
        docs[lang or ""].update(set(found))
    out = set()
    for lang in {g[0] for g in groups}:
        kept = sorted(t for t, n in docs[lang].items() if n >= min_docs)
        sources = sorted(s for g, s in groups if g == lang)
        whole = sum((counts[lang, s] for s in sources), Counter())

        def shares(c):
            total = sum(c[t] for t in kept)
            return {t: 1 + (10**9 * (c[t] + 5)) // (total + 5 * len(kept)) for t in kept}

        p, q = {s: shares(counts[lang, s]) for s in sources}, shares(whole)
        for s in sources:
            pairs = [(-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode(), o) for o in sources if o != s]
            terms = [(q[t] - p[s][t], t.encode(), t) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, len(pairs)), ("term", terms, top)):
                out |= {(lang, s, part, item, -value, i + 1) for i, (value, _, item) in enumerate(sorted(found)[:most])}
    return out


@pytest.mark.parametrize("min_docs, top", [(3, 50), (12, 2), (1, 50), (1000, 50)])
def test_divergence(spark, min_docs, top):
    rows = corpus()
    got = [tuple(r) for r in source_divergence(frame(spark, rows), min_docs, top).collect()]
    assert len(got) == len(set(got)) and set(got) == brute_divergence(rows, min_docs, top)


def test_divergence_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(divergence, "SOURCES", 2)
    monkeypatch.setattr(divergence, "TERMS", 3)
    rows = corpus(4)
    got = [tuple(r) for r in source_divergence(frame(spark, rows), 5).collect()]
    assert len(got) == len(set(got)) and set(got) == brute_divergence(rows, 5)


def test_divergence_survives_a_full_bitmap(spark, monkeypatch):
    monkeypatch.setattr(divergence, "_bitmap", lambda *of: np.full(divergence.BITMAP_ROW // 8, 255, np.uint8))
    rows = corpus(5)
    assert {tuple(r) for r in source_divergence(frame(spark, rows), 6).collect()} == brute_divergence(rows, 6)


def test_divergence_of_nothing(spark):
    assert source_divergence(frame(spark, [])).collect() == []
    assert source_divergence(frame(spark, [(1, None, None, None), (2, "", None, None)])).collect() == []


def test_terms_end_with_their_text():
    data = np.frombuffer("abÉc1d".encode(), np.uint8)
    starts, sizes, doc = terms_in(data, np.array([0, 1, 5, 5, 7]))
    assert list(zip(starts, sizes, doc)) == [(0, 1, 0), (1, 4, 1), (6, 1, 3)]


# Ranked search


def brute_search(docs, items, best=10):
    found = [(i, Counter(TERMS.findall((t or "").translate(LOWER)))) for i, t, *_ in docs]
    found = [(i, c, sum(c.values())) for i, c in found if c]
    total, words = len(found), sum(n for *_, n in found)
    df = Counter(t for _, c, _ in found for t in c)
    asked = defaultdict(set)
    for item, text in items:
        asked[item] |= set(TERMS.findall((text or "").translate(LOWER)))
    out = []
    for item, terms in asked.items():
        scores = []
        for doc, c, n in found:
            m = 100 - 90 + (90 * n * total) // words
            score = sum(math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t in terms if t in c)
            scores.append((-score, doc is None, doc or 0, doc))
        out += [(item, rank + 1, doc, -s) for rank, (s, _, _, doc) in enumerate(sorted(scores, key=lambda x: x[:3])[:best]) if s < 0]
    return Counter(out)


ITEMS = [(1, "alpha BETA élan"), (2, None), (3, ""), (4, "nowhere"), (5, "日本語の長い文 x9y"), (6, "abcde"), (6, "gamma1 abcde"), (None, "ab"), (7, "x" * 200_000), (8, "alpha alpha")]


@pytest.mark.parametrize("blocks", [1, 3])
def test_ranked_search(spark, monkeypatch, blocks):
    monkeypatch.setattr(ranked, "QUERIES", 256 if blocks == 1 else 3)
    rows = corpus(6)
    items = spark.createDataFrame([(i, t, "d") for i, t in ITEMS], "item_id long, text string, doc_id string")
    got = ranked_search(frame(spark, rows), items)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert Counter(tuple(r) for r in got.collect()) == brute_search(rows, ITEMS)
    assert Counter(tuple(r) for r in ranked_search(frame(spark, rows), items, 3).collect()) == brute_search(rows, ITEMS, 3)


def test_ranked_search_of_nothing(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    none, empty = frame(spark, []), frame(spark, [(1, None, None, None), (2, " ", None, None)])
    assert ranked_search(none, items).collect() == ranked_search(empty, items).collect() == []
    assert ranked_search(frame(spark, corpus()), items.limit(0)).collect() == []


def test_terms_of_long_texts_are_whole():
    rng = random.Random(1)
    text = " ".join("".join(rng.choices("abcAB é1", k=9)) for _ in range(300_000)) + " " + "z" * 3_000_000
    assert term_counts(text) == Counter(t.encode() for t in TERMS.findall(text.translate(LOWER)))


@pytest.mark.parametrize("scale", [1, 10**9])
def test_strata_in_slices_and_waves(monkeypatch, scale):
    """Small slices and waves, and weights too large for doubles, find what scoring everything finds."""
    monkeypatch.setattr(ranked, "SLICE", 3)
    monkeypatch.setattr(ranked, "WAVE", 10)
    rng = np.random.default_rng(2)
    weights = rng.integers(0, 5, (12, 6)) * scale
    assert Search(weights, 4).weights.dtype == (np.float64 if scale == 1 else np.int64)
    m = np.sort(rng.integers(10, 14, 90))
    docs = rng.integers(0, 60, 90)
    terms = [np.sort(rng.choice(12, rng.integers(0, 6), replace=False)) for _ in m]
    tfs = [rng.integers(1, 4, len(t)) for t in terms]
    batch = pa.RecordBatch.from_arrays([
        pa.array(docs), pa.array(m), pa.array([t.tolist() for t in terms], pa.list_(pa.int32())), pa.array([t.tolist() for t in tfs], pa.list_(pa.int64())),
    ], ["doc", "m", "terms", "tfs"])
    out = next(ranked._searched(weights, 4)(iter([batch.slice(0, 35), batch.slice(35, 8), batch.slice(43)]))).to_pylist()
    for q in range(6):
        all_scores = sorted((-sum(int(weights[t, q]) * ((10**9 * int(f)) // (1000 * int(f) + 8 * int(mm))) for t, f in zip(ts, fs)), int(d)) for d, mm, ts, fs in zip(docs, m, terms, tfs))
        want = [(d, -s) for s, d in all_scores[:4] if s < 0]
        assert sorted((r["doc_id"], r["score"]) for r in out if r["query"] == q) == sorted(want)


# Toxicity


def toxic_corpus(seed=7, count=900):
    rng = random.Random(seed)
    parts = ["th", "an", "er", "ing", "on", "re", "st", "en", "at", "ou", "ha", "ble"]
    bad = ["grumbler", "nincompoop", "wastrel", "scoundrel", "blockhead"]

    def word():
        return "".join(rng.choices(parts, k=rng.randint(1, 4)))

    docs, labels = [], []
    for i in range(count):
        words = [word() for _ in range(rng.randint(5, 250))]
        toxic = int(rng.random() < 0.25)
        if toxic:
            for _ in range(max(1, len(words) // 25)):
                words.insert(rng.randint(0, len(words)), rng.choice(bad))
        docs.append((i, " ".join(words)))
        labels.append((i, toxic, rng.randint(0, 1)))
    return docs, labels


DOC_TYPES = "doc_id long, text string, score string, toxic string, windows int"
LABEL_TYPES = "doc_id long, toxic int, quality int"


def held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0


def test_toxicity_held_out(spark):
    docs, labels = toxic_corpus()
    odd = [(9001, None), (9002, ""), (9003, " \n"), (None, docs[0][1]), docs[1], docs[1], (9004, "x" * 300_000), (9005, (docs[2][1] + " ") * 200)]
    table = spark.createDataFrame([(*d, "s", "t", 1) for d in docs + odd], DOC_TYPES)
    judged = spark.createDataFrame([*labels, (9001, None, None), (None, 1, 1), (labels[0][0], 1 - labels[0][1], 0), (77777, 1, 0), (5, 7, 0)], LABEL_TYPES)
    model = train(table, judged)
    out = score_toxicity(table, model)
    assert out.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = out.collect()
    assert len(rows) == len(docs) + len(odd)
    assert all(r.held_out == held(r.doc_id) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    by_id = defaultdict(set)
    for r in rows:
        by_id[r.doc_id].add(r.score)
    assert all(len(s) == 1 for s in by_id.values()) and by_id[9001] == by_id[9002] == by_id[9003]
    truth = {i: t for i, t, _ in labels}
    test = [(truth[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in truth]
    assert np.mean([a == b for a, b in test]) > 0.9
    assert np.mean([b for a, b in test if a]) > 0.8

    # Labels of held-out documents, and whatever else the tables hold, teach nothing.
    flipped = spark.createDataFrame([(i, 1 - t if held(i) else t, q) for i, t, q in labels] + [(labels[0][0], 1 - labels[0][1], 0)], LABEL_TYPES)
    again = {(r.doc_id, r.score) for r in score_toxicity(table, train(table, flipped)).collect()}
    assert again == {(r.doc_id, r.score) for r in rows}


def test_toxicity_without_labels(spark):
    docs, labels = toxic_corpus(8, 30)
    table = spark.createDataFrame([(*d, "s", "t", 1) for d in docs], DOC_TYPES)
    none = spark.createDataFrame([], LABEL_TYPES)
    assert train(table, none) == ToxicityModel(0.0)
    assert {(r.score, r.predicted) for r in score_toxicity(table, train(table, none)).collect()} == {(0.0, 0)}
    one = spark.createDataFrame([(i, 1, 0) for i, *_ in labels], LABEL_TYPES)
    assert {r.score for r in score_toxicity(table, train(table, one)).collect()} == {1.0}
    assert score_toxicity(table.limit(0), train(table, one)).collect() == []


def test_few_labels_make_a_model():
    sample = [([b"plain words"], 0), ([b"nasty words"], 1), ([b"other words"], 0), ([b"nasty things"], 1)]
    model = fit(sample, {0: 2, 1: 2})
    assert model.weights is not None and np.isfinite(model.weights).all()
    assert fit(sample[:3], {0: 2, 1: 1}).weights is None


def test_windows_hold_all_words():
    docs, _ = toxic_corpus(9, 20)
    for _, text in docs + [(0, "A B \x1c c" + " d" * 500)]:
        assert b" ".join(windows(text)) == b" ".join(text.translate(LOWER).encode().split())
    assert max(map(len, windows("y" * 100_000 + " z"))) <= 256 and b"".join(windows("y" * 100_000)) == b"y" * 100_000
    assert windows("") == windows(" \n") == [b""]
