"""Recall of repeated lines and passages on a whole table, against brute force."""

from collections import Counter, defaultdict

from sluice.llm.paragraphs import without_repeats
from sluice.llm.passages import repeats

DOCS = "/root/testdata/sf0.01/documents.parquet"


def test_lines_and_passages_of_a_whole_table(spark):
    docs = spark.read.parquet(DOCS)
    found = repeats(docs)
    rows = found.collect()
    texts = [(r.doc_id, r.text) for r in docs.collect()]

    # Lines: all pairs of different long lines that share a shingle, by exact Jaccard similarity.
    lines = defaultdict(list)
    for i, text in texts:
        for n, line in enumerate((text or "").split("\n")):
            words = tuple(line.encode().lower().split())
            if len(words) >= 25:
                lines[words].append((i, n))
    sets = [{w[i : i + 5] for i in range(len(w) - 4)} for w in lines]
    holders = defaultdict(list)
    for k, s in enumerate(sets):
        for shingle in s:
            holders[shingle].append(k)
    shared = Counter()
    for held in holders.values():
        for x, a in enumerate(held):
            shared.update((a, b) for b in held[x + 1 :])
    similar = [(a, b) for (a, b), n in shared.items() if n >= 0.8 * (len(sets[a]) + len(sets[b]) - n)]
    places = list(lines.values())
    alike = {p for a, b in similar for p in (*places[a], *places[b])} | {p for ps in places if len(ps) > 1 for p in ps}
    reported = defaultdict(set)
    for r in rows:
        reported[r.doc_id, r.paragraph].add((r.first_id, r.first_paragraph))
    linked = sum(any(reported[p] & reported[q] for p in places[a] for q in places[b]) for a, b in similar)
    assert len(similar) >= 40 and linked >= 0.995 * len(similar)
    assert sum(p in reported for p in alike) >= 0.995 * len(alike)

    # Passages: in what is left no run of 50 words stands twice, but for one that overlaps itself.
    left = defaultdict(list)
    for r in without_repeats(docs, found).collect():
        words = (r.text or "").encode().lower().split()
        for k in range(len(words) - 49):
            left[tuple(words[k : k + 50])].append((r.doc_id, k))
    again = [w for w, at in left.items() if len({i for i, _ in at}) > 1 or at[-1][1] - at[0][1] >= 50]
    kept = Counter(r.kept for r in rows)
    assert kept[True] and kept[False] and len(left) > 10_000
    # What cutting has brought side by side is new text; it is the only thing that may repeat.
    assert len(again) <= 0.001 * len(left)
