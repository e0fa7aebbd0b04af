"""SimHash, passages, packing, mixing, token counts and languages, against brute force."""

import random
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import public_tokenizers
import pytest
import xxhash
from tokenizers import Tokenizer

from sluice.llm import mixing, packing, paragraphs, simhash
from sluice.llm.language import fit, identify_language, train
from sluice.llm.merges import Merges
from sluice.llm.mixing import mix_plan, mixed, sainte_lague, targets
from sluice.llm.packing import pack, pack_histogram
from sluice.llm.paragraphs import paragraph_groups, without_repeats
from sluice.llm.passages import repeats
from sluice.llm.simhash import simhash_near_dedup
from sluice.llm.token_count import count_tokens

SF = "/root/testdata/sf0.001/documents.parquet"
WORD_FILE, BYTE_FILE = (public_tokenizers.path(f) for f in ("word_bpe_49k.json", "byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def odd_docs(spark):
    """The smallest documents with nulls, empty and long texts, repeated rows and clashing columns."""
    docs = [(r.doc_id, r.text, r.lang, r.source) for r in spark.read.parquet(SF).collect()]
    long = " ".join(docs[i][1] for i in range(40))
    docs += [
        (90001, None, None, None), (90002, "", "en", ""), (90003, " \n\t ", "en", "src1"), (90004, long, "en", "src2"),
        (90005, "12 !? 34", "en", "src0"), (None, docs[5][1], "en", "src0"), docs[0], docs[1], (90006, docs[3][1], None, None),
        (90007, "x" * 300_000, "en", "src3"), (90008, "a<|endoftext|>b é\u0301 \u2028 \x1c ß İ ²", "en", "src4"),
    ]
    return spark.createDataFrame([(*d, 1, 2) for d in docs], "doc_id long, text string, lang string, source string, size int, fp int").cache()


def classes(n, linked):
    """For nodes 0..n-1 the smallest node of each node's component."""
    parent = list(range(n))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in linked:
        a, b = sorted((root(i), root(j)))
        parent[b] = a
    return [root(i) for i in range(n)]


# SimHash


def brute_fingerprint(text):
    words = (text or "").translate({c: c + 32 for c in range(65, 91)}).encode().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(len(words) - 2, 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def test_simhash_against_brute_force(spark, odd_docs):
    rows = odd_docs.select("doc_id", "text").collect()
    fps = [brute_fingerprint(r.text) for r in rows]
    roots = classes(len(rows), [(i, j) for i in range(len(rows)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 3])
    first = defaultdict(list)
    for r, root in zip(rows, roots):
        first[root].append(r.doc_id)
    want = Counter((r.doc_id, f"{f:016x}", min(i for i in first[c] if i is not None)) for r, f, c in zip(rows, fps, roots))
    assert Counter(tuple(r) for r in simhash_near_dedup(odd_docs).collect()) == want
    assert simhash_near_dedup(odd_docs.limit(0)).count() == 0


@pytest.mark.parametrize("bits", [0, 1, 2, 3, 4])
def test_balls_find_all_components(spark, bits):
    rng = random.Random(bits)
    fps = {rng.getrandbits(64) for _ in range(60)}
    for f in list(fps)[:30]:
        for _ in range(12):  # chains and clusters around
            for b in rng.sample(range(64), rng.randint(1, 3)):
                f ^= 1 << b
            fps.add(f)
    fps = sorted(fps)
    signed = [f - (f >> 63 << 64) for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    links = simhash.fingerprint_links(df, 1 << (16 if bits < 4 else 8), bits).collect()
    at = {f: i for i, f in enumerate(signed)}
    assert all((fps[at[r.a]] ^ fps[at[r.b]]).bit_count() <= bits for r in links)
    got = classes(len(fps), [(at[r.a], at[r.b]) for r in links])
    want = classes(len(fps), [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= bits])
    assert got == want


# Passages


def passage_docs():
    rng = random.Random(5)
    vocab = [f"w{i}" for i in range(4000)]
    line = lambda n: " ".join(rng.choices(vocab, k=n))
    common, base = line(60), line(80)
    docs = []
    for i in range(120):
        lines = [line(rng.randint(1, 60)) for _ in range(4)]
        if i % 3 == 0:
            lines.insert(1, common)
        if i % 4 == 0:  # near copies of one another
            words = base.split()
            for _ in range(rng.randint(0, 3)):
                words[rng.randrange(80)] = rng.choice(vocab)
            lines.append(" ".join(words).upper() if i % 8 else " ".join(words))
        docs.append((i, "\n".join(lines)))
    return docs + [(500, None), (501, ""), (502, "\n\n"), (None, common), docs[0], (503, common + "\n" + common), (504, "é " * 30 + "\r\n" + "é " * 30)]


@pytest.mark.parametrize("block", [512, 8])
def test_passages_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(paragraphs, "BLOCK", block)
    docs = passage_docs()
    df = spark.createDataFrame([(*d, "p") for d in docs], "doc_id long, text string, paragraph string")
    got = {(r.doc_id, r.paragraph): (r.first_id, r.first_paragraph, r.kept) for r in paragraph_groups(df).collect()}
    places, sets = [], []
    for doc_id, text in dict.fromkeys(d for d in docs if d[0] is not None):
        for n, line in enumerate((text or "").split("\n")):
            words = line.lower().split()
            if len(words) >= 25:
                places.append((doc_id, n))
                sets.append({tuple(words[i : i + 5]) for i in range(len(words) - 4)})
    order = sorted(range(len(places)), key=places.__getitem__)
    places, sets = [places[i] for i in order], [sets[i] for i in order]
    roots = classes(len(places), [(i, j) for i in range(len(places)) for j in range(i) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])])
    sizes = Counter(roots)
    want = {p: (*places[r], p == places[r]) for p, r in zip(places, roots) if sizes[r] > 1}
    assert got == want
    assert paragraph_groups(df.limit(0)).count() == 0


def test_passages_are_cut(spark):
    df = spark.createDataFrame(passage_docs(), "doc_id long, text string").where("doc_id is not null").dropDuplicates(["doc_id"])
    groups = paragraph_groups(df)
    drop = {(r.doc_id, r.paragraph) for r in groups.where("not kept").collect()}
    texts = {r.doc_id: r.text for r in df.collect()}
    cut = {r.doc_id: r.text for r in without_repeats(df, groups).collect()}
    assert cut.keys() == texts.keys() and drop
    for i, text in texts.items():
        kept = [line for n, line in enumerate(text.split("\n")) if (i, n) not in drop] if text is not None else None
        assert cut[i] is None if text is None else cut[i].rstrip("\n") == "\n".join(kept).rstrip("\n")
    assert paragraph_groups(without_repeats(df, groups)).count() == 0


def planted(seed, count=24):
    """Documents of their own words with one passage of 50 to 70 words in the middle of longer lines, or over a line end."""
    rng = random.Random(seed)
    own = lambda n: [f"v{rng.randrange(10**9)}" for _ in range(n)]
    out = []
    for i in range(0, count, 2):
        passage = own(rng.randint(50, 70))
        for n in (i, i + 1):
            words = [*own(rng.randint(30, 90)), *passage, *own(rng.randint(30, 90))]
            text = " ".join(words)
            if n % 4 > 1:  # the line ends inside the passage
                text = text.replace(f" {passage[20 + n]} ", f" {passage[20 + n]}\n", 1)
            out.append((n, text, passage))
    return out


def test_passages_within_longer_lines_and_over_line_ends(spark):
    docs = planted(8)
    df = spark.createDataFrame([d[:2] for d in docs], "doc_id long, text string")
    found = repeats(df)
    rows = {(r.doc_id, r.kept): (r.n_words, r.first_id) for r in found.collect()}
    assert rows == {(n, n % 2 == 0): (len(p), n // 2 * 2) for n, _, p in docs}
    cut = {r.doc_id: r.text.split() for r in without_repeats(df, found).collect()}
    for n, text, passage in docs:
        assert cut[n] == (text.split() if n % 2 == 0 else [w for w in text.split() if w not in passage])
    assert repeats(df.limit(0)).count() == 0


def test_passages_of_short_lines(spark):
    rng = random.Random(9)
    own = lambda n: " ".join(f"u{rng.randrange(10**9)}" for _ in range(n))
    verse = own(60).split()
    wrapped = lambda k: "\n".join(" ".join(verse[i : i + k]) for i in range(0, 60, k))
    docs = [(i, f"{own(40)}\n{wrapped(k)}\n{own(i)}") for i, k in ((1, 12), (2, 12), (3, 7), (4, 24))]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    cut = {r.doc_id: r.text.split() for r in without_repeats(df, repeats(df)).collect()}
    for i, text in docs:
        assert cut[i] == [w for w in text.split() if i == 1 or w not in verse]


def test_passages_leave_no_repeated_window(spark):
    docs = [d for d in passage_docs() if d[0] is not None] + [(900, "x " * 60), (901, "y " * 260)]
    docs += [(500, "other words " + docs[0][1].replace("\n", " "))]  # one id, another text
    df = spark.createDataFrame(docs, "doc_id long, text string")
    left = Counter()
    texts = {(r.doc_id, r.text) for r in without_repeats(df, repeats(df)).collect()}
    for i, text in texts:
        words = (text or "").lower().split()
        if i in (900, 901):
            assert len(words) == {900: 60, 901: 50}[i]
        else:
            left.update({tuple(words[k : k + 50]) for k in range(len(words) - 49)})
    assert left and max(left.values()) == 1


def test_bands_are_tuned():
    for similarity in (0.5, 0.8, 0.9):
        bands = paragraphs.tuned_bands(similarity, 0.99)
        assert 1 - (1 - similarity**3) ** bands >= 0.99 > 1 - (1 - similarity**3) ** (bands - 1)


def test_default_bands_reach_the_recall():
    assert 1 - (1 - paragraphs.SIMILARITY**paragraphs.BAND_ROWS) ** paragraphs.tuned_bands() >= 0.995


# Tokens


def strange_texts():
    rng = random.Random(3)
    some = [chr(i) for i in [*range(9, 127), *range(160, 0x250), 0x300, 0x2003, 0x1F600, 0x4E00, 0x3042, 0x85, 0x200B, 0x2028]]
    some += ["<|endoftext|>", "<|ENDOFTEXT|>", "'s", "  ", "'ll", "the", "Σ"]
    out = ["".join(rng.choice(some) for _ in range(rng.randint(0, 25))) for _ in range(4000)]
    out += ["".join(rng.choice("aé'S stl\n1.ßÿ,É ,.") for _ in range(rng.randint(0, 60))) for _ in range(2000)]
    return [*out, "", "ab" * 300, "a, b. c.\nd.. e,, f.", "a<|startoftext|>b C", "Ω ΑΣ ΑΣ. ŉ İ", "x" * 5000]


def test_merges_agree_with_the_library():
    rng = random.Random(1)
    words = [bytes(rng.choice(b"abcdethinos'.-\xc3\xa9 ") for _ in range(rng.randint(1, 60))) for _ in range(3000)] + [b"a" * 500]
    for path in (WORD_FILE, BYTE_FILE):
        m = Merges(path)
        for word, ids in zip(words, m.encode(words)):
            want = [t.id for t in m.library.model.tokenize("".join(m.letters[b] for b in word))]
            assert np.frombuffer(ids, "<i4").tolist() == want, word


def test_token_counts(spark, odd_docs):
    texts = strange_texts()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").unionByName(odd_docs.select("doc_id", "text"))
    library, text_of = Tokenizer.from_file(BYTE_FILE), [(r.doc_id, r.text or "") for r in df.collect()]
    want = Counter()
    for (i, t), e in zip(text_of, library.encode_batch([t for _, t in text_of], add_special_tokens=False)):
        want[i, len(t.encode()), len(e.ids), len(e.ids) > 512] += 1
    assert Counter(tuple(r) for r in count_tokens(df, BYTE_FILE).collect()) == want
    assert count_tokens(df.limit(0), BYTE_FILE).count() == 0


def test_whole_tokens_are_proved():
    from sluice.llm.token_count import counter

    c = counter(BYTE_FILE)
    some = sorted(c.whole_tokens)[::50]
    assert all(len(c._merges.library.encode(t, add_special_tokens=False).ids) == 1 for t in some if t.strip())
    assert len(c.whole_tokens) > 45_000


@pytest.mark.parametrize("slice_", [2048, 7])
def test_packing(spark, monkeypatch, odd_docs, slice_):
    monkeypatch.setattr(packing, "SLICE", slice_)
    strange = spark.createDataFrame(list(enumerate(strange_texts(), 10**6)), "doc_id long, text string")
    df = odd_docs.select("doc_id", "text").unionByName(strange)
    library = Tokenizer.from_file(WORD_FILE)
    docs = [(r.doc_id, r.text or "") for r in df.collect()]
    want = Counter()
    for (i, _), e in zip(docs, library.encode_batch([t for _, t in docs], add_special_tokens=False)):
        ids = np.array([*e.ids, 1], "<u4")
        for s in range(0, len(ids), 2048):
            piece = ids[s : s + 2048]
            want[i, s, len(piece), zlib.crc32(piece.tobytes()), len(ids)] += 1
    got = pack(df, WORD_FILE, with_ids=True).collect()
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got) == want
    assert all(zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length for r in got)
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    used = sum(r.length for r in got)
    assert used / (2048 * len(sequences)) > 0.95
    assert pack(df.limit(0), WORD_FILE).count() == 0


def test_shortest_pack_first():
    rng = random.Random(2)
    for _ in range(20):
        counts = {rng.randint(1, 64): rng.randint(1, 500) for _ in range(rng.randint(1, 40))}
        patterns = pack_histogram(counts, 64)
        assert all(sum(p) <= 64 and n > 0 for p, n in patterns)
        assert Counter({k: sum(p.count(k) * n for p, n in patterns) for k in counts}) == Counter(counts)


# Mixing


def test_targets_and_apportionment():
    rng = random.Random(4)
    for _ in range(50):
        sizes = [rng.randint(0, 1000) for _ in range(rng.randint(1, 12))]
        weights = [(3, 1, 2)[i % 3] for i in range(len(sizes))]
        goals = targets(sizes, weights)
        assert sum(goals) == pytest.approx(1.5 * sum(sizes))
        open_ = [g / w for g, w, s in zip(goals, weights, sizes) if g < 2 * s]
        assert all(g <= 2 * s + 1e-9 for g, s in zip(goals, sizes))
        assert not open_ or max(open_) == pytest.approx(min(open_))
        votes, seats = [rng.randint(0, 50) for _ in sizes], rng.randint(0, 200)
        caps = [rng.randint(0, 40) for _ in sizes]
        want = [0] * len(sizes)
        for _ in range(seats):
            best = max((i for i in range(len(sizes)) if want[i] < caps[i] and votes[i]), key=lambda i: (Fraction(votes[i], 2 * want[i] + 1), -i), default=None)
            if best is not None:
                want[best] += 1
        assert sainte_lague(votes, seats, caps) == want


def test_mix(spark, odd_docs):
    plan = mix_plan(odd_docs).collect()
    rows = odd_docs.collect()
    count = lambda t: len((t or "").encode().split())
    assert Counter((r.doc_id, r["size"]) for r in plan) == Counter((r.doc_id, count(r.text)) for r in rows)
    sizes, taken, goal = Counter(), Counter(), {}
    for r in plan:
        sizes[r.mix_source] += r["size"]
        taken[r.mix_source] += r.taken
        goal[r.mix_source] = r.target
        assert 0 <= r.taken <= 2 * r["size"]
    names = sorted(s for s in sizes if s is not None) + [None]
    want = dict(zip(names, targets([sizes[s] for s in names], [(3, 1, 2)[i % 3] for i in range(len(names))])))
    assert goal == pytest.approx(want)
    total = sum(sizes.values())
    assert all(r.source_size == sizes[r.mix_source] for r in plan)
    assert all(abs(taken[s] - want[s]) <= 0.01 * want[s] + total * 1.5 / mixing.SEATS * 4 for s in names)
    assert Counter(map(str, mix_plan(odd_docs.repartition(5)).collect())) == Counter(map(str, plan))
    out = mixed(odd_docs)
    assert out.columns == odd_docs.columns
    words = Counter()
    for r in out.collect():
        words[r.doc_id] += count(r.text)
    want_words = Counter()
    for r in plan:
        want_words[r.doc_id] += r.taken
    assert +words == +want_words
    assert mix_plan(odd_docs.limit(0)).count() == 0 and mixed(odd_docs.limit(0)).count() == 0
    assert mix_plan(odd_docs.where("text is null")).first().taken == 0


def test_mix_of_thousands_of_sources(spark):
    rng = random.Random(6)
    docs = [(3 * i + k, "w " * rng.randint(100, 200), f"site{i:04}") for i in range(3000) for k in range(3)]
    plan = mix_plan(spark.createDataFrame(docs, "doc_id long, text string, source string"))
    got = plan.groupBy("mix_source").agg({"taken": "sum", "target": "max"}).collect()
    assert len(got) == 3000
    assert all(abs(r["sum(taken)"] / r["max(target)"] - 1) <= 0.01 for r in got)


# Languages


def test_language(spark, odd_docs):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = identify_language(docs, train(docs)).collect()
    lang = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    assert len(got) == len(lang)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) / len(held) > 0.95
    model = train(docs)
    rows = {r.doc_id: r for r in identify_language(odd_docs, model).collect()}
    assert all(rows[i].lang_pred == "und" and rows[i].score == 0 for i in (90001, 90002, 90003, 90005))
    assert rows[90004].lang_pred in ("en", "fr", "de", "es") and not rows[None].held_out
    assert identify_language(odd_docs.limit(0), model).count() == 0
    untaught = train(odd_docs.limit(0))
    assert untaught.languages == () and {r.lang_pred for r in identify_language(odd_docs, untaught).collect()} == {"und"}


def test_folded_scores_are_the_kernel_regression():
    texts = ["the thing and then", "der die das und", "que los de la casa", "thereon of the end", "und wieder nicht", "los que dan"]
    model = fit(texts, ["en", "de", "es"] * 2)
    assert model.languages == ("de", "en", "es")
    scores = model.scores([*texts, "", "the " * 5000])
    assert [model.languages[i] for i in scores[:6].argmax(axis=1)] == ["en", "de", "es"] * 2
    assert (scores[6] == 0).all() and scores[7].argmax() == 1
    assert np.allclose(model.scores(["the " * 5000]), scores[7:8])  # batches do not matter
