"""Removal of passages that repeat within and across documents: paragraph MinHash banding.

1. Documents are cut into paragraphs (lines). One pass over the texts gives each long
   enough paragraph a digest of its words and one hash per band of its MinHash signature.
   The bands are tuned so that a pair at the threshold collides with the wanted recall.
2. Equal paragraphs are grouped by digest first; all later steps see each text once.
3. Different paragraphs with an equal band are joined in two steps, neither of which forms
   all pairs of a group. First each is compared with one leader of its bucket, the one that
   collides most. Only buckets whose members are not yet all connected go on; they are
   compared in blocks of bounded size, which return links that connect, not all links.
4. Links hold where the exact Jaccard similarity of the word shingles reaches the
   threshold. Components of links are the groups; all but the first paragraph go.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.components import components
from sluice.llm.names import spare
from sluice.llm.scan import BAND_ROWS, scanned, shingle_hashes, texts_of
from sluice.llm.workers import give_back
from sluice.session import Steps, freed_shuffles, small_batches

SIMILARITY = 0.8
RECALL = 0.995
# Shorter paragraphs are never removed: headings, greetings, common sentences.
MIN_WORDS = 25
# Paragraphs of one bucket that a task compares with as many others.
BLOCK = 512


def tuned_bands(similarity: float = SIMILARITY, recall: float = RECALL, rows: int = BAND_ROWS) -> int:
    """How many bands of ``rows`` hashes let a pair at ``similarity`` collide with probability ``recall``."""
    return int(np.ceil(np.log(1 - recall) / np.log(1 - similarity**rows)))


def _shingle_sets(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """``(digest, shingles)`` for paragraphs ``(digest, id, mark, start, end)``; texts travel once, by document."""

    @F.pandas_udf("array<long>")
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for digests, parts in batches:
            out = []
            for digest, part in zip(digests, parts):
                words = (part or "").encode().lower().split()
                # Texts of one id and one hash would be a collision; only the one that has the paragraph counts.
                same = xxhash.xxh3_128_digest(b" ".join(words)) == bytes(digest)
                out.append(np.unique(shingle_hashes([words])[0]).view(np.int64) if same else None)
            yield pd.Series(out, dtype=object)
        give_back()

    part = F.col("text").substr(F.col("start") + 1, F.col("end") - F.col("start"))
    parts = texts.join(wanted, ["id", "mark"])
    # A document that is there twice has its paragraphs twice.
    return parts.select("digest", run("digest", part).alias("shingles")).where("shingles is not null").dropDuplicates(["digest"])


def _linked_pairs(sets: list[np.ndarray], classes: np.ndarray, side: np.ndarray, own: bool, similarity: float) -> list[tuple[int, int]]:
    """Pairs that connect all classes that similar sets connect; with ``own`` unset only pairs across sides count."""
    sizes = np.array([len(s) for s in sets])
    column = np.unique(np.concatenate(sets), return_inverse=True)[1]
    row = np.repeat(np.arange(len(sets)), sizes)
    # Shingles of one paragraph alone cannot be shared.
    shared = np.bincount(column) > 1
    place, keep = np.cumsum(shared) - 1, shared[column]
    held = np.zeros((len(sets), max(1, int(shared.sum()))), np.float32)
    held[row[keep], place[column[keep]]] = 1
    common = held @ held.T
    linked = common >= similarity * (sizes[:, None] + sizes[None, :] - common) - 1e-6
    linked &= own | (side[:, None] != side[None, :])
    linked &= classes[:, None] != classes[None, :]
    out, classes = [], classes.copy()
    for i, j in zip(*np.nonzero(linked)):
        # One link to each class that is not connected yet is enough.
        if classes[i] != classes[j]:
            out.append((i, j))
            classes[classes == classes[j]] = classes[i]
    return out


def _block_links(similarity: float):
    def links(table: pa.Table) -> pa.Table:
        tasks = list(zip(*(table.column(c).to_pylist() for c in ("key", "x", "y"))))
        order = sorted(range(len(tasks)), key=tasks.__getitem__)
        digests = table.column("digest").to_pylist()
        sets = [s.values.to_numpy() for s in table.column("shingles")]
        classes = np.unique(np.array(table.column("class").to_pylist(), object), return_inverse=True)[1]
        side = table.column("side").to_numpy(zero_copy_only=False)
        a, b, first = [], [], 0
        for last in range(1, len(order) + 1):
            if last == len(order) or tasks[order[last]] != tasks[order[first]]:
                rows = order[first:last]
                own = tasks[rows[0]][1] == tasks[rows[0]][2]
                for i, j in _linked_pairs([sets[r] for r in rows], classes[rows], side[rows], own, similarity):
                    a.append(digests[rows[i]])
                    b.append(digests[rows[j]])
                first = last
        return pa.table({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary())})

    return links


def _rest_links(steps: Steps, members: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Links between the classes of ``(key, digest, class)``, all members of a bucket compared in blocks."""
    sized = members.groupBy("key").agg((F.ceil(F.count(F.lit(1)) / BLOCK)).cast("int").alias("blocks"))
    dealt = members.join(sized, "key").withColumn("own_block", F.pmod(F.xxhash64("digest"), "blocks").cast("int"))
    placed = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "key", "digest", "class",
        F.least("own_block", "other").alias("x"), F.greatest("own_block", "other").alias("y"),
        (F.col("own_block") <= F.col("other")).alias("side"),
    )
    # Most tasks are a few rows, so many go together; the largest are two blocks.
    placed = steps.keep("placed", placed)
    groups = max(1, placed.count() // (2 * BLOCK))
    grouped = placed.join(sets, "digest").withColumn("group", F.pmod(F.xxhash64("key", "x", "y"), F.lit(groups)))
    return grouped.groupBy("group").applyInArrow(_block_links(similarity), "a binary, b binary")


def groups_of(steps: Steps, texts: DataFrame, scan: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``paragraph_groups`` of texts that are scanned already; the caller drops the step ``groups``, if it wants to."""
    found = scan.select("id", "mark", F.explode("lines").alias("line")).select("id", "mark", "line.*")
    name = F.struct("id", "mark", "paragraph")
    distinct = steps.keep("lines", found.groupBy("digest").agg(
        F.min(F.struct("id", "mark", "paragraph", "start", "end", "bands")).alias("at"), F.max(name).alias("last")
    ).select("digest", "at.*", (F.struct("at.id", "at.mark", "at.paragraph") != F.col("last")).alias("copied")))
    keyed = distinct.select("digest", F.explode("bands").alias("key"))
    sizes = steps.keep("keys", keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    members = steps.keep("members", keyed.join(sizes, "key"))
    copied = steps.keep("copied", distinct.where("copied").select("digest"))

    # The leader of a bucket collides with the most paragraphs over all its bands.
    degree = members.groupBy("digest").agg(F.sum("n").alias("degree"))
    wanted = steps.keep("wanted", distinct.join(degree, "digest").select("digest", "id", "mark", "start", "end", "degree"))
    steps.drop("lines", "keys")
    ranked = members.join(wanted.select("digest", "degree"), "digest").select("key", "digest", F.struct("degree", "digest").alias("rank"))
    leaders = ranked.groupBy("key").agg(F.max("rank").alias("rank")).select("key", F.col("rank.digest").alias("leader"))
    led = steps.keep("led", members.join(leaders, "key").where("digest <> leader").select("key", "digest", "leader"))
    steps.drop("members")
    pairs = led.select("digest", "leader").distinct()

    sets = steps.keep("sets", _shingle_sets(texts, wanted))
    steps.drop("wanted")
    right = sets.select(F.col("digest").alias("leader"), F.col("shingles").alias("leading"))
    common = F.size(F.array_intersect("shingles", "leading"))
    union = F.size("shingles") + F.size("leading") - common
    starred = steps.keep("starred", pairs.join(sets, "digest").join(right, "leader").where(
        common >= F.lit(similarity) * union - 1e-9
    ).select(F.col("digest").alias("a"), F.col("leader").alias("b")))

    first = components(starred)
    # With its leader every member has been compared; the others are compared with each other now.
    classed = steps.keep("classed", led.join(first, F.col("digest") == F.col("node"), "left").select(
        "key", "digest", F.coalesce("component", "digest").alias("class")
    ))
    steps.drop("led")
    open_keys = classed.groupBy("key").agg(F.min("class").alias("low"), F.max("class").alias("high")).where("low <> high")
    rest = _rest_links(steps, classed.join(open_keys.select("key"), "key", "left_semi"), sets, similarity)
    rest = steps.keep("rest", rest)
    steps.drop("placed", "classed", "sets")
    linked = components(starred.union(rest)).select(F.col("node").alias("digest"), "component")

    # Most paragraphs are alone; only digests in a group are joined back to their places.
    nodes = linked.select("digest").union(linked.select("component")).union(copied).distinct()
    grouped = steps.keep("grouped", nodes.join(linked, "digest", "left").select("digest", F.coalesce("component", "digest").alias("class")))
    places = steps.keep("places", found.join(grouped, "digest").select("id", "mark", "paragraph", "start", "end", "words", "class").distinct())
    firsts = places.groupBy("class").agg(F.min(name).alias("first"))
    out = steps.keep("groups", places.join(firsts, "class").select(
        "id", "mark", "paragraph", "start", "end", "words", F.col("first.id").alias("first_id"),
        F.col("first.paragraph").alias("first_paragraph"), (name == F.col("first")).alias("kept"),
    ))
    steps.drop("copied", "starred", "rest", "grouped", "places")
    return out


def named_groups(groups: DataFrame, id_col: str) -> DataFrame:
    """The rows of ``groups_of`` under their public names."""
    return groups.select(
        F.col("id").alias(id_col), "paragraph", "start", "end", F.col("words").alias("n_words"),
        "first_id", "first_paragraph", "kept", F.col("mark").alias("text_hash"),
    )


def paragraph_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_words: int = MIN_WORDS,
    similarity: float = SIMILARITY,
    recall: float = RECALL,
) -> DataFrame:
    """One row per paragraph that has a near copy, the first of each group included.

    Columns: id, ``paragraph`` (number of the line, from 0), ``start``, ``end`` (characters
    of the text, end excluded), ``n_words``, ``first_id`` and ``first_paragraph`` (of the
    group's first member by id, hash of the text and number), ``kept`` (whether it is that first
    member), ``text_hash`` (``xxhash64`` of the text, which tells rows of one id apart).

    Lines under ``min_words`` words take no part, so null and empty texts give no rows.
    A document whose id is null takes no part. Repeated rows hold the same paragraphs twice
    under one name: those copies are not told apart, and count as one. Different texts of one
    id are different documents. An empty table gives no rows. Pairs whose shingle sets reach
    ``similarity`` are found with at least the probability ``recall`` each, equal paragraphs always.
    """
    spark = docs.sparkSession
    small_batches(spark)
    with freed_shuffles(spark):
        steps, texts = Steps(spark), texts_of(docs, id_col, text_col)
        scan = steps.keep("scan", scanned(texts, min_words, tuned_bands(similarity, recall), anchors=False))
        groups = groups_of(steps, texts, scan, similarity)
        steps.drop("scan")
    return named_groups(groups, id_col)


def without_repeats(docs: DataFrame, groups: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents without what ``groups`` does not keep, whole lines with their line ends.

    A row of ``groups`` holds for documents of its id and of the text that has its ``text_hash``.
    Rows without an id stay as they are; all columns of ``docs`` keep their names.
    """
    its_id, its_mark, its_spans = (spare(docs, n) for n in ("id_of_spans", "mark_of_spans", "spans"))
    spans = groups.where(~F.col("kept")).groupBy(F.col(id_col).alias(its_id), F.col("text_hash").alias(its_mark)).agg(
        F.array_sort(F.collect_list(F.struct("start", "end"))).alias(its_spans)
    )

    @F.pandas_udf("string")
    def cut(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for texts, spans in batches:
            out = []
            for text, drop in zip(texts, spans):
                if drop is not None and text is not None:
                    kept, at = [], 0
                    for span in drop:
                        kept.append(text[at : span["start"]])
                        whole = text[max(0, span["start"] - 1) : span["start"]] in ("", "\n")
                        at = span["end"] + (whole and text[span["end"] : span["end"] + 1] == "\n")
                    text = "".join(kept) + text[at:]
                out.append(text)
            yield pd.Series(out, dtype=object)
        give_back()

    small_batches(docs.sparkSession)
    text = F.col(f"`{text_col}`")
    both = docs.join(spans, (docs[f"`{id_col}`"] == F.col(its_id)) & (F.xxhash64(docs[f"`{text_col}`"]) == F.col(its_mark)), "left")
    return both.select(*[
        (F.when(F.col(its_spans).isNull(), text).otherwise(cut(text, its_spans)) if c == text_col else F.col(f"`{c}`")).alias(c)
        for c in docs.columns
    ])
