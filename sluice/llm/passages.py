"""Passages of 50 words and more that repeat anywhere: within lines, over line ends, in short lines.

1. The scan of the texts names anchors: of each run of 25 overlapping stretches of 26 words the one
   with the least hash. The words alone set them, so equal passages of 50 words share an anchor wherever
   they stand, whatever is around them and however their lines are wrapped.
2. Anchors that touch a line that is removed anyway go: no window that counts holds one. Where an anchor
   is there twice among the others, the windows of 50 words around it get a digest of 128 bits each.
3. A window whose digest stands at an earlier place repeats. Windows that overlap or meet are one passage.

No pairs are formed: every step counts, or joins places with the first one of their digest.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.paragraphs import MIN_WORDS, groups_of, named_groups, tuned_bands
from sluice.llm.scan import BASES, CHUNK, GRAM_WORDS, PASSAGE_WORDS, hashed, run_hashes, scanned, texts_of
from sluice.llm.workers import give_back
from sluice.session import Steps, freed_shuffles, plain_unions, small_batches

# White space as bytes.split() sees it.
WORD = re.compile(r"[^\x20\x09-\x0D]+")

WINDOWS = "mark long, at int, line int, start int, end int, high long, low long"


def _batch(ids: pa.Array, rows: list[tuple], kinds: tuple) -> pa.RecordBatch:
    """Rows ``(row of the id, mark, *arrays of one length)`` as a batch."""
    sizes = [len(r[2]) for r in rows]
    arrays = [ids.take(pa.array(np.repeat([r[0] for r in rows], sizes)))]
    arrays.append(pa.array(np.repeat(np.array([r[1] for r in rows], np.int64), sizes)))
    for i, (_, kind) in enumerate(kinds, 2):
        whole = np.concatenate([r[i] for r in rows])
        arrays.append(pa.array(whole.view(np.int64) if kind == pa.int64() else whole.astype(np.int32), kind))
    return pa.RecordBatch.from_arrays(arrays, ["id", "mark", *[n for n, _ in kinds]])


def _rows(found, kinds: tuple):
    """A function for mapInArrow: ``found`` gives each row's arrays from its values after the id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, waiting = [], 0
            for i in range(batch.num_rows):
                arrays = found(*(batch.column(c)[i].as_py() for c in range(1, batch.num_columns)))
                if len(arrays[0]):
                    rows.append((i, batch.column(1)[i].as_py(), *arrays))
                    waiting += len(arrays[0])
                if waiting > CHUNK:
                    yield _batch(batch.column(0), rows, kinds)
                    rows, waiting = [], 0
            if rows:
                yield _batch(batch.column(0), rows, kinds)
        give_back()

    return run


def _anchors_outside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Place and hash of the anchors of ``(id, mark, anchors, dropped lines)`` that touch none of these lines."""
    for batch in batches:
        lists = batch.column(2)
        ends = lists.offsets.to_numpy().astype(np.int64) - lists.offsets[0].as_py()
        flat = lists.flatten()
        at, low, high, gram = (flat.field(i).to_numpy(zero_copy_only=False) for i in range(4))
        keep = np.ones(len(at), bool)
        for i, dropped in enumerate(batch.column(3)):
            if dropped.is_valid:
                lines = np.sort(dropped.values.to_numpy())
                part = slice(ends[i], ends[i + 1])
                keep[part] = np.searchsorted(lines, low[part]) == np.searchsorted(lines, high[part], side="right")
        row = pa.array(np.repeat(np.arange(batch.num_rows), np.diff(ends))[keep])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(row), batch.column(1).take(row), pa.array(at[keep]), pa.array(gram[keep])], ["id", "mark", "at", "gram"]
        )


def window_rows(mark: int, text: str, anchors: list, drops: list | None) -> tuple:
    """Place, line, start, end (in characters) and digest of the windows that hold one of the ``anchors`` and none of the ``drops``."""
    words = hashed(text.encode().lower().split())
    spans = np.array([m.span() for m in WORD.finditer(text)], np.int64).reshape(-1, 2)
    count = max(0, len(words) - PASSAGE_WORDS + 1)
    # Windows from ``first`` up to ``last`` hold the anchor.
    near = np.zeros(count + 1, np.int64)
    mine = np.unique(np.array(anchors, np.int64))
    np.add.at(near, np.maximum(mine - (PASSAGE_WORDS - GRAM_WORDS), 0), 1)
    np.add.at(near, np.minimum(mine + 1, count), -1)
    gone = np.zeros(len(words) + 1, np.int64)
    for d in drops or ():
        a, b = np.searchsorted(spans[:, 0], (d["start"], d["end"]))
        gone[a] += 1
        gone[b] -= 1
    gone = np.concatenate([[0], np.cumsum(np.cumsum(gone[:-1]) > 0)])
    at = np.nonzero((np.cumsum(near[:-1]) > 0) & (gone[PASSAGE_WORDS:] == gone[: len(gone) - PASSAGE_WORDS])[:count])[0] if count else np.zeros(0, np.int64)
    starts, ends = spans[at, 0], spans[at + PASSAGE_WORDS - 1, 1]
    breaks = np.array([m.start() for m in re.finditer("\n", text)], np.int64)
    high, low = (run_hashes(words, PASSAGE_WORDS, b)[at] for b in BASES)
    return at, np.searchsorted(breaks, starts), starts, ends, high, low


def passages_of(steps: Steps, texts: DataFrame, scan: DataFrame, groups: DataFrame) -> DataFrame:
    """One row per passage of ``PASSAGE_WORDS`` words and more that stands at several places.

    ``groups`` are the lines of ``groups_of``; what it does not keep takes no part. The columns are those of
    ``groups``: ``paragraph`` is the line that the passage begins in, ``first_id`` and ``first_paragraph``
    where its first window stands first by id, hash of the text and place. Passages that are kept may
    overlap others that are not.

    Words are equal if they are but for A-Z; white space does not matter. Every equal run of
    ``PASSAGE_WORDS`` words is found. A copy that overlaps its first occurrence, as in a text of one
    word, does not count. Rows of one id and text count once; a document whose id is null takes no part.
    """
    kind = texts.dtypes[0][1]
    drops = steps.keep("drops", groups.where(~F.col("kept")).groupBy("id", "mark").agg(
        F.collect_list("paragraph").alias("lines"), F.collect_list(F.struct("start", "end")).alias("drops")
    ))
    listed = scan.where(F.size("anchors") > 0).select("id", "mark", "anchors").join(drops.select("id", "mark", "lines"), ["id", "mark"], "left")
    anchors = steps.keep("anchors", listed.mapInArrow(_anchors_outside, f"id {kind}, mark long, at int, gram long"))
    # Repeated rows name an anchor twice, which costs some windows that then find no other place.
    shared = steps.keep("shared", anchors.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("gram"))
    where = steps.keep("where", anchors.join(shared, "gram").groupBy("id", "mark").agg(F.collect_set("at").alias("anchors")))
    steps.drop("anchors", "shared")
    near = where.join(drops.select("id", "mark", "drops"), ["id", "mark"], "left")
    held = texts.join(near, ["id", "mark"]).select("id", "mark", "text", "anchors", "drops")
    kinds = (*((c, pa.int32()) for c in ("at", "line", "start", "end")), ("high", pa.int64()), ("low", pa.int64()))
    windows = steps.keep("windows", held.mapInArrow(_rows(window_rows, kinds), f"id {kind}, {WINDOWS}"))
    steps.drop("where", "drops")

    place = F.struct("id", "mark", "at", "line")
    # Written down, so that the join is one that adaptive execution can split where a digest is very frequent.
    firsts = steps.keep("firsts", windows.groupBy("high", "low").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first <> last").drop("last"))
    there = windows.join(firsts, ["high", "low"]).withColumn("kept", place == F.col("first")).where(
        (F.col("kept") | (F.col("id") != F.col("first.id")) | (F.col("mark") != F.col("first.mark")))
        | (F.col("at") >= F.col("first.at") + PASSAGE_WORDS)
    )
    order = Window.partitionBy("id", "mark", "kept").orderBy("at")
    begins = F.coalesce(F.col("at") > F.lag("at").over(order) + PASSAGE_WORDS, F.lit(True)).cast("int")
    numbered = there.withColumn("begins", begins).withColumn("run", F.sum("begins").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    found = numbered.groupBy("id", "mark", "kept", "run").agg(
        F.min("line").alias("paragraph"), F.min("start").alias("start"), F.max("end").alias("end"),
        (F.max("at") - F.min("at") + PASSAGE_WORDS).alias("words"), F.min_by("first", "at").alias("first"),
    )
    out = steps.keep("passages", found.select(
        "id", "mark", "paragraph", "start", "end", "words", F.col("first.id").alias("first_id"),
        F.col("first.line").alias("first_paragraph"), "kept",
    ))
    steps.drop("windows", "firsts")
    return out


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The lines of ``paragraph_groups`` and, in what they leave, the passages of ``passages_of``; one pass over the texts finds both."""
    spark = docs.sparkSession
    small_batches(spark)
    plain_unions(spark)
    with freed_shuffles(spark):
        steps, texts = Steps(spark), texts_of(docs, id_col, text_col)
        scan = steps.keep("scan", scanned(texts, MIN_WORDS, tuned_bands()))
        groups = groups_of(steps, texts, scan)
        passages = passages_of(steps, texts, scan, groups)
        steps.drop("scan")
    return named_groups(groups.unionByName(passages), id_col)
