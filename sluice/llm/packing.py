"""Packing documents into sequences: shortest pack first over the length histogram.

Documents become token ids with an end id and are cut into full sequences and one rest.
Only the histogram of piece lengths, at most one row per length up to the sequence size,
reaches the driver. There the lengths are placed longest first: each goes to the packs
that are shortest so far, and a packing pattern (its lengths) keeps a count instead of its
packs. The result says, per length, which ranks go to which pattern and offset. Pieces
get a rank among those of their length, counted in slices so that no length is in one
task, and look their place up by rank.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, filterfalse

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.merges import Merges
from sluice.llm.workers import give_back
from sluice.session import durable, small_batches

SEQUENCE = 2048
END_ID = 1
# Cached words; a worker clears them beyond this number.
CACHE = 1 << 19
# Bytes of text that are taken apart together, unless one text is longer.
TOGETHER = 1 << 22
# Pieces of one length that one task ranks, on average.
SLICE = 2048

# The pattern of the vocabulary file, plain texts, and what it comes to on them in lower case.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
NOT_PLAIN = "[^\t\n\r -~¡-©«-¬®-±´¶-¸»¿-ÿ‐-‧‰-⁞€]"
RUN = "[^a-zß-öø-ÿ0-9\\s][.,]"
PLAIN_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9\s]+"


PIECES = "start long, length int, ids_crc32 long, ids binary, doc_tokens long"


class WordIds:
    """The ids of texts, word by word, for vocabularies that drop white space: no token reaches over it.

    Texts of plain letters, digits and punctuation are split by Arrow, and every different
    word of a part is looked up once; new words are cut as the vocabulary file says, merged
    in batches and cached. Any other text, and one that may hold a special string, is
    encoded by the library.
    """

    def __init__(self, path: str):
        self._merges = Merges(path)
        steps = self._merges.spec["pre_tokenizer"]["pretokenizers"]
        if steps[0]["pattern"]["Regex"] != PATTERN or steps[1]["type"] != "ByteLevel" or steps[1]["add_prefix_space"]:
            raise ValueError("a file for lower-cased words without white space is needed")
        self._words: dict[str, bytes] = {"": b""}
        self._cut = re.compile(PLAIN_WORDS)

    def forget(self) -> None:
        self._words = {"": b""}

    def _learn(self, words: list[str]) -> None:
        if len(self._words) > CACHE:
            self.forget()
        new = list(filterfalse(self._words.__contains__, words))
        pieces = list(map(self._cut.findall, new))
        whole = [w for w, p in zip(new, pieces) if len(p) == 1]
        self._words.update(zip(whole, self._merges.encode([w.encode() for w in whole])))
        rest = list(set(chain.from_iterable(p for p in pieces if len(p) > 1)).difference(self._words))
        self._words.update(zip(rest, self._merges.encode([w.encode() for w in rest])))
        get = self._words.__getitem__
        self._words.update((w, b"".join(map(get, p))) for w, p in zip(new, pieces) if len(p) > 1)

    def _plain_ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of plain texts one after the other, and where each text's begin and end."""
        lower = pc.utf8_lower(texts)
        # A single full stop or comma at a word's end is a word; one after other punctuation belongs to that.
        apart = lower
        for mark, spaced in ((", ", " , "), (". ", " . "), (".\n", " . ")):
            apart = pc.replace_substring(apart, mark, spaced)
        split = pc.ascii_split_whitespace(pc.if_else(pc.match_substring_regex(lower, RUN), lower, apart))
        coded = split.flatten().dictionary_encode()
        words, index = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        self._learn(words)
        parts = [self._words[w] for w in words]
        sizes = np.fromiter(map(len, parts), np.int64, len(parts)) // 4
        starts, all_ids = np.cumsum(sizes) - sizes, np.frombuffer(b"".join(parts), "<u4")
        taken = sizes[index]
        ends = np.concatenate(([0], np.cumsum(taken)))
        ids = all_ids[np.repeat(starts[index] - ends[:-1], taken) + np.arange(ends[-1])]
        return ids, ends[split.offsets.to_numpy() - split.offsets[0].as_py()]

    def of(self, texts: pa.Array) -> list[bytes]:
        """Little-endian ids of each text; none for a null text."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        odd = pc.or_(pc.match_substring_regex(texts, NOT_PLAIN), pc.match_substring(texts, "<|")).to_numpy(zero_copy_only=False)
        out = [b""] * len(texts)
        for i in np.flatnonzero(odd):
            out[i] = np.array(self._merges.library.encode(texts[i].as_py(), add_special_tokens=False).ids, "<u4").tobytes()
        plain = np.flatnonzero(~odd)
        if len(plain):
            ids, ends = self._plain_ids(texts.take(pa.array(plain)))
            for k, i in enumerate(plain.tolist()):
                out[i] = ids[ends[k] : ends[k + 1]].tobytes()
        return out


def parts(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of texts of ``TOGETHER`` bytes at most, or of one text."""
    total = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    first, before = 0, 0
    while first < len(total):
        last = max(first + 1, int(np.searchsorted(total, before + TOGETHER, side="right")))
        yield first, last
        first, before = last, int(total[last - 1])


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    return WordIds(path)


def cut(ids: bytes, sequence: int = SEQUENCE) -> list[tuple[int, int, int]]:
    """``(start, length, crc32)`` of each piece: full sequences, then the rest."""
    n = len(ids) // 4
    return [
        (s, min(sequence, n - s), zlib.crc32(ids[4 * s : 4 * (s + sequence)])) for s in range(0, n, sequence)
    ]


def pack_histogram(counts: dict[int, int], sequence: int = SEQUENCE) -> list[tuple[tuple[int, ...], int]]:
    """Patterns ``(lengths, how many packs)``: longest lengths first, each to the shortest packs it fits.

    Where none fits, the pieces of one length open packs that hold as many of them as fit.
    """
    packs: dict[int, list[tuple[tuple[int, ...], int]]] = defaultdict(list)
    used_heap: list[int] = []
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            while used_heap and not packs[used_heap[0]]:
                heapq.heappop(used_heap)
            if used_heap and used_heap[0] + length <= sequence:
                used = used_heap[0]
                lengths, n = packs[used].pop()
                if n > left:
                    packs[used].append((lengths, n - left))
                    n = left
                each = 1
            else:
                # Full packs of this length, then one with the rest.
                each = min(left, sequence // length)
                used, lengths, n = 0, (), left // each
            left -= n * each
            used += length * each
            if not packs[used]:
                heapq.heappush(used_heap, used)
            packs[used].append(((*lengths, *[length] * each), n))
    return [p for used in sorted(packs, reverse=True) for p in packs[used]]


def placement(patterns: list[tuple[tuple[int, ...], int]], sequence: int = SEQUENCE) -> dict[str, np.ndarray]:
    """Sorted by length and first rank: ``key`` (both in one number), ``sequence_id`` and ``offset`` of that rank.

    The pieces of the next ranks go to the same offset of the next sequences.
    """
    next_rank: dict[int, int] = defaultdict(int)
    rows, first = [], 0
    for lengths, n in patterns:
        offset = 0
        for length in lengths:
            rows.append((length, next_rank[length], first, offset))
            next_rank[length] += n
            offset += length
        first += n
    table = np.array(sorted(rows), np.int64).reshape(-1, 4)
    return {"key": (table[:, 0] << 46) + table[:, 1], "sequence_id": table[:, 2], "offset": table[:, 3]}


def pack(
    docs: DataFrame,
    path: str,
    sequence: int = SEQUENCE,
    end_id: int = END_ID,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: id, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset``.

    A document is the ids of its whole text (null: none) and ``end_id``; every id is in
    exactly one piece. Pieces of a sequence lie side by side from offset 0. ``with_ids``
    adds the piece's ids. Repeated rows are documents of their own; an empty table gives
    no rows. ``path``: a vocabulary file that drops white space, there on every executor.
    """
    tail = np.array([end_id], "<u4").tobytes()

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last in parts(batch.column(1)):
                at, rows = [], []
                for i, ids in enumerate(word_ids(path).of(batch.column(1).slice(first, last - first)), first):
                    ids += tail
                    for s, n, crc in cut(ids, sequence):
                        at.append(i)
                        rows.append((s, n, crc, ids[4 * s : 4 * (s + n)] if with_ids else None, len(ids) // 4))
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.int64())
                columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(at)), *columns], ["id", "start", "length", "ids_crc32", "ids", "doc_tokens"]
                )
        word_ids(path).forget()
        give_back()

    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    cuts = source.mapInArrow(pieces, f"id {source.dtypes[0][1]}, {PIECES}")
    small_batches(docs.sparkSession)
    cuts = durable(cuts.drop(*[] if with_ids else ["ids"]))
    counts = {r["length"]: r["n"] for r in cuts.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        counts = {1: 0}
    place = placement(pack_histogram(counts, sequence), sequence)

    # Ranks in two steps: pieces of one length are dealt to slices by a hash, ranked
    # there, and start at the sum of the slices before.
    slices = np.ones(sequence + 1, np.int64)
    for length, n in counts.items():
        slices[length] = max(1, -(-n // SLICE))
    spark = docs.sparkSession
    dealt = spark.createDataFrame(pd.DataFrame({"length": np.arange(sequence + 1, dtype=np.int32), "slices": slices}))
    sliced = cuts.join(F.broadcast(dealt), "length").withColumn(
        "slice", F.pmod(F.xxhash64("id", "start", "ids_crc32"), "slices")
    )
    # Slices of one length are added up in runs of as many slices, and the runs before.
    sized = sliced.groupBy("length", "slice").agg(F.count(F.lit(1)).alias("n")).withColumn("run", F.floor(F.col("slice") / SLICE))
    inside = Window.partitionBy("length", "run").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy("length").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = sized.groupBy("length", "run").agg(F.sum("n").alias("n")).select(
        "length", "run", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead")
    )
    firsts = sized.withColumn("near", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(runs, ["length", "run"]).select(
        "length", "slice", (F.col("near") + F.col("ahead")).alias("first")
    )
    order = Window.partitionBy("length", "slice").orderBy("id", "start", "ids_crc32", "doc_tokens")
    ranked = sliced.withColumn("rank", F.row_number().over(order) - 1).join(firsts, ["length", "slice"])

    @F.pandas_udf("sequence_id long, offset long")
    def placed(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        key = (length.to_numpy().astype(np.int64) << 46) + rank.to_numpy()
        at = np.searchsorted(place["key"], key, side="right") - 1
        return pd.DataFrame({
            "sequence_id": place["sequence_id"][at] + key - place["key"][at], "offset": place["offset"][at],
        })

    out = ranked.withColumn("at", placed("length", F.col("rank") + F.col("first")))
    return out.select(
        F.col("id").alias(id_col), "start", F.col("length").cast("long").alias("length"), "ids_crc32",
        "doc_tokens", "at.sequence_id", "at.offset", *["ids"] * with_ids,
    )
