"""One pass over whole texts for what passages are found by: digests and band keys of long lines, and anchors.

Words are runs of anything but ASCII white space, lower-cased in A-Z. Each is hashed once; shingles
of a line, its MinHash signature and the anchors of the text are all made from these hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.workers import give_back
from sluice.session import small_batches

SHINGLE_WORDS = 5
BAND_ROWS = 3
# Words of the shortest passage, and of the stretches that anchors are chosen from.
PASSAGE_WORDS = 50
GRAM_WORDS = 26
# Shingles that are hashed at a time.
CHUNK = 1 << 15

MIX, SPREAD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)

FOUND = (
    "lines array<struct<paragraph: int, start: int, end: int, words: int, digest: binary, bands: array<long>>>, "
    "anchors array<struct<at: int, low: int, high: int, gram: long>>"
)


def hashed(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def line_shingles(words: np.ndarray, sizes: np.ndarray, size: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """A hash per run of ``size`` words within each line, and where each line's begin; no line is shorter than ``size``."""
    runs = words[: len(words) - size + 1].copy()
    for i in range(1, size):
        runs *= MIX
        runs ^= runs >> np.uint64(29)
        runs += words[i : len(words) - size + 1 + i]
    ends = np.cumsum(sizes)
    inside = np.ones(len(words), bool)
    for i in range(1, size):
        inside[ends - i] = False
    starts = np.cumsum(sizes - size + 1) - (sizes - size + 1)
    return runs[inside[: len(runs)]], starts


def shingle_hashes(lines: list[list[bytes]], size: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """``line_shingles`` of words; a line of fewer words has one shingle, of all its words together."""
    filled = [p + [b""] * (size - len(p)) if len(p) < size else p for p in lines]
    return line_shingles(hashed(list(chain.from_iterable(filled))), np.array([len(p) for p in filled]), size)


def _signature_seeds(count: int) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(b"minhash %d" % i) | 1 for i in range(count)], np.uint64)


def _mixed(hashes: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    x = hashes[:, None] * seeds[None, :]
    x ^= x >> np.uint64(32)
    x *= SPREAD
    return x


def band_keys(hashes: np.ndarray, starts: np.ndarray, bands: int) -> np.ndarray:
    """One signed key per line and band of the MinHash signature; shingles are expanded in chunks."""
    seeds = _signature_seeds(bands * BAND_ROWS)
    least = np.full((len(starts), len(seeds)), np.uint64(2**64 - 1))
    for at in range(0, len(hashes), CHUNK):
        part = hashes[at : at + CHUNK]
        first = int(np.searchsorted(starts, at, side="right")) - 1
        last = int(np.searchsorted(starts, at + len(part), side="left"))
        cuts = np.maximum(starts[first:last] - at, 0)
        least[first:last] = np.minimum(least[first:last], np.minimum.reduceat(_mixed(part, seeds), cuts, axis=0))
    keys = np.tile(np.arange(1, bands + 1, dtype=np.uint64) * MIX, (len(starts), 1))
    for i in range(BAND_ROWS):
        keys = (keys ^ least[:, i::BAND_ROWS]) * SPREAD
        keys ^= keys >> np.uint64(31)
    return keys.view(np.int64)


def run_hashes(words: np.ndarray, size: int, base: int) -> np.ndarray:
    """A hash per run of ``size`` words, from differences of one running sum."""
    powers = np.full(len(words), np.uint64(base))
    powers[:1] = 1
    back = np.full(max(0, len(words) - size + 1), np.uint64(pow(base, -1, 1 << 64)))
    back[:1] = 1
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * np.cumprod(powers))])
    out = (sums[size:] - sums[:-size]) * np.cumprod(back) if len(words) >= size else back
    for shift in (32, 29):
        out ^= out >> np.uint64(shift)
        out *= SPREAD if shift == 32 else MIX
    return out ^ (out >> np.uint64(32))


def anchors_of(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the anchors: of each 25 overlapping runs of ``GRAM_WORDS`` words the one with the least hash.

    Every run of ``PASSAGE_WORDS`` words holds one, and its words alone settle which.
    """
    grams = run_hashes(words, GRAM_WORDS, BASES[0])
    width = PASSAGE_WORDS - GRAM_WORDS + 1
    if len(grams) < width:
        return np.zeros(0, np.int64), grams[:0]
    least = np.lib.stride_tricks.sliding_window_view(grams, width).argmin(axis=1)
    places = np.unique(least + np.arange(len(least)))
    return places, grams[places]


class _Found:
    """What the texts of a batch hold, column by column."""

    def __init__(self, min_words: int, bands: int, anchors: bool):
        self.min_words, self.bands, self.anchored = min_words, bands, anchors
        self.rows: list[int] = []
        self.line_ends, self.anchor_ends = [0], [0]
        self.number, self.start, self.end, self.count, self.digest = [], [], [], [], []
        self.words: list[np.ndarray] = []
        self.at, self.low, self.high, self.gram = [], [], [], []
        self.waiting = 0

    def add(self, row: int, text: str) -> None:
        lines = text.encode().lower().split(b"\n")
        chars = [len(line) for line in (lines if text.isascii() else text.split("\n"))]
        split = [line.split() for line in lines]
        words = hashed(list(chain.from_iterable(split)))
        counts = np.fromiter(map(len, split), np.int64, len(split))
        ends = np.cumsum(counts)
        starts = np.cumsum(np.array(chars) + 1) - chars - 1
        fill = xxhash.xxh3_64_intdigest(b"")
        for i in np.nonzero(counts >= max(1, self.min_words))[0]:
            self.number.append(i)
            self.start.append(starts[i])
            self.end.append(starts[i] + chars[i])
            self.count.append(counts[i])
            self.digest.append(xxhash.xxh3_128_digest(b" ".join(split[i])))
            held = words[ends[i] - counts[i] : ends[i]]
            short = SHINGLE_WORDS - len(held)
            self.words.append(np.concatenate([held, np.full(short, fill, np.uint64)]) if short > 0 else held)
        at, gram = anchors_of(words) if self.anchored else (np.zeros(0, np.int64), words[:0])
        if len(self.number) == self.line_ends[-1] and not len(at):
            return
        line = np.repeat(np.arange(len(split)), counts)
        self.rows.append(row)
        self.line_ends.append(len(self.number))
        self.anchor_ends.append(self.anchor_ends[-1] + len(at))
        for column, values in ((self.at, at), (self.low, line[at]), (self.high, line[at + GRAM_WORDS - 1]), (self.gram, gram)):
            column.append(values)
        self.waiting += len(words)

    def batch(self, batch: pa.RecordBatch) -> pa.RecordBatch:
        sizes = np.array([len(w) for w in self.words], np.int64)
        keys = band_keys(*line_shingles(np.concatenate(self.words), sizes), self.bands) if self.words else np.zeros(0, np.int64)
        offsets = pa.array(np.arange(len(sizes) + 1, dtype=np.int32) * self.bands)
        ints = [pa.array(np.array(c, np.int32)) for c in (self.number, self.start, self.end, self.count)]
        lines = pa.StructArray.from_arrays(
            [*ints, pa.array(self.digest, pa.binary()), pa.ListArray.from_arrays(offsets, pa.array(keys.ravel()))],
            ["paragraph", "start", "end", "words", "digest", "bands"],
        )
        flat = [np.concatenate(c) for c in (self.at, self.low, self.high, self.gram)]
        anchors = pa.StructArray.from_arrays(
            [*(pa.array(c.astype(np.int32)) for c in flat[:3]), pa.array(flat[3].view(np.int64))], ["at", "low", "high", "gram"]
        )
        rows = pa.array(self.rows)
        return pa.RecordBatch.from_arrays([
            batch.column(0).take(rows), batch.column(1).take(rows),
            pa.ListArray.from_arrays(pa.array(self.line_ends, pa.int32()), lines),
            pa.ListArray.from_arrays(pa.array(self.anchor_ends, pa.int32()), anchors),
        ], ["id", "mark", "lines", "anchors"])


def texts_of(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id``, ``mark`` (``xxhash64`` of the text) and ``text`` of the documents that have an id and a text."""
    held = docs.where(F.col(f"`{id_col}`").isNotNull() & F.col(f"`{text_col}`").isNotNull())
    return held.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(f"`{text_col}`").alias("mark"), F.col(f"`{text_col}`").alias("text"))


def scanned(texts: DataFrame, min_words: int, bands: int, anchors: bool = True) -> DataFrame:
    """Long lines and anchors of each text that has any: ``id``, ``mark`` and ``FOUND``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = _Found(min_words, bands, anchors)
            for i, text in enumerate(batch.column(2)):
                found.add(i, text.as_py())
                if found.waiting > CHUNK:
                    yield found.batch(batch)
                    found = _Found(min_words, bands, anchors)
            if found.rows:
                yield found.batch(batch)
        give_back()

    small_batches(texts.sparkSession)
    return texts.mapInArrow(run, f"id {texts.dtypes[0][1]}, mark long, {FOUND}")
