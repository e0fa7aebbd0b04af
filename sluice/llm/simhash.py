"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints at most ``bits`` apart have a common point within half that distance
of each. Every distinct fingerprint emits the points of a ball around it, the points
are shuffled, and fingerprints that share a point are candidates.

For an odd distance the halves differ by one. Fingerprints an odd distance apart have
different parity, so only those with an even number of set bits emit the larger ball.
Of its outermost shell, for a distance of 3, the flips of two bits in the same half of
the word suffice: among any three bits two are in one half, and the other side flips the
third. That is 1057 points and 65 points instead of 2081 for all.

A point may be shared by many fingerprints. Those within the inner radius of the point
are all linked with each other and with those in the outer shell (triangle inequality),
and two of the outer shell that are linked also meet elsewhere. So each point yields a
star around its smallest inner fingerprint: as many links as members, never all pairs,
and the components are those of all links.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.components import components
from sluice.llm.workers import give_back
from sluice.session import durable, small_batches

SHINGLE_WORDS = 3
MAX_BITS = 3
SEED = 42
# Points that one group of the shuffle holds, on average: 2.5 MB.
POINTS_PER_GROUP = 1 << 18
# Groups whose points one task emits, on average.
GROUPS_PER_TASK = 16
# Fingerprints whose balls are formed at a time.
CHUNK = 1024


def fingerprint_bytes(text: str | None, words: int = SHINGLE_WORDS, seed: int = SEED) -> bytes:
    """The 64 bits, big-endian; zero for a null text or one without words."""
    tokens = (text or "").encode().lower().split()
    if not tokens:
        return bytes(8)
    line = b" ".join(tokens)
    ends = np.cumsum([len(t) + 1 for t in tokens]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    last = max(len(tokens) - words, 0)
    starts, ends = starts[: last + 1].tolist(), ends[len(tokens) - 1 - last :].tolist()
    counts = np.zeros(64, np.int64)
    digest = xxhash.xxh64_digest
    for at in range(0, len(starts), 1 << 16):
        part = b"".join([digest(line[s:e], seed) for s, e in zip(starts[at : at + (1 << 16)], ends[at : at + (1 << 16)])])
        counts += np.unpackbits(np.frombuffer(part, np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return np.packbits(counts * 2 > len(starts)).tobytes()


def fingerprints(text: Column, words: int = SHINGLE_WORDS) -> Column:
    """The fingerprint of each text as a signed long."""

    @F.pandas_udf("long")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([int.from_bytes(fingerprint_bytes(t, words), "big", signed=True) for t in texts], dtype="int64")
        give_back()

    return run(text)


def ball_masks(bits: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Flips of a ball, how many bits each flips, and how many flips the smaller ball has."""
    if not 0 <= bits <= 4:
        raise ValueError("distances from 0 to 4 are supported")
    inner = [c for r in range(bits // 2 + 1) for c in combinations(range(64), r)]
    outer = list(combinations(range(64), bits // 2 + 1)) if bits % 2 else []
    if bits == 3:
        outer = [c for c in outer if c[0] // 32 == c[1] // 32]
    masks = np.array([sum(1 << i for i in c) for c in inner + outer], np.uint64)
    return masks, np.array([len(c) for c in inner + outer], np.uint8), len(inner)


def _emit(bits: int, groups: int):
    masks, _, inner = ball_masks(bits)
    mix = np.uint64(0x9E3779B97F4A7C15)

    def points(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            all_fps = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for at in range(0, len(all_fps), CHUNK):
                fps = all_fps[at : at + CHUNK]
                odd = np.bitwise_count(fps) % 2 == 1
                point, code = [], []
                for part, n in ((fps[odd], inner), (fps[~odd], len(masks))):
                    point.append((part[:, None] ^ masks[None, :n]).ravel())
                    code.append(np.tile(np.arange(n, dtype=np.uint16), len(part)))
                point, code = np.concatenate(point), np.concatenate(code)
                group = (((point * mix) >> np.uint64(24)) % np.uint64(groups)).astype(np.int32)
                order = np.argsort(group, kind="stable")
                point, code, group = point[order], code[order], group[order]
                first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
                ends = np.r_[first[1:], len(group)]
                yield pa.record_batch({
                    "group": pa.array(group[first], pa.int32()),
                    "points": pa.array([point[s:e].tobytes() for s, e in zip(first, ends)], pa.binary()),
                    "codes": pa.array([code[s:e].tobytes() for s, e in zip(first, ends)], pa.binary()),
                })
        give_back()

    return points


def _meet(bits: int):
    masks, flips, _ = ball_masks(bits)

    def links(table: pa.Table) -> pa.Table:
        point = np.frombuffer(b"".join(table.column("points").to_pylist()), np.uint64)
        code = np.frombuffer(b"".join(table.column("codes").to_pylist()), np.uint16)
        order = np.argsort(point, kind="stable")
        point, code = point[order], code[order]
        same = point[1:] == point[:-1]
        shared = np.r_[False, same] | np.r_[same, False]
        point, code = point[shared], code[shared]
        if not len(point):
            return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
        fps, near = point ^ masks[code], flips[code] <= bits // 2
        new = np.r_[True, point[1:] != point[:-1]]
        first, run = np.flatnonzero(new), np.cumsum(new) - 1
        centre = np.minimum.reduceat(np.where(near, fps, np.uint64(2**64 - 1)), first)[run]
        linked = np.logical_or.reduceat(near, first)[run] & (fps != centre)
        linked &= np.bitwise_count(fps ^ centre) <= bits
        pairs = np.unique(np.stack([fps[linked], centre[linked]], axis=1), axis=0).view(np.int64)
        return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})

    return links


def fingerprint_links(fps: DataFrame, rows: int, bits: int = MAX_BITS) -> DataFrame:
    """Links ``(a, b)`` that connect all distinct fingerprints (one long column) at most ``bits`` apart.

    ``rows``: an upper bound of the number of fingerprints; it only sets how finely the
    shuffle is cut.
    """
    masks, _, inner = ball_masks(bits)
    groups = max(1, min(rows * (len(masks) + inner) // 2 // POINTS_PER_GROUP, 2**31 - 1))
    # Fingerprints are small and their balls are not: adaptive execution would leave them in a few tasks.
    fps = fps.repartition(max(1, groups // GROUPS_PER_TASK))
    spread = fps.mapInArrow(_emit(bits, groups), "group int, points binary, codes binary")
    return spread.groupBy("group").applyInArrow(_meet(bits), "a long, b long").distinct()


def simhash_near_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE_WORDS, bits: int = MAX_BITS
) -> DataFrame:
    """One row ``(id, fingerprint, component_id)`` per document.

    Texts are lower-cased in A-Z and cut at ASCII white space; all shingles of ``words``
    words count, repeats included; a shorter text is one shingle. A null text and one
    without words have fingerprint zero and are linked like any other. Documents link at
    ``bits`` or fewer differing bits; ``component_id`` is the smallest id reachable,
    null only where no id in the component is known. A repeated row is returned as often
    as it is there; other columns are not read; an empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    marked = durable(docs.select(F.col(id_col).alias("id"), fingerprints(F.col(text_col), words).alias("fp")))
    distinct = marked.groupBy("fp").agg(F.min("id").alias("first"))
    found = components(fingerprint_links(distinct.select("fp"), marked.count(), bits))
    classes = distinct.join(found, F.col("fp") == F.col("node"), "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("class")
    )
    first = classes.groupBy("class").agg(F.min("first").alias("component_id"))
    names = classes.join(first, "class").select(F.col("fp").alias("_fp"), "component_id")
    return marked.join(names, F.col("fp") == F.col("_fp")).select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
