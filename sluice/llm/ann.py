"""Approximate nearest neighbours by collision-counting hashing.

A block of vectors is projected on random lines, and each projection is a sorted array.
A query opens a window around its own projection on every line and widens all windows
together, round by round, by a fixed factor (virtual rehashing: no array is built anew).
A vector that has come into at least ``THRESHOLD`` of the ``LINES`` windows is verified
with its exact inner product. A query ends when its k-th best verified vector is not
farther than the half-width of the windows: a vector that near collides on a line with
probability 0.68, so it passes the threshold with probability 0.98 or more. If the windows
grow over the whole block, every vector has been verified: there is no cap on candidates.

Each projection is cut into slabs, with a bitmap of the vectors ahead of each slab. A window
is the difference of two bitmaps, widened to whole slabs, and the windows of all lines are
added up as bit planes: a few word operations for 64 vectors at a time.

Largest inner product is nearest neighbour search after one more component lifts all
vectors of the block to the same length; queries are scaled to that length as well.

The query set is searched in all rows in blocks: rows are dealt to blocks by a hash,
queries to chunks, and each task searches one chunk in one block. Tasks have a fixed
size, and only the k best per query and block go on to the merge. Each query searches one
block first; its k-th best score there is a bound for all other blocks, where the windows
open once, with the first half-width of the rounds that is not below the bound's distance.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.vectors import matrix, row_dots, usable
from sluice.session import staged

K = 20
LINES = 48
THRESHOLD = 26
# Vectors in a block, queries in a chunk, on average.
BLOCK = 8192
CHUNK = 8192
GROW = 1.3
# The first half-width, in standard deviations of the projections.
FIRST = 0.3
# Slabs of a projection, queries counted at a time, cells of their table of products.
SLABS = 128
BATCH = 64
CELLS = 1 << 20
# Relative error of an inner product, generously.
ROUNDING = 1e-9
SEED = 42

RESULT = "query_id long, vec_id long, score double"


def _bitmaps(order: np.ndarray, size: int) -> np.ndarray:
    """``(line, slab, word)``: which rows stand ahead of a slab of ``size`` places, one bit a row."""
    lines, n = order.shape
    slabs, words = -(-n // size), -(-n // 64)
    out = np.zeros((lines, slabs + 1, words * 8), np.uint8)
    for line in range(lines):
        inside = np.zeros((slabs, words * 64), np.bool_)
        inside[np.arange(n) // size, order[line]] = True
        np.bitwise_or.accumulate(np.packbits(inside, axis=1), axis=0, out=out[line, 1:])
    return out.view(np.uint64)


def _collided(bitmaps: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """``(query, word)``: the rows in at least ``THRESHOLD`` of the windows ``(line, query)`` between two slabs."""
    planes = np.zeros((len(bitmaps).bit_length(), low.shape[1], bitmaps.shape[2]), np.uint64)
    for line, maps in enumerate(bitmaps):
        carry = maps[high[line]] ^ maps[low[line]]
        for plane in planes[: (line + 1).bit_length()]:
            plane ^= carry
            carry &= ~plane
    more, equal = np.zeros_like(planes[0]), np.full_like(planes[0], ~np.uint64(0))
    for bit in reversed(range(len(planes))):
        if THRESHOLD >> bit & 1:
            equal &= planes[bit]
        else:
            more |= equal & planes[bit]
            equal &= ~planes[bit]
    return more | equal


def search(
    rows: np.ndarray, ids: np.ndarray, queries: np.ndarray, query_ids: np.ndarray, k: int = K, bounds: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(query, row, score)`` of the k best rows found for each query, its own id left out.

    Where ``bounds`` has a score, k rows elsewhere are known to reach it: only rows that reach it too are looked for.
    """
    n, width = rows.shape
    squares = (rows * rows).sum(axis=1)
    most = squares.max()
    lifted = np.hstack([rows, np.sqrt(np.maximum(most - squares, 0.0))[:, None]])
    lengths = np.sqrt((queries * queries).sum(axis=1))
    lines = np.random.default_rng(SEED).standard_normal((width + 1, LINES))
    projected = (lifted @ lines).T
    order = np.argsort(projected, axis=1, kind="stable")
    arrays = np.take_along_axis(projected, order, axis=1)
    centres = ((queries * (np.sqrt(most) / lengths)[:, None]) @ lines[:width]).T
    size = -(-n // SLABS)
    bitmaps = _bitmaps(order, size)
    slabs = bitmaps.shape[1] - 1
    first = FIRST * arrays.std()
    first = first if first > 0 else 1.0
    slack = ROUNDING * np.sqrt(most) * lengths

    def distance(q: int, score: float) -> float:
        return np.sqrt(max(0.0, 2 * most - 2 * np.sqrt(most) * score / lengths[q]))

    asked = len(queries)
    best_rows: list[np.ndarray] = [np.empty(0, np.int64)] * asked
    best_scores: list[np.ndarray] = [np.empty(0)] * asked
    # What a row has to reach to be among the best.
    least = np.full(asked, -np.inf) if bounds is None else np.where(np.isnan(bounds), -np.inf, bounds)
    half = np.full(asked, first)
    far = np.array([0.0 if s == -np.inf else distance(q, s) for q, s in enumerate(least)])
    while (half < far).any():
        half = np.where(half < far, half * GROW, half)
    batch = max(1, min(BATCH, CELLS // n))
    for start in range(0, asked, batch):
        open_ = np.arange(start, min(start + batch, asked))
        seen = np.zeros((len(open_), bitmaps.shape[2]), np.uint64)
        while len(open_):
            low = np.stack([np.searchsorted(arrays[j], centres[j, open_] - half[open_], side="left") for j in range(LINES)]) // size
            high = -(-np.stack([np.searchsorted(arrays[j], centres[j, open_] + half[open_], side="right") for j in range(LINES)]) // size)
            at = open_ - start
            fresh = _collided(bitmaps, low, high) & ~seen[at]
            seen[at] |= fresh
            fresh = np.unpackbits(fresh.view(np.uint8), axis=1, count=n).view(np.bool_)
            # One product for all that any of these queries has to verify, if they have many rows in common.
            some = np.flatnonzero(fresh.any(axis=0))
            shared = 8 * np.count_nonzero(fresh) > len(some) * len(open_)
            if shared:
                products, fresh = queries[open_] @ rows[some].T, fresh[:, some]
            going = []
            for i, q in enumerate(open_):
                picked = np.flatnonzero(fresh[i])
                near = products[i, picked] if shared else rows[picked] @ queries[q]
                picked = some[picked] if shared else picked
                # A product that may round either way leaves out what cannot be among the best.
                reach = near >= least[q] - slack[q]
                picked, near = picked[reach], near[reach]
                own = ids[picked] == query_ids[q]
                if own.any():
                    picked, near = picked[~own], near[~own]
                if len(picked) > k:
                    picked = picked[near >= np.partition(near, -k)[-k] - slack[q]]
                if len(picked):
                    r = np.concatenate([best_rows[q], picked])
                    s = np.concatenate([best_scores[q], row_dots(rows[picked], queries[q])])
                    top = np.lexsort((ids[r], -s))[:k]
                    best_rows[q], best_scores[q] = r[top], s[top]
                    if len(top) == k:
                        least[q] = max(least[q], best_scores[q][-1])
                reached = distance(q, least[q]) if least[q] > -np.inf else np.inf
                whole = not low[:, i].any() and (high[:, i] == slabs).all()
                if reached > half[q] and not whole:
                    half[q] *= GROW
                    going.append(i)
            open_ = open_[going]
    found = [(np.full(len(best_rows[q]), q), best_rows[q], best_scores[q]) for q in range(asked)]
    return tuple(np.concatenate([f[c] for f in found]) for c in range(3))


def _task(k: int):
    def run(data: pa.Table, asked: pa.Table) -> pa.Table:
        if not data.num_rows or not asked.num_rows:
            return pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        width = len(data.column("vector")[0])
        ids, query_ids = (t.column("id").to_numpy() for t in (data, asked))
        bounds = asked.column("bound").to_numpy().astype(np.float64)  # null becomes NaN
        q, r, score = search(matrix(data.column("vector"), width), ids, matrix(asked.column("vector"), width), query_ids, k, bounds)
        return pa.table({"query_id": query_ids[q], "vec_id": ids[r], "score": score})

    return run


def nearest(
    rows: DataFrame, queries: DataFrame, k: int = K, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """The k rows with the largest inner product found for each query: ``query_id, rank, vec_id, score``.

    Nearest first, ties to the smaller id; the row with the query's own id is left out.
    Null ids, null or zero vectors and those with a null or non-finite component take no
    part on either side, and only vectors of equal length are compared. Rows repeated with
    id and vector count once; a query id that has several vectors is searched by the
    smallest. A query without other rows, and an empty table, give no rows.
    """
    def clean(df: DataFrame) -> DataFrame:
        vector = F.col(vector_col)
        return df.where(usable(vector) & F.col(id_col).isNotNull()).select(
            F.col(id_col).cast("long").alias("id"), vector.cast("array<double>").alias("vector"), F.size(vector).alias("width")
        )

    data = clean(rows).dropDuplicates(["id", "vector"])
    asked = clean(queries).groupBy("id").agg(F.min(F.struct("width", "vector")).alias("v")).select("id", "v.vector", "v.width")
    blocks = max(1, -(-rows.count() // BLOCK))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    dealt = lambda n: F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")
    data, asked = data.withColumn("block", dealt(blocks)), asked.withColumn("home", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(blocks)).cast("int"))
    if blocks > 1:
        keys = ["width", "block"]
        at_home = asked.withColumn("block", F.col("home")).withColumn("bound", F.lit(None).cast("double"))
        first = staged(data.groupBy(*keys).cogroup(at_home.groupBy(*keys)).applyInArrow(_task(k), RESULT), "neighbours")
        known = first.groupBy("query_id").agg(F.when(F.count(F.lit(1)) == k, F.min("score")).alias("bound"))
        asked = asked.join(known, F.col("id") == F.col("query_id"), "left").drop("query_id")
    else:
        first, asked = None, asked.withColumns({"home": F.lit(-1), "bound": F.lit(None).cast("double")})
    chunks = max(1, -(-queries.count() // CHUNK))
    data = data.withColumn("chunk", every(chunks))
    asked = asked.withColumn("chunk", dealt(chunks)).withColumn("block", every(blocks)).where(F.col("block") != F.col("home"))
    keys = ["width", "block", "chunk"]
    found = data.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(_task(k), RESULT)
    found = found if first is None else found.unionByName(first)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
