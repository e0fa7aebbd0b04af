"""Ranked lexical search over a length-stratified index.

A document's score depends on its length only by its normaliser m. Documents of equal m are a
stratum; in it a posting's impact is settled by its term frequency, so it is computed once per tf.

1. One pass over the texts counts each document's terms and keeps the postings of the terms that
   the queries hold: the index, written to the shared folder. N, L and df are sums over it.
2. The index is laid out by m. A task holds a run of strata; for each it knows, per query, a bound:
   the weights times the impact of the largest tf that each term has in the stratum. The strata are
   visited by falling bound, each for those queries whose bound reaches their k-th best score so far.
3. The best of all tasks are merged.

Queries go in blocks of bounded size. Scores are whole numbers; they are added up in doubles where
all sums stay below 2^53, and in 64-bit integers otherwise.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.workers import give_back
from sluice.session import discard, durable, scratch_path, small_batches

BEST = 10
# Queries of a block, and its rows (query, term), both expected: queries are dealt to blocks by hash.
QUERIES, QUERY_TERMS = 256, 1 << 14
# Documents of a stratum that are scored in one product, and documents whose strata are ordered together.
SLICE, WAVE = 512, 8192
# Bytes of a text whose terms are counted at a time.
PIECE = 1 << 20

TERM = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
BREAK = re.compile(rb"[^0-9A-Za-z\x80-\xff]")
LOWER = bytes(range(256)).replace(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def term_counts(text: str | None) -> Counter:
    """Occurrences of the terms of a whole text, lower-cased in A-Z."""
    data, at, out = (text or "").encode().translate(LOWER), 0, Counter()
    while at < len(data):
        end = BREAK.search(data, at + PIECE)
        stop = end.start() if end else len(data)
        out.update(TERM.findall(data[at:stop]))
        at = stop
    return out


def _postings(numbers: dict[bytes, int]):
    """Per document: its number of terms, and number and tf of those of its terms that have a number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() * 0x9E3779B1
        for batch in batches:
            lengths, ends, terms, tfs = [], [0], [], []
            for text in batch.column(1):
                counts = term_counts(text.as_py())
                lengths.append(counts.total())
                for term in numbers.keys() & counts.keys():
                    terms.append(numbers[term])
                    tfs.append(counts[term])
                ends.append(len(terms))
            row += batch.num_rows
            ends = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(np.arange(row - batch.num_rows, row, dtype=np.int64)), pa.array(lengths, pa.int64()),
                pa.ListArray.from_arrays(ends, pa.array(terms, pa.int32())), pa.ListArray.from_arrays(ends, pa.array(tfs, pa.int64())),
            ], ["doc", "row", "n", "terms", "tfs"])
        give_back()

    return run


class Search:
    """The best documents per query among the strata seen so far."""

    def __init__(self, weights: np.ndarray, best: int):
        """``weights`` has a row per term and a column per query."""
        exact = weights.sum(axis=0).max(initial=0) * 1e6 < 2**53
        self.weights, self.best = weights.astype(np.float64 if exact else np.int64), best
        self.least = np.ones(weights.shape[1], self.weights.dtype)
        self.query, self.doc, self.score = (np.zeros(0, np.int64) for _ in range(3))

    def visit(self, strata: list[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]) -> None:
        """``(m, rank of each document, and per posting: document, term, tf)`` for each stratum; ranks follow the ids."""
        held = []
        for m, docs, at, terms, tfs in strata:
            # The impact of each tf, once.
            several, which = np.unique(tfs, return_inverse=True)
            impact = ((1_000_000_000 * several) // (1000 * several + 8 * m)).astype(self.weights.dtype)
            columns, place = np.unique(terms, return_inverse=True)
            most = np.zeros(len(columns), self.weights.dtype)
            np.maximum.at(most, place, impact[which])
            held.append((most @ self.weights[columns], docs, at, columns, place, impact[which]))
        for bound, docs, at, columns, place, impact in sorted(held, key=lambda s: -s[0].max(initial=0)):
            queries = np.nonzero(bound >= self.least)[0]
            if len(queries):
                rows = np.zeros((len(docs), len(columns)), self.weights.dtype)
                rows[at, place] = impact
                self._merge(queries, docs, rows @ self.weights[np.ix_(columns, queries)])

    def _merge(self, queries: np.ndarray, docs: np.ndarray, scores: np.ndarray) -> None:
        row, column = np.nonzero(scores >= self.least[queries])
        if not len(row):
            return
        query = np.concatenate([self.query, queries[column]])
        doc = np.concatenate([self.doc, docs[row]])
        score = np.concatenate([self.score, scores[row, column].astype(np.int64)])
        order = np.lexsort((doc, -score, query))
        query, doc, score = query[order], doc[order], score[order]
        first = np.searchsorted(query, query)
        rank = np.arange(len(query)) - first
        self.query, self.doc, self.score = query[rank < self.best], doc[rank < self.best], score[rank < self.best]
        full = rank == self.best - 1
        self.least[query[full]] = score[full]


def _searched(weights: np.ndarray, best: int):
    """For index rows ``(doc, m, terms, tfs)`` in the order of m: the best documents per query of the task."""

    def strata(batch: pa.RecordBatch, ranks: np.ndarray) -> list:
        m = batch.column(1).to_numpy()
        lists = batch.column(2)
        ends = lists.offsets.to_numpy().astype(np.int64)
        ends -= ends[0]
        terms, tfs = lists.flatten().to_numpy(), batch.column(3).flatten().to_numpy()
        cuts = np.nonzero(np.diff(m))[0] + 1
        out = []
        for low, high in zip([0, *cuts], [*cuts, len(m)]):
            # A large stratum is scored in slices.
            for a in range(low, high, SLICE):
                b = min(a + SLICE, high)
                at = np.repeat(np.arange(b - a), np.diff(ends[a : b + 1]))
                out.append((int(m[a]), ranks[a:b], at, terms[ends[a] : ends[b]], tfs[ends[a] : ends[b]]))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search, waiting, ids = Search(weights, best), [], None

        def wave() -> None:
            nonlocal ids
            batch = pa.Table.from_batches(waiting).combine_chunks().to_batches()[0]
            # Ids of the best so far and of the wave, in one order, so that ranks break ties.
            new = batch.column(0)
            all_ids = new if ids is None else pa.concat_arrays([ids, new])
            order = pc.sort_indices(all_ids, null_placement="at_end").to_numpy()
            ranks = np.empty(len(order), np.int64)
            ranks[order] = np.arange(len(order))
            old = 0 if ids is None else len(ids)
            search.doc = ranks[:old]
            search.visit(strata(batch, ranks[old:]))
            ids = all_ids.take(pa.array(order[search.doc]))
            search.doc = np.arange(len(search.doc))
            waiting.clear()

        for batch in batches:
            if batch.num_rows:
                waiting.append(batch)
            if sum(b.num_rows for b in waiting) >= WAVE:
                wave()
        if waiting:
            wave()
        if ids is not None:
            yield pa.RecordBatch.from_arrays([pa.array(search.query.astype(np.int32)), ids, pa.array(search.score)], ["query", "doc_id", "score"])
        give_back()

    return run


def _block(index_of: DataFrame, queries: list, id_type: str, best: int) -> DataFrame:
    """The best documents for ``(item_id, terms)`` rows; ``index_of`` has id and text."""
    spark = index_of.sparkSession
    numbers = {t: i for i, t in enumerate(sorted({bytes(t) for q in queries for t in q["terms"]}))}
    path = scratch_path(spark, "index")
    kind = index_of.dtypes[0][1]
    index_of.mapInArrow(_postings(numbers), f"doc {kind}, row long, n long, terms array<int>, tfs array<long>").write.parquet(path)
    index = spark.read.parquet(path)
    filled, words = index.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(len(numbers), np.int64)
    for r in index.select(F.explode("terms").alias("t")).groupBy("t").count().collect():
        df[r["t"]] = r["count"]
    weight = [math.floor(1000 * math.log((2 * filled + 2) / (2 * int(d) + 1))) for d in df]
    weights = np.zeros((len(numbers), len(queries)), np.int64)
    for i, q in enumerate(queries):
        for t in q["terms"]:
            weights[numbers[bytes(t)], i] = weight[numbers[bytes(t)]]

    m = F.expr(f"100 - 90 + (90 * n * {filled}L) div {max(1, words)}L")
    laid = index.where(F.size("terms") > 0).withColumn("m", m).repartitionByRange("m", "row").sortWithinPartitions("m", "row")
    found = laid.select("doc", "m", "terms", "tfs").mapInArrow(_searched(weights, best), f"query int, doc_id {kind}, score long")
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)
    names = spark.createDataFrame([(i, q["item_id"]) for i, q in enumerate(queries)], f"query int, item_id {id_type}")
    out = durable(ranked.join(names, "query").select("item_id", "rank", "doc_id", "score"))
    discard(spark, path)
    return out


def ranked_search(
    docs: DataFrame, queries: DataFrame, best: int = BEST,
    id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """The ``best`` documents for each query: ``item_id``, ``rank`` from 1, ``doc_id``, ``score``, by falling score, ties by id.

    Every row of ``docs`` is a document, repeated rows and rows without an id included (null ids come last
    among equals). Rows of ``queries`` with one ``item_id``, null included, are one query with the terms of
    all of them. Null and empty texts have no terms; such documents count neither in N nor in a result, and
    such queries have no rows. Documents with a score of 0 are no results. Empty tables give no rows. Other
    columns of either table take no part, whatever their names.

    A block of queries (``QUERIES`` and ``QUERY_TERMS`` expected) passes through the driver with the document
    frequencies of its terms; each block reads the texts once.
    """
    spark = docs.sparkSession
    small_batches(spark)
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    asked = queries.select(F.col(f"`{item_col}`").alias("item_id"), F.col(f"`{item_text_col}`").alias("text"))
    id_type = asked.dtypes[0][1]

    @F.pandas_udf("array<binary>")
    def distinct_terms(texts: pd.Series) -> pd.Series:
        return pd.Series([sorted(term_counts(t)) for t in texts], dtype=object)

    listed = durable(asked.select("item_id", F.explode(distinct_terms("text")).alias("term")).distinct())
    sizes = listed.groupBy("item_id").agg(F.count(F.lit(1)).alias("n")).agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    blocks = max(1, -(-sizes[0] // QUERIES), -(-sizes[1] // QUERY_TERMS))
    out = spark.createDataFrame([], f"item_id {id_type}, rank int, doc_id {texts.dtypes[0][1]}, score long")
    for block in range(blocks):
        mine = listed.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block)
        rows = mine.groupBy("item_id").agg(F.collect_list("term").alias("terms")).collect()
        if rows:
            out = out.unionByName(_block(texts, rows, id_type, best))
    return out
