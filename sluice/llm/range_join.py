"""Embedding near-duplicates by an exact metric range join.

On vectors of length one, cosine >= c is distance <= r with r^2 = 2 - 2 c. Per label,
pivots divide the vectors into cells (nearest pivot, ties to the first). Two linked vectors
whose cells are i < j meet in cell i: by the triangle inequality the vector of cell j is
at most 2 r farther from pivot i than from its own pivot, and only vectors within that
margin (narrowed by the distance to the bisecting plane, which is at least as strict) are
replicated. Cells are joined independently. Equal vectors are joined as one with a weight.

Pivots are a bounded sample that is sent to all tasks. A cell that is large all the same
is cut into chunks, and every pair of chunks is a task of its own: exact, and of bounded
memory. Tasks return how many vectors each vector is linked with and only as many links as
it takes to connect them, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.components import components
from sluice.llm.vectors import matrix, usable
from sluice.session import durable, plain_unions

COSINE = 0.98
# Vectors that a cell shall hold, and the bound of the pivots of all labels together.
CELL = 2048
PIVOTS = 4096
CHUNK = 2048
# Rounding of distances; replicating a little more changes nothing.
SLACK = 1e-9


def _units(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.sqrt((vectors * vectors).sum(axis=1))[:, None]


def _assign(pivots: dict[tuple, np.ndarray], radius: float):
    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            groups, widths = batch.column("grp").to_pylist(), batch.column("width").to_pylist()
            by_key: dict[tuple, list[int]] = {}
            for i, key in enumerate(zip(groups, widths)):
                by_key.setdefault(key, []).append(i)
            rows, cell, home = [], [], []
            for key, index in by_key.items():
                index = np.array(index)
                marks = pivots.get(key)
                if marks is None:
                    rows.append(index)
                    cell.append(np.zeros(len(index), np.int32))
                    home.append(np.ones(len(index), bool))
                    continue
                u = _units(matrix(batch.column("vector").take(pa.array(index)), key[1]))
                squared = np.maximum(2.0 - 2.0 * (u @ marks.T), 0.0)
                own = squared.argmin(axis=1)
                nearest = squared[np.arange(len(u)), own][:, None]
                apart = np.sqrt(np.maximum(2.0 - 2.0 * (marks @ marks.T), 0.0))[own]
                margin = (np.sqrt(squared) - np.sqrt(nearest) <= 2 * radius + SLACK)
                margin &= squared - nearest <= 2 * radius * apart + SLACK
                margin &= np.arange(len(marks))[None, :] < own[:, None]
                margin[np.arange(len(u)), own] = True
                r, c = np.nonzero(margin)
                rows.append(index[r])
                cell.append(c.astype(np.int32))
                home.append(c == own[r])
            if rows:
                taken = batch.take(pa.array(np.concatenate(rows)))
                yield pa.record_batch(
                    [*taken.columns, pa.array(np.concatenate(cell)), pa.array(np.concatenate(home))],
                    names=[*taken.schema.names, "cell", "home"],
                )

    return cells


def _compare(cosine: float):
    def links(table: pa.Table) -> pa.Table:
        width = table.column("width")[0].as_py()
        ids, weight = table.column("id").to_numpy(), table.column("weight").to_numpy()
        vectors = matrix(table.column("vector"), width)
        home = table.column("home").to_numpy(zero_copy_only=False)
        side, own = (table.column(c).to_numpy(zero_copy_only=False) for c in ("side", "own"))
        norms = np.sqrt((vectors * vectors).sum(axis=1))
        linked = (vectors @ vectors.T) / (norms[:, None] * norms[None, :]) >= cosine
        # Two replicas meet in a cell of their own; rows of one side meet in the side's own task.
        linked &= home[:, None] | home[None, :]
        linked &= (side[:, None] != side[None, :]) | own[:, None]
        np.fill_diagonal(linked, False)
        counts = linked.astype(np.float64) @ weight
        some = np.flatnonzero(counts)
        a, b, open_ = [], [], np.ones(len(ids), bool)
        for first in some:
            if not open_[first]:
                continue
            open_[first] = False
            front = [first]
            while front:
                i = front.pop()
                new = np.flatnonzero(linked[i] & open_)
                open_[new] = False
                a += [ids[i]] * len(new)
                b += ids[new].tolist()
                front += new.tolist()
        return pa.table({
            "a": pa.array([*ids[some].tolist(), *a], pa.int64()),
            "b": pa.array([*[None] * len(some), *b], pa.int64()),
            "n": pa.array([*counts[some].astype(np.int64).tolist(), *[None] * len(a)], pa.int64()),
        })

    return links


def _pivots(distinct: DataFrame) -> dict[tuple, np.ndarray]:
    """At most about ``PIVOTS`` vectors with the smallest hashes, per label in proportion to its vectors."""
    large = distinct.groupBy("grp", "width").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > CELL)
    total = large.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    if not total:
        return {}
    share = min(1.0 / CELL, PIVOTS / total)
    limit = F.lit(-(2.0**63)) + F.lit(share) * F.lit(2.0**64)
    # Labels without cells of their own are left out before anything is drawn.
    drawn = distinct.join(large.select("grp", "width"), ["grp", "width"], "left_semi").where(F.xxhash64("vector") <= limit)
    out: dict[tuple, list] = {}
    for r in drawn.select("grp", "width", "vector").collect():
        out.setdefault((r["grp"], r["width"]), []).append(r["vector"])
    return {k: _units(np.array(sorted(v), np.float64)) for k, v in out.items() if len(v) > 1}


def near_duplicates(
    rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", cosine: float = COSINE
) -> DataFrame:
    """One row per vector: id, ``n_links``, ``component_id``, ``kept`` (whether it is its component's smallest id).

    Vectors link when their labels are equal and not null and their cosine reaches
    ``cosine``. Null and zero vectors, those with a null or non-finite component, and rows
    without an id link with nothing: no links, and their own component (null without id).
    Vectors of different length never link. Repeated rows are vectors of their own that
    link with each other. An empty table gives no rows.
    """
    plain_unions(rows.sparkSession)
    vector = F.col(vector_col)
    named = rows.select(
        F.col(id_col).alias("id"), F.col(label_col).alias("grp"), vector.cast("array<double>").alias("vector"),
        F.size(vector).alias("width"), (usable(vector) & F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).alias("ok"),
    )
    named = durable(named)
    able = named.where("ok")
    distinct = durable(able.groupBy("grp", "width", "vector").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("weight")))
    radius = float(np.sqrt(2.0 - 2.0 * cosine))
    kinds = dict(distinct.dtypes)
    schema = ", ".join(f"{c} {kinds[c]}" for c in distinct.columns) + ", cell int, home boolean"
    placed = durable(distinct.mapInArrow(_assign(_pivots(distinct), radius), schema))

    sized = placed.groupBy("grp", "width", "cell").agg(F.ceil(F.count(F.lit(1)) / CHUNK).cast("int").alias("chunks"))
    dealt = placed.join(sized, ["grp", "width", "cell"]).withColumn("chunk", F.pmod(F.xxhash64("id"), "chunks").cast("int"))
    tasks = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).select(
        "grp", "width", "cell", "id", "vector", "weight", "home",
        F.least("chunk", "other").alias("x"), F.greatest("chunk", "other").alias("y"),
        (F.col("chunk") <= F.col("other")).alias("side"), (F.col("chunk") == F.col("other")).alias("own"),
    )
    found = durable(
        tasks.groupBy("grp", "width", "cell", "x", "y").applyInArrow(_compare(cosine), "a long, b long, n long")
    )
    linked = components(found.where("b is not null").select("a", "b"))
    counts = found.where("b is null").groupBy(F.col("a").alias("id")).agg(F.sum("n").alias("others"))
    classes = distinct.join(linked, F.col("id") == F.col("node"), "left").join(counts, "id", "left").select(
        F.col("grp").alias("_grp"), F.col("vector").alias("_vector"),
        F.coalesce("component", "id").alias("class"), (F.col("weight") - 1 + F.coalesce("others", F.lit(0))).alias("links"),
    )
    both = named.join(classes, F.col("ok") & (F.col("grp") == F.col("_grp")) & (F.col("vector") == F.col("_vector")), "left")
    component = F.coalesce("class", "id")
    return both.select(
        F.col("id").alias(id_col), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"), (F.col("id") == component).alias("kept"),
    )
