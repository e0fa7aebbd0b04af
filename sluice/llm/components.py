"""Connected components of a distributed list of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.session import durable, plain_unions


# From so many edges on, smallest neighbours are written down before they are joined. The join has two plain
# inputs then, and adaptive execution deals the edges of a node that has very many to several tasks.
MANY_EDGES = 1 << 20


def _lowest(edges: DataFrame, count: int) -> DataFrame:
    """``(a, m)``: the smallest neighbour of each node."""
    low = edges.groupBy("a").agg(F.min("b").alias("m"))
    return durable(low) if count >= MANY_EDGES else low


def _large_star(edges: DataFrame, count: int) -> DataFrame:
    """Every larger neighbour of a node is tied to the node's smallest neighbour."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = _lowest(both, count).select("a", F.least("m", "a").alias("m"))
    return both.join(low, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame, count: int) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are tied to its smallest neighbour."""
    low = _lowest(edges, count)
    tied = edges.join(low, "a").where(F.col("b") > F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return tied.union(low.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node that is not the smallest of its component.

    ``edges`` has two columns of one orderable type. A node that is missing from the
    result is its own component. Rows with a null end, loops and repeats are ignored.
    Alternating large and small stars: the number of rounds grows with the logarithm
    of the longest path, no neighbourhood is collected, and each round is cut from its
    lineage by a checkpoint in the shared folder.
    """
    a, b = edges.columns
    plain_unions(edges.sparkSession)
    e = edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct()
    e, mark = durable(e), None
    while True:
        now = e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == mark or now[0] == 0:
            return e.select(F.col("a").alias("node"), F.col("b").alias("component"))
        mark, e = now, durable(_small_star(_large_star(e, now[0]), now[0]))
