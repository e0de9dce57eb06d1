"""Connected components of an undirected graph given as edge rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from nodecast.session import materialize

EDGES_PER_PARTITION = 500_000
"""Partitions are sized by counted edges, so a small graph needs no shuffle."""


def _sized(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """The written edges in partitions of fair size, and a summary of the set."""
    n, total = edges.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(a, b))")).first()
    return edges.coalesce(max(1, -(-n // EDGES_PER_PARTITION))), (n, total)


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node hands its least neighbour to the neighbours above itself."""
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    joined = both.join(least, "a").where("b > a")
    return joined.select(F.col("b").alias("a"), F.least("m", "a").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node hands its least lower neighbour to itself and the other lower
    ones.  Rows have a > b."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    joined = edges.join(least, "a")
    handed = joined.where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return handed.unionAll(least.select("a", F.col("m").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """``node, component``: the least node reachable, for each node of ``edges``.

    ``edges`` has two columns of one orderable type; direction, repeats, loops
    and rows with a null do not matter.  Nodes without an edge are not listed.
    Large-star and small-star rounds (their number grows with the logarithm of
    the graph) are each written to the shared folder, so that a round never
    recomputes the one before; all sets stay distributed.
    """
    a, b = edges.columns
    clean = (
        edges.toDF("a", "b")
        .where("a != b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    current, seen = _sized(materialize(clean, "edges"))
    while True:
        stepped = _small_star(_large_star(current)).distinct()
        current, now = _sized(materialize(stepped, "edges"))
        if now == seen:
            break
        seen = now
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(roots)
