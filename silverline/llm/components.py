"""Connected components of links that stay distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def components(links: DataFrame) -> DataFrame:
    """``node``, ``root`` for every end of ``links`` (a, b); root is the least node reachable.

    Alternating large-star and small-star steps: each turns the links of a node to
    its least neighbour, so paths halve and no node's whole neighbourhood is
    gathered in one place. Each step's links are checkpointed to the shared folder;
    the loop ends when a pair of steps changes nothing.
    """
    edges = _distinct(links.select("a", "b"))
    edges = edges.checkpoint(eager=True)
    seen = None
    while True:
        stars = _star(_star(edges, large=True), large=False).checkpoint(eager=True)
        # Equal count and equal order-free sum of hashes: the links are the same.
        now = stars.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(a, b))")).first()
        edges = stars
        if now == seen:
            break
        seen = now
    ends = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return ends.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()


def _distinct(edges: DataFrame) -> DataFrame:
    """Links as (larger, smaller), once each."""
    return edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Large star: every larger neighbour of a node links to the node's least one.

    Small star: the node and every smaller neighbour do. The least neighbour comes
    from an aggregate with partial sums, not from a gathered list.
    """
    both = edges.select(F.col("a").alias("n"), F.col("b").alias("m"))
    if large:
        both = both.unionByName(edges.select(F.col("b").alias("n"), F.col("a").alias("m")))
    least = both.groupBy("n").agg(F.min("m").alias("least")).select(
        F.col("n").alias("k"), F.least("n", "least").alias("least")
    )
    joined = both.join(least, F.col("n") == F.col("k"))
    if large:
        out = joined.where("m > n").select(F.col("m").alias("a"), F.col("least").alias("b"))
    else:
        out = joined.select(F.col("m").alias("a"), F.col("least").alias("b")).unionByName(
            least.select(F.col("k").alias("a"), F.col("least").alias("b"))
        )
    return _distinct(out)
