"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import staged


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b), both long; the component is its smallest node.

    Alternating large and small stars: every round hangs neighbours onto the smallest one they know, so chains halve
    and a node with very many edges costs an aggregate with partial sums and a join that adaptive execution can split.
    Loops and repeated edges are allowed; rows with a NULL end are left out. No edges give an empty table.
    """
    now = edges.select("a", "b").dropna().select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    loops = now.where("a = b").select(F.col("a").alias("node"), F.col("b").alias("component"))
    now = staged(now.where("a <> b").distinct(), "edges")
    before, here = None, _digest(now)
    while here != before:
        now = staged(_small_star(_large_star(now)), "edges")
        before, here = here, _digest(now)
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component"))
    stars = now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots).union(loops)
    return stars.groupBy("node").agg(F.min("component").alias("component"))


def _digest(edges: DataFrame) -> tuple:
    """Count, exclusive or and sum of the edges' hashes; the sum is a decimal, as a long's end is near for many edges."""
    mark = F.xxhash64("a", "b")
    return tuple(edges.agg(F.count("*"), F.bit_xor(mark), F.sum(mark.cast("decimal(19,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of each node go to its smallest neighbour."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Smaller neighbours of each node, and the node, go to the smallest of them. ``edges`` has a > b."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    near = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return near.union(least.select("a", F.col("m").alias("b"))).distinct()
