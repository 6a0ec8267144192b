"""Connected components of a graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covtab.llm.common import cut_lineage


def _with_least(pairs: DataFrame) -> DataFrame:
    """Each (node, other) with the least of the node's others."""
    least = pairs.groupBy("node").agg(F.min("other").alias("least"))
    return pairs.join(least, "node")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    found = _with_least(both.select(F.col("a").alias("node"), F.col("b").alias("other")))
    return found.where("other > node").select(F.col("other").alias("a"), F.least("node", "least").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    found = _with_least(edges.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("other")))
    hang = found.where("other <> least").select(F.col("other").alias("a"), F.col("least").alias("b"))
    return hang.union(found.select(F.col("node").alias("a"), F.col("least").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """``(a, b)`` edges to ``(node, root)``: the least node that each node of
    an edge can reach, for nodes other than the root itself.

    Alternating star contraction: every round hangs nodes under smaller
    neighbours; it ends when all edges lead to a root. The minima are combined
    before each shuffle, and each round is written to the shared folder.
    """
    edges = cut_lineage(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    while True:
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("a", "b") % 1_000_003)).first()
        if now == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = now
        edges = cut_lineage(_small_star(_large_star(edges).distinct()).distinct())
