"""Connected components of a large edge table: alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.store import staged


def _star(edges: DataFrame, keep_larger: bool) -> DataFrame:
    """One round: every node links its neighbours to the least node among them and itself."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if keep_larger:
        both = both.union(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    # The least neighbour comes from a map-side aggregate and joins back: a node of very
    # many neighbours is never gathered in one group.
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    linked = both.join(least, "u")
    if keep_larger:
        out = linked.filter(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        out = (linked.select(F.col("v").alias("a"), F.col("m").alias("b"))
               .union(least.select(F.col("u").alias("a"), F.col("m").alias("b"))))
    return out.filter("a != b").distinct()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); component is its least node.

    Each round is written to the shared folder. It ends when no edge changes, which takes
    a number of rounds in the order of the logarithm of the longest chain.
    """
    edges = staged(edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                   .distinct(), "edges")
    before = None
    for _ in range(max_rounds):
        edges = staged(_star(_star(edges, True), False), "edges")
        state = tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())
        if state == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")) \
                .union(edges.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
        before = state
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
