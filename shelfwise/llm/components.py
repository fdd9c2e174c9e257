"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.sources.scratch import materialise


def _large_star(edges: DataFrame) -> DataFrame:
    """Ties every larger neighbour of a node to the smallest node around it."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    least = least.select("a", F.least("a", "m").alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Ties a node and its smaller neighbours to the smallest of them; edges fall from a to b."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    own = least.select("a", F.col("m").alias("b"))
    rest = edges.join(least, "a").filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return own.unionByName(rest)


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of an edge; the component is its smallest node.

    Each round writes its edges, so lineage stays short and a lost executor costs one task. The
    edges end as one star per component, after a number of rounds logarithmic in the longest path.
    """
    fallen = edges.select(
        F.greatest(F.col(a), F.col(b)).alias("a"), F.least(F.col(a), F.col(b)).alias("b")
    ).filter("a != b")
    current = materialise(fallen.distinct(), "edges")
    state = None
    while True:
        key = F.bit_xor(F.xxhash64("a", "b"))
        now = tuple(current.agg(F.count("*"), key).first())
        if now == state:
            break
        state = now
        large = _large_star(current).distinct()
        current = materialise(_small_star(materialise(large, "large-star")).distinct(), "small-star")
    leaves = current.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return leaves.unionByName(roots)
