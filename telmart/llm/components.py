"""Connected components of a large graph by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telmart.llm.common import stored


def _towards_smallest(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the node's smallest neighbour."""
    both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    return (
        both.where("v > u")
        .join(least, "u")
        .select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
        .distinct()
    )


def _among_smaller(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    others = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return others.unionAll(least.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node with an edge to another node; root is the smallest node.

    ``edges`` has two integer columns u and v. Each round costs a few shuffles of at most
    the edges; rounds grow with the logarithm of the longest path. Sums and minima are
    pre-aggregated, and joins on a hub's key can be split by adaptive execution. Loops and
    rows with a null end are ignored.
    """
    current = stored(
        edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
        "edges",
    )
    seen = None
    while True:
        state = current.agg(
            F.count(F.lit(1)).alias("n"), F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0)).alias("x")
        ).first()
        if not state["n"] or state == seen:
            roots = current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            return current.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(roots)
        seen = state
        current = stored(_among_smaller(_towards_smallest(current)), "edges")
