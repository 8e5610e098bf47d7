"""Connected components of an edge table, as joins and aggregates that end in a table per round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.common import stored


def _print(edges: DataFrame) -> tuple:
    """Size and order-independent hash of an edge table: equal when a round changed nothing."""
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.crc32(F.concat_ws(",", "u", "v")))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node that has an edge (columns a and b); the root is the component's least node.

    Alternates two steps until nothing changes: larger neighbours move to a node's least neighbour, then the
    smaller ones do. A hub with very many neighbours is one key of a join whose large side Spark can split;
    its least neighbour is an aggregate. Self loops and repeated edges do not matter.
    """
    edges = stored(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        "components",
    )
    seen = _print(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(low, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(low.select("u", F.col("m").alias("v")))
        )
        edges = stored(small.where("u <> v").distinct(), "components")
        now = _print(edges)
        if now == seen:
            break
        seen = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
