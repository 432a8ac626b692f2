"""Connected components of an edge table, by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvid.llm.common import discard, staged


def _linked_to_least(pairs: DataFrame) -> DataFrame:
    """``pairs`` (node, other) with the least of each node and its others.
    The least is a partially aggregated minimum joined back, so a node with a
    third of all edges is one row of the small side."""
    least = pairs.groupBy("node").agg(F.min(F.least("node", "other")).alias("low"))
    return pairs.join(least, "node")


def components(edges: DataFrame) -> DataFrame:
    """Edges ``a, b`` (64-bit ids) -> ``node, component`` (the least id
    reachable) for every node that has an edge to another node.

    Each round links a node's larger neighbours, then all its smaller ones, to
    the least; rounds grow with the logarithm of the number of nodes. Every
    round is written to the shared folder; only two numbers reach the driver.
    """
    live = staged(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("other")).distinct(),
        "edges",
    )
    before = None
    while True:
        both = live.unionByName(live.select(F.col("other").alias("node"), F.col("node").alias("other")))
        large = (
            _linked_to_least(both)
            .filter("other > node")
            .select(F.col("other").alias("node"), F.col("low").alias("other"))
            .filter("node <> other")
            .distinct()
        )
        low = _linked_to_least(large)
        small = (
            low.select(F.col("other").alias("node"), F.col("low").alias("other"))
            .unionByName(low.select("node", F.col("low").alias("other")))
            .filter("node <> other")
            .distinct()
        )
        live, old = staged(small, "edges"), live
        discard(old)
        now = live.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("node", "other")).alias("x")).first()
        if now == before:
            break
        before = now
    return live.groupBy("node").agg(F.min("other").alias("component"))
