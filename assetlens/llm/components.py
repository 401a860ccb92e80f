"""Connected components of a large edge list, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage


def _state(edges: DataFrame) -> tuple[int, int]:
    n, s = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
    return int(n), int(s or 0)


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): root is the smallest node that can be reached; nodes without an edge to another are left out.

    Minima are aggregates (reduced before the shuffle) joined back, so a node with very many
    edges is never gathered in one task. Every step is written to the shared checkpoint folder.
    """
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    e = cut_lineage(e, edges.sparkSession)
    state = _state(e)
    while state[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m"))
        low = low.select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        e = cut_lineage(small, edges.sparkSession)
        old, state = state, _state(e)
        if state == old:
            break
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
