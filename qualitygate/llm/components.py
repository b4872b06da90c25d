"""Connected components by alternating stars: every step is a shuffle join, nothing is gathered."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qualitygate.llm.common import spool


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _with_least(edges: DataFrame) -> DataFrame:
    """Edges with the least neighbour of ``u``, written first so that a node with many edges can be split in the join."""
    least = spool(edges.groupBy("u").agg(F.min("v").alias("m")), "least")
    return edges.join(least, "u")


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of all nodes in ``edges`` (u, v); a component is named after its least node.

    Self loops and repeated edges do no harm; no edges give no rows.
    """
    now = spool(edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    state = _state(now)
    while state[0]:
        both = now.union(now.select("v", "u"))
        large = _with_least(both).select(F.col("v").alias("u"), F.least("u", "m").alias("v"), F.col("u").alias("old"))
        large = spool(large.where("u > old and u != v").select("u", "v").distinct(), "edges")
        near = _with_least(large)
        small = near.select(F.col("v").alias("u"), F.col("m").alias("v")).union(near.select("u", F.col("m").alias("v")))
        now = spool(small.where("u != v").distinct(), "edges")
        before, state = state, _state(now)
        if before == state:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(now.select("v", "v").distinct())
