"""Connected components of a link table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One contraction.  Large: neighbours above a node move to its smallest
    neighbour.  Small: a node and its smaller neighbours move to the smallest.
    The minimum is a partial aggregate and the way back a join that AQE can
    split, so that a node with very many links is neither collected nor bound to
    one task."""
    if large:
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    # Dealt out anew, so that the join has shuffles of its own, whose skewed partitions AQE splits.
    met = both.join(low.hint("rebalance"), "a")
    if large:
        out = met.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = met.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            low.select("a", F.col("m").alias("b")))
    return out.where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``(a, b)`` links -> ``(node, root)``: the smallest node of its component,
    for every node that has a link.  Nulls and self-links are ignored.

    Each round is checkpointed in the shared folder; the rounds grow with the
    logarithm of the longest chain.  An empty table gives an empty result.
    """
    now = cut_lineage(edges.select(F.col("a").cast("long"), F.col("b").cast("long"))
                      .where("a is not null and b is not null and a <> b").distinct())
    seen = None
    while True:
        state = now.select(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen or not state[0]:
            break
        seen = state
        now = cut_lineage(_star(_star(now, True), False))
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
