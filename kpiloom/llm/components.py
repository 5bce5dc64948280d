"""Connected components of a links table, by rounds of joins; nothing of it reaches the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.llm.common import checkpointed


def _large_star(edges: DataFrame) -> DataFrame:
    """Links every larger neighbour of a node to the node's smallest neighbour, itself included."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy(F.col("a").alias("of")).agg(F.min("b").alias("low"))
    least = least.select("of", F.least("of", "low").alias("low"))
    larger = both.filter(F.col("b") > F.col("a"))
    return larger.join(least, F.col("a") == F.col("of")).select(F.col("low").alias("a"), "b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Links the smaller neighbours of a node, and the node, to the smallest of them. Edges have a < b."""
    least = edges.groupBy(F.col("b").alias("of")).agg(F.min("a").alias("low"))
    joined = edges.join(least, F.col("b") == F.col("of"))
    moved = joined.filter(F.col("a") > F.col("low")).select(F.col("low").alias("a"), F.col("a").alias("b"))
    own = least.select(F.col("low").alias("a"), F.col("of").alias("b"))
    return moved.unionByName(own).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node that has an edge; root is the smallest node of its component.

    `edges` has the columns a and b, of type long. Stars are contracted in turn until
    nothing changes, which takes about the logarithm of a component's width; the state
    is checkpointed every round.
    """
    known = checkpointed(
        edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    )
    state = None
    while True:
        known = checkpointed(_small_star(_large_star(known)))
        now = known.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    roots = known.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct()
    return checkpointed(known.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(roots))
