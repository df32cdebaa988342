"""Connected components of an edge table, by joins: nodes hook to neighbours, edges contract."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowloom.llm.common import staged


def _distinct_edges(edges: DataFrame) -> DataFrame:
    ends = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return staged(ends.where("a <> b").distinct(), "edges")


def components(edges: DataFrame) -> DataFrame:
    """node and component (its least node) of every node with an edge; columns a and b of long.

    In each round a node hooks to its least neighbour if that is smaller, hooks are followed
    twice, and edges are drawn anew between what they lead to; a star is done in one round,
    and every round leaves fewer edges. Rounds end when none is left.
    """
    edges = _distinct_edges(edges)
    labels = None
    while labels is None or edges.limit(1).count():
        both = edges.select("a", "b").union(edges.select("b", "a"))
        hooks = staged(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("up")), "hooks")
        over = hooks.select(F.col("a").alias("up"), F.col("up").alias("top"))
        hooks = staged(hooks.join(over, "up").select(F.col("a").alias("node"), "top"), "hooks")
        if labels is None:
            labels = hooks.select("node", F.col("top").alias("component"))
        else:
            moved = hooks.select(F.col("node").alias("component"), "top")
            labels = labels.join(moved, "component", "left").select("node", F.coalesce("top", "component").alias("component"))
            labels = staged(labels, "labels")
        left = hooks.select(F.col("node").alias("a"), F.col("top").alias("one"))
        right = hooks.select(F.col("node").alias("b"), F.col("top").alias("two"))
        edges = _distinct_edges(
            edges.join(left, "a").join(right, "b").select(F.col("one").alias("a"), F.col("two").alias("b"))
        )
    return labels
