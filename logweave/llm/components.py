"""Connected components of a graph given as edges, by contraction with Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweave.llm.tables import checkpointed


def _roots(hooks: DataFrame) -> DataFrame:
    """Follow (node, to) until every `to` is its own root; every `to` is a node itself."""
    while True:
        above = hooks.select(F.col("node").alias("to"), F.col("to").alias("next"))
        beyond = hooks.select(F.col("node").alias("next"), F.col("to").alias("last"))
        jumped = checkpointed(hooks.join(above, "to").join(beyond, "next").select("node", "next", "last"))
        if jumped.where("next <> last").isEmpty():
            return jumped.select("node", F.col("next").alias("to"))
        hooks = jumped.select("node", F.col("last").alias("to"))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the edges (a, b); a component is its least node.

    In each round every node hooks to its least neighbour if that is smaller, hooks are
    followed to their roots and the edges are drawn between roots; at least half of the
    nodes that still have edges vanish, so the rounds grow with the logarithm of the graph.
    """
    left = checkpointed(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    labels = None
    while not left.isEmpty():
        both = left.unionAll(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("to")).select("node", F.least("node", "to").alias("to"))
        roots = _roots(hooks)
        if labels is None:
            labels = roots.withColumnRenamed("to", "component")
        else:
            moved = roots.select(F.col("node").alias("component"), "to")
            labels = checkpointed(labels.join(moved, "component", "left").select("node", F.coalesce("to", "component").alias("component")))
        for side in ("a", "b"):
            left = left.join(roots.withColumnRenamed("node", side), side).drop(side).withColumnRenamed("to", side)
        left = checkpointed(left.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("a").alias("component")).limit(0)
    return labels
