"""Connected components of an edge table by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def _roots(hook: DataFrame) -> DataFrame:
    """(node, to): hooks followed to their ends by pointer doubling, as many joins as the logarithm of
    the longest chain of hooks."""
    while True:
        ahead = hook.select(F.col("node").alias("to"), F.col("to").alias("further"))
        hook = hook.join(ahead, "to").select("node", F.col("further").alias("to"), (F.col("further") != F.col("to"))
                                             .alias("moved"))
        hook = materialize(hook, "components-hook")
        if hook.where("moved").isEmpty():
            return hook.select("node", "to")


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); component is the smallest node reached.

    Each round hooks every node to its smallest neighbour, or to itself if it
    is smaller (a partial minimum, so a hub costs one row per task), follows the hooks to their
    ends, and contracts: edges are renamed to those ends, and edges inside one end go.
    Every node with a smaller neighbour disappears in a round: where numbers are
    as good as random, as with hashes, that is about half of them or more. Every round's tables are written to
    the shared folder; nothing is collected but whether rows are left.
    Self loops and repeated edges are allowed; an empty table gives an empty one.
    """
    edges = edges.select("a", "b")
    labels = None
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hook = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"),
                                                                  F.least("a", "m").alias("to"))
        hook = _roots(materialize(hook, "components-hook"))
        if labels is None:
            labels = hook.select("node", F.col("to").alias("component"))
        else:
            step = hook.select(F.col("node").alias("component"), "to")
            labels = labels.join(step, "component", "left").select(
                "node", F.coalesce("to", "component").alias("component"))
            labels = materialize(labels, "components-labels")
        left = hook.select(F.col("node").alias("a"), F.col("to").alias("x"))
        right = hook.select(F.col("node").alias("b"), F.col("to").alias("y"))
        edges = (edges.join(left, "a").join(right, "b").where("x <> y")
                 .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
        edges = materialize(edges, "components-edges")
        if edges.isEmpty():
            return labels
