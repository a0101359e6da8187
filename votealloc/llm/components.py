"""Connected components by repeated contraction of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from votealloc.llm.shared import discard, join_parted, materialise


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of edges (a, b): component is the smallest node reachable.

    Nodes may be of any type that has an order. Each round maps every node to its smallest
    neighbour (or itself) and rewrites both ends of the edges; edges inside a component vanish as
    they become loops, so later rounds work on ever fewer. Minima are pre-aggregated before the
    shuffle, nothing of a node's neighbourhood is gathered, the edges of a node that has very
    many are joined in parts, and only a count of the edges that are left reaches the driver.
    Null ends and loops are ignored (their nodes don't appear); no edges give no rows.
    """
    left = materialise(edges.select("a", "b").where("a <> b").distinct(), "cc-edges")
    labels = None
    while not left.isEmpty():
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy(F.col("a").alias("at")).agg(F.min("b").alias("to"), F.count("*").alias("n"))
        step = materialise(least.select("at", F.least("at", "to").alias("to"), "n"), "cc-step")
        ends = join_parted(left, step.withColumnsRenamed({"at": "a", "to": "x"}), ["a"], "b")
        ends = join_parted(ends, step.withColumnsRenamed({"at": "b", "to": "y"}), ["b"], "a")
        fewer = materialise(ends.where("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct(), "cc-edges")
        if labels is None:
            labels = step.select(F.col("at").alias("node"), F.col("to").alias("component"))
        else:
            held = labels.groupBy("component").agg(F.count("*").alias("n"))
            moves = materialise(held.join(step.select(F.col("at").alias("component"), "to"), "component"), "cc-moves")
            labels = materialise(join_parted(labels, moves, ["component"], "node", how="left").select("node", F.coalesce("to", "component").alias("component")), "cc-labels")
            discard(moves)
        discard(left)
        left = fewer
    if labels is None:
        return left.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return labels
