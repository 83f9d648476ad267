"""Connected parts of an edge table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import discard, materialize


def connected_components(edges: DataFrame) -> DataFrame:
    """``id, component`` for every node of an undirected edge table (src, dst); component = smallest id.

    Each round draws a new order of the nodes by a hash, points every node at the first of itself and its
    neighbours, follows that pointer twice and replaces the nodes of all edges by what they point at. Because the order is
    drawn anew, a chain loses a constant share of its nodes per round whatever its ids are, so the rounds grow
    with the logarithm of the longest path; there is no limit on them. Each round is written to shared storage: its
    lineage ends there, a lost executor repeats one round at most, and the round before it is deleted.
    """
    pairs = edges.select(F.col("src").alias("a"), F.col("dst").alias("b")).where("a <> b")
    live = materialize(pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = materialize(live.select(F.col("a").alias("id"), F.col("a").alias("label")).distinct(), "labels")
    turn = 0
    while not live.isEmpty():
        order = lambda c: F.struct(F.xxhash64(c, F.lit(turn)).alias("h"), F.col(c).alias("n"))  # noqa: B023, E731
        point = live.groupBy("a").agg(_first(F.min(order("b")), order("a")).alias("to"))
        up = point.select(F.col("a").alias("to"), F.col("to").alias("up"))
        jump = materialize(point.join(up, "to").select(F.col("a").alias("node"), F.col("up").alias("root")), "jump")
        moved = labels.join(jump, labels["label"] == jump["node"], "left")
        new_labels = materialize(moved.select("id", F.coalesce("root", "label").alias("label")), "labels")
        left = live.join(jump.select(F.col("node").alias("a"), F.col("root").alias("ra")), "a")
        both = left.join(jump.select(F.col("node").alias("b"), F.col("root").alias("rb")), "b")
        new_live = materialize(both.where("ra <> rb").select(F.col("ra").alias("a"), F.col("rb").alias("b")).distinct(), "edges")
        discard(live, labels, jump)
        live, labels, turn = new_live, new_labels, turn + 1
    smallest = labels.groupBy("label").agg(F.min("id").alias("component"))
    return labels.join(smallest, "label").select("id", "component")


def _first(best: Column, own: Column) -> Column:
    return F.least(best, own)["n"]
