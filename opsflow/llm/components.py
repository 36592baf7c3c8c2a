"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from opsflow.session import settle


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step over ``a > b`` pairs: neighbours move to the least one they share.

    The least neighbour comes from a map-side combined aggregation and is joined
    back, so no neighbourhood is ever gathered.
    """
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"))
    joined = both.join(least, "a")
    moved = joined.where("b > a") if large else joined
    out = moved.select(F.col("b").alias("a"), F.col("least").alias("b"))
    if not large:
        out = out.unionByName(least.select("a", F.col("least").alias("b")))
    return out.where("a > b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``edges`` (two columns of one type, not null).

    ``component`` is the least node reachable. Loops and repeated edges do no harm.
    Every round is written to the shared folder; the number of rounds grows with the
    logarithm of the nodes. Nodes without an edge to another are not in the result.
    """
    a, b = edges.columns
    now = settle(
        edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct(), "edges"
    )
    before = None
    while True:
        now = settle(_star(_star(now, large=True), large=False), "edges")
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    nodes = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
