"""Connected components by alternating large-star and small-star rounds.

Every round is two aggregations and two joins over the edge table; no group of neighbours is ever collected.  The
small star works on the partitioning by its nodes that the large star leaves.  The rounds needed grow with the logarithm
of a component's diameter.  Edges are written to the shared folder each round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from kvflow.llm.common import discard, materialise

MAX_ROUNDS = 60


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    far = both.where("b > a").join(least, "a")
    # A far node has few edges, however many its hub has: dealt by it once for all that follows.
    return far.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").repartition("a").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """edges point from the larger node a to the smaller b."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return least.select("a", F.col("m").alias("b")).union(moved).distinct()


def _written(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """(edges, written; their number and a sum of their hashes, taken on the way)."""
    seen = Observation()
    out = materialise(edges.observe(seen, F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")).alias("hashes")), "edges")
    return out, (seen.get["n"], seen.get["hashes"])


def connected_components(edges: DataFrame) -> DataFrame:
    """edges: columns a, b of a sortable type.  Returns node, component (the smallest node reachable).

    Loops, repeated edges and null ends are ignored; nodes without an edge aren't in the result.
    """
    linked = edges.where("a is not null and b is not null and a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    current, mark = _written(linked.distinct())
    for _ in range(MAX_ROUNDS):
        if not mark[0]:
            break
        following, new = _written(_small_star(_large_star(current)))
        discard(current)
        current, same = following, new == mark
        mark = new
        if same:
            break
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
