"""Connected components by min-label hooking and pointer jumping, all in DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinderspark.sources.tables import written


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Smallest node reachable from each node of ``edges(a long, b long)``.

    Alternates the large-star and small-star steps: every node's larger (smaller) neighbours are hooked to its smallest
    neighbour, which keeps connectivity, never grows the edge set, and ends in stars after O(log^2 n) rounds. Each round is
    two aggregations with map-side combine and one equi-join; a round's edges are written to the shared folder, so a lost
    executor costs one round at most. Returns ``(node, component)`` for nodes with an edge to another node; self-loops and
    null ends are ignored. An empty input gives an empty result.
    """
    e = written(_clean(edges), "cc")
    before = _print(e)
    for _ in range(max_rounds):
        e = written(_star(_star(e, larger=True), larger=False), "cc")
        now = _print(e)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    # settled: each edge is (leaf a, centre b) with b the smallest node of the component
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(e.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()


def _print(e: DataFrame) -> tuple:
    """Number and hash sums of the (distinct) edges: equal for equal sets, and no edge has to move for it."""
    wide = lambda seed: F.sum(F.xxhash64("a", "b", F.lit(seed)).cast("decimal(38,0)"))
    return tuple(e.agg(F.count("*"), wide(1), wide(2)).first())


def _clean(edges: DataFrame) -> DataFrame:
    a, b = F.col("a"), F.col("b")
    return edges.where(a.isNotNull() & b.isNotNull() & (a != b)).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct()


def _star(e: DataFrame, larger: bool) -> DataFrame:
    """Edges (high a, low b) after one star step."""
    if larger:
        both = e.select("a", "b").unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        hooked = both.where("b > a").join(least, "a").select(F.col("b").alias("u"), F.col("m").alias("v"))
    else:
        least = e.groupBy("a").agg(F.min("b").alias("m"))
        hooked = e.join(least, "a").select(F.col("b").alias("u"), F.col("m").alias("v")).unionByName(least.select(F.col("a").alias("u"), F.col("m").alias("v")))
    return _clean(hooked.select(F.col("u").alias("a"), F.col("v").alias("b")))
