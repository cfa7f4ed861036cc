"""Connected components of an edge table, without gathering it anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillon.llm._store import saved


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for the nodes of ``edges`` (a, b); component is the smallest node reachable.

    Alternating large-star and small-star rounds: each is an aggregation of the
    smallest neighbour per node and a join, so a node with very many neighbours is
    pre-aggregated map-side and its join side can be split. Every round is written
    to the shared folder. Null ends and self-loops are ignored; no edges, no rows.
    """
    edges = edges.where("a is not null and b is not null and a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = saved(edges, "edges")
    before = None
    for _ in range(max_rounds):
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.unionAll(least.where("a > m").select("a", F.col("m").alias("b"))).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = saved(small.unionAll(least.select("a", F.col("m").alias("b"))).where("a > b").distinct(), "edges")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"no fixed point in {max_rounds} rounds")
    stars = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.unionAll(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
