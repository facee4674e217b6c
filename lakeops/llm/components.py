"""Connected components of an edge table by star contraction, without bringing edges to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.operators.joins import heavy_keys, join_salting_hot
from lakeops.session import stored

HOT_SHARE = 1 / 500


def _to_minimum(edges: DataFrame, both: bool) -> DataFrame:
    """Link neighbours of each node to the least of them and the node itself (large star: both directions; small star: one).

    Nodes with more than ``HOT_SHARE`` of all rows, at most 500, are salted.
    """
    near = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if both else edges
    least = near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    rows = near.where("v > u") if both else near
    moved = join_salting_hot(rows, least, "u", heavy_keys(rows, "u", HOT_SHARE)).select(F.col("v").alias("u"), F.col("m").alias("v"))
    if not both:
        moved = moved.unionByName(least.select("u", F.col("m").alias("v")))
    return moved.where("u > v").distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def roots(edges: DataFrame) -> DataFrame:
    """(u, v) edges of bigint nodes to (u, root): every node but the roots themselves with the least node it can reach.

    Each round replaces every edge by one to a smaller node; the number of rounds grows with the logarithm of the longest path.
    """
    now = stored(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u > v").distinct(), "edges")
    state = _state(now)
    while state[0]:
        now = stored(_to_minimum(stored(_to_minimum(now, True), "large"), False), "small")
        before, state = state, _state(now)
        if state == before:
            break
    return now.select("u", F.col("v").alias("root"))
