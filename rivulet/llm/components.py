"""Connected components by alternating stars, as joins on edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.session import materialize


def _with_least(edges: DataFrame) -> DataFrame:
    """(u, v, m): every edge with the least neighbour of u, u included."""
    least = edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return edges.join(least, "u")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _with_least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    found = _with_least(down)
    return found.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
        found.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, label): every node of an edge with the least node of its component.

    Every round shortens all paths by a constant factor, so the number of rounds grows with the
    logarithm of the longest one. Nothing but a count and a checksum reaches the driver.
    """
    now = materialize(edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v").distinct())
    state = _state(now)
    while True:
        now = materialize(_small_star(_large_star(now)))
        new = _state(now)
        if new == state:
            break
        state = new
    labels = now.groupBy("u").agg(F.min("v").alias("label"))
    return labels.select(F.col("u").alias("node"), "label").unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("label"))).distinct()
