"""Connected components by alternating large and small stars, in DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _star(edges: DataFrame, small: bool) -> DataFrame:
    """Every node links its larger neighbours (large star) or itself and its
    smaller ones (small star) to its least neighbour. Minima are taken with
    map-side aggregation and joined back, so a hub's edges may be split."""
    pairs = edges if small else edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = pairs.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    met = pairs.join(least, "a")
    if small:
        out = met.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
    else:
        out = met.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return out.where(F.col("a") != F.col("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, label): label is the least node of the component. ``edges``: (a, b)
    of one type that has an order; nodes without an edge don't appear."""
    now = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct(), "cc")
    mark = None
    while True:
        new = now.agg(F.count(F.lit(1)), F.sum((F.xxhash64("a", "b") % 1_000_003)), F.countDistinct("b")).first()
        if new == mark:
            return now.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(
                now.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
        mark = new
        now = written(_star(_star(now, small=False), small=True), "cc")
