"""Connected components of a table of links, by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexigrid.session import written


def _large_star(edges: DataFrame) -> DataFrame:
    """Each vertex links its larger neighbours to the smallest it knows."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.where(F.col("b") > F.col("a")).join(least, "a").select(F.col("m").alias("a"), "b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each vertex links its smaller neighbours, and itself, to the smallest."""
    least = edges.groupBy("b").agg(F.min("a").alias("m"))
    moved = edges.join(least, "b").select(F.col("m").alias("a"), F.col("a").alias("b")).where("a < b")
    return moved.union(least.select(F.col("m").alias("a"), "b")).distinct()


def stars(edges: DataFrame) -> DataFrame:
    """``a, b``: every vertex ``b`` of an edge beside the smallest vertex ``a`` of its component, where they differ."""

    def state(df: DataFrame):
        return df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).collect()[0]

    edges = written(edges, "simhash-links")
    seen = state(edges)
    while seen[0]:
        edges = written(_small_star(written(_large_star(edges), "simhash-large")), "simhash-small")
        now = state(edges)
        if now == seen:
            break
        seen = now
    return edges
