"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from truerow.llm.common import stored


def _nearest(edges: DataFrame) -> DataFrame:
    """Per node the smallest of itself and its neighbours; partial minima come before the shuffle."""
    return edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))


def _both(edges: DataFrame) -> DataFrame:
    return edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the edges (a, b): the smallest node it reaches.

    Large-star hangs each larger neighbour on the smallest one, small-star hangs a node's
    smaller neighbours and itself on it; both keep the components. When nothing changes, every
    component is a star around its smallest node. A node's neighbours are never gathered: its
    minimum is joined to its edges, and adaptive execution splits a hot node's edges.
    """
    now = stored(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(),
        "edges",
    )
    while True:
        both = _both(now)
        large = both.join(_nearest(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stored(large.where("u <> v").distinct(), "edges")
        small = large.join(_nearest(large), "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
        small = stored(small.where("u <> v").distinct(), "edges")
        # A star: no node is both a child and a parent, and no child has two parents.
        parents = small.select(F.col("v").alias("u")).distinct()
        many = small.groupBy("u").count().where("count > 1").select("u")
        if small.join(parents, "u", "left_semi").union(many.withColumn("v", F.col("u"))).isEmpty():
            stars = small.select(F.col("u").alias("node"), F.col("v").alias("component"))
            return stars.union(stars.select(F.col("component").alias("node"), "component").distinct())
        now = small
