"""Connected components by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.llm.tables import by_few, forget, stored


def _towards_least(edges: DataFrame, only_smaller: bool, tasks: int | None) -> DataFrame:
    """Every node hands its least neighbour (itself included) to its neighbours: to the larger ones, or
    with `only_smaller` to the smaller ones and itself."""
    both = edges if only_smaller else edges.union(edges.select("b", "a"))
    both = both.toDF("node", "other")
    least = both.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("least"))
    told = both.join(least, "node")
    if only_smaller:
        own = least.select(F.col("node").alias("a"), F.col("least").alias("b"))
        handed = told.select(F.col("other").alias("a"), F.col("least").alias("b")).union(own)
    else:
        handed = told.where(F.col("other") > F.col("node")).select(
            F.col("other").alias("a"), F.col("least").alias("b")
        )
    return by_few(handed.where(F.col("a") != F.col("b")).distinct(), tasks)


def _stars(edges: DataFrame, tasks: int | None) -> bool:
    """Whether every node hangs on one other that hangs on none."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("hangs"), F.lit(0).alias("holds"))
    ends = ends.union(edges.select("b", F.lit(0), F.lit(1))).groupBy("node")
    ends = ends.agg(F.sum("hangs").alias("hangs"), F.max("holds").alias("holds"))
    return by_few(ends.where("hangs > 1 OR hangs = 1 AND holds = 1"), tasks).isEmpty()


def components(edges: DataFrame, tasks: int | None = None) -> DataFrame:
    """(node, component) for every node of `edges` (a, b); a component is named by its least node.

    Each round rehangs neighbours to the least node they see, until every component is a star. A node
    with many neighbours is met by a partial minimum and a join, never gathered. Rounds are cut by
    written tables, each written by `tasks` at most.
    """
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = stored(edges.where(F.col("a") != F.col("b")).distinct(), "links", tasks)
    while not _stars(edges, tasks):
        before, edges = edges, stored(_towards_least(_towards_least(edges, False, tasks), True, tasks), "links", tasks)
        forget(before)
    ends = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return ends.union(edges.select(F.col("b"), F.col("b"))).distinct()
