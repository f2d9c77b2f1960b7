"""Hierarchies of any depth: parent accounts of parent accounts, supervisors of supervisors.

Links are followed by doubling: after k rounds each row knows its ancestor 2**k levels up, so a chain of a
thousand levels takes ten joins. Rounds go on only for rows whose chain goes on, and each is stored,
so a lost executor costs one round.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.operators.rowsets import keep


def links_of(df: DataFrame, child: str, parent: str) -> DataFrame:
    """(hijo, padre), one row per child: of several parents the smallest. A row without a parent, or that is
    its own, has no link."""
    own = (F.col(parent).isNotNull()) & (F.col(parent) != F.col(child))
    return df.filter(own).groupBy(F.col(child).alias("hijo")).agg(F.min(parent).alias("padre"))


def _onward(jumps: DataFrame) -> DataFrame:
    """Twice as far up, for those that have that many levels above them."""
    far = jumps.select(F.col("hijo").alias("padre"), F.col("padre").alias("_lejos"))
    return jumps.join(far, "padre").select("hijo", F.col("_lejos").alias("padre"))


def cycle_heads(links: DataFrame) -> DataFrame:
    """The smallest member (`hijo`) of every cycle of the links.

    Who still has an ancestor as many levels up as there are links left hangs on a cycle, and that ancestor
    lies on it. Members of cycles, mostly none, then learn the smallest among them by doubling.
    """
    links = keep(links)
    jumps, levels, left = links, 1, links.count()
    while left and levels <= left:
        jumps = keep(_onward(jumps))
        levels *= 2
        # Chains that end drop out; no chain is longer than the links there are.
        if jumps.isEmpty():
            left = 0
    if not left:
        return links.select("hijo").limit(0)
    members = keep(jumps.select(F.col("padre").alias("hijo")).distinct())
    jumps = keep(links.join(members, "hijo", "left_semi").withColumn("menor", F.least("hijo", "padre")))
    size, levels = members.count(), 1
    while levels <= size:
        far = jumps.select(F.col("hijo").alias("padre"), F.col("padre").alias("_lejos"), F.col("menor").alias("_menor"))
        step = jumps.join(far, "padre")
        jumps = keep(step.select("hijo", F.col("_lejos").alias("padre"), F.least("menor", "_menor").alias("menor")))
        levels *= 2
    return jumps.filter(F.col("hijo") == F.col("menor")).select("hijo")


def without_cycles(links: DataFrame) -> DataFrame:
    """The links, cut above the smallest member of every cycle, which so becomes a head."""
    return links.join(cycle_heads(links), "hijo", "left_anti")


def ancestors(links: DataFrame) -> DataFrame:
    """(hijo, padre, nivel): every ancestor of every child of links without cycles, from level 1."""
    jumps = keep(links)
    found = keep(jumps.withColumn("nivel", F.lit(1)))
    levels = 1
    while not jumps.isEmpty():
        above = found.select(F.col("hijo").alias("padre"), F.col("padre").alias("_lejos"), F.col("nivel").alias("_mas"))
        # Both sides are scans, so a parent of very many children may be split.
        higher = jumps.join(above, "padre").select("hijo", F.col("_lejos").alias("padre"), (F.col("_mas") + levels).alias("nivel"))
        found = keep(found.unionByName(higher))
        jumps = keep(_onward(jumps))
        levels *= 2
    return found


def heads(links: DataFrame) -> DataFrame:
    """(hijo, padre): the topmost ancestor of every child of links without cycles."""
    jumps = keep(links)
    while True:
        # Who stands at a head stays there; all others go on from where they are.
        far = jumps.select(F.col("hijo").alias("padre"), F.col("padre").alias("_lejos"))
        onward = keep(jumps.join(far, "padre", "left").select("hijo", F.coalesce("_lejos", "padre").alias("padre"), F.col("_lejos").isNotNull().alias("_mas")))
        if onward.filter("_mas").isEmpty():
            return jumps
        jumps = onward.drop("_mas")


def to_head(df: DataFrame, hierarchy: DataFrame, key: str, values: Sequence[str], child: str = "IdCliente", parent: str = "Cta_Madre") -> DataFrame:
    """Totals per topmost account (`Cuenta`), through any number of levels. An account without a parent is
    its own; a cycle counts under its smallest member. Rows are summed per account before the join."""
    totals = df.groupBy(F.col(key).alias("hijo")).agg(*[F.sum(v).alias(v) for v in values])
    top = heads(without_cycles(links_of(hierarchy, child, parent)))
    return (
        totals.join(top, "hijo", "left")
        .groupBy(F.coalesce("padre", "hijo").alias("Cuenta"))
        .agg(*[F.sum(v).alias(v) for v in values])
    )


def rollup_levels(df: DataFrame, hierarchy: DataFrame, key: str, values: Sequence[str], child: str, parent: str) -> DataFrame:
    """Totals of every member of the hierarchy over itself and all below it: `nodo`, `niveles` (how many
    levels reach down from it to a row), and the values. Members without any row below have none."""
    totals = df.groupBy(F.col(key).alias("hijo")).agg(*[F.sum(v).alias(v) for v in values])
    above = ancestors(without_cycles(links_of(hierarchy, child, parent)))
    own = totals.select(F.col("hijo").alias("nodo"), F.lit(0).alias("nivel"), *values)
    below = totals.join(above, "hijo").select(F.col("padre").alias("nodo"), "nivel", *values)
    rows = own.unionByName(below).groupBy("nodo")
    return rows.agg(F.max("nivel").alias("niveles"), *[F.sum(v).alias(v) for v in values])
