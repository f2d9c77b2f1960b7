"""Distinct customers that add up: exact bitmaps per month and group, of which any range is a union.

Customers get dense numbers that never change; a bitmap holds 32,768 of them in 4 KB. Counting distinct
customers of a year by region then reads the stored bitmaps, not the orders.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivulet.operators.rowsets import keep


def numbered(keys: DataFrame, key: str, known: DataFrame | None = None) -> DataFrame:
    """(key, nro): a number from 0 for every distinct key, without gaps. Those of `known` keep theirs, others
    go on after the last. Sorted by range over all tasks; of each range only its size is added up. Null
    keys have no number."""
    fresh = keys.select(key).filter(F.col(key).isNotNull()).distinct()
    first = F.lit(0).cast("long")
    if known is not None:
        fresh = fresh.join(known, key, "left_anti")
        first = F.coalesce(known.agg(F.max("nro") + 1).scalar(), first)
    at = F.monotonically_increasing_id()
    placed = fresh.repartitionByRange(key).sortWithinPartitions(key)
    placed = keep(placed.select(key, F.shiftright(at, 33).alias("_tramo"), at.bitwiseAND((1 << 33) - 1).alias("_en")))
    sizes = placed.groupBy("_tramo").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_tramo").rowsBetween(Window.unboundedPreceding, -1))
    # One row per range.
    starts = F.broadcast(sizes.select("_tramo", F.coalesce(before, F.lit(0)).alias("_desde")))
    rows = placed.join(starts, "_tramo").select(key, (F.col("_en") + F.col("_desde") + first).alias("nro"))
    return rows if known is None else known.select(key, "nro").unionByName(rows)


def bitmaps(facts: DataFrame, key: str, numbers: DataFrame, by: Sequence[str]) -> DataFrame:
    """(by ..., _cubo, _bits): the customers of each group. Rows are brought to one per group and customer
    before they meet the numbers. Customers without a number are left out."""
    seen = facts.select(*by, key).distinct().join(numbers, key)
    number = F.col("nro")
    return seen.groupBy(*by, F.bitmap_bucket_number(number).alias("_cubo")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("_bits")
    )


def distinct_count(stored: DataFrame, by: Sequence[str | Column] = (), into: str = "clientes") -> DataFrame:
    """Distinct customers of the stored bitmaps per `by`, however many months or groups they join."""
    names = [f"_g{k}" for k in range(len(by))]
    columns = [F.col(c) if isinstance(c, str) else c for c in by]
    shown = stored.select(*columns).columns if by else []
    parts = stored.select(*[c.alias(n) for c, n in zip(columns, names)], "_cubo", "_bits").groupBy(*names, "_cubo")
    united = parts.agg(F.bitmap_count(F.bitmap_or_agg("_bits")).alias("_n"))
    counted = united.groupBy(*names).agg(F.coalesce(F.sum("_n"), F.lit(0)).alias(into))
    return counted.select(*[F.col(n).alias(s) for n, s in zip(names, shown)], into)
