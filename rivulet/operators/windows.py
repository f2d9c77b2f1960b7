"""One row per key, and rows in sequence.

Every rank is bounded (`rn <= n`), so Spark keeps at most n rows per key in each task before the
exchange, and a hot key moves little data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OrderKey = str | Column


def nth_orders(df: DataFrame, key: str | Sequence[str], order: Sequence[OrderKey], n: int) -> DataFrame:
    """The first `n` rows of each key in the given order, numbered in `rn`."""
    keys = [key] if isinstance(key, str) else list(key)
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("rn", rank).filter(F.col("rn") <= n)


def dedupe_one(df: DataFrame, key: str | Sequence[str], tiebreak: Sequence[OrderKey]) -> DataFrame:
    """One row per key: the first by the tiebreak."""
    return nth_orders(df, key, tiebreak, 1).drop("rn")


def prioritise(df: DataFrame, key: str, rank: Column, date: str, last: Sequence[OrderKey] = ()) -> DataFrame:
    """The row of each key with the smallest rank, latest date first among equals."""
    return dedupe_one(df, key, [rank, F.col(date).desc(), *last])


def nth_pair(df: DataFrame, key: str, order: Sequence[OrderKey], values: dict[str, tuple[str, str]]) -> DataFrame:
    """First and second row of each key side by side. `values` maps a column to the names its
    first and second value get. One aggregation over the two ranked rows, no self join."""
    ranked = nth_orders(df, key, order, 2)
    picks = []
    for column, (first, second) in values.items():
        picks.append(F.max(F.when(F.col("rn") == 1, F.col(column))).alias(first))
        picks.append(F.max(F.when(F.col("rn") == 2, F.col(column))).alias(second))
    return ranked.groupBy(key).agg(*picks)
