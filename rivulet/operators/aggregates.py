"""Aggregation shapes the reports share."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivulet.functions.exprs import ratio
from rivulet.operators.windows import dedupe_one


def balance(sources: Sequence[DataFrame], key: str, amount: str) -> DataFrame:
    """Net amount per key over several ledgers: rows are unioned and summed once."""
    rows = reduce(DataFrame.unionByName, [s.select(key, amount) for s in sources])
    return rows.groupBy(key).agg(F.sum(amount).alias(amount))


def day_then_mean(
    df: DataFrame, keys: Sequence[str], day: str, values: Sequence[str], counted: Column | None = None
) -> DataFrame:
    """Totals per key and day, then their mean over the days (those that meet `counted`)."""
    daily = df.groupBy(*keys, day).agg(*[F.sum(v).alias(v) for v in values])
    kept = F.lit(True) if counted is None else counted
    return daily.groupBy(*keys).agg(
        F.count(F.when(kept, 1)).alias("dias"),
        *[F.avg(F.when(kept, F.col(v))).alias(v) for v in values],
    )


def audit_text(events: DataFrame, key: str, order: Sequence[str], text: Column, separator: str) -> DataFrame:
    """All texts of a key in order, joined into one. Equal events are counted before the shuffle,
    so what is gathered per key is its distinct events, not its rows."""
    counted = events.groupBy(key, *order, text.alias("_text")).agg(F.count(F.lit(1)).cast("int").alias("_times"))
    entry = F.struct(*order, "_text", "_times")
    return counted.groupBy(key).agg(joined_text(F.array_sort(F.collect_list(entry)), separator).alias("texto"))


def audit_parts(
    events: DataFrame, key: str, day: str, order: Sequence[str], text: Column, separator: str, entries: int = 1000
) -> DataFrame:
    """(key, parte, texto): the text of `audit_text` in parts of at most `entries` events, numbered from 0;
    joined by the separator in that order they are the whole text, however long.

    Events are placed in two steps: the days of a key by running sums over one row per day, and the events of a day
    by those of that day alone. So neither a window nor a gathered list grows with the history of a key.
    An event without a day comes first.
    """
    counted = events.groupBy(key, day, *order, text.alias("_text")).agg(F.count(F.lit(1)).alias("_times"))
    days = counted.groupBy(F.col(key).alias("_k"), F.col(day).alias("_d")).agg(F.sum("_times").alias("_n"))
    earlier = Window.partitionBy("_k").orderBy("_d").rowsBetween(Window.unboundedPreceding, -1)
    days = days.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    within = Window.partitionBy(key, day).orderBy(*order, "_text").rowsBetween(Window.unboundedPreceding, -1)
    placed = counted.withColumn("_at", F.coalesce(F.sum("_times").over(within), F.lit(0)))
    same = F.col(key).eqNullSafe(F.col("_k")) & F.col(day).eqNullSafe(F.col("_d"))
    placed = placed.join(days, same).withColumn("_first", F.col("_before") + F.col("_at"))
    # An event that is there more often than a part holds goes on in the next ones.
    part = lambda at: F.floor(at / entries).cast("long")
    last = F.col("_first") + F.col("_times") - 1
    parts = placed.withColumn("parte", F.explode(F.sequence(part(F.col("_first")), part(last))))
    start = F.greatest("_first", F.col("parte") * entries)
    end = F.least(last + 1, (F.col("parte") + 1) * entries)
    entry = F.struct(start.alias("_start"), "_text", (end - start).cast("int").alias("_times"))
    return parts.groupBy(key, "parte").agg(joined_text(F.array_sort(F.collect_list(entry)), separator).alias("texto"))


def joined_text(entries: Column, separator: str) -> Column:
    """Entries (structs with `_text` and `_times`) to one text."""
    repeated = F.transform(entries, lambda e: F.array_repeat(e["_text"], e["_times"]))
    return F.array_join(F.flatten(repeated), separator)


def share_of_total(totals: DataFrame, value: str, into: str) -> DataFrame:
    """Each row's share of the whole column. Filter afterwards, so that the share stays one of the whole.

    The whole is a scalar subquery over partial sums: no task sees all rows, and Spark reuses the exchange
    below the totals, which both read.
    """
    whole = totals.agg(F.sum(value).alias("_whole")).scalar()
    return totals.withColumn(into, ratio(value, whole))


def top1(df: DataFrame, by: Sequence[str], label: str, amount: str) -> DataFrame:
    """The label with the largest total amount in each group; the smaller label wins a tie."""
    totals = df.groupBy(*by, label).agg(F.sum(amount).alias(amount))
    return dedupe_one(totals, by, [F.desc(amount), F.asc(label)])


def rank_desc(df: DataFrame, *columns: str) -> DataFrame:
    """Rows from the largest value down; a caller adds `limit` for a top-k."""
    return df.orderBy(*[F.desc(c) for c in columns])
