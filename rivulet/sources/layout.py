"""How tables are laid out on storage, and filters that make use of it."""

from __future__ import annotations

import datetime as dt
from dataclasses import replace
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from rivulet.sources.lots import (
    DATE_OF_PARENT,
    LOT,
    MONTH,
    REJECTS,
    Lot,
    Lots,
    Manifest,
    Storage,
    grows,
    in_ranges,
    indexed,
    manifest_of,
    publish,
)
from rivulet.sources.schema import DATE_COLUMN

# The text of a row that could not be read, in frames that keep such rows.
CORRUPT = "_corrupt_record"


def write(df: DataFrame, path: str, partition_by: str | list[str] | None = None, mode: str = "errorifexists") -> None:
    """Write a report as Parquet, optionally in one folder per value of `partition_by`."""
    keys = [partition_by] if isinstance(partition_by, str) else list(partition_by or [])
    if keys:
        # Rebalancing keeps a folder's rows together but splits an oversized one over tasks.
        df = df.hint("rebalance", *keys)
    df.write.mode(mode).partitionBy(*keys).parquet(path)


def with_month(df: DataFrame, table: str, parent: DataFrame | None = None) -> DataFrame:
    """A growing table with the month of its date. For one dated by its parent, `parent` is that table;
    rows whose parent is unknown have no month. Tables that do not grow stay as they are."""
    if table in DATE_COLUMN:
        return df.withColumn(MONTH, F.trunc(F.col(DATE_COLUMN[table]), "month"))
    if table in DATE_OF_PARENT and parent is not None:
        name, key = DATE_OF_PARENT[table]
        months = parent.groupBy(key).agg(F.min(F.trunc(F.col(DATE_COLUMN[name]), "month")).alias(MONTH))
        return df.join(months, key, "left").select(*df.columns, MONTH)
    return df


def dating(spark: SparkSession, rows: DataFrame, table: str, parent_path: str) -> DataFrame | None:
    """The part of the table that dates `rows` which may hold their keys: folders whose key range meets
    theirs. The range costs a pass over `rows`, which are one load's."""
    if table not in DATE_OF_PARENT:
        return None
    name, key = DATE_OF_PARENT[table]
    parent = Lots(spark, parent_path, name)
    low, high = rows.agg(F.min(key), F.max(key)).first()
    if low is None:
        return parent.read().limit(0)
    return parent.over_keys(low, high).filter(in_ranges(F.col(key), [(low, high)]))


def write_table(
    df: DataFrame, path: str, table: str, mode: str = "errorifexists", parent: DataFrame | None = None
) -> None:
    """Write a business table; growing tables get one folder per month (see `with_month`)."""
    df = with_month(df, table, parent)
    write(df, path, MONTH if MONTH in df.columns else None, mode)


class Loaded(NamedTuple):
    rows: int
    rejected: int


class TooManyRejects(Exception):
    """A load refused more rows than it may; it does not count."""


def write_lot(
    df: DataFrame,
    path: str,
    table: str,
    lot: int,
    parent: DataFrame | None = None,
    day: dt.date | None = None,
    most_rejected: int | None = None,
) -> Loaded:
    """Write one load of a table below its folder and make it count, as known since `day` (today). Writing a
    lot again replaces it, so a load that is repeated or was interrupted counts once; one that was
    compacted since is left as it is.

    Rows with a text in `_corrupt_record` go to the table's rejects in the same write, which also counts
    both kinds. With more than `most_rejected` of them the load raises and does not count.
    """
    spark, storage = df.sparkSession, Storage(df.sparkSession, path)
    before = manifest_of(storage)
    if before is not None and 0 <= lot <= before.folded:
        return Loaded(0, 0)
    for old in (lot, REJECTS + lot):
        storage.remove(f"{LOT}={old}")
    refused = F.col(CORRUPT).isNotNull() if CORRUPT in df.columns else F.lit(False)
    dated = with_month(df, table, parent).withColumn(LOT, F.when(refused, F.lit(REJECTS + lot)).otherwise(F.lit(lot)))
    seen = Observation()
    counts = [F.count(F.when(test, 1)).alias(name) for name, test in (("rows", ~refused), ("rejected", refused))]
    # Counted behind the exchange, in the tasks that write: a task that runs again counts once.
    _spread(dated).observe(seen, *counts).write.mode("append").partitionBy(*_folders(dated)).parquet(path)
    done = Loaded(seen.get["rows"], seen.get["rejected"])
    if most_rejected is not None and done.rejected > most_rejected:
        raise TooManyRejects(f"{table}: {done.rejected} rows refused, {done.rows} read")
    entry = Lot(lot, (day or dt.date.today()).isoformat(), indexed(spark, storage.root, table, lot), done.rejected)
    publish(storage, lambda now: now.with_lot(entry))
    return done


def _folders(df: DataFrame) -> list[str]:
    return [LOT, *([MONTH] if MONTH in df.columns else [])]


def _spread(df: DataFrame) -> DataFrame:
    """A task for each month, more for a large one: a lot adds few files to a month."""
    return df.hint("rebalance", MONTH) if MONTH in df.columns else df


def compact(spark: SparkSession, path: str, table: str, parent: DataFrame | None = None) -> Manifest:
    """Rewrite all lots of a growing table as one: replaced rows go, each month gets as few files as its size
    asks for, and rows that came before the row that dates them (`parent`) move to their month.

    Readers go on with the old lots, and see the new one once it is whole. Lots that arrive meanwhile
    stay lots of their own on top. `expire` frees the space of the old ones.
    """
    storage = Storage(spark, path)
    now = manifest_of(storage)
    if now is None or not now.lots or not grows(table):
        return now or Manifest()
    base = {x.lot for x in now.lots}
    number = -(now.version + 1)
    storage.remove(f"{LOT}={number}")
    rows = Lots(spark, path, table)
    rows.manifest = now
    merged = rows.read()
    merged = merged if table in DATE_OF_PARENT and parent is None else with_month(merged.drop(MONTH), table, parent)
    merged = merged.withColumn(LOT, F.lit(number))
    _spread(merged).write.mode("append").partitionBy(LOT, MONTH).parquet(path)
    day = max(x.day for x in now.lots)
    entry = Lot(number, day, indexed(spark, storage.root, table, number))

    def swap(current: Manifest) -> Manifest:
        since = tuple(x for x in current.lots if x.lot not in base)
        if base - {x.lot for x in current.lots}:
            raise RuntimeError(f"{table} was compacted by another run")
        return replace(current, lots=(entry, *since), folded=max(now.folded, *base))

    return publish(storage, swap)


def loaded(spark: SparkSession, path: str, table: str, as_of: dt.date | None = None) -> DataFrame:
    """A table as `write_lot` laid it out: all lots of one that grows, where later ones replace rows of the
    same key; else the newest, or the one that was known on the day `as_of`."""
    return Lots(spark, path, table, as_of).read()


def save_bucketed(df: DataFrame, name: str, key: str, buckets: int) -> None:
    """Save a table bucketed and sorted by `key`: two tables bucketed alike join and aggregate on
    that key without an exchange."""
    df.write.bucketBy(buckets, key).sortBy(key).mode("errorifexists").saveAsTable(name)


def in_window(
    df: DataFrame,
    column: str,
    start: dt.date | None = None,
    before: dt.date | None = None,
) -> DataFrame:
    """Rows with `start <= column < before`, on the stored column so that the test reaches the
    Parquet scan, and on the month folder where the table has one."""
    tests: list[Column] = []
    if start is not None:
        tests.append(F.col(column) >= _wall_clock(start))
        if MONTH in df.columns:
            tests.append(F.col(MONTH) >= F.lit(start.replace(day=1)))
    if before is not None:
        tests.append(F.col(column) < _wall_clock(before))
        if MONTH in df.columns:
            tests.append(_month_before(before))
    for test in tests:
        df = df.filter(test)
    return df


def in_months(
    df: DataFrame,
    start: dt.date | None = None,
    before: dt.date | None = None,
    also: Column | None = None,
) -> DataFrame:
    """Rows of the months that `start <= date < before` touches, and those that meet `also`, where the table
    is laid out by month; all rows where it is not. For tables that are then joined to rows of that window."""
    if MONTH not in df.columns:
        return df
    # A row without a month came before its parent, which may be there by now.
    unknown = F.col(MONTH).isNull() if also is None else F.col(MONTH).isNull() | also
    if start is not None:
        df = df.filter(unknown | (F.col(MONTH) >= F.lit(start.replace(day=1))))
    return df if before is None else df.filter(unknown | _month_before(before))


def _month_before(before: dt.date) -> Column:
    """Months with a day before `before`."""
    return F.col(MONTH) < F.lit(before) if before.day == 1 else F.col(MONTH) <= F.lit(before.replace(day=1))


def _wall_clock(day: dt.date) -> Column:
    return F.lit(day.isoformat()).cast("timestamp_ntz")
