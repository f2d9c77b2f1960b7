"""Months to columns."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pivot(
    df: DataFrame, keys: Sequence[str], on: str, columns: Sequence, value: str, rest: str | None = None
) -> DataFrame:
    """Sum of `value` per key with one column for each listed value of `on`. Listing the values
    saves the job that would look for them. `rest` names a column for all values not listed."""
    if rest is None:
        return df.groupBy(*keys).pivot(on, list(columns)).agg(F.sum(value))
    label = F.when(F.col(on).isin(*columns), F.col(on)).otherwise(rest)
    return df.withColumn(on, label).groupBy(*keys).pivot(on, [*columns, rest]).agg(F.sum(value))


def fill0(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.na.fill(0, list(columns))


def month_matrix(
    cells: DataFrame,
    keys: Sequence[str],
    month: str,
    months: Sequence[dt.date],
    metrics: Mapping[str, str],
) -> DataFrame:
    """One row per key, and per month one column for each metric, named `yyyy-MM SUFFIX`, 0 where
    the key has no cell. `metrics` maps a metric column to its suffix. `cells` must already hold
    one row per key and month.

    The months present travel as an array of at most len(months) entries and are spread into
    columns only after the exchange; a pivot aggregate would ship one row of all columns for every
    cell.
    """
    gathered = month_cells(cells, keys, month, metrics)
    return gathered.select(*keys, *month_columns(gathered, months, metrics))


def month_cells(cells: DataFrame, keys: Sequence[str], month: str, metrics: Mapping[str, str]) -> DataFrame:
    """One row per key with its months as a map, `_cells`: the form in which a matrix goes through joins."""
    entry = F.struct(F.date_format(month, "yyyy-MM"), F.struct(*metrics))
    return cells.groupBy(*keys).agg(F.map_from_entries(F.collect_list(entry)).alias("_cells"))


def month_columns(
    gathered: DataFrame,
    months: Sequence[dt.date],
    metrics: Mapping[str, str],
    scaled: Mapping[str, Column] | None = None,
) -> list[Column]:
    """The columns of `_cells`; a metric in `scaled` is multiplied by its column."""
    kinds = gathered.schema["_cells"].dataType.valueType
    columns: list[Column] = []
    for first in months:
        name = first.strftime("%Y-%m")
        for metric, suffix in metrics.items():
            value = F.coalesce(F.col("_cells")[name][metric], F.lit(0).cast(kinds[metric].dataType))
            if scaled and metric in scaled:
                value = value * scaled[metric]
            columns.append(value.alias(f"{name} {suffix}"))
    return columns
