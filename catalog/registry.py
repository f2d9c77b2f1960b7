"""Registration of queries with their SQL."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivulet.functions.exprs import quote
from rivulet.sources.star import star_tables
from rivulet.sources.tables import Tables

Query = Callable[[Tables], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under a name, with the SQL for the same rows."""

    def add(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = function
        if sql is not None:
            ORACLE[name] = sql
        return function

    return add


def comparable(df: DataFrame) -> DataFrame:
    """Values in forms every engine writes alike: numbers with a fraction as doubles of four
    decimals, dates as ISO text."""

    def plain(field: T.StructField) -> Column:
        column = F.col(quote(field.name))
        if isinstance(field.dataType, T.DecimalType) and field.dataType.scale <= 4:
            column = column.cast("double")
        elif isinstance(field.dataType, (T.DecimalType, T.DoubleType, T.FloatType)):
            column = F.round(column.cast("double"), 4)
        elif isinstance(field.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            column = F.date_format(column, "yyyy-MM-dd")
        return column.alias(field.name)

    return df.select(*[plain(f) for f in df.schema.fields])


@functools.lru_cache(maxsize=8)
def _tables(spark: SparkSession, sf_dir: str) -> Tables:
    return star_tables(spark, sf_dir)


def runner(name: str) -> Callable[[SparkSession, str], DataFrame]:
    """The query over the star schema in a folder."""
    return lambda spark, sf_dir: comparable(QUERIES[name](_tables(spark, sf_dir)))
