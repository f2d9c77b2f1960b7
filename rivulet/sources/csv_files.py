"""CSV ingest with a declared schema."""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Iterable
from concurrent.futures import Future

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivulet.operators.rowsets import side_by_side
from rivulet.sources.layout import CORRUPT, TooManyRejects, write_lot
from rivulet.sources.lots import DATE_OF_PARENT, Lots
from rivulet.sources.schema import TABLE_COLUMNS, WHOLE_KINDS, canonical_schema, columns_of, file_schema
from rivulet.sources.tables import Tables

# Header row, comma separated, double-quoted fields, UTF-8, empty cell is NULL, LF or CRLF.
CSV_OPTIONS = {
    "header": "true",
    "sep": ",",
    "quote": '"',
    "escape": '"',
    "encoding": "UTF-8",
    "nullValue": "",
    "timestampNTZFormat": "yyyy-MM-dd[[ ]['T']HH:mm:ss[.SSS]]",
}


def canonicalise(df: DataFrame, table: str) -> DataFrame:
    """Parsed text columns to canonical types, blank padding removed. `12.0` is the whole number 12; `1.5`
    in a whole-number column fails the scan, or is NULL with its row in `_corrupt_record`."""
    keeps = CORRUPT in df.columns
    out, broken = [], F.lit(False)
    for (name, kind), field in zip(columns_of(table), canonical_schema(table).fields):
        column = F.col(f"`{name}`")
        if kind == "char":
            column = F.rtrim(column)
        if kind in WHOLE_KINDS:
            fits = column == F.floor(column)
            broken = broken | F.coalesce(~fits, F.lit(False))
            refused = F.raise_error(F.concat(F.lit(f"{table}.{name} is no whole number: "), column.cast("string")))
            column = F.when(column.isNull() | fits, column).otherwise(
                F.lit(None) if keeps else refused.cast(df.schema[name].dataType)
            )
        out.append(column.cast(field.dataType).alias(name))
    if keeps:
        row = F.to_json(F.struct(*[F.col(f"`{name}`") for name, _ in columns_of(table)]))
        out.append(F.coalesce(F.col(CORRUPT), F.when(broken, row)).alias(CORRUPT))
    return df.select(*out)


def read_csv(spark: SparkSession, path: str, table: str, keep_corrupt: bool = False) -> DataFrame:
    """Scan one table's CSV files. A malformed row fails the scan, or with `keep_corrupt` stays
    as a row whose text is in `_corrupt_record`."""
    schema = file_schema(table)
    reader = spark.read.options(**CSV_OPTIONS)
    if keep_corrupt:
        schema = schema.add(CORRUPT, T.StringType())
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT).option("mode", "PERMISSIVE")
    else:
        reader = reader.option("mode", "FAILFAST")
    return canonicalise(reader.schema(schema).csv(path), table)


REPORT_SCHEMA = "tabla string, filas long, rechazadas long, milisegundos long, error string"


def load_all(
    spark: SparkSession,
    csv_dir: str,
    parquet_dir: str,
    names: Iterable[str] = tuple(TABLE_COLUMNS),
    quarantine: bool = False,
    most_rejected: int | None = None,
    day: dt.date | None = None,
) -> tuple[Tables, DataFrame]:
    """Write each table's CSV as Parquet, count and time it. A table that fails is reported and
    the others still load. Several tables are loaded at a time, one laid out by its parent's date after that
    parent; the time of a table is from its own start to its end.

    A malformed row fails its table; with `quarantine` it goes to the table's rejects (see `rejects`) and
    the rest is loaded, unless more than `most_rejected` rows are malformed. `day` is since when the
    load counts as known. The file is read once: the write itself tells the rows loaded and rejected.
    """
    names = sorted(names, key=lambda table: table in DATE_OF_PARENT)

    def load(name: str, parent: str, waiting: Future | None) -> tuple:
        there = waiting is not None and waiting.result()[-1] is None
        started = time.monotonic()
        rows, refused, error = None, None, None
        try:
            source = read_csv(spark, f"{csv_dir}/{name}.csv", name, keep_corrupt=quarantine)
            dated = Lots(spark, f"{parquet_dir}/{parent}", parent).read() if there else None
            rows, refused = write_lot(source, f"{parquet_dir}/{name}", name, 0, dated, day, most_rejected)
        except (PySparkException, Py4JJavaError, TooManyRejects) as problem:
            error = str(problem).splitlines()[0]
        return name, rows, refused, int((time.monotonic() - started) * 1000), error

    parent_of = {name: DATE_OF_PARENT.get(name, ("", ""))[0] for name in names}
    # Parents first, then what waits for them: the wait is short and the rest fills in.
    order = sorted(parent_of, key=lambda table: (table not in parent_of.values(), not parent_of[table]))
    running: dict[str, Future] = {}
    with side_by_side(spark) as start:
        for name in order:
            running[name] = start(load, name, parent_of[name], running.get(parent_of[name]))
    report = [running[name].result() for name in parent_of]
    tables = Tables.from_parquet(spark, parquet_dir, [name for name, *_, error in report if error is None])
    return tables, spark.createDataFrame(report, REPORT_SCHEMA)


def rejects(spark: SparkSession, parquet_dir: str, table: str) -> DataFrame:
    """The rows that loads of a table refused: what could be read of their columns, their text in
    `_corrupt_record`, and the lot that brought them."""
    return Lots(spark, f"{parquet_dir}/{table}", table).rejects(CORRUPT)
