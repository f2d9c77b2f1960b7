"""Scheduled refresh: each run loads the CSV files that arrived since the run before."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from rivulet.sources.csv_files import CSV_OPTIONS, canonicalise
from rivulet.sources.layout import CORRUPT, dating, write_lot
from rivulet.sources.lots import DATE_OF_PARENT
from rivulet.sources.schema import file_schema


def refresh_table(
    spark: SparkSession,
    table: str,
    csv_dir: str,
    parquet_dir: str,
    checkpoint_dir: str,
    parent_dir: str | None = None,
    quarantine: bool = False,
    most_rejected: int | None = None,
    day: dt.date | None = None,
) -> None:
    """Bring one table's new files to its Parquet copy, as a lot of their own (see `write_lot`). A growing
    table gets their rows added, laid out by month, and those of a key it has replaced; any other is
    replaced by what the run found.

    The checkpoint, on shared storage, remembers the files and the number of the lot, so a run that is
    repeated or interrupted loads each file once. A malformed row stops the run before its file counts as
    loaded; with `quarantine` it goes to the table's rejects, up to `most_rejected` of them. `parent_dir` is
    the folder of the table that dates this one (orders, for order lines), to be refreshed first; by
    default it stands next to `parquet_dir`. `day` is since when the lot counts as known.
    """
    schema = file_schema(table)
    if quarantine:
        schema = schema.add(CORRUPT, T.StringType())
    files = spark.readStream.schema(schema).options(**CSV_OPTIONS).option("mode", "PERMISSIVE" if quarantine else "FAILFAST")
    files = files.option("columnNameOfCorruptRecord", CORRUPT).csv(csv_dir)
    parent = DATE_OF_PARENT.get(table, ("", ""))[0]
    folder = parent_dir or f"{parquet_dir.rstrip('/').rpartition('/')[0]}/{parent}"

    def write(rows: DataFrame, batch: int) -> None:
        dated = dating(rows.sparkSession, rows, table, folder) if parent else None
        # Lot 0 is the first load.
        write_lot(rows, parquet_dir, table, batch + 1, dated, day, most_rejected)

    stream = canonicalise(files, table).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint_dir)
    stream.trigger(availableNow=True).start().awaitTermination()
