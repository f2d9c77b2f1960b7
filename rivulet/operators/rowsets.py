"""Row sources, unions and materialised intermediates."""

from __future__ import annotations

import datetime as dt
import functools
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import Future, ThreadPoolExecutor
from contextlib import contextmanager
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.functions.exprs import quote


def _literal(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, dt.date):
        return f"DATE '{value.isoformat()}'"
    if isinstance(value, str):
        escaped = value.replace("\\", "\\\\").replace("'", "\\'")
        return f"'{escaped}'"
    return str(value)


def values(spark: SparkSession, rows: list[tuple], columns: Sequence[str]) -> DataFrame:
    """A small inline table. Spark holds its rows in the plan and so knows its size."""
    lines = ", ".join("(" + ", ".join(map(_literal, row)) + ")" for row in rows)
    names = ", ".join(quote(c) for c in columns)
    return spark.sql(f"SELECT * FROM VALUES {lines} AS v({names})")


def month_calendar(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """One row per month from `start` to `end`, each as its first day."""
    span = F.sequence(
        F.trunc(F.lit(start), "month"), F.trunc(F.lit(end), "month"), F.expr("interval 1 month")
    )
    return spark.range(1).select(F.explode(span).alias("Mes"))


def union_states(active: DataFrame, closed: DataFrame) -> DataFrame:
    """Active and closed customers in one set, told apart by `Estado`."""
    return active.withColumn("Estado", F.lit("Activo")).unionByName(
        closed.withColumn("Estado", F.lit("Baja")), allowMissingColumns=True
    )


def union_events(*sources: DataFrame) -> DataFrame:
    """Events of unlike origin that share their column names."""
    return reduce(DataFrame.unionByName, sources)


@functools.cache
def _one_machine_folder() -> str:
    return tempfile.mkdtemp(prefix="rivulet-")


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder name under the folder that driver and executors share, as the session names it in
    `spark.checkpoint.dir`. Without one, only a local session, which is one machine, gets a
    temporary folder; on a cluster every executor would write to its own disk, so this raises."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("name a folder that all executors share in spark.checkpoint.dir")
        root = _one_machine_folder()
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def keep(df: DataFrame) -> DataFrame:
    """Materialise an intermediate that several results read: written to the shared folder, so it
    outlives any executor, and read back as a scan."""
    path = shared_folder(df.sparkSession, "kept")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# Jobs that are handed to Spark at a time: while the last tasks of one run, those of the next take the free cores.
JOBS_AT_ONCE = 4


@contextmanager
def side_by_side(spark: SparkSession) -> Iterator[Callable[..., Future]]:
    """A function that starts `work(*args)` in a thread of its own, `JOBS_AT_ONCE` at a time and in the order of
    the calls, with the caller's job properties. All are done when the block ends."""
    with ThreadPoolExecutor(JOBS_AT_ONCE) as pool:
        yield lambda work, *args: pool.submit(inheritable_thread_target(spark)(work), *args)
