"""What the operators share: tables, keys and word patterns."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.operators.rowsets import shared_folder

# A word: anything between spaces, tabs, line ends, vertical tabs and form feeds.
WORD = r"[^\x20\x09-\x0D]+"

# Rows that go to a Python worker at a time. Ten times as many whole texts, Spark's default, are tens of
# megabytes, which the executor and each of its workers hold more than once.
BATCH_ROWS = 1000

# Bytes of text for which a step of a long chain has one task that writes.
TASK_BYTES = 1 << 25


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def unit_hash(bits: int, *parts: Column) -> Column:
    """A whole number below 2**bits (a multiple of 4, at most 52) from the MD5 of the parts, which
    any engine computes alike. Null parts count as empty."""
    text = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, bits // 4), 16, 10).cast("long")


def nested(docs: DataFrame, **columns: Column) -> DataFrame:
    """The rows as one column, `row`, next to columns made of them: whatever names `docs` bears, they do
    not clash. `select("row.*")` brings the rows back."""
    every = F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("row")
    return docs.select(every, *[column.alias(name) for name, column in columns.items()])


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


@contextmanager
def short_batches(spark: SparkSession):
    """Jobs that run within hand `BATCH_ROWS` rows at most to a Python worker at a time; the session's own
    setting is put back behind them."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    if 0 < int(before) <= BATCH_ROWS:
        yield
        return
    spark.conf.set(name, str(BATCH_ROWS))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def writing_tasks(docs: DataFrame) -> int:
    """Tasks that write what is made of the texts of `docs`: one for each core, more as the texts grow.

    For each file and each folder of a task an executor starts a process (`chmod`) where Hadoop has no native
    library, and until that has its own memory the executor's memory is counted twice. A small table that lies
    in many partitions would be written as as many files by every step."""
    size = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    return max(docs.sparkSession.sparkContext.defaultParallelism, -(-size // TASK_BYTES))


def by_few(df: DataFrame, tasks: int | None) -> DataFrame:
    """The rows, made by so many tasks at most (None: as they come).

    The driver keeps a record of every task of the latest stages, so a chain of a few hundred stages should
    not have a task for every shuffle partition where there are few rows."""
    return df.coalesce(tasks) if tasks else df


def stored(df: DataFrame, purpose: str, tasks: int | None = None) -> DataFrame:
    """The frame, written to the shared folder and read back: later steps read it however often, and
    a lost executor costs none of the work before it. `tasks`: write by so many at most.

    Nothing refers to the shuffles of the step any more. The driver's collector is asked to notice, upon
    which Spark removes their files: a chain of steps takes the disk of its largest one, not of all.
    """
    spark = df.sparkSession
    path = shared_folder(spark, purpose)
    with short_batches(spark):
        by_few(df, tasks).write.parquet(path)
    spark.sparkContext._jvm.System.gc()
    kept = spark.read.schema(df.schema).parquet(path)
    kept._stored_at = path
    return kept


def forget(*frames: DataFrame) -> None:
    """Remove what `stored` wrote for these frames, once nothing reads them any more."""
    for df in frames:
        jvm = df.sparkSession.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(df._stored_at)
        path.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
