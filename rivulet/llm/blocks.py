"""Numbers that travel between tasks packed by range, and small filters of a fixed size."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.llm.tables import short_batches

# Bits of a filter; 512 KB. A fuller filter only lets more through.
FILTER_BITS = 1 << 22


def ranges_of(spark: SparkSession) -> int:
    """Ranges that hashes are parted into: a few for each reducer, so they shrink as a user raises
    `spark.sql.shuffle.partitions` with the input."""
    return 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))


def range_of(hashes: np.ndarray, ranges: int) -> np.ndarray:
    """The range of each hash, by its upper 32 bits."""
    return ((hashes >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)


def filter_of(hashes: DataFrame, column: str, bits: int = FILTER_BITS) -> np.ndarray:
    """A bitmap (64 bits a word) of the lowest bits of a column of 64-bit hashes."""
    bit = F.col(column).bitwiseAND(F.lit(bits - 1))
    words = (
        hashes.select(F.shiftright(bit, 6).alias("word"), bit.bitwiseAND(F.lit(63)).cast("int").alias("bit"))
        .groupBy("word")
        .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit"))).alias("bits"))
    )
    with short_batches(hashes.sparkSession):
        words = words.toArrow()
    found = np.zeros(bits >> 6, dtype=np.uint64)
    found[words.column("word").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    return found


def in_filter(held: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    bit = hashes & np.uint64(len(held) * 64 - 1)
    return (held[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63)) & np.uint64(1)).astype(bool)


def packed(ranges: int, where: np.ndarray, **columns: np.ndarray) -> list[dict]:
    """One row for each range that occurs, with the bytes of its part of every column; `where` ascends."""
    cut = np.searchsorted(where, np.arange(ranges + 1))
    return [
        {"range": int(r)} | {name: values[cut[r] : cut[r + 1]].tobytes() for name, values in columns.items()}
        for r in np.flatnonzero(np.diff(cut))
    ]


def packed_schema(*names: str) -> pa.Schema:
    return pa.schema([("range", pa.int32()), *[(name, pa.binary()) for name in names]])


def packed_ddl(*names: str) -> str:
    return ", ".join(["range int", *[f"{name} binary" for name in names]])


def joined(column: pa.ChunkedArray, kind) -> np.ndarray:
    """The packed numbers of a column as one array."""
    parts = [np.frombuffer(x.as_buffer(), kind) for x in column]
    return np.concatenate(parts) if parts else np.zeros(0, kind)
