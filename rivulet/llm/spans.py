"""Bytes to be taken out of texts: `spans` (first, last excluded; ascending, apart) by the key of a row."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.llm.blocks import filter_of, in_filter


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text and a key that rows share if they agree in both."""
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn(
        "key", F.xxhash64("doc_id", "text")
    )


def _may_be_in(keys: DataFrame) -> Column:
    held = filter_of(keys, "key")

    @F.arrow_udf("boolean")
    def may(key: pa.Array) -> pa.Array:
        return pa.array(in_filter(held, key.to_numpy(zero_copy_only=False).view(np.uint64)))

    return may(F.col("key"))


def only_keys(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows of `docs` that may be among the keys, told by a bitmap before anything is shuffled."""
    return docs.where(_may_be_in(keys))


def with_spans(docs: DataFrame, spans: DataFrame, change: Callable[[DataFrame], DataFrame] = lambda some: some) -> DataFrame:
    """`docs` without `key` and with `spans`; only texts that may have some are shuffled. `change` is made to
    these rows, which leaves their columns; the others, which have no spans, pass as they are."""
    docs = docs.withColumn("_may", _may_be_in(spans))
    of = spans.withColumnRenamed("key", "_of")
    some = change(docs.where("_may").join(of, F.col("key") == F.col("_of"), "left").drop("_of", "_may", "key"))
    none = F.lit(None).cast(spans.schema["spans"].dataType)
    return some.unionByName(docs.where("NOT _may").drop("_may", "key").withColumn("spans", none))


def kept_bytes(text, spans) -> bytes:
    at, parts = 0, []
    for span in spans or ():
        parts.append(text[at : span["first"]])
        at = span["last"]
    return b"".join([*parts, text[at:]])


def digested(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every row of `docs` (as by `keyed`)."""

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = {"n_bytes": [], "n_removed": [], "n_spans": [], "kept_sha256": []}
            for text, runs in zip(batch.column("text"), batch.column("spans")):
                text, runs = text.as_buffer(), runs.as_py()
                kept = kept_bytes(memoryview(text), runs)
                rows["n_bytes"].append(len(text))
                rows["n_removed"].append(len(text) - len(kept))
                rows["n_spans"].append(len(runs or ()))
                rows["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *map(pa.array, rows.values())], names=["doc_id", *rows]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return with_spans(docs, spans).mapInArrow(
        told, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    )
