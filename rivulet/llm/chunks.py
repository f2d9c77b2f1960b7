"""Substring deduplication by content-defined chunks.

A gear hash rolls over the bytes of a text: each byte shifts the hash left by one and adds its own random
number, so the hash, of `WINDOW` bits, depends on the last `WINDOW` bytes. Where its upper `AVERAGE_BITS` bits are zero a chunk
ends, if it has at least `LEAST` bytes; a chunk ends at `MOST` bytes anyhow. An insertion moves the
boundaries next to it and no others. Chunks are known by digest (128 bits); the first, by doc_id and
place, stays; later ones go where they run for `LEAST_RUN` bytes or make up the whole text. Passages of
50 words hold such a run, once their edges are off; a short stock phrase within a text stays.

Digests meet by range, each task's own repeats told before. Nothing is gathered by chunk, so a chunk
that stands in very many documents is one entry per task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.llm.blocks import filter_of, in_filter, joined, packed, packed_ddl, packed_schema, range_of, ranges_of
from rivulet.llm.bytetext import SubstringHash, text_slices
from rivulet.llm.spans import digested, keyed
from rivulet.llm.tables import stored

WINDOW = 32
AVERAGE_BITS = 4
LEAST, MOST = 16, 160
SEED = 20
LEAST_RUN = 64
CHUNK_FILTER_BITS = 1 << 26


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """The rolling hash behind each byte, for all bytes at once: the sum over the last `WINDOW` bytes, each
    shifted by its distance, doubled up from 1 to all of them."""
    gear = np.random.default_rng(SEED).integers(0, 1 << WINDOW, 256, dtype=np.uint32)
    out, width = gear[data], 1
    while width < WINDOW:
        before = np.zeros_like(out)
        before[width:] = out[:-width] << np.uint32(width)
        out = out + before
        width *= 2
    return out


def chunk_ends(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, start and end of every chunk of some texts. A hash sees its own text only from `WINDOW` bytes on;
    before that it also sees the text before, so boundaries there are left out."""
    marks = np.flatnonzero(gear_hashes(data) >> np.uint32(WINDOW - AVERAGE_BITS) == 0) + 1
    rows, starts, ends = [], [], []
    for row in range(len(offsets) - 1):
        begin, end = int(offsets[row]), int(offsets[row + 1])
        mine = marks[np.searchsorted(marks, begin + WINDOW) : np.searchsorted(marks, end)].tolist()
        at, cuts = begin, []
        for mark in mine:
            if mark - at < LEAST:
                continue
            while mark - at > MOST:
                at += MOST
                cuts.append(at)
            if mark - at >= LEAST:
                at = mark
                cuts.append(at)
        while end - at > MOST:
            at += MOST
            cuts.append(at)
        if end > at:
            cuts.append(end)
        starts += [begin, *cuts[:-1]] if cuts else []
        ends += cuts
        rows += [row] * len(cuts)
    return np.array(rows, np.int64), np.array(starts, np.int64), np.array(ends, np.int64)


def _chunks(batch: pa.RecordBatch):
    """(row, start in its text, end, bytes of the text, two hashes) of every chunk of a batch."""
    for first, _, data, offsets in text_slices(batch.column("text")):
        rows, starts, ends = chunk_ends(data, offsets)
        hashes = SubstringHash(data).of(starts, ends), SubstringHash(data, seed=2).of(starts, ends)
        yield first + rows, starts - offsets[rows], ends - offsets[rows], offsets[rows + 1] - offsets[rows], *hashes


def first_chunks(docs: DataFrame) -> DataFrame:
    """hash, check and the first occurrence (rank, key, start) of every chunk that is found again."""
    ranges = ranges_of(docs.sparkSession)
    kinds = {
        "hashes": np.uint64, "checks": np.uint64, "ranks": np.int64, "keys": np.int64, "starts": np.int32, "again": bool
    }

    def firsts(found: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        order = np.lexsort([found[x] for x in ("starts", "keys", "ranks", "checks", "hashes")])
        found = {name: values[order] for name, values in found.items()}
        hashes, checks = found["hashes"], found["checks"]
        new = np.ones(len(order), bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (checks[1:] != checks[:-1])
        at = np.flatnonzero(new)
        again = np.logical_or.reduceat(found["again"], at) if len(at) else found["again"]
        several = np.diff(np.append(at, len(order))) > 1
        return {name: values[at] for name, values in found.items()} | {"again": again | several}

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ranks, keys = batch.column("rank").to_numpy(), batch.column("key").to_numpy()
            for rows, starts, _, _, hashes, checks in _chunks(batch):
                found = firsts(
                    {
                        "hashes": hashes,
                        "checks": checks,
                        "ranks": ranks[rows],
                        "keys": keys[rows],
                        "starts": starts.astype(np.int32),
                        "again": np.zeros(len(rows), bool),
                    }
                )
                yield pa.RecordBatch.from_pylist(
                    packed(ranges, range_of(found["hashes"], ranges), **found), packed_schema(*kinds)
                )

    def meet(table: pa.Table) -> pa.Table:
        found = firsts({name: joined(table.column(name), kind) for name, kind in kinds.items()})
        held = {name: values[found["again"]] for name, values in found.items()}
        return pa.table(
            {
                "hash": held["hashes"].view(np.int64),
                "check": held["checks"].view(np.int64),
                "rank": held["ranks"],
                "of": held["keys"],
                "at": held["starts"],
            }
        )

    parted = docs.select("text", "rank", "key").mapInArrow(spread, packed_ddl(*kinds))
    return parted.groupBy("range").applyInArrow(meet, "hash long, check long, rank long, of long, at int")


def repeated_spans(docs: DataFrame, least_run: int = LEAST_RUN) -> DataFrame:
    """key and spans of the chunks that stood earlier, where such chunks run for `least_run` bytes
    or over the whole text."""
    firsts = stored(first_chunks(docs), "chunks")
    held = filter_of(firsts, "hash", CHUNK_FILTER_BITS)

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("key").to_numpy()
            for rows, starts, ends, sizes, hashes, checks in _chunks(batch):
                some = in_filter(held, hashes)
                columns = (
                    keys[rows[some]],
                    starts[some].astype(np.int32),
                    ends[some].astype(np.int32),
                    sizes[some].astype(np.int32),
                    hashes[some].view(np.int64),
                    checks[some].view(np.int64),
                )
                yield pa.RecordBatch.from_arrays(
                    list(map(pa.array, columns)), names=["key", "first", "last", "size", "hash", "check"]
                )

    found = docs.select("text", "key").mapInArrow(again, "key long, first int, last int, size int, hash long, check long")
    later = found.join(firsts.drop("rank"), ["hash", "check"]).where("key <> of OR first <> at")
    runs = later.groupBy("key").agg(F.sort_array(F.collect_set(F.struct("first", "last"))).alias("runs"), F.max("size").alias("size"))

    def grown(spans: Column, run: Column) -> Column:
        end = F.get(spans, F.size(spans) - 1)
        widened = F.struct(end["first"].alias("first"), run["last"].alias("last"))
        joins = (F.size(spans) > 0) & (run["first"] == end["last"])
        return F.when(joins, F.concat(F.slice(spans, F.lit(1), F.size(spans) - 1), F.array(widened))).otherwise(
            F.concat(spans, F.array(run))
        )

    nothing = F.array().cast("array<struct<first:int,last:int>>")
    spans = F.filter(F.aggregate("runs", nothing, grown), lambda s: s["last"] - s["first"] >= F.least(F.lit(least_run), "size"))
    return runs.select("key", spans.alias("spans")).where(F.size("spans") > 0)


def deduplicated(docs: DataFrame, least_run: int = LEAST_RUN) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document, one row for each row of `docs`.

    Reads `doc_id` and `text`; other columns may bear any name. Null text is empty. The first occurrence of a
    chunk, by doc_id (numbers ascending, null last; other ids by hash) and place, stays. Rows that agree in
    doc_id and text are one document. An empty table gives no rows.
    """
    whole = docs.schema["doc_id"].dataType.typeName() in ("byte", "short", "integer", "long")
    rank = F.col("doc_id").cast("long") if whole else F.xxhash64("doc_id")
    docs = keyed(docs).withColumn("rank", F.coalesce(rank, F.lit((1 << 63) - 1)))
    return digested(docs.drop("rank"), stored(repeated_spans(docs, least_run), "chunk-spans"))
