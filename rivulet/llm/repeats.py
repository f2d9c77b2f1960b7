"""Removal of long repeated byte strings by a distributed suffix order.

A byte goes if a string of `LENGTH` bytes that covers it also starts anywhere else.

1. Texts are cut into phrases at anchors (see `anchors`). A string of LENGTH bytes has an anchor among its
   first WINDOW bytes, and what stands right of it, LENGTH - WINDOW + 1 bytes (the core), holds the two
   phrases from there on. Phrases that the corpus holds once are discarded: they end every match. A bitmap
   of fixed size tells which; a false hit keeps a phrase that could have gone.
2. The suffixes of what is left, as strings of phrases, are ordered by the difference-cover algorithm
   (see `suffixes`). Neighbours in the order that agree in two phrases hold all matches.
3. Exact check: per anchor, the stretch of text that its strings cover is compared as a whole with
   those of equal core. If a stretch stands elsewhere, all of its strings do. Stretches whose core is
   found with other stretches are unfolded into their strings, one of each kind, and these are
   compared by hash.

Passages can be judged by words instead: each word is one symbol of WORD_BYTES bytes, its hash, and a text is
the row of these. All of the above holds for such bytes; strings begin where a word does.

Hashes of text that decide are of 128 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.llm.anchors import GRAM, WINDOW, anchors
from rivulet.llm.blocks import (
    filter_of,
    in_filter,
    joined,
    packed,
    packed_ddl,
    packed_schema,
    range_of,
    ranges_of,
)
from rivulet.llm.bytetext import SLICE_BYTES, SubstringHash, give_back, text_slices, word_spans
from rivulet.llm.spans import digested, kept_bytes, keyed, only_keys, with_spans
from rivulet.llm.suffixes import distinct_suffixes, key_hash, keyed_suffixes, neighbours_agree
from rivulet.llm.tables import forget, nested, stored, writing_tasks

LENGTH = 400
# Passages of so many words go from the documents of a corpus, be they shorter than LENGTH.
PASSAGE = 50
WORD_BYTES = 8
PHRASE_FILTER_BITS = 1 << 26
# Strings that one range of hashes holds at least, so that tasks do not hand on many rows of a few strings each.
RANGE_STRINGS = 1 << 15
# Bytes of text that are worked on at a time.
SLICE = 1 << 19


def _slices(texts: pa.Array, step: int, most: int = SLICE_BYTES):
    """As `text_slices`: the bytes of the texts, or with a step of WORD_BYTES the codes of their words."""
    for first, count, data, offsets in text_slices(texts, most):
        if step == WORD_BYTES:
            starts, stops, _ = word_spans(data, offsets)
            codes = SubstringHash(data).of(starts, stops)
            data, offsets = codes.view(np.uint8), WORD_BYTES * np.searchsorted(starts, offsets)
        yield first, count, data, offsets


def _phrases(texts: pa.Array, step: int):
    """(first row, rows, bytes, offsets, hashes, anchors, hashes of their phrases)."""
    for first, count, data, offsets in _slices(texts, step, SLICE):
        found = anchors(data, offsets)
        hashes = SubstringHash(data)
        _, place, following, _, _ = found
        phrase = np.zeros(len(place), np.uint64)
        some = following >= 0
        phrase[some] = hashes.of(place[some], following[some])
        yield first, count, data, offsets, hashes, found, phrase
    give_back()


def repeated_phrases(docs: DataFrame, step: int) -> np.ndarray:
    """The bitmap of phrases that stand in the corpus more than once."""
    ranges = ranges_of(docs.sparkSession)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, _, _, _, found, phrase in _phrases(batch.column("text"), step):
                values, n = np.unique(phrase[found[2] >= 0], return_counts=True)
                yield pa.RecordBatch.from_pylist(
                    packed(ranges, range_of(values, ranges), hashes=values, often=(n > 1).astype(np.uint8)),
                    packed_schema("hashes", "often"),
                )

    def meet(table: pa.Table) -> pa.Table:
        hashes, often = joined(table.column("hashes"), np.uint64), joined(table.column("often"), np.uint8)
        values, at = np.unique(hashes, return_inverse=True)
        again = values[np.bincount(at, 1 + often.astype(np.int64), minlength=len(values)) > 1]
        return pa.table({"hash": pa.array(again.view(np.int64))})

    counted = docs.select("text").mapInArrow(spread, packed_ddl("hashes", "often")).groupBy("range")
    return filter_of(counted.applyInArrow(meet, "hash long"), "hash", PHRASE_FILTER_BITS)


_STRING = (
    "key long, number int, symbols array<long>, bytes array<long>, first array<int>, last array<int>, "
    "core array<long>, stretch array<binary>"
)


def least_shared(length: int) -> int:
    """Bytes of whole phrases that two equal strings of `length` bytes share from their anchor on: the next
    anchor is told by WINDOW + GRAM bytes, so phrases go on as long as these lie in the core."""
    return length - 2 * WINDOW - GRAM + 2


def phrase_strings(docs: DataFrame, repeated: np.ndarray, length: int, step: int) -> DataFrame:
    """Runs of repeated phrases, one row for each: their hashes and bytes, the starts (each `step` bytes behind
    the other) of the strings whose anchor begins them, and hashes of the core and of the stretch that those
    strings cover."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("key").to_numpy()
            for first, _, data, offsets, hashes, found, phrase in _phrases(batch.column("text"), step):
                row, place, following, start, stop = found
                held = np.flatnonzero((following >= 0) & in_filter(repeated, phrase))
                if not len(held):
                    continue
                new = np.ones(len(held), bool)
                new[1:] = (np.diff(held) > 1) | (row[held[1:]] != row[held[:-1]])
                cut = np.append(np.flatnonzero(new), len(held))
                # A match has two phrases and so many bytes of them at least.
                run_bytes = np.add.reduceat((following - place)[held], cut[:-1])
                several = np.flatnonzero((np.diff(cut) > 1) & (run_bytes >= least_shared(length)))
                held = held[np.repeat(np.isin(np.arange(len(cut) - 1), several), np.diff(cut))]
                cut = np.concatenate([[0], np.cumsum(np.diff(cut)[several])]).astype(np.int32)
                row, place, following, start, stop = (x[held] for x in (row, place, following, start, stop))
                end = offsets[row + 1]
                stop = np.minimum(stop, end - length + 1)
                # The first and the last start that are a whole number of steps from where the text begins.
                start = start + (offsets[row] - start) % step
                stop = np.maximum(stop - (stop - 1 - offsets[row]) % step, start)
                strings = stop > start
                core = np.zeros(len(held), np.uint64)
                core[strings] = hashes.of(place[strings], place[strings] + length - WINDOW + 1)
                both = np.zeros((len(held), 2), ">u8")
                reach = stop[strings] - 1 + length
                both[strings, 0] = hashes.of(start[strings], reach)
                both[strings, 1] = SubstringHash(data, seed=2).of(start[strings], reach)
                lists = [
                    pa.array((phrase[held] >> np.uint64(1)).view(np.int64) + 1),
                    pa.array(following - place),
                    pa.array((start - offsets[row]).astype(np.int32)),
                    pa.array((stop - offsets[row]).astype(np.int32)),
                    pa.array(core.view(np.int64)),
                    pa.array([x.tobytes() for x in both], pa.binary()),
                ]
                of = row[cut[:-1]]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(keys[first + of]),
                        pa.array(place[cut[:-1]].astype(np.int32) - offsets[of].astype(np.int32)),
                        *[pa.ListArray.from_arrays(cut, x) for x in lists],
                    ],
                    names=["key", "number", "symbols", "bytes", "first", "last", "core", "stretch"],
                )

    return docs.select("key", "text").mapInArrow(run, _STRING)


def repeated_starts(docs: DataFrame, length: int, step: int, tasks: int) -> tuple[DataFrame, list[DataFrame]]:
    """key, first, last: runs of starts (last excluded) of strings of `length` bytes that also start elsewhere,
    and the stored frames that they are read from. `docs` as by `keyed`; `length` is at least 3 * WINDOW + 8.
    Each step is written by `tasks` at most."""
    repeated = repeated_phrases(docs, step)
    strings = phrase_strings(docs, repeated, length, step)
    # Equal strings are one to the order. They are told by a hash of 128 bits.
    content = F.struct(F.xxhash64("symbols").alias("h"), F.xxhash64(F.lit(1), "symbols").alias("k"))
    strings = stored(strings.withColumn("string", content), "phrases", tasks)
    single = strings.groupBy("string").agg(
        F.first("symbols").alias("symbols"), F.first("bytes").alias("bytes"), F.count("*").alias("n")
    )
    single = stored(single, "strings", tasks)
    # Whole phrases of the core are shared until one begins behind this many bytes.
    suffixes = keyed_suffixes(single.select("string", "symbols", "bytes"), least_shared(length), tasks)
    distinct = distinct_suffixes(suffixes, tasks)
    near = suffixes.select("string", "i", key_hash().alias("suffix"))
    near = near.join(neighbours_agree(distinct), "suffix", "left_semi").select("string", "i")
    several = single.where("n > 1").select("string", F.explode(F.sequence(F.lit(0), F.size("symbols") - 1)).alias("i"))
    near = stored(near.union(several).groupBy("string").agg(F.collect_set("i").alias("places")), "near", tasks)
    forget(suffixes, distinct, single)
    spot = lambda name: F.get(name, F.col("i")).alias(name)
    spots = (
        strings.join(near, "string")
        .select("key", "first", "last", "core", "stretch", F.explode("places").alias("i"))
        .select("key", spot("first"), spot("last"), spot("core"), spot("stretch"))
        .where("last > first")
    )
    spots = stored(spots, "spots", tasks)
    forget(strings, near)
    kinds = spots.groupBy("core", "stretch").agg(
        F.count("*").alias("n"), F.min(F.struct("key", "first", "last")).alias("one")
    )
    kinds = stored(kinds, "stretches", tasks)
    whole = spots.join(kinds.where("n > 1").select("stretch"), "stretch", "left_semi").select("key", "first", "last")
    several = kinds.groupBy("core").agg(F.count("*").alias("kinds")).where("kinds > 1").select("core")
    unfold = kinds.join(several, "core", "left_semi").select("one.*")
    unfold = stored(unfold.groupBy("key").agg(F.collect_set(F.struct("first", "last")).alias("runs")), "unfold", tasks)
    return whole.union(_equal_strings(docs, unfold, length, step)), [spots, kinds, unfold]


def ranges_for(unfold: DataFrame, step: int) -> int:
    """Ranges for the strings of `unfold`: as many as they fill, up to those that suit the session."""
    run = unfold.select(F.explode("runs").alias("run"))
    strings = (run.agg(F.sum(F.col("run.last").cast("long") - F.col("run.first"))).first()[0] or 0) // step
    return min(ranges_of(unfold.sparkSession), 1 + strings // RANGE_STRINGS)


def _equal_strings(docs: DataFrame, unfold: DataFrame, length: int, step: int) -> DataFrame:
    """Of the starts in `unfold` (key, runs of them), those whose strings equal another's, as runs."""
    ranges = ranges_for(unfold, step)
    texts = only_keys(docs, unfold).join(unfold.withColumnRenamed("key", "of"), F.col("key") == F.col("of"))
    # Rows that repeat bring the same strings; one of them is enough, as their stretches are found whole.
    texts = texts.select("key", "text", "runs").groupBy("key").agg(F.first("text").alias("text"), F.first("runs").alias("runs"))
    names = ("hashes", "checks", "keys", "starts")

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, runs = batch.column("key").to_numpy(), batch.column("runs")
            for first, count, data, offsets in _slices(batch.column("text"), step):
                starts, of = [], []
                for k in range(count):
                    for x in runs[first + k].as_py():
                        starts.append(np.arange(x["first"], x["last"], step) + offsets[k])
                        of.append(np.full(len(starts[-1]), k))
                starts, of = np.concatenate(starts), np.concatenate(of)
                found = SubstringHash(data).of(starts, starts + length)
                check = SubstringHash(data, seed=2).of(starts, starts + length)
                where = range_of(found, ranges).astype(np.int64)
                order = np.argsort(where, kind="stable")
                place = (starts - offsets[of]).astype(np.int32)
                yield pa.RecordBatch.from_pylist(
                    packed(
                        ranges,
                        where[order],
                        hashes=found[order],
                        checks=check[order],
                        keys=keys[first + of][order],
                        starts=place[order],
                    ),
                    packed_schema(*names),
                )

    def meet(table: pa.Table) -> pa.Table:
        found, check = joined(table.column("hashes"), np.uint64), joined(table.column("checks"), np.uint64)
        keys, starts = joined(table.column("keys"), np.int64), joined(table.column("starts"), np.int32)
        order = np.lexsort((check, found))
        same = (found[order][1:] == found[order][:-1]) & (check[order][1:] == check[order][:-1])
        again = np.zeros(len(order), bool)
        again[1:] |= same
        again[:-1] |= same
        return pa.table({"key": pa.array(keys[order][again]), "start": pa.array(starts[order][again])})

    parted = texts.mapInArrow(spread, packed_ddl(*names))
    starts = parted.groupBy("range").applyInArrow(meet, "key long, start int")
    return starts.groupBy("key").agg(F.sort_array(F.collect_set("start")).alias("starts")).select(
        "key", F.explode(_runs("starts", step)).alias("run")
    ).select("key", "run.first", "run.last")


def _runs(starts: str, step: int):
    """Ascending numbers as runs."""
    begins = F.filter(starts, lambda x, i: (i == 0) | (F.get(starts, i - 1) != x - step))
    ends = F.filter(starts, lambda x, i: (i + 1 == F.size(starts)) | (F.get(starts, i + 1) != x + step))
    return F.transform(
        F.arrays_zip(begins.alias("b"), ends.alias("e")),
        lambda z: F.struct(z["b"].alias("first"), (z["e"] + 1).alias("last")),
    )


def removed_spans(docs: DataFrame, length: int = LENGTH, step: int = 1) -> DataFrame:
    """key and spans (first, last; ascending, apart) of the bytes to be removed, stored."""
    tasks = writing_tasks(docs)
    starts, used = repeated_starts(docs, length, step, tasks)
    starts = starts.groupBy("key").agg(
        F.sort_array(F.collect_set(F.struct("first", "last"))).alias("runs")
    )
    nothing = F.array().cast("array<struct<first:int,last:int>>")

    def grown(spans, run):
        last = F.get(spans, F.size(spans) - 1)
        reach = (run["last"] - 1 + length).cast("int")
        joins = (F.size(spans) > 0) & (run["first"] <= last["last"])
        widened = F.struct(last["first"].alias("first"), F.greatest(last["last"], reach).alias("last"))
        return F.when(
            joins, F.concat(F.slice(spans, F.lit(1), F.size(spans) - 1), F.array(widened))
        ).otherwise(F.concat(spans, F.array(F.struct(run["first"].alias("first"), reach.alias("last")))))

    spans = stored(starts.select("key", F.aggregate("runs", nothing, grown).alias("spans")), "spans", tasks)
    forget(*used)
    return spans


def _runs_of_bytes(text: bytes, runs: list[dict]) -> list[dict]:
    """Runs of bytes, and of words by their codes, as runs of bytes that lie apart."""
    starts, stops, _ = word_spans(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
    places = sorted(
        (int(starts[x["first"] // WORD_BYTES]), int(stops[x["last"] // WORD_BYTES - 1])) if x["words"] else (x["first"], x["last"])
        for x in runs
    )
    apart = []
    for first, last in places:
        if apart and first <= apart[-1]["last"]:
            apart[-1]["last"] = max(last, apart[-1]["last"])
        else:
            apart.append({"first": first, "last": last})
    return apart


def trimmed(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document, one row for each row of `docs`.

    Reads `doc_id` and `text`; other columns may bear any name. Null text is empty. Matches may overlap and may
    lie in one document, never across two. Of rows that repeat each is a document of its own, so their
    long passages go from all. An empty table gives no rows.
    """
    docs = keyed(docs)
    return digested(docs, removed_spans(docs, length))


def without_repeats(docs: DataFrame, length: int = LENGTH, words: int = PASSAGE) -> DataFrame:
    """The documents with all their columns, the strings of `length` bytes and of `words` words that also
    start elsewhere taken out of `text`; words are parted by white space, however much. Both are judged on the input.
    A character that loses some of its bytes goes as a whole; `n_chars`, if there is one, is counted anew."""
    by_unit = [(False, removed_spans(keyed(docs), length)), (True, removed_spans(keyed(docs), words * WORD_BYTES, WORD_BYTES))]
    named = [
        found.select("key", F.explode("spans").alias("run")).select("key", F.struct("run.*", F.lit(unit).alias("words")).alias("run"))
        for unit, found in by_unit
    ]
    spans = stored(named[0].union(named[1]).groupBy("key").agg(F.collect_list("run").alias("spans")), "cuts", writing_tasks(docs))
    forget(*[found for _, found in by_unit])

    @F.arrow_udf("string")
    def cut(texts: pa.Array, spans: pa.Array) -> pa.Array:
        out = []
        for text, runs in zip(texts, spans):
            runs = runs.as_py()
            if not runs or not text.is_valid:
                out.append(text.as_py())
            else:
                whole = text.as_py().encode()
                out.append(kept_bytes(whole, _runs_of_bytes(whole, runs)).decode(errors="ignore"))
        return pa.array(out, pa.string())

    rows = nested(docs, key=F.xxhash64("doc_id", F.coalesce("text", F.lit(""))), text=F.col("text"))
    done = with_spans(rows, spans, lambda some: some.withColumn("text", cut(F.col("text"), F.col("spans"))))
    changed = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        counted = F.length("text").cast(docs.schema["n_chars"].dataType)
        changed["n_chars"] = F.when(F.col("spans").isNotNull(), counted).otherwise(F.col("row.n_chars"))
    return done.select(*[changed.get(name, F.col(f"row.`{name}`")).alias(name) for name in docs.columns])
