"""Grouped prefix join: documents whose sets of word shingles have a Jaccard similarity of at least 3/4.

Shingles are put in one order for all documents: those of many documents last, by hash otherwise. Two
sets that link share a shingle among the first n - ceil(3n/4) + 1 of each (the prefix), and the
smaller of the two holds it among its first n - ceil(6n/7) + 1. So:

1. Copies (equal sets) are one class, classes with equal prefix and size are one group. Only groups
   are indexed.
2. The order: a count of all shingles says which are frequent. They are kept in a bitmap of fixed size.
   A false hit moves a shingle back in the order of all documents alike, so the bitmap bears on speed
   only.
3. Group pairs that share a prefix shingle and whose sizes allow a link are expanded to their classes.
   Counts of shingles by range of hash bound what two sets can share; of the pairs left, the whole
   sets are compared.
4. Shingles that many groups have in the prefix are not paired all with all: each of their groups is
   compared with a few leaders of about its size first, some with as few rare shingles as any, some by
   hash. The links found make components, and then every pair of groups that share such a shingle and
   still lie in different components is compared. The same goes for the classes of one group. No pair
   that could join two components is left out, and pairs within a component need no comparison.
5. A group whose prefix reaches its frequent shingles has all its rare ones in it. Two such groups that share
   no rare one there share none at all, so at most the frequent shingles of the one that has fewer: where
   that is too little for a link, the pair is not made. Near copies of one text with so many changes
   that they link to nothing are never held against each other, the others link to a leader.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

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
from rivulet.llm.bytetext import SubstringHash, distinct_in_rows, give_back, lower_ascii, mixed, text_slices, word_spans
from rivulet.llm.components import components
from rivulet.llm.tables import by_few, forget, nested, stored, writing_tasks

SHINGLE = 5
FREQUENT = 24
LEADERS = 4
# Bytes of text that are worked on at a time.
SLICE = 1 << 19
CELLS = 256
WHOLE, PART = 4, 3  # a link: WHOLE * intersection >= PART * union


def shingles(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, rows, row within, hash) of all shingles of whole texts."""
    for first, count, data, offsets in text_slices(texts, SLICE):
        data = lower_ascii(data)
        starts, ends, rows = word_spans(data, offsets)
        words = SubstringHash(data).of(starts, ends)
        begin = np.searchsorted(rows, np.arange(count + 1))
        size = np.diff(begin)
        at = np.arange(len(words))
        at = at[at + SHINGLE <= begin[rows + 1]] if len(rows) else at
        short = np.flatnonzero((size > 0) & (size < SHINGLE))
        hashes = SubstringHash(words, seed=3)
        found = np.concatenate([hashes.of(at, at + SHINGLE), hashes.of(begin[short], begin[short + 1])])
        yield first, count, np.concatenate([rows[at], short]), found
    give_back()


class Sets:
    """The sets of some rows, each in the common order."""

    def __init__(self, count: int, rows: np.ndarray, found: np.ndarray, frequent: np.ndarray | None):
        late = in_filter(frequent, found) if frequent is not None else np.zeros(len(found), bool)
        keys, self.shingles, _ = distinct_in_rows(rows * 2 + late, found)
        self.rows, self.late = keys >> 1, (keys & 1).astype(bool)
        self.begin = np.searchsorted(self.rows, np.arange(count + 1))
        self.size = np.diff(self.begin)
        self.rank = np.arange(len(self.rows)) - self.begin[self.rows]

    def among_first(self, share: int, of: int) -> np.ndarray:
        """Which shingles are among the first n - ceil(n * share / of) + 1."""
        most = self.size - -(-self.size * share // of) + 1
        return self.rank < most[self.rows]

    def digests(self, held: np.ndarray, seed: int) -> np.ndarray:
        """Per row a hash of the shingles `held`, whatever their order."""
        terms = np.where(held, mixed(self.shingles + np.uint64(seed)), np.uint64(0))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)])
        return mixed(sums[self.begin[1:]] - sums[self.begin[:-1]] + self.size.astype(np.uint64))

    def classes(self) -> pa.Array:
        """16 bytes per row that equal sets share."""
        every = np.ones(len(self.rows), bool)
        both = np.stack([self.digests(every, 11), self.digests(every, 12)], axis=1).astype(">u8")
        return pa.array([bytes(x) for x in both], pa.binary())

    def sketches(self) -> pa.Array:
        """How many shingles each of `CELLS` ranges of the hash holds; null where one holds 255 or more."""
        cell = (self.shingles >> np.uint64(56)).astype(np.int64)
        counts = np.bincount(self.rows * CELLS + cell, minlength=len(self.size) * CELLS).reshape(-1, CELLS)
        told = counts.astype(np.uint8)
        return pa.array([x.tobytes() if fits else None for x, fits in zip(told, counts.max(axis=1) < 255)], pa.binary())

    def shareable(self) -> np.ndarray:
        """How many shingles a row may share with one that it shares a frequent prefix shingle with, but no
        rare one: its frequent ones; 0 where the prefix holds none of them."""
        reaches = np.bincount(self.rows[self.late & self.among_first(PART, WHOLE)], minlength=len(self.size)) > 0
        return np.where(reaches, np.bincount(self.rows[self.late], minlength=len(self.size)), 0)

    def groups(self) -> np.ndarray:
        return self.digests(self.among_first(PART, WHOLE), 13).view(np.int64)


def _packed_counts(ranges: int):
    """Task side of the count: the lower halves of the shingles' hashes, by range of the upper ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, count, rows, found in shingles(batch.column("text")):
                values, n = np.unique(Sets(count, rows, found, None).shingles, return_counts=True)
                low = (values & np.uint64(0xFFFFFFFF)).astype(np.uint32)
                n = np.minimum(n, 255).astype(np.uint8)
                yield pa.RecordBatch.from_pylist(
                    packed(ranges, range_of(values, ranges), hashes=low, counts=n), packed_schema("hashes", "counts")
                )

    return run


def _frequent(table: pa.Table) -> pa.Table:
    hashes, counts = joined(table.column("hashes"), np.uint32), joined(table.column("counts"), np.uint8)
    values, at = np.unique(hashes, return_inverse=True)
    many = values[np.bincount(at, counts, minlength=len(values)) >= FREQUENT]
    return pa.table({"hash": pa.array(many.astype(np.int64))})


def frequent_shingles(docs: DataFrame) -> np.ndarray:
    """The bitmap of frequent shingles. Counts meet by range of the hash, summed per task before."""
    counted = docs.select("text").mapInArrow(
        _packed_counts(ranges_of(docs.sparkSession)), packed_ddl("hashes", "counts")
    )
    return filter_of(counted.groupBy("range").applyInArrow(_frequent, "hash long"), "hash")


def described(docs: DataFrame, frequent: np.ndarray) -> DataFrame:
    """doc_id, hash (of the text), n, class, group, f (see `Sets.shareable`), sketch and the frequent shingles
    in the prefix of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, count, rows, found in shingles(batch.column("text")):
                sets = Sets(count, rows, found, frequent)
                late = np.flatnonzero(sets.late & sets.among_first(PART, WHOLE))
                cut = np.searchsorted(sets.rows[late], np.arange(count + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(first, count),
                        batch.column("hash").slice(first, count),
                        pa.array(sets.size.astype(np.int64)),
                        sets.classes(),
                        pa.array(sets.groups()),
                        pa.array(sets.shareable().astype(np.int64)),
                        sets.sketches(),
                        pa.ListArray.from_arrays(cut, pa.array(sets.shingles[late].view(np.int64))),
                    ],
                    names=["doc_id", "hash", "n", "class", "group", "f", "sketch", "late"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text", _text_hash(F.col("text")).alias("hash")).mapInArrow(
        run, f"doc_id {kind}, hash long, n long, class binary, group long, f long, sketch binary, late array<long>"
    )


def _text_hash(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _meet(table: pa.Table) -> pa.Table:
    """One range of shingles: which groups meet."""
    one = np.uint64(1)
    keys, times = joined(table.column("keys"), np.uint64), joined(table.column("times"), np.int32)
    groups = np.repeat(joined(table.column("groups"), np.int64), times)
    sizes = np.repeat(joined(table.column("sizes"), np.int64), times)
    order = np.lexsort((groups, sizes, keys >> one))
    keys, groups, sizes = keys[order], groups[order], sizes[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (groups[1:] != groups[:-1]) | (sizes[1:] != sizes[:-1])
    keys, groups, sizes = keys[new], groups[new], sizes[new]
    near, keys = (keys & one).astype(bool), keys >> one
    begin = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    share = np.diff(np.append(begin, len(keys)))
    many = np.repeat(share >= FREQUENT, share)
    cells = pa.table(
        {
            "shingle": pa.array(keys[many].view(np.int64)),
            "a": pa.array(groups[many]),
            "b": pa.nulls(int(many.sum()), pa.int64()),
            "n": pa.array(sizes[many]),
        }
    )
    keys, groups, sizes, near = keys[~many], groups[~many], sizes[~many], near[~many]
    # By size within a shingle: the first of a pair is the smaller one.
    found = [np.zeros((0, 2), np.int64)]
    for apart in range(1, FREQUENT):
        at = np.arange(max(len(keys) - apart, 0))
        other = at + apart
        good = (keys[at] == keys[other]) & (groups[at] != groups[other])
        good &= (WHOLE * sizes[at] >= PART * sizes[other]) & near[at] & (near[other] | (sizes[at] < sizes[other]))
        a, b = groups[at[good]], groups[other[good]]
        found.append(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1))
    pairs = np.unique(np.concatenate(found), axis=0)
    none = pa.nulls(len(pairs), pa.int64())
    pairs = pa.table({"shingle": none, "a": pa.array(pairs[:, 0]), "b": pa.array(pairs[:, 1]), "n": none})
    return pa.concat_tables([cells, pairs])


def rare_meetings(docs: DataFrame, frequent: np.ndarray) -> DataFrame:
    """Groups that share a prefix shingle not marked as frequent: as pairs (a, b) if few do, sizes and places
    allowing a link; with the shingle as rows (shingle, a, n) if `FREQUENT` groups or more do."""
    ranges = ranges_of(docs.sparkSession)
    one = np.uint64(1)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, count, rows, found in shingles(batch.column("text")):
                sets = Sets(count, rows, found, frequent)
                held = np.flatnonzero(sets.among_first(PART, WHOLE) & ~sets.late)
                near = sets.among_first(2 * PART, WHOLE + PART)[held]
                keys = (sets.shingles[held] & ~one) | near.astype(np.uint64)
                where = range_of(keys, ranges).astype(np.int64)
                order = np.lexsort((sets.rows[held], where))
                keys, where, of = keys[order], where[order], sets.rows[held][order]
                cut = np.searchsorted(where, np.arange(ranges + 1))
                groups, out = sets.groups(), []
                for r in np.flatnonzero(np.diff(cut)):
                    a, b = cut[r], cut[r + 1]
                    mine, times = np.unique(of[a:b], return_counts=True)
                    out.append(
                        {
                            "range": int(r),
                            "keys": keys[a:b].tobytes(),
                            "groups": groups[mine].tobytes(),
                            "sizes": sets.size[mine].astype(np.int64).tobytes(),
                            "times": times.astype(np.int32).tobytes(),
                        }
                    )
                yield pa.RecordBatch.from_pylist(out, schema)

    names = ("keys", "groups", "sizes", "times")
    schema = packed_schema(*names)

    parted = docs.select("text").mapInArrow(spread, packed_ddl(*names))
    return parted.groupBy("range").applyInArrow(_meet, "shingle long, a long, b long, n long")


def _sizes_allow(a: Column, b: Column) -> Column:
    return (WHOLE * F.least(a, b)) >= (PART * F.greatest(a, b))


def _late_allow(n_a: Column, f_a: Column, n_b: Column, f_b: Column) -> Column:
    """Whether two groups may link that share frequent shingles only (see 5 above)."""
    return _sizes_allow(n_a, n_b) & ((WHOLE + PART) * F.least(f_a, f_b) >= PART * (n_a + n_b))


def _band(n: Column) -> Column:
    """Sizes that link are in one band or in two that follow each other."""
    return F.floor(F.log(n.cast("double")) / math.log(WHOLE / PART)).cast("int")


def possible(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs of classes whose sketches allow a link: sets cannot share more than the lesser count of
    each cell. What is out cannot link."""

    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = batch.column("of_a"), batch.column("of_b")
            told = np.asarray(pc.and_(x.is_valid(), y.is_valid()))
            n_a, n_b = batch.column("n_a").to_numpy(), batch.column("n_b").to_numpy()
            most = np.minimum(n_a, n_b)
            if told.any():
                both = [
                    np.frombuffer(b"".join(z.filter(pa.array(told)).to_pylist()), np.uint8).reshape(-1, CELLS)
                    for z in (x, y)
                ]
                most[told] = np.minimum(*both).sum(axis=1, dtype=np.int64)
            good = pa.array(WHOLE * most >= PART * (n_a + n_b - most))
            yield pa.RecordBatch.from_arrays(
                [batch.column("a").filter(good), batch.column("b").filter(good)], names=["a", "b"]
            )

    of = lambda x: classes.select(
        F.col("class").alias(x), F.col("n").alias(f"n_{x}"), F.col("sketch").alias(f"of_{x}")
    )
    rows = pairs.join(of("a"), "a").where("n_a > 0").join(of("b"), "b").where(_sizes_allow(F.col("n_a"), F.col("n_b")))
    return rows.mapInArrow(bound, "a binary, b binary")


def compared(docs: DataFrame, pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs of classes (a, b), with `linked` from their whole sets.

    classes: class and the document (`doc`) whose text stands for it. Sets are made of these documents
    only, and travel to the pairs by two joins.
    """
    wanted = pairs.select(F.col("a").alias("class")).union(pairs.select("b")).distinct().join(classes, "class")
    held = filter_of(wanted.select(F.xxhash64("doc").alias("hash")), "hash")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            mask = in_filter(held, batch.column("hash").to_numpy().view(np.uint64))
            texts = batch.column("text").filter(pa.array(mask))
            for _, count, rows, found in shingles(texts):
                sets = Sets(count, rows, found, None)
                items = [sets.shingles[a:b].tobytes() for a, b in zip(sets.begin[:-1], sets.begin[1:])]
                yield pa.RecordBatch.from_arrays(
                    [sets.classes(), pa.array(items, pa.binary())], names=["class", "items"]
                )

    sets = docs.select("text", F.xxhash64("doc_id").alias("hash")).mapInArrow(run, "class binary, items binary")
    sets = sets.join(wanted.select("class"), "class", "left_semi").groupBy("class").agg(F.first("items").alias("items"))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for x, y in zip(batch.column("of_a"), batch.column("of_b")):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                linked.append(WHOLE * both >= PART * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"), pa.array(linked, pa.bool_())], names=["a", "b", "linked"]
            )

    of_a = sets.select(F.col("class").alias("a"), F.col("items").alias("of_a"))
    of_b = sets.select(F.col("class").alias("b"), F.col("items").alias("of_b"))
    return pairs.join(of_b, "b").join(of_a, "a").select("a", "b", "of_a", "of_b").mapInArrow(
        check, "a binary, b binary, linked boolean"
    )


def _ordered(pairs: DataFrame, tasks: int) -> DataFrame:
    pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b")
    return by_few(pairs.distinct(), tasks)


def linked_documents(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id (the least doc_id that links reach), one row for each row of
    `docs`.

    Reads `doc_id` and `text`; other columns may bear any name. Null texts and texts without words have
    no shingles and are their own component. Rows with equal sets are linked, rows that repeat
    included. A component of rows without doc_id only has none. An empty table gives no rows.
    """
    return _linked(docs).select("doc_id", "n_shingles", "component_id")


def _linked(docs: DataFrame) -> DataFrame:
    """As `linked_documents`, with the hash of the text and the component's name (null without shingles)."""
    tasks = writing_tasks(docs)
    frequent = frequent_shingles(docs)
    few = lambda df: by_few(df, tasks)
    told = stored(few(described(docs, frequent)), "shingled")
    some = told.where("n > 0")
    classes = some.groupBy("class").agg(
        F.min("doc_id").alias("doc"),
        F.first("group").alias("group"),
        F.first("n").alias("n"),
        F.first("f").alias("f"),
        F.first("sketch").alias("sketch"),
    )
    classes = stored(few(classes), "classes")
    first = classes.groupBy("group").agg(F.min("class").alias("leader"))
    rare = rare_meetings(docs, frequent)
    # A shingle of many groups is one of many documents and so marked as frequent: all that meet here are pairs.
    rare = stored(few(rare.where("b IS NOT NULL").select("a", "b")), "meetings")
    late = stored(few(some.select("group", "n", "f", F.explode("late").alias("shingle")).distinct()), "late")
    group_pairs = stored(_ordered(rare.union(_with_leaders(late)), tasks), "group-pairs")
    within = classes.join(first, "group").select(F.col("leader").alias("a"), F.col("class").alias("b"))
    of_a = first.select(F.col("group").alias("a"), F.col("leader").alias("class_a"))
    of_b = first.select(F.col("group").alias("b"), F.col("leader").alias("class_b"))
    between = group_pairs.join(of_a, "a").join(of_b, "b").select(F.col("class_a").alias("a"), F.col("class_b").alias("b"))
    first_pairs = stored(few(possible(_ordered(within.union(between), tasks), classes)), "pairs")
    checked = stored(few(compared(docs, first_pairs, classes)), "compared")
    forget(first_pairs, group_pairs)
    reached = stored(few(components(checked.where("linked").select("a", "b"), tasks)), "reached")

    members = (
        classes.join(reached, F.col("class") == F.col("node"), "left")
        .select("group", "class", "n", "f", F.coalesce("component", "class").alias("component"))
    )
    members = stored(few(members), "members")
    left = _ordered(_apart(members, rare, late, tasks), tasks).join(checked, ["a", "b"], "left_anti")
    left = stored(few(possible(left, classes)), "pairs")
    forget(rare, late, checked, members)
    if not left.isEmpty():
        again = compared(docs, left, classes).where("linked").select("a", "b")
        links = reached.select(F.col("node").alias("a"), F.col("component").alias("b")).union(again)
        reached = stored(few(components(links, tasks)), "reached")
    forget(left)

    named = classes.join(reached, F.col("class") == F.col("node"), "left").select(
        F.col("class").alias("of_class"), "doc", F.coalesce("component", "class").alias("component")
    )
    least = named.groupBy("component").agg(F.min("doc").alias("component_id"))
    named = named.join(least, "component").select("of_class", "component", "component_id")
    return told.join(named, (F.col("class") == F.col("of_class")) & (F.col("n") > 0), "left").select(
        "doc_id",
        "hash",
        F.col("n").alias("n_shingles"),
        "component",
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def _with_leaders(late: DataFrame) -> DataFrame:
    """Pairs (a, b) of groups that share a frequent shingle with its leaders of about their size. Half of the
    leaders have the fewest rare shingles for their size: of near copies, those nearest to what they
    are copies of. Each group meets the leaders of two of its shingles."""
    sized = late.withColumn("band", _band(F.col("n")))
    rare = (F.col("n") - F.col("f")) / F.col("n")
    told = F.struct(F.col("group").alias("b"), F.col("n").alias("n_b"), F.col("f").alias("f_b"))
    kinds = [F.min_by(told, F.xxhash64("group", F.lit(k))) for k in range(LEADERS // 2)]
    # The plainest group of each of a few parts of the groups.
    part = F.pmod(F.xxhash64("group"), F.lit(LEADERS // 2))
    kinds += [F.min_by(F.when(part == k, told), F.when(part == k, F.struct(rare, F.xxhash64("group")))) for k in range(LEADERS // 2)]
    leaders = sized.groupBy("shingle", "band").agg(F.array_distinct(F.array_compact(F.array(*kinds))).alias("leaders"))
    leaders = leaders.select("shingle", "band", F.explode("leaders").alias("of")).select("shingle", "band", "of.*")
    two = F.array_distinct(F.array(F.min_by("shingle", "nth"), F.max_by("shingle", "nth")))
    early = late.withColumn("nth", F.xxhash64("shingle")).groupBy("group", "n", "f").agg(two.alias("shingles"))
    near = F.array(*[_band(F.col("n")) + k for k in (-1, 0, 1)])
    early = early.select(F.col("group").alias("a"), "n", "f", F.explode("shingles").alias("shingle"), near.alias("bands"))
    early = early.select("a", "n", "f", "shingle", F.explode("bands").alias("band"))
    met = early.join(leaders, ["shingle", "band"])
    return met.where(_late_allow(F.col("n"), F.col("f"), F.col("n_b"), F.col("f_b"))).select("a", "b")


def _apart(members: DataFrame, rare: DataFrame, late: DataFrame, tasks: int) -> DataFrame:
    """Pairs of classes in different components whose groups share a prefix shingle, or are one.

    Each step is written: as one plan they are so large that planning it over and over, as its stages end,
    fills the driver's memory."""
    few_tasks = lambda df: by_few(df, tasks)
    groups = stored(few_tasks(members.select("group", "n", "f", "component").distinct()), "groups")
    single = groups.groupBy("component").agg((F.count("*") == 1).alias("lone"))

    def pairs_of(cells: DataFrame, by_late: bool) -> DataFrame:
        """Group pairs of one key (`key`, `group`, `n`, `f`, `component`) whose components differ, reached by
        pairs of components, so that a component's own groups never meet. A component with one group meets
        the other as a whole, once for all keys they share; of two larger ones only groups of a key meet.
        `by_late`: the keys are frequent shingles, so what two groups may share is bounded."""
        allow = _late_allow if by_late else lambda n_a, f_a, n_b, f_b: _sizes_allow(n_a, n_b)
        few = cells.groupBy("key", "component").agg(
            F.min("n").alias("low"), F.max("n").alias("high"), F.max("f").alias("most")
        )
        held = few = stored(few_tasks(few), "parts")
        mixed_keys = few.groupBy("key").agg(F.count("*").alias("parts")).where("parts > 1").select("key")
        few = stored(few_tasks(few.join(mixed_keys, "key", "left_semi").join(single, "component")), "mixed-parts")
        forget(held)
        cells = stored(few_tasks(cells.join(few.select("key").distinct(), "key", "left_semi")), "cells")
        other = few.select(
            "key",
            F.col("component").alias("other"),
            F.col("low").alias("low_b"),
            F.col("high").alias("high_b"),
            F.col("most").alias("most_b"),
            F.col("lone").alias("lone_b"),
        )
        near = (WHOLE * F.col("high") >= PART * F.col("low_b")) & (WHOLE * F.col("high_b") >= PART * F.col("low"))
        if by_late:
            near &= (WHOLE + PART) * F.least("most", "most_b") >= PART * (F.col("low") + F.col("low_b"))
        meet = few.join(other, "key").where((F.col("component") < F.col("other")) & near)
        meet = meet.select("key", "component", "other", (F.col("lone") | F.col("lone_b")).alias("simple"))
        meet = stored(few_tasks(meet), "meet")
        of = lambda df, x, key, *more: df.select(
            *more, F.col("component").alias(key), F.col("group").alias(x), F.col("n").alias(f"n_{x}"), F.col("f").alias(f"f_{x}")
        )
        allowed = allow(F.col("n_a"), F.col("f_a"), F.col("n_b"), F.col("f_b"))
        simple = meet.where("simple").select("component", "other").distinct()
        simple = simple.join(of(groups, "a", "component"), "component").join(of(groups, "b", "other"), "other").where(allowed)
        rest = meet.where("NOT simple").join(of(cells, "a", "component", "key"), ["key", "component"])
        rest = rest.join(of(cells, "b", "other", "key"), ["key", "other"]).where(allowed)
        columns = ["a", "component", "b", "other"]
        found = stored(few_tasks(simple.select(*columns).union(rest.select(*columns)).distinct()), "apart")
        forget(few, cells, meet)
        return found

    by_shingle = late.join(groups.select("group", "component"), "group").withColumnRenamed("shingle", "key")
    by_group = groups.withColumn("key", F.col("group"))
    of_a = groups.select(F.col("group").alias("a"), "component")
    of_b = groups.select(F.col("group").alias("b"), F.col("component").alias("other"))
    rare = rare.join(of_a, "a").join(of_b, "b").where("component <> other").select("a", "component", "b", "other")
    found = [pairs_of(by_shingle, True), pairs_of(by_group, False)]
    meet = stored(few_tasks(found[0].union(found[1]).union(rare).distinct()), "met")
    forget(groups, *found)
    class_a = members.select(F.col("group").alias("a"), "component", F.col("class").alias("class_a"))
    class_b = members.select(F.col("group").alias("b"), F.col("component").alias("other"), F.col("class").alias("class_b"))
    return (
        meet.join(class_a, ["a", "component"])
        .join(class_b, ["b", "other"])
        .select(F.col("class_a").alias("a"), F.col("class_b").alias("b"))
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """The documents with all their columns, of each component only the row with the least doc_id (of
    several with it, one). Documents without shingles or without doc_id stay. Rows are told apart by doc_id
    and text: of rows that repeat both one stays, and a row whose doc_id another bears with an unrelated
    text is judged by its own."""
    found = stored(by_few(_linked(docs), writing_tasks(docs)), "linked").where("doc_id IS NOT NULL AND n_shingles > 0")
    found = found.select("component", F.struct("doc_id", "hash").alias("pair"))
    kept = found.groupBy("component").agg(F.min("pair").alias("pair")).select("pair.*")
    named = found.select("pair.*")
    gone = named.join(kept, ["doc_id", "hash"], "left_anti").distinct().toDF("of", "with")
    again = named.groupBy("doc_id", "hash").agg(F.count("*").alias("times")).where("times > 1").drop("times").toDF("of", "with")
    same = (F.col("id") == F.col("of")) & (F.col("text_hash") == F.col("with"))
    rows = nested(docs, id=F.col("doc_id"), text_hash=_text_hash(F.col("text"))).join(gone, same, "left_anti")
    single = rows.join(again, same, "left_anti")
    several = rows.join(again, same, "left_semi").dropDuplicates(["id", "text_hash"])
    return single.union(several).select("row.*")
