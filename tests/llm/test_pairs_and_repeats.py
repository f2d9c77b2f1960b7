"""Jaccard join, byte repeats and chunks against plain loops."""

import hashlib
import random
import tracemalloc

import brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rivulet.llm import anchors, chunks, components, jaccard, repeats, suffixes
from rivulet.llm.spans import with_spans
from rivulet.llm.tables import stored


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple(map(str, r)))


def test_jaccard_components(odd_docs, odd_rows):
    assert rows_of(jaccard.linked_documents(odd_docs)) == brute.jaccard_components(odd_rows)


def test_jaccard_with_every_bucket_large(monkeypatch, odd_docs, odd_rows):
    # All shingles of two documents or more go by leaders, and what they leave apart is compared.
    monkeypatch.setattr(jaccard, "FREQUENT", 2)
    assert rows_of(jaccard.linked_documents(odd_docs)) == brute.jaccard_components(odd_rows)


def test_one_of_each_keeps_the_least(odd_docs, odd_rows):
    kept = jaccard.one_of_each(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = [r.doc_id for r in kept.collect()]
    found = brute.jaccard_components(odd_rows)
    named = {c for i, n, c in found if n and i is not None}
    assert sorted(i for i in ids if i is not None) == sorted({i for i, n, c in found if i is not None and (i in named or not n)})


def test_byte_repeats(odd_docs, odd_rows):
    assert rows_of(repeats.trimmed(odd_docs)) == brute.without_repeats(odd_rows, 400)


def test_trimmed_documents_keep_columns_and_characters(odd_docs):
    done = repeats.without_repeats(odd_docs)
    assert done.columns == odd_docs.columns and done.count() == odd_docs.count()
    assert all(r.n_chars == len(r.text or "") for r in done.collect())


def test_repeated_passages_of_fifty_words_are_cut(spark):
    rng = random.Random(9)
    text = lambda n: " ".join("".join(rng.choice("abcdefghé") for _ in range(rng.randint(1, 7))) for _ in range(n))
    passage = [text(50 + k % 4) for k in range(12)]
    assert sum(len(p.encode()) < 300 for p in passage) > 6
    rows, kept = [], []
    for k, p in enumerate(passage):
        for spaced in (p, p.replace(" ", "\n ")):
            ends = text(30) + f" a{len(rows)}", f"b{len(rows)} " + text(20)
            rows.append((len(rows), f"{ends[0]} {spaced} {ends[1]}"))
            kept.append(f"{ends[0]}  {ends[1]}")
    # One word less, and the same words with one altered in their midst, stay.
    for short in (text(49), text(30)):
        for k in range(2):
            rows.append((len(rows), f"c{len(rows)} {short} d{len(rows)} {text(10)}"))
            kept.append(rows[-1][1])
    # Bytes without white space go by their number (with the spaces around, which are alike), two passages that overlap as one, and twice in one text counts.
    run = "".join(rng.choice("abcdefgh") for _ in range(420))
    both = text(80).split(" ")
    more = [f"e {run} f", f"g {run} h", "i " + " ".join(both) + " j", "k " + " ".join(both[:55]) + " l", "m " + " ".join(both[25:]) + " n"]
    twice = text(50)
    more.append(f"{twice} o {twice} p")
    gone = ["ef", "gh", "i j", "k l", "m n", "o p"]
    rows += [(len(rows) + k, x) for k, x in enumerate(more)] + [(500, None), (501, ""), (502, " \n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.text for r in repeats.without_repeats(docs).collect()}
    assert [found[i] for i in range(len(kept))] == kept
    assert [" ".join(found[len(kept) + k].split()) for k in range(len(more))] == gone
    assert [found[i] for i in (500, 501, 502)] == [None, "", " \n"]


def test_few_strings_are_not_dealt_over_many_ranges(spark):
    few = spark.createDataFrame([(1, [(0, 800)]), (2, [(8, 16), (40, 400)])], "key long, runs array<struct<first:int,last:int>>")
    many = spark.createDataFrame([(1, [(0, 1 << 30)])], few.schema)
    assert [repeats.ranges_for(few, step) for step in (1, 8)] == [1, 1]
    assert repeats.ranges_for(few.limit(0), 1) == 1 and repeats.ranges_for(many, 8) == repeats.ranges_of(spark)


def test_small_tables_in_many_partitions_are_not_written_as_many_files(spark, monkeypatch, odd_docs):
    written, left = [], set()

    def counted(df, *how, write=repeats.stored):
        kept = write(df, *how)
        written.append(kept.inputFiles())
        left.add(kept._stored_at)
        return kept

    def gone(*frames, remove=repeats.forget):
        left.difference_update(df._stored_at for df in frames)
        remove(*frames)

    for module in (repeats, suffixes):
        monkeypatch.setattr(module, "stored", counted)
        monkeypatch.setattr(module, "forget", gone)
    cores = spark.sparkContext.defaultParallelism
    done = repeats.without_repeats(odd_docs.repartition(3 * cores + 5))
    assert max(map(len, written)) <= cores
    # Only the cuts are still read.
    assert len(left) == 1 and done.count() == odd_docs.count()


def test_jaccard_steps_of_small_tables_are_written_by_few_tasks(spark, monkeypatch, odd_docs):
    """The driver keeps a record of every task, so little rows are not dealt over all shuffle partitions."""
    written = []

    def counted(df, *how, write=stored):
        kept = write(df, *how)
        written.append(len(kept.inputFiles()))
        return kept

    for module in (jaccard, components):
        monkeypatch.setattr(module, "stored", counted)
    monkeypatch.setattr(jaccard, "FREQUENT", 2)
    cores = spark.sparkContext.defaultParallelism
    held = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": str(3 * cores)}
    before = {name: spark.conf.get(name) for name in held}
    try:
        for name, value in held.items():
            spark.conf.set(name, value)
        jaccard.one_of_each(odd_docs.repartition(3 * cores))
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert len(written) > 15 and max(written) <= cores


def test_texts_without_a_whole_window(spark):
    rows = [(k, "short " * (k % 9)) for k in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    assert rows_of(repeats.trimmed(docs)) == brute.without_repeats(rows, repeats.LENGTH)


def test_anchors_by_blocks_are_those_of_all_texts_at_once(monkeypatch):
    rng = np.random.default_rng(2)
    sizes = np.concatenate([rng.integers(0, 400, 300), [70_000, 0, 134, 135, 136, 5000]])
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    data = rng.integers(97, 100, offsets[-1], dtype=np.uint8)
    found = []
    for block in (1, 1 << 12, 1 << 30):
        monkeypatch.setattr(anchors, "BLOCK", block)
        found.append(anchors.anchors(data, offsets))
    for some in found[:2]:
        assert all(np.array_equal(a, b) for a, b in zip(some, found[2]))


def test_anchors_need_little_more_memory_than_they_fill():
    data = np.random.default_rng(4).integers(97, 123, 1 << 22, dtype=np.uint8)
    offsets = np.arange(0, len(data) + 1, 1 << 11)
    tracemalloc.start()
    try:
        anchors.anchors(data, offsets)
        assert tracemalloc.get_traced_memory()[1] < 4 * len(data)
    finally:
        tracemalloc.stop()


def test_suffix_order_is_that_of_sorted_suffixes(spark):
    strings = {1: [3, 1, 3, 1, 3, 1, 2], 2: [1, 3, 1, 2], 3: [2] * 7, 4: [5], 5: [3, 1]}
    data = [(i, s, [1] * len(s)) for i, s in strings.items()]
    df = spark.createDataFrame(data, "string long, symbols array<long>, bytes array<long>")
    found = {(r.string, r.i): r["rank"] for r in suffixes.suffix_ranks(df, 1000).collect()}
    every = sorted((s[i:], (n, i)) for n, s in strings.items() for i in range(len(s)))
    ranks = [found[place] for _, place in every]
    assert len(found) == len(every)
    assert all(a <= b or x[0] == y[0] for (a, x), (b, y) in zip(zip(ranks, every), zip(ranks[1:], every[1:])))


def test_chunks_survive_an_insertion():
    rng = np.random.default_rng(1)
    text = bytes(rng.integers(97, 123, 4000, dtype=np.uint8))
    moved = text[:1000] + b"inserted" + text[1000:]

    def parts(b):
        _, starts, ends = chunks.chunk_ends(np.frombuffer(b, np.uint8), np.array([0, len(b)]))
        assert b"".join(b[x:y] for x, y in zip(starts, ends)) == b
        return {b[x:y] for x, y in zip(starts, ends)}

    assert len(parts(moved) - parts(text)) <= 4


def test_chunk_deduplication(odd_docs, odd_rows):
    rows = [(i, t) for i, t in odd_rows if i is not None]
    seen, out = set(), {}
    for i, t in sorted(dict(rows).items()):
        b = (t or "").encode()
        _, starts, ends = chunks.chunk_ends(np.frombuffer(b, np.uint8), np.array([0, len(b)]))
        spans = []
        for x, y in zip(starts, ends):
            if b[x:y] in seen:
                if spans and spans[-1][1] == x:
                    spans[-1][1] = y
                else:
                    spans.append([x, y])
            seen.add(b[x:y])
        spans = [s for s in spans if s[1] - s[0] >= chunks.LEAST_RUN]
        kept = b""
        at = 0
        for x, y in spans:
            kept, at = kept + b[at:x], y
        kept += b[at:]
        out[i] = (i, len(b), len(b) - len(kept), len(spans), hashlib.sha256(kept).hexdigest())
    found = chunks.deduplicated(odd_docs.where("doc_id IS NOT NULL"))
    assert rows_of(found) == sorted((out[i] for i, _ in rows), key=lambda r: tuple(map(str, r)))


def test_passages_of_fifty_words_and_short_copies_go(spark):
    rng = random.Random(5)
    text = lambda n: " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(3, 7))) for _ in range(n))
    rows = []
    for k in range(60):
        passage = text(53)
        rows += [(2 * k, f"{text(40)} {passage} {text(30)}"), (2 * k + 1, f"{text(25)} {passage} {text(50)}")]
    rows += [(1000, "a short text"), (1001, "a short text"), (1002, "short line " * 8), (1003, "short line " * 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: (r.n_bytes, r.n_removed) for r in chunks.deduplicated(docs).collect()}
    assert sum(found[2 * k + 1][1] > 0 for k in range(60)) >= 57
    assert found[1000][1] == 0 and all(found[i][0] == found[i][1] for i in (1001, 1003))


@pytest.mark.parametrize("operator", [jaccard.linked_documents, jaccard.one_of_each, repeats.trimmed, repeats.without_repeats, chunks.deduplicated])
def test_empty_tables(no_docs, operator):
    assert operator(no_docs).count() == 0


def near_copies(seed, copies, most):
    """Copies of two texts with up to `most` of their words changed, dropped or added, some of them twice."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    bases = [[word() for _ in range(120)], [word() for _ in range(60)]]
    rows = []
    for k in range(copies):
        words = list(rng.choice(bases))
        for _ in range(rng.randrange(most)):
            at = rng.randrange(len(words))
            words[at : at + rng.choice([0, 1, 1, 1])] = [word()] * rng.choice([0, 1, 1, 1])
        rows += [(k, " ".join(words))] * rng.choice([1, 1, 1, 2])
    return rows


@pytest.mark.parametrize("seed,most", [(1, 4), (2, 9), (3, 14)])
def test_jaccard_of_many_near_copies(spark, seed, most):
    rows = near_copies(seed, 160, most)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert rows_of(jaccard.linked_documents(docs)) == brute.jaccard_components(rows)


def test_rows_of_one_doc_id_are_judged_by_their_texts(spark):
    rng = random.Random(9)
    text = lambda: " ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(40))
    a, b, c = text(), text(), text()
    rows = [(1, a), (1, b), (1, b), (2, a), (3, c), (3, a), (None, b), (None, None), (4, None), (4, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = jaccard.one_of_each(docs).collect()
    assert sorted(((r.doc_id, r.text) for r in kept), key=str) == sorted(
        [(1, a), (1, b), (3, c), (None, b), (None, None), (4, None), (4, None)], key=str
    )


def test_steps_of_the_jaccard_join_are_small_plans(monkeypatch, odd_docs):
    """A plan is planned anew whenever a stage of it ends, and the driver keeps what it prints of it."""
    joins = []

    def counted(df, purpose, write=jaccard.stored):
        joins.append(df._jdf.queryExecution().optimizedPlan().toString().count("Join "))
        return write(df, purpose)

    monkeypatch.setattr(jaccard, "FREQUENT", 2)
    monkeypatch.setattr(jaccard, "stored", counted)
    jaccard.linked_documents(odd_docs)
    assert max(joins) <= 8


def test_texts_go_to_workers_in_short_batches(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [batch.num_rows]})

    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    found = stored(spark.range(0, 5000, 1, 1).mapInArrow(sizes, "n long"), "sizes")
    assert sorted({r.n for r in found.collect()}) == [1000]
    assert spark.conf.get(name) == before


def test_only_texts_that_may_have_spans_are_cut(spark):
    docs = spark.range(200).selectExpr("id AS key", "CAST(id AS STRING) AS text")
    held = spark.createDataFrame([(7, [(0, 1)])], "key long, spans array<struct<first:int,last:int>>")
    done = with_spans(docs, held, lambda some: some.withColumn("text", F.lit("cut")))
    assert [r.text for r in done.where("spans IS NOT NULL").collect()] == ["cut"]
    assert done.where("spans IS NULL AND text <> 'cut'").count() == 199
