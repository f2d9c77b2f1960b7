"""Importance resampling against plain loops."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from rivulet.llm import resampling

FEATURE = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def features(text, words=1):
    w = FEATURE.findall((text or "").translate(LOWER))
    return [" ".join(w[i : i + n]).encode() for n in range(1, words + 1) for i in range(len(w) - n + 1)]


def plain(docs, target, percent=10, least=20, words=1):
    """Sorted (doc_id, n_features, weight, score, rank) for (doc_id, text) rows."""
    of = [(i, [zlib.crc32(f) % 10000 for f in features(t, words)]) for i, t in docs]
    s = Counter(b for _, bs in of for b in bs)
    t = Counter(zlib.crc32(f) % 10000 for x in target for f in features(x, words))
    S, T = s.total(), t.total()
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (S + 10000) / ((s[b] + 1) * (T + 10000))))
    rows = []
    for i, bs in of:
        weight = sum(map(gain, bs)) // len(bs) if bs else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(bs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    able = [r for r in rows if r[1] >= least]
    able.sort(key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for rank, r in enumerate(able[: percent * len(able) // 100]):
        r[4] = rank + 1
    return sorted(map(tuple, rows), key=str)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def target(spark):
    texts = ["What is 12 plus 30 please", None, "", "abc Déjà vu — again", "one two three"]
    return texts, spark.createDataFrame([(t, 1) for t in texts], "text string, bucket int")


def test_crc_matrices():
    rng = random.Random(2)
    data = bytes(rng.randrange(256) for _ in range(5000))
    starts = np.array([rng.randrange(3000) for _ in range(900)])
    lengths = np.array([rng.choice([0, 1, 3, 3, 8, 21, resampling.LONG, resampling.LONG + 1, 1900]) for _ in starts])
    told = [zlib.crc32(data[a : a + n]) for a, n in zip(starts, lengths)]
    assert resampling.crc32_of(np.frombuffer(data, np.uint8), starts, lengths).tolist() == told


def test_matrices_are_cut(monkeypatch):
    monkeypatch.setattr(resampling, "MATRIX_BYTES", 16)
    test_crc_matrices()


@pytest.mark.parametrize("percent,least,words", [(10, 20, 1), (50, 1, 1), (100, 0, 1), (30, 5, 3), (0, 0, 1)])
def test_against_plain_loops(spark, odd_docs, odd_rows, target, percent, least, words):
    got = found(resampling.resampled(odd_docs, target[1], percent, least, words))
    assert got == plain(odd_rows, target[0], percent, least, words)


def test_very_long_and_repeated_texts(spark, target):
    rows = [(1, "word " * 400_000), (2, "x" * 1_500_000), (3, " ".join(f"w{k}" for k in range(200_000)))]
    rows += [(7, "the same words again " * 6)] * 40 + [(None, "the same words again " * 6)] * 40
    rows += [(k, "the same words again " * 6) for k in range(100, 300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert found(resampling.resampled(docs, target[1], 60)) == plain(rows, target[0], 60)


def test_empty_tables(spark, no_docs, odd_docs, odd_rows, target):
    assert resampling.resampled(no_docs, target[1]).count() == 0
    assert resampling.drawn_documents(no_docs, target[1]).count() == 0
    assert found(resampling.resampled(odd_docs, target[1].limit(0))) == plain(odd_rows, [])


def test_drawn_documents(spark, odd_docs, target):
    ranks = resampling.resampled(odd_docs, target[1], 40).where("rank IS NOT NULL")
    drawn = resampling.drawn_documents(odd_docs, target[1], 40)
    assert drawn.columns == odd_docs.columns
    assert sorted(map(str, (r.doc_id for r in drawn.collect()))) == sorted(map(str, (r.doc_id for r in ranks.collect())))


def test_ranks_follow_the_sizes_of_the_ranges(spark):
    rows = spark.range(5000).select(F.col("id").alias("doc_id"), (F.col("id") % 11).alias("score"))
    from rivulet.llm.tables import stored

    ranked = resampling.ranked(stored(rows, "r"), 50, F.lit(True)).where("rank IS NOT NULL").collect()
    order = sorted(((-r.score, r.doc_id) for r in rows.collect()))[:2500]
    assert sorted((r.rank, -r.score, r.doc_id) for r in ranked) == [(k + 1, *o) for k, o in enumerate(order)]
