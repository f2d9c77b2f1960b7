"""The conversation trie against plain loops."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from brute import WORD

from rivulet.llm import tries


def plain_trie(rows):
    """Sorted node rows for (conv_id, turn, role, text) rows."""
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            told = hashlib.sha256((text or "").encode()).hexdigest()
            turns[conv].append(((turn is not None, turn or 0), role or "", told, text or ""))
    ordered = {c: [(r, x) for _, r, _, x in sorted(t)] for c, t in turns.items()}
    rebuilt = {}
    for c in ordered:
        h = zlib.crc32(str(c).encode()) % 4
        first = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        rebuilt[c] = tuple(ordered.get(first, [])[:h] + ordered[c][h:])
    members = defaultdict(list)
    for c, seq in rebuilt.items():
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
    saved, leaves, children = defaultdict(int), defaultdict(int), defaultdict(int)
    for node, of in members.items():
        if node:
            children[node[:-1]] += 1
    for node, of in members.items():
        words = len(WORD.findall(node[-1][1])) if node else 0
        for d in range(len(node) + 1):
            saved[node[:d]] += (len(of) - 1) * words
            leaves[node[:d]] += children[node] == 0
    out = []
    for node, of in members.items():
        ends = ",".join(str(c) for c in sorted(of) if rebuilt[c] == node)
        up = min(members[node[:-1]]) if node else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(of), len(node), up, len(of), children[node], leaves[node], saved[node], digest))
    return sorted(out, key=str)


def frame(spark, rows, clash=True):
    extra = ", depth long, words string, piece int, weight long, `a.b` string, p1 long" if clash else ""
    more = (5, "w", 1, 2, "x", 3) if clash else ()
    return spark.createDataFrame([(*r, *more) for r in rows], "conv_id long, turn long, role string, text string" + extra)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def shared_rows(seed, convs, most):
    """Conversations over few texts, so that prefixes, whole copies and proper prefixes abound."""
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(convs * 2), convs):
        for t in range(rng.randint(1, most)):
            rows.append((c, t, rng.choice(["user", "user", "assistant"]), rng.choice(["hi there", "yes", "a b c", ""])))
    return rows


ODD = [
    (None, 0, "user", "belongs to none"),
    (40, None, None, None),
    (40, 3, "user", "three words here"),
    (40, 3, "assistant", "same turn"),
    (40, 3, "assistant", "another of the turn"),
    (40, 5, "user", "twice"),
    (40, 5, "user", "twice"),
    (41, 1, "user", "its block has forty"),
    (-7, 1, "user", "negative"),
    (-20, 1, "user", "opening of the negative block"),
    (-3, 9, "us", "er x"),
    (-4, 9, "user", " x"),
    (67, 0, "user", "no first of the block"),
    (2_000_000, 0, "user", "word " * 300_000),
    (2_000_003, 0, "user", "after a long one"),
    (2_000_003, 7, "user", "and one more"),
    (2_000_003, 8, "user", "and one more"),
    (2_000_003, 9, "user", "and one more"),
    (2_000_003, 10, "user", "and one more"),
]


@pytest.mark.parametrize("rows", [ODD, shared_rows(1, 60, 4), shared_rows(2, 150, 6)], ids=["odd", "few", "many"])
def test_against_plain_loops(spark, rows):
    assert found(tries.conversation_trie(frame(spark, rows))) == plain_trie(rows)


def test_hot_conversations_span_ranges(spark):
    """Half the rows in one conversation, a third of all conversations alike, all sorted in several ranges."""
    rows = [(20, t, "user", f"turn {t % 3}") for t in range(900)]
    rows += [(22, t, "user", f"turn {t % 3}") for t in range(900)]
    rows += [(1000 + c, t, "user", "alike") for c in range(400) for t in range(2)]
    rows += shared_rows(4, 100, 5)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        got = found(tries.conversation_trie(frame(spark, rows)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got == plain_trie(rows)


def test_end_lists_are_blocks(spark):
    rows = [(c, t, "user", "alike") for c in range(0, 24000, 20) for t in range(2)]
    whole, _ = tries.rebuilt_prefixes(frame(spark, rows))
    lists = tries.end_lists(whole).collect()
    assert max(len(r.conv_ids) for r in lists) <= tries.LISTED and len(lists) >= 1200 // tries.LISTED
    assert sorted(c for r in lists for c in r.conv_ids) == list(range(0, 24000, 20))


def test_no_conversations(spark):
    assert tries.conversation_trie(frame(spark, ODD[:1])).count() == 0
    assert tries.conversation_trie(frame(spark, ODD).limit(0)).count() == 0
