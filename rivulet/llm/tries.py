"""The trie of conversation prefixes, by collapsing whole conversations.

A conversation is rebuilt from the opening turns of the first of its block and its own turns after
those. Conversations that are equal as a whole become one weighted sequence with the list of those
that end there; only one of each is unfolded into prefixes. Sequences that are a proper prefix of
another go by an anti join, what is left are the leaves. Prefixes are then summed by weight.

Texts are read once, for a 128-bit digest and a word count of each turn. The digest of a prefix is
the exclusive or of digests of (position, turn), so it is a running sum that need not be taken in
one task: turns are sorted by range over all tasks, and a conversation that runs over several ranges
carries over what the ranges before hold. At most one conversation begins before each range, which
bounds what is broadcast for that. Only keys and numbers are shuffled, and every count is summed
before it is, so neither a common first turn nor a conversation of many copies gathers in one task.

The tokens a trie saves need no walk over subtrees: below a node at depth d, each sequence adds its
weight times its words from turn d on, less the words of the nodes that it owns there. A node is owned
by the sequence of its smallest member, and a sequence owns all its nodes from some depth on.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivulet.llm.tables import WORD, forget, stored, word_count

BLOCK = 20
OPENINGS = 4

# Members of a sequence are listed in blocks of this many ids (a power of two).
LISTED = 256

NODE = ["depth", "p1", "p2"]
NOTHING = hashlib.sha256(b"").hexdigest()


def _bits(digest: Column, first: int) -> Column:
    """60 bits of a hexadecimal digest."""
    return F.conv(F.substring(digest, first, 15), 16, 10).cast("long")


def digested_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, told (SHA-256 of the text), k1, k2 (digest of role and text) and words."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    told = F.sha2(text, 256)
    rows = conversations.where("conv_id IS NOT NULL").select(
        "conv_id", "turn", role.alias("role"), told.alias("told"), word_count(F.col("text")).alias("words")
    )
    # The digest of the text has a fixed length, so role and text cannot run into each other.
    whole = F.sha2(F.concat("told", "role"), 256)
    return rows.select("*", _bits(whole, 1).alias("k1"), _bits(whole, 16).alias("k2"))


def sorted_turns(turns: DataFrame) -> DataFrame:
    """Stored turns (as by `digested_turns`) in order: conv_id, k1, k2, words, `piece` (the range a turn is
    in) and `at`, which ascends.

    Turns go by number, null first; equal numbers by role, then by SHA-256 of the text.
    """
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("told"), F.col("_stored")]
    # The stored position parts turns that are equal in all, so none fills a range.
    turns = turns.withColumn("_stored", F.monotonically_increasing_id())
    turns = turns.repartitionByRange(*order).sortWithinPartitions(*order)
    at = F.monotonically_increasing_id()
    columns = ["conv_id", "k1", "k2", "words"]
    return stored(turns.select(*columns, F.shiftright(at, 33).cast("int").alias("piece"), at.alias("at")), "sorted")


def _carried(rows: DataFrame, spanning: DataFrame, **sums: Column) -> DataFrame:
    """`rows` with, for each of `sums`, what the pieces of its conversation before this one add up to.

    `spanning`: conversations in more than one piece. Only the last conversation of a piece can go on in
    the next, so there are fewer of them than pieces, and the broadcast tables have a row per piece.
    """
    parts = rows.join(F.broadcast(spanning), "conv_id", "left_semi").groupBy("conv_id", "piece")
    parts = parts.agg(*[column.alias(name) for name, column in sums.items()])
    before = Window.partitionBy("conv_id").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    total = lambda name: F.bit_xor(name) if name.startswith("p") else F.sum(name)
    parts = parts.select(
        F.col("conv_id").alias("_conv"),
        F.col("piece").alias("_piece"),
        *[F.coalesce(total(name).over(before), F.lit(0)).alias(name) for name in sums],
    )
    same = (F.col("conv_id") == F.col("_conv")) & (F.col("piece") == F.col("_piece"))
    joined = rows.join(F.broadcast(parts), same, "left").drop("_conv", "_piece")
    return joined.withColumns({name: F.coalesce(name, F.lit(0)) for name in sums})


def taken_turns(conv_id: Column) -> Column:
    """How many opening turns a conversation takes from the first of its block."""
    return F.crc32(conv_id.cast("string")) % OPENINGS


def rebuilt_prefixes(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All conversations (conv_id, depth, p1, p2, through: whole digest and words), and the turns of the
    rebuilt ones (conv_id, depth, p1, p2, k1, k2, words, through: digest and words up to here)."""
    turns = stored(digested_turns(conversations), "turns")
    ordered = sorted_turns(turns)
    forget(turns)
    within = Window.partitionBy("conv_id", "piece").orderBy("at")
    spans = ordered.groupBy("conv_id").agg(
        F.min("piece").alias("first"), F.max("piece").alias("last"), F.count(F.lit(1)).alias("n")
    )
    spanning = spans.where("last > first").select("conv_id")
    ranked = _carried(ordered, spanning, n=F.count(F.lit(1)))
    ranked = ranked.withColumn("nth", F.row_number().over(within) + F.col("n")).drop("n")

    pick = F.struct("k1", "k2", "words")
    openings = ranked.where(F.col("nth") < OPENINGS).groupBy(F.col("conv_id").alias("of"))
    openings = openings.agg(*[F.max(F.when(F.col("nth") == k, pick)).alias(f"o{k}") for k in range(1, OPENINGS)])
    heads = spans.select("conv_id", F.col("first").alias("piece"), (F.col("conv_id") - F.col("conv_id") % BLOCK).alias("of"))
    heads = heads.join(openings, "of")
    each = F.array(*[F.when(taken_turns(F.col("conv_id")) >= k, F.col(f"o{k}")) for k in range(1, OPENINGS)])
    heads = heads.select("conv_id", "piece", F.posexplode(F.filter(each, lambda o: o.isNotNull())).alias("at", "o"))
    # Places of sorted turns are not negative: openings come before them, in the first of the pieces.
    heads = heads.select("conv_id", "o.*", "piece", (F.col("at") - OPENINGS).cast("long").alias("at"))
    tails = ranked.where(F.col("nth") > taken_turns(F.col("conv_id"))).drop("nth")
    rebuilt = stored(heads.unionByName(tails), "rebuilt")
    rows = _carried(rebuilt, spanning, n=F.count(F.lit(1)))
    rows = rows.withColumn("depth", (F.row_number().over(within) + F.col("n")).cast("long")).drop("n")

    rows = rows.withColumns({f"x{k}": F.xxhash64(F.lit(k), "depth", "k1", "k2") for k in (1, 2)})
    rows = _carried(rows, spanning, p1=F.bit_xor("x1"), p2=F.bit_xor("x2"), through=F.sum("words"))
    running = within.rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.select(
        "conv_id",
        "depth",
        *[F.col(f"p{k}").bitwiseXOR(F.bit_xor(f"x{k}").over(running)).alias(f"p{k}") for k in (1, 2)],
        "x1",
        "x2",
        "words",
        (F.col("through") + F.sum("words").over(running)).alias("through"),
    )
    rows = stored(rows, "prefixes")
    whole = rows.groupBy("conv_id").agg(
        F.max("depth").alias("depth"),
        F.bit_xor("x1").alias("p1"),
        F.bit_xor("x2").alias("p2"),
        F.sum("words").alias("through"),
    )
    zero = lambda name: F.coalesce(name, F.lit(0).cast("long")).alias(name)
    whole = spans.select("conv_id").join(whole, "conv_id", "left")
    whole = stored(whole.select("conv_id", *map(zero, [*NODE, "through"])), "whole")
    forget(ordered, rebuilt)
    return whole, rows


def sequences(whole: DataFrame) -> DataFrame:
    """Distinct rebuilt conversations: depth, p1, p2, conv_id (smallest), weight, total (words)."""
    return whole.groupBy(*NODE).agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("weight"), F.max("through").alias("total")
    )


def end_lists(whole: DataFrame) -> DataFrame:
    """The conversations that end at each sequence, ascending, in blocks: depth, p1, p2, block, conv_ids.

    Sorted by range over all tasks; a block has at most LISTED ids, so no row grows with the copies.
    """
    order = [*NODE, "conv_id"]
    ranged = whole.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    ranged = ranged.withColumn("block", F.shiftright(F.monotonically_increasing_id(), LISTED.bit_length() - 1))
    return ranged.groupBy(*NODE, "block").agg(F.array_sort(F.collect_list("conv_id")).alias("conv_ids"))


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the joined texts of each run of rows of one node."""
    names = [*NODE, "ends_sha256"]
    now, state, done = None, None, {name: [] for name in names}

    def close():
        if now is not None:
            for name, value in zip(names, (*now, state.hexdigest())):
                done[name].append(value)

    for batch in batches:
        for *node, text in zip(*[column.to_pylist() for column in batch.columns]):
            if node != now:
                close()
                now, state = node, hashlib.sha256(text.encode())
            else:
                state.update(b"," + text.encode())
        yield pa.RecordBatch.from_pydict(done, schema=_HASHED)
        done = {name: [] for name in names}
    close()
    yield pa.RecordBatch.from_pydict(done, schema=_HASHED)


_HASHED = pa.schema([*[(name, pa.int64()) for name in NODE], ("ends_sha256", pa.string())])


def end_digests(lists: DataFrame) -> DataFrame:
    """depth, p1, p2 and ends_sha256, the SHA-256 of the ids joined by commas. A list of one block is hashed
    as it is; a hash over more must be taken in order, so their blocks stream through one task per list."""
    text = F.array_join(F.transform("conv_ids", lambda c: c.cast("string")), ",")
    lists = stored(lists.select(*NODE, "block", text.alias("ids")), "ends")
    counts = lists.groupBy(*NODE).agg(F.count(F.lit(1)).alias("n"), F.min("ids").alias("ids"))
    short = counts.where("n = 1").select(*NODE, F.sha2("ids", 256).alias("ends_sha256"))
    longer = lists.join(counts.where("n > 1").select(*NODE), NODE, "left_semi")
    longer = longer.repartition(*NODE).sortWithinPartitions(*NODE, "block").select(*NODE, "ids")
    return short.unionByName(longer.mapInArrow(_hashed, "depth long, p1 long, p2 long, ends_sha256 string"))


def prefix_trie(whole: DataFrame, prefixes: DataFrame) -> DataFrame:
    """One row per node, from what `rebuilt_prefixes` returns: depth, p1, p2 (its digest), conv_id,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens."""
    found = stored(sequences(whole), "sequences")
    chosen = found.select("conv_id", "weight", "total", F.col("depth").alias("length"))
    # Both sides are read from storage, so the join may split a conversation of very many turns.
    of = prefixes.join(chosen, "conv_id")
    up = [F.col(f"p{k}").bitwiseXOR(F.col(f"x{k}")).alias(f"up{k}") for k in (1, 2)]
    of = of.select("conv_id", *NODE, *up, "words", "through", "weight", "total", "length")
    root = [F.lit(0).cast("long").alias(name) for name in (*NODE, "up1", "up2", "words", "through")]
    of = stored(of.unionByName(chosen.select("conv_id", *root, "weight", "total", "length")), "unfolded")

    before = F.col("through") - F.col("words")
    nodes = of.groupBy(*NODE).agg(
        F.min("conv_id").alias("conv_id"),
        F.sum("weight").alias("n_convs"),
        F.max("length").alias("longest"),
        F.min("up1").alias("up1"),
        F.min("up2").alias("up2"),
        F.min(before).alias("before"),
    )
    nodes = stored(nodes, "nodes")
    proper = nodes.where("longest > depth").select(*NODE)
    leaves = found.join(proper, NODE, "left_anti").select("conv_id", F.lit(1).cast("long").alias("leaf"))
    # Words before the first node that a sequence owns; a sequence that owns none has no such words.
    owned = nodes.groupBy("conv_id").agg(F.min("before").alias("start"))
    facts = found.select("conv_id").join(owned, "conv_id", "left").join(leaves, "conv_id", "left")
    facts = stored(facts, "facts")

    zero = F.lit(0).cast("long")
    rest = F.col("total") - before
    own = F.col("total") - F.greatest(before, F.coalesce("start", "total"))
    sums = of.join(facts, "conv_id").select(
        *NODE,
        (F.col("weight") * rest - own).alias("saved_tokens"),
        F.coalesce("leaf", zero).alias("n_leaves"),
        zero.alias("n_children"),
    )
    children = nodes.where("depth > 0").select(
        (F.col("depth") - 1).alias("depth"), F.col("up1").alias("p1"), F.col("up2").alias("p2")
    )
    children = children.select(*NODE, zero.alias("saved_tokens"), zero.alias("n_leaves"), F.lit(1).cast("long").alias("n_children"))
    summed = sums.unionByName(children).groupBy(*NODE)
    summed = summed.agg(*[F.sum(name).alias(name) for name in ("saved_tokens", "n_leaves", "n_children")])

    above = nodes.select(
        (F.col("depth") + 1).alias("depth"),
        F.col("p1").alias("up1"),
        F.col("p2").alias("up2"),
        F.col("conv_id").alias("parent_conv_id"),
    )
    # Children of one node may be a third of all: both sides are scans, so the join may split them.
    named = nodes.join(above, ["depth", "up1", "up2"], "left")
    return named.select(*NODE, "conv_id", "parent_conv_id", "n_convs").join(summed, NODE)


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The nodes of the trie of rebuilt conversations: conv_id, depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256.

    Null role or text counts as empty, a null turn comes first, turns of equal number go by role, then by
    SHA-256 of the text, and rows that repeat are turns each. Rows without conv_id belong to no
    conversation. Without any conversation there is no root: an empty table gives no rows. Other
    columns are not read.
    """
    whole, prefixes = rebuilt_prefixes(conversations)
    ends = end_digests(end_lists(whole))
    nodes = prefix_trie(whole, prefixes).join(ends, NODE, "left")
    return nodes.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.lit(NOTHING)).alias("ends_sha256"),
    )


SQL = rf"""
WITH turns AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''),
                              sha256(coalesce(text, ''))) AS nth
    FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
    SELECT conv_id, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(
               string_split(CAST(conv_id AS VARCHAR), ''), lambda d: CAST(ord(d) AS BIGINT))),
               lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0],
                   lambda x, i: xor(x >> 1, CASE WHEN x % 2 = 1 THEN 3988292384 ELSE 0 END))),
               4294967295) % {OPENINGS} AS h
    FROM (SELECT DISTINCT conv_id FROM turns)
), rebuilt AS (
    SELECT c.conv_id, 0 AS own, t.nth, t.role, t.text
    FROM convs c JOIN turns t ON t.conv_id = c.conv_id - c.conv_id % {BLOCK} AND t.nth <= c.h
    UNION ALL
    SELECT c.conv_id, 1, t.nth, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.nth > c.h
), placed AS (
    SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY own, nth) AS depth,
           len(regexp_extract_all(text, '{WORD}')) AS words, sha256(sha256(text) || role) AS k
    FROM rebuilt
), keyed AS (
    SELECT conv_id, depth, words,
           sha256(string_agg(k, '') OVER (PARTITION BY conv_id ORDER BY depth)) AS node,
           max(depth) OVER (PARTITION BY conv_id) AS length
    FROM placed
), passed AS (
    SELECT conv_id, depth, words, node, length, coalesce(lag(node) OVER (PARTITION BY conv_id ORDER BY depth), '') AS up
    FROM keyed
    UNION ALL
    SELECT conv_id, 0, 0, '', coalesce((SELECT max(length) FROM keyed k WHERE k.conv_id = c.conv_id), 0), NULL FROM convs c
), nodes AS (
    SELECT node, depth, min(up) AS up, min(conv_id) AS conv_id, count(*) AS n_convs, max(words) AS words,
           sha256(coalesce(string_agg(CASE WHEN depth = length THEN CAST(conv_id AS VARCHAR) END, ','
                                      ORDER BY conv_id), '')) AS ends_sha256,
           max(length) = depth AS leaf
    FROM passed GROUP BY node, depth
), below AS (
    SELECT a.node, CAST(sum((v.n_convs - 1) * v.words) AS BIGINT) AS saved_tokens, count(*) FILTER (v.leaf) AS n_leaves
    FROM nodes v JOIN passed a ON a.conv_id = v.conv_id AND a.depth <= v.depth
    GROUP BY a.node
), kids AS (
    SELECT up AS node, count(*) AS n FROM nodes WHERE up IS NOT NULL GROUP BY up
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(kids.n, 0) AS n_children,
       b.n_leaves, b.saved_tokens, n.ends_sha256
FROM nodes n JOIN below b USING (node) LEFT JOIN kids USING (node) LEFT JOIN nodes p ON p.node = n.up
"""
