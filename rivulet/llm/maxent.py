"""Scoring texts by a hashed maximum-entropy language model, next to a smoothed unigram base.

Every token is predicted from three features of what stands before it: the last word, the last two, and
the last but one alone (a skip). The softmax is factored by classes: the `CLASSES` * `MEMBERS` most
frequent tokens fall into classes by frequency, the rest of the `HEAD` into `BANDS` bands of about equal
token counts, all other words, those met once among them, are one class more. A class is drawn by the features, then a member by
features and class; a word of a band or of the last class is drawn by its (smoothed) count. So the
probabilities of all words add up to one.

Weights stand in two tables whose rows are hashes of a feature, and of a feature within a class; a row
holds a weight for every class or member. The tables grow with the square root of the training tokens, up to
`MOST_ROWS`. Every round sums the gradient (how often a class or member follows a row's features, less
how often the weights expect it to) over all training tokens and tasks, and takes one step, in which each
weight has its own rate: `PACE` over the logarithmic mean of the two counts. Before the first round
all weights are zero and what they expect is known, so that round only counts. Sums do not depend on how the
texts are spread over tasks, but for the rounding of floating-point sums; they are added up by groups
of tasks first.

Counts are exact and cover all training texts. They meet by range of the word's hash. The
`HEAD` most frequent words travel to the tasks (a bound of 5 MB); rarer tokens travel to the counts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.llm.blocks import joined, packed, packed_ddl, packed_schema, range_of, ranges_of
from rivulet.llm.bytetext import SubstringHash, lower_ascii, mixed, text_slices, word_spans
from rivulet.llm.tables import stored

HEAD = 1 << 18
CLASSES, MEMBERS, BANDS = 32, 32, 7
INSIDE, LAST = CLASSES * MEMBERS, CLASSES + BANDS
LEAST_ROWS, MOST_ROWS = 1 << 12, 1 << 19
ROUNDS, PACE, PRIOR = 2, (0.5, 0.5), 60.0
BATCH = 1 << 14
# Rows of a table in one message, and tasks whose messages meet first.
PIECE, TOGETHER = 1 << 9, 32
SMOOTH = 0.1
END = np.uint64(0x9E3779B97F4A7C15)


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from training; one without an id is."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 10 == 0


def tokens(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, rows, row within, hash) of the tokens of whole texts: words and an end for each text."""
    for first, count, data, offsets in text_slices(texts):
        data = lower_ascii(data)
        starts, ends, rows = word_spans(data, offsets)
        words = SubstringHash(data).of(starts, ends)
        begin = np.searchsorted(rows, np.arange(count + 1))
        out = np.full(len(words) + count, END)
        out[np.arange(len(words)) + rows] = words
        yield first, count, np.repeat(np.arange(count), np.diff(begin) + 1), out


def counted(docs: DataFrame) -> DataFrame:
    """range, hash and n of every distinct token of the texts."""
    ranges = ranges_of(docs.sparkSession)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, _, found in tokens(batch.column("text")):
                values, n = np.unique(found, return_counts=True)
                yield pa.RecordBatch.from_pylist(
                    packed(ranges, range_of(values, ranges), hashes=values, counts=n.astype(np.int32)),
                    packed_schema("hashes", "counts"),
                )

    def meet(table: pa.Table) -> pa.Table:
        values, at = np.unique(joined(table.column("hashes"), np.uint64), return_inverse=True)
        n = np.bincount(at, joined(table.column("counts"), np.int32), minlength=len(values)).astype(np.int64)
        where = range_of(values, ranges).astype(np.int32)
        return pa.table({"range": pa.array(where), "hash": pa.array(values.view(np.int64)), "n": pa.array(n)})

    parted = docs.select("text").mapInArrow(spread, packed_ddl("hashes", "counts"))
    return parted.groupBy("range").applyInArrow(meet, "range int, hash long, n long")


@dataclass(frozen=True)
class Model:
    hashes: np.ndarray  # of the head, ascending
    counts: np.ndarray
    ids: np.ndarray  # place in the classes; from INSIDE on, the band
    total: int  # tokens
    words: int  # distinct tokens
    masses: np.ndarray  # tokens of each band
    class_bias: np.ndarray
    member_bias: np.ndarray
    class_rows: np.ndarray  # row, class
    member_rows: np.ndarray  # class, row, member

    def looked_up(self, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Counts and places; -1 where a token is not in the head."""
        if not len(self.hashes):
            return np.full(len(found), -1), np.full(len(found), -1)
        at = np.minimum(np.searchsorted(self.hashes, found), len(self.hashes) - 1)
        known = self.hashes[at] == found
        return np.where(known, self.counts[at], -1), np.where(known, self.ids[at], -1)

    def base(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + SMOOTH) / (self.total + SMOOTH * (self.words + 1)))

    def rest(self, counts: np.ndarray) -> np.ndarray:
        """log10 of a word's share of the last class."""
        tokens, words = self.total - self.counts.sum(), self.words - len(self.counts)
        return np.log10((counts + SMOOTH) / (tokens + SMOOTH * (words + 1)))

    def class_places(self, features: np.ndarray) -> np.ndarray:
        return (features % np.uint64(len(self.class_rows))).astype(np.int64)

    def member_places(self, features: np.ndarray) -> np.ndarray:
        """Rows within the class; other bits of the feature than for the class."""
        return (features >> np.uint64(20)).astype(np.int64) % self.member_rows.shape[1]

    def class_logits(self, at: np.ndarray) -> np.ndarray:
        return _added(self.class_rows, at, self.class_bias)

    def member_logits(self, at: np.ndarray, of: np.ndarray) -> np.ndarray:
        at = of[:, None] * self.member_rows.shape[1] + at
        return _added(self.member_rows.reshape(-1, MEMBERS), at, self.member_bias.take(of, axis=0))


def _added(rows: np.ndarray, at: np.ndarray, bias: np.ndarray) -> np.ndarray:
    x = rows.take(at[:, 0], axis=0)
    x += rows.take(at[:, 1], axis=0)
    x += rows.take(at[:, 2], axis=0)
    x += bias
    return x


def classes_of(ids: np.ndarray) -> np.ndarray:
    return np.where(ids < 0, LAST, np.where(ids < INSIDE, ids // MEMBERS, ids - INSIDE + CLASSES))


def context_features(rows: np.ndarray, found: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Hashes of the features of the chosen tokens: last word, last two, last but one."""
    n = len(found)
    one, two = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
    one[1:] = np.where(rows[1:] == rows[:-1], found[:-1], np.uint64(0))
    two[2:] = np.where(rows[2:] == rows[:-2], found[:-2], np.uint64(0))
    one, two = one[chosen], two[chosen]
    return np.stack([mixed(one + np.uint64(1)), mixed(one * np.uint64(3) ^ mixed(two)), mixed(two + np.uint64(2))], axis=1)


def _log_chance(x: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Logarithm of the softmax at the target of each row."""
    x -= x.max(axis=1, keepdims=True)
    chosen = x[np.arange(len(x)), target].astype(np.float64)
    return chosen - np.log(np.exp(x, out=x).sum(axis=1))


def _softmax(x: np.ndarray) -> np.ndarray:
    x -= x.max(axis=1, keepdims=True)
    np.exp(x, out=x)
    x /= x.sum(axis=1, keepdims=True)
    return x


def started(vocabulary: DataFrame) -> Model:
    """The model of the counts alone."""
    facts = vocabulary.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    # Words met once stand for those not met: both are in the last class.
    head = vocabulary.where("n > 1").orderBy(F.col("n").desc(), "hash").limit(HEAD).select("hash", "n").toArrow()
    hashes = head.column("hash").to_numpy().view(np.uint64)
    counts = head.column("n").to_numpy().astype(np.int64)
    inside = min(INSIDE, len(hashes))
    weights = np.zeros(INSIDE)
    weights[:inside] = counts[:inside]
    weights = weights.reshape(CLASSES, MEMBERS)
    others = counts[inside:]
    # Bands are cut where the running count passes a share of the whole.
    before = np.cumsum(others) - others
    band = before * BANDS // max(int(others.sum()), 1)
    ids = np.append(np.arange(inside), INSIDE + band).astype(np.int64)
    masses = np.bincount(band, others, minlength=BANDS)
    last = facts[0] - counts.sum() + SMOOTH
    sums = np.concatenate([weights.sum(axis=1), masses, [last]])
    order = np.argsort(hashes)
    with np.errstate(divide="ignore"):
        class_bias = np.maximum(np.log(sums / max(sums.sum(), 1)), -60).astype(np.float32)
        member_bias = np.log(weights) - np.log(np.maximum(weights.sum(axis=1, keepdims=True), 1))
    rows = min(max(LEAST_ROWS, int(facts[0] ** 0.5)), MOST_ROWS)
    return Model(
        hashes[order],
        counts[order],
        ids[order],
        int(facts[0]),
        int(facts[1]),
        masses,
        class_bias,
        np.maximum(member_bias, -60).astype(np.float32),
        np.zeros((rows, LAST + 1), np.float32),
        np.zeros((CLASSES, max(rows // 16, 1), MEMBERS), np.float32),
    )


def _observed(model: Model, sums: dict, rows: np.ndarray, found: np.ndarray) -> None:
    """Add how often each class and member follows the features of each row."""
    _, ids = model.looked_up(found)
    of, features = classes_of(ids), context_features(rows, found, np.arange(len(found)))
    flat = model.class_places(features) * (LAST + 1) + of[:, None]
    sums["class"] += np.bincount(flat.ravel(), minlength=sums["class"].size).reshape(sums["class"].shape)
    inside = np.flatnonzero(of < CLASSES)
    at = of[inside, None] * model.member_rows.shape[1] + model.member_places(features[inside])
    flat = at * MEMBERS + ids[inside, None] % MEMBERS
    sums["member"] += np.bincount(flat.ravel(), minlength=sums["member"].size).reshape(sums["member"].shape)


def _add_rows(sums: np.ndarray, at: np.ndarray, values: np.ndarray, room: np.ndarray) -> None:
    """Add the values of each example to all of its rows; `room` is used again by each call."""
    values, of = values.T, np.ascontiguousarray(at.T)
    room = room[: len(values), : values.shape[1]]
    np.copyto(room, values)
    for places in of:
        for k, value in enumerate(room):
            sums[:, k] += np.bincount(places, value, minlength=len(sums))


def _expected(model: Model, sums: dict, rows: np.ndarray, found: np.ndarray) -> None:
    """Add how often the weights expect each class and member to follow the features of each row."""
    _, ids = model.looked_up(found)
    of, features = classes_of(ids), context_features(rows, found, np.arange(len(found)))
    room = np.empty((LAST + 1, BATCH))
    for k in range(0, len(found), BATCH):
        at = model.class_places(features[k : k + BATCH])
        _add_rows(sums["class"], at, _softmax(model.class_logits(at)), room)
    inside = np.flatnonzero(of < CLASSES)
    places, of = model.member_places(features[inside]), of[inside]
    room = np.empty((MEMBERS, 4 * BATCH))
    for k in range(0, len(of), 4 * BATCH):
        at, target = places[k : k + 4 * BATCH], of[k : k + 4 * BATCH]
        p = _softmax(model.member_logits(at, target))
        _add_rows(sums["member"], target[:, None] * model.member_rows.shape[1] + at, p, room)


_SENT = "name string, at long, sums binary"


def _summed(docs: DataFrame, model: Model, add) -> dict[str, np.ndarray]:
    """The sums that `add` makes of all texts, as large as the model's tables."""
    wide = {"class": LAST + 1, "member": MEMBERS}
    size = {"class": len(model.class_rows), "member": model.member_rows.shape[0] * model.member_rows.shape[1]}

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # By column, as they are added to.
        sums = {name: np.zeros((size[name], wide[name]), order="F") for name in wide}
        none = True
        for batch in batches:
            for _, _, rows, found in tokens(batch.column("text")):
                none = False
                add(model, sums, rows, found)
        if none:
            return
        task = TaskContext.get().partitionId() // TOGETHER
        for name, table in sums.items():
            for k in range(0, len(table), PIECE):
                piece = table[k : k + PIECE]
                if piece.any():
                    row = {"name": name, "at": k, "sums": piece.astype(np.float32).tobytes(), "task": task}
                    yield pa.RecordBatch.from_pylist([row], schema)

    def met(data: pa.Table) -> pa.Table:
        # In an order of their own, so that sums come out alike.
        sent = sorted(data.column("sums").to_pylist())
        sums = sum(np.frombuffer(x, np.float32).astype(np.float64) for x in sent).astype(np.float32)
        return data.slice(0, 1).select(["name", "at"]).append_column("sums", pa.array([sums.tobytes()], pa.binary()))

    schema = pa.schema([("name", pa.string()), ("at", pa.int64()), ("sums", pa.binary()), ("task", pa.int64())])
    sent = docs.select("text").mapInArrow(each, f"{_SENT}, task long")
    sent = sent.groupBy("name", "at", "task").applyInArrow(met, _SENT).groupBy("name", "at").applyInArrow(met, _SENT)
    out = {name: np.zeros((size[name], wide[name]), np.float32) for name in wide}
    # At most `MOST_ROWS` rows of each class table.
    for row in sent.toArrow().to_pylist():
        sums = np.frombuffer(row["sums"], np.float32).reshape(-1, wide[row["name"]])
        out[row["name"]][row["at"] : row["at"] + len(sums)] = sums
    return out


def _step(rows: np.ndarray, bias: np.ndarray, seen: np.ndarray, expected: np.ndarray, pace: float) -> np.ndarray:
    """`rows` after a step: seen less expected, over their logarithmic mean; `PRIOR` tokens of every row are as
    the bias has them."""
    prior = PRIOR * np.exp(bias) + 1e-9
    return rows + (pace * np.log((seen + prior) / (expected + prior))).astype(np.float32)


def trained(docs: DataFrame, vocabulary: DataFrame) -> Model:
    """The model after all rounds over `docs`, whose tokens `vocabulary` counts."""
    model = started(vocabulary)
    members = model.member_rows.shape
    bias = {"class": model.class_bias, "member": np.repeat(model.member_bias, members[1], axis=0)}
    seen = _summed(docs, model, _observed)
    expected = {name: seen[name].sum(axis=1, keepdims=True) * np.exp(bias[name]) for name in seen}
    for turn in range(ROUNDS):
        if turn:
            expected = _summed(docs, model, _expected)
        class_rows = _step(model.class_rows, bias["class"], seen["class"], expected["class"], PACE[turn])
        flat = model.member_rows.reshape(-1, MEMBERS)
        flat = _step(flat, bias["member"], seen["member"], expected["member"], PACE[turn])
        model = replace(model, class_rows=class_rows, member_rows=flat.reshape(members))
    return model


def _scores(model: Model, rows: np.ndarray, found: np.ndarray, counts: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """log10 probability of each token; of those outside the head only that of the last class."""
    out = np.empty(len(found))
    features = context_features(rows, found, np.arange(len(found)))
    of = classes_of(ids)
    for k in range(0, len(found), BATCH):
        now = slice(k, k + BATCH)
        x, target = features[now], of[now]
        log = _log_chance(model.class_logits(model.class_places(x)), target)
        inside = np.flatnonzero(target < CLASSES)
        if len(inside):
            x, target = model.member_places(x[inside]), target[inside]
            log[inside] += _log_chance(model.member_logits(x, target), ids[now][inside] % MEMBERS)
        out[now] = log / np.log(10)
    banded = ids >= INSIDE
    out[banded] += np.log10(counts[banded] / model.masses[ids[banded] - INSIDE])
    return out


def scored(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, one row for each row of `docs`.

    Reads `doc_id` and `text`; other columns may bear any name. Null text is empty and has its end only. Rows
    that repeat count as often as they are there, and get equal scores. Without training texts nothing is
    known and all words are equally likely. An empty table gives no rows.
    """
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    docs = docs.withColumns({"key": F.xxhash64("doc_id", "text"), "held_out": held_out(F.col("doc_id"))})
    training = docs.where("NOT held_out").select("text")
    vocabulary = stored(counted(training), "vocabulary")
    model = trained(training, vocabulary)
    ranges = ranges_of(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def in_head(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, count, rows, found in tokens(batch.column("text")):
                counts, ids = model.looked_up(found)
                known = counts >= 0
                sums = lambda x, of=rows, n=count: np.bincount(of, x, minlength=n)
                base = np.where(known, model.base(np.maximum(counts, 0)), 0.0)
                some = batch.slice(first, count)
                yield pa.RecordBatch.from_arrays(
                    [
                        some.column("doc_id"),
                        some.column("key"),
                        some.column("held_out"),
                        pa.array(np.bincount(rows, minlength=count).astype(np.int64)),
                        pa.array(sums(known).astype(np.int64)),
                        pa.array(sums(base)),
                        pa.array(sums(_scores(model, rows, found, counts, ids))),
                    ],
                    names=["doc_id", "key", "held_out", "n_tokens", "n_head", "base", "model"],
                )

    names = ("hashes", "keys")

    def rare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("key").to_numpy()
            for first, _, rows, found in tokens(batch.column("text")):
                outside = model.looked_up(found)[0] < 0
                found, rows = found[outside], rows[outside]
                where = range_of(found, ranges).astype(np.int64)
                order = np.argsort(where, kind="stable")
                yield pa.RecordBatch.from_pylist(
                    packed(ranges, where[order], hashes=found[order], keys=keys[first + rows[order]]),
                    packed_schema(*names),
                )

    def meet(sent: pa.Table, words: pa.Table) -> pa.Table:
        found, keys = joined(sent.column("hashes"), np.uint64), joined(sent.column("keys"), np.int64)
        hashes = words.column("hash").to_numpy().view(np.uint64)
        order = np.argsort(hashes)
        hashes, n = hashes[order], words.column("n").to_numpy()[order]
        counts = np.zeros(len(found), np.int64)
        if len(hashes):
            at = np.minimum(np.searchsorted(hashes, found), len(hashes) - 1)
            counts = np.where(hashes[at] == found, n[at], 0)
        mine, of = np.unique(keys, return_inverse=True)
        sums = lambda x: np.bincount(of, x, minlength=len(mine))
        return pa.table(
            {
                "of": pa.array(mine),
                "known": pa.array(sums(counts > 0).astype(np.int64)),
                "more_base": pa.array(sums(model.base(counts)) if len(counts) else np.zeros(0)),
                "more": pa.array(sums(model.rest(counts)) if len(counts) else np.zeros(0)),
            }
        )

    told = docs.mapInArrow(
        in_head, f"doc_id {kind}, key long, held_out boolean, n_tokens long, n_head long, base double, model double"
    )
    told = stored(told, "scored")
    sent = docs.select("key", "text").mapInArrow(rare, packed_ddl(*names)).groupBy("range")
    met = sent.cogroup(vocabulary.groupBy("range")).applyInArrow(
        meet, "of long, known long, more_base double, more double"
    )
    # Sums of doubles in a fixed order, so reruns agree; rows that repeat share what all of them sent.
    parts = F.sort_array(F.collect_list(F.struct("known", "more_base", "more")))
    added = lambda name, zero: F.aggregate("parts", zero, lambda s, p: s + p[name]).alias(name)
    met = met.groupBy("of").agg(parts.alias("parts")).select(
        "of",
        added("known", F.lit(0).cast("long")),
        added("more_base", F.lit(0.0)),
        added("more", F.lit(0.0)),
    )
    rows = told.groupBy(F.col("key").alias("same")).agg(F.count("*").alias("rows"))
    met = met.join(rows, F.col("of") == F.col("same")).drop("same")
    joined_up = told.join(met, F.col("key") == F.col("of"), "left")
    share = lambda name: F.coalesce(F.col(name) / F.col("rows"), F.lit(0.0))
    return joined_up.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_head") + share("known").cast("long")).alias("n_known"),
        F.lit(model.total).cast("long").alias("train_tokens"),
        (F.col("base") + share("more_base")).alias("base_score"),
        (F.col("model") + share("more")).alias("score"),
    )
