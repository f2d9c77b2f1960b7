"""Severity of toxic text by cumulative-link ordinal regression.

Grades 0 < 1 < ... < K are ordered. One weight vector over the distinct words and stems of a text is shared by
all thresholds: P(grade > k) = sigmoid(w.x - t_k) with t_0 <= t_1 <= ..., so a word that makes one
grade likelier makes every step up likelier, and few severe examples borrow from many mild ones. The
output is the expected grade, the sum of P(grade > k).

The model is fitted on at most `MAX_LABELLED` labelled documents, the first of each grade in the
order of a hash; rows are weighted by what they stand for, so probabilities keep the grades' shares
of all labels. Words and stems found in at least `MIN_DOCS` of them, at most `MAX_WORDS`, are features; an L1
penalty leaves weight on few. Everything else covers all documents: scoring is one pass over the
texts without a shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.llm.bytetext import (
    PUNCTUATION,
    SubstringHash,
    distinct_in_rows,
    give_back,
    lower_ascii,
    text_slices,
    word_spans,
)
from rivulet.llm.tables import stored

MAX_LABELLED = 10_000
# Features that are looked up at a time while the model is fitted.
BLOCK = 1 << 16
MIN_DOCS = 3
STEMS = (4, 5, 6)
MAX_WORDS = 1 << 18
PENALTY = 2e-4
ROUNDS = 400


def word_features(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, rows, row within, hash) of the distinct words and word stems of whole texts: words
    are lower-cased runs of letters, digits and non-ASCII characters, stems their first `STEMS` bytes."""
    for first, count, data, offsets in text_slices(texts):
        data = lower_ascii(data)
        starts, ends, rows = word_spans(data, offsets, PUNCTUATION)
        hashes = SubstringHash(data)
        every_row, found = [rows], [hashes.of(starts, ends)]
        for length in STEMS:
            longer = ends - starts > length
            every_row.append(rows[longer])
            found.append(hashes.of(starts[longer], starts[longer] + length) + np.uint64(length))
        rows, words, _ = distinct_in_rows(np.concatenate(every_row), np.concatenate(found).view(np.int64))
        yield first, count, rows, words


@dataclass(frozen=True)
class OrdinalModel:
    words: np.ndarray  # sorted hashes
    weights: np.ndarray
    thresholds: np.ndarray  # one below each grade above the lowest
    grades: np.ndarray  # the grades that labels bear, ascending

    def steps(self, texts: pa.Array) -> np.ndarray:
        """P(grade > k) for each text and threshold."""
        scores = np.zeros(len(texts))
        for first, count, rows, words in word_features(texts):
            if len(self.words) and len(words):
                at = np.minimum(np.searchsorted(self.words, words), len(self.words) - 1)
                known = self.words[at] == words
                sums = np.bincount(rows[known], self.weights[at[known]], minlength=count)
                scores[first : first + count] = sums
        return _sigmoid(scores[:, None] - self.thresholds[None, :])

    def severity(self) -> Callable[..., Column]:
        """A column function from text to expected grade."""

        @F.arrow_udf("double")
        def expected(texts: pa.Array) -> pa.Array:
            return pa.array(self.grades[0] + self.steps(texts) @ np.diff(self.grades), pa.float64())

        return expected

    def exceeds(self, grade: float = 0) -> Callable[..., Column]:
        """A column function from text to P(grade > `grade`)."""
        above = np.flatnonzero(self.grades[1:] > grade)

        @F.arrow_udf("double")
        def probability(texts: pa.Array) -> pa.Array:
            if not len(above):
                return pa.array(np.full(len(texts), float(self.grades[-1] > grade)), pa.float64())
            return pa.array(self.steps(texts)[:, above[0]], pa.float64())

        return probability


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def severity_grades(labels: DataFrame) -> DataFrame:
    """doc_id and grade: 0 for no toxic text, 1 for toxic text that is well written, 2 for toxic text
    that is poor as well. Unlabelled toxicity is left out; of labels that disagree the worse counts."""
    toxic = F.col("toxic") == 1
    grade = F.when(~toxic, 0).when(F.coalesce(F.col("quality"), F.lit(1)) == 0, 2).otherwise(1)
    return (
        labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL")
        .select("doc_id", grade.alias("grade"))
        .groupBy("doc_id")
        .agg(F.max("grade").alias("grade"))
    )


def labelled_sample(docs: DataFrame, grades: DataFrame, most: int = MAX_LABELLED) -> DataFrame:
    """grade, weight and text of at most about `most` labelled documents, the same number of each
    grade where there are enough. Labels of documents that are not in `docs` take no part."""
    grades = grades.join(docs.select("doc_id"), "doc_id", "left_semi")
    counts = {row["grade"]: row["n"] for row in grades.groupBy("grade").agg(F.count("*").alias("n")).collect()}
    parts, left = None, most
    for done, grade in enumerate(sorted(counts, key=lambda g: (counts[g], g))):
        take = min(counts[grade], left // (len(counts) - done))
        left -= take
        part = grades.where(F.col("grade") == grade).orderBy(F.xxhash64("doc_id"), "doc_id").limit(take)
        part = part.withColumn("weight", F.lit(counts[grade] / max(take, 1)))
        parts = part if parts is None else parts.union(part)
    if parts is None:
        parts = grades.limit(0).withColumn("weight", F.lit(1.0))
    # At most `most` rows of three numbers.
    return docs.select("doc_id", "text").join(F.broadcast(parts), "doc_id").select("grade", "weight", "text")


def fit(docs: DataFrame, labels: DataFrame, most: int = MAX_LABELLED) -> OrdinalModel:
    """The model for `docs` from `labels` (doc_id, quality, toxic). Without labels, or with one
    grade only, every text has that grade (0 for none)."""

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, count, rows, words in word_features(batch.column("text")):
                cut = np.searchsorted(rows, np.arange(count + 1)).astype(np.int32)
                lists = pa.ListArray.from_arrays(cut, pa.array(words))
                some = batch.slice(first, count)
                yield pa.RecordBatch.from_arrays(
                    [some.column("grade"), some.column("weight"), lists], names=["grade", "weight", "words"]
                )

    sample = labelled_sample(docs, severity_grades(labels), most)
    sample = stored(sample.mapInArrow(features, "grade int, weight double, words array<long>"), "toxicity-sample")
    named = (
        sample.select(F.explode("words").alias("word"))
        .groupBy("word")
        .agg(F.count("*").alias("docs"))
        .where(F.col("docs") >= MIN_DOCS)
        .orderBy(F.col("docs").desc(), "word")
        .limit(MAX_WORDS)
        .select("word")
        .toArrow()
    )
    words = np.sort(named.column("word").combine_chunks().to_numpy(zero_copy_only=False).astype(np.int64))

    def known(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("words")
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            rows = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
            at = np.minimum(np.searchsorted(words, flat), max(len(words) - 1, 0))
            good = words[at] == flat if len(words) else np.zeros(len(flat), bool)
            cut = np.searchsorted(rows[good], np.arange(len(lists) + 1)).astype(np.int32)
            columns = pa.ListArray.from_arrays(cut, pa.array(at[good].astype(np.int32)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("grade"), batch.column("weight"), columns], names=["grade", "weight", "columns"]
            )

    # At most `most` documents, as numbers of the words above.
    rows = sample.mapInArrow(known, "grade int, weight double, columns array<int>").toArrow().combine_chunks()
    if rows.num_rows == 0:
        return OrdinalModel(words[:0], np.zeros(0), np.zeros(0), np.zeros(1))
    lists = rows.column("columns").combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    grade, weight, lengths = rows.column("grade").to_numpy(), rows.column("weight").to_numpy(), np.diff(lists.offsets.to_numpy())
    model = _fitted(words, grade, weight, lengths, lists.flatten().to_numpy(zero_copy_only=False))
    del rows, lists, grade, weight, lengths
    # The driver goes on with other work.
    give_back()
    return model


def _gathered(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """`values[at]`; numpy widens the whole of an index, so it gets a block at a time."""
    out = np.empty(len(at), values.dtype)
    for first in range(0, len(at), BLOCK):
        out[first : first + BLOCK] = values[at[first : first + BLOCK]]
    return out


def _fitted(words, grade, weight, lengths, columns) -> OrdinalModel:
    """Proximal gradient descent with momentum on the weighted log-likelihood."""
    grades, y = np.unique(grade, return_inverse=True)
    share = weight / weight.sum()
    above = np.array([share[y > k].sum() for k in range(len(grades) - 1)])
    thresholds = -np.log(above / (1 - above))
    if len(grades) == 1:
        return OrdinalModel(words[:0], np.zeros(0), thresholds, grades.astype(float))
    # Each document's words, and each word's documents, as runs: sums need no copy in double precision.
    # Word and document are one number, sorted where it stands: an order beside it would be as large again.
    both = columns.astype(np.int64)
    both <<= 32
    both |= np.repeat(np.arange(len(y), dtype=np.int32), lengths)
    both.sort()
    both &= 0xFFFFFFFF
    documents = both.astype(np.int32)
    del both
    uses = np.bincount(columns, minlength=len(words))
    lengths = lengths.astype(np.int64)

    def run_sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(sizes))
        some = np.flatnonzero(sizes)
        if len(some):
            sums[some] = np.add.reduceat(values, (np.cumsum(sizes) - sizes)[some])
        return sums

    # The loss curves by at most 1/2 in a row's score, and a row of n words is moved by n weights: a
    # bound for each weight, so that rare words are not held back by frequent ones.
    step = 1 / np.maximum(0.5 * run_sums(_gathered(share * lengths, documents), uses), 1e-9)
    w, momentum, looked = np.zeros(len(words)), 1.0, np.zeros(len(words))
    for _ in range(ROUNDS):
        scores = run_sums(_gathered(looked.astype(np.float32), columns), lengths)
        pull, shifts = _gradient(scores, y, share, thresholds)
        gradient = run_sums(_gathered(pull.astype(np.float32), documents), uses)
        moved = looked - step * gradient
        following = np.sign(moved) * np.maximum(np.abs(moved) - step * PENALTY, 0)
        next_momentum = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        looked = following + (momentum - 1) / next_momentum * (following - w)
        w, momentum = following, next_momentum
        thresholds = np.maximum.accumulate(thresholds - shifts)
    held = np.abs(w) > 1e-6
    return OrdinalModel(words[held], w[held], thresholds, grades.astype(float))


def _gradient(scores, y, share, thresholds):
    """Gradient of the loss in each row's score, and a Newton step for each threshold."""
    at = _sigmoid(scores[:, None] - thresholds[None, :])
    upper = np.concatenate([np.ones((len(y), 1)), at], axis=1)  # P(grade > k - 1)
    lower = np.concatenate([at, np.zeros((len(y), 1))], axis=1)
    pick = np.arange(len(y)), y
    u, v = upper[pick], lower[pick]
    likelihood = np.maximum(u - v, 1e-12)
    du, dv = u * (1 - u), v * (1 - v)
    pull = -share * (du - dv) / likelihood
    shifts = np.zeros(len(thresholds))
    for k in range(len(thresholds)):
        slope = at[:, k] * (1 - at[:, k])
        toward = np.where(y == k + 1, slope / likelihood, 0) - np.where(y == k, slope / likelihood, 0)
        gradient = (share * toward).sum()
        shifts[k] = np.clip(0.5 * gradient / max((share * slope).sum(), 1e-9), -0.5, 0.5)
    return pull, shifts


def scored(docs: DataFrame, model: OrdinalModel, threshold: float = 0.5) -> DataFrame:
    """doc_id, severity (expected grade) and toxic (more likely than `threshold` above the lowest
    grade), one row for each row of `docs`.

    Reads `doc_id` and `text`; other columns may bear any name. Null and empty texts have no words
    and get what the thresholds alone say. Rows that repeat get the same answer.
    """
    text = F.col("text")
    return docs.select(
        "doc_id", model.severity()(text).alias("severity"), (model.exceeds()(text) >= threshold).alias("toxic")
    )


def without_toxic(docs: DataFrame, model: OrdinalModel, threshold: float = 0.5) -> DataFrame:
    """The documents that are not toxic, with all their columns."""
    return docs.where(model.exceeds()(F.col("text")) < threshold)
