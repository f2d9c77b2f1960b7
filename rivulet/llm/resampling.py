"""Importance resampling towards a target by hashed word counts.

Features are runs of consecutive words, each hashed by CRC-32 to a bucket. A bucket's gain is the
smoothed log ratio of its share among the target's features to its share among the documents'; a
document's weight is the mean of its features' gains. Gumbel noise drawn from doc_id turns the
weights into scores, so that the highest scores are a sample without replacement in proportion to
the exponentials of the weights.

Inside a task the distinct features of a slice of texts are grouped by their length in bytes; each
group is a matrix with a feature per row, whose CRCs advance column by column; the buckets are then
scattered back to where the features stand. What leaves a task is one count per bucket, so counting
moves at most BUCKETS rows a task, and the gains (BUCKETS numbers) are all that is sent to tasks.

Ranks are given without one task seeing all documents: scores are whole numbers within a range that
the smoothing bounds (about 130,000 of them), so their histogram tells the score at which the sample
ends; only documents from there up are sorted, by range, and the ranges' sizes are added up.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivulet.llm.bytetext import PUNCTUATION, SubstringHash, lower_ascii, text_slices, word_spans
from rivulet.llm.tables import stored

BUCKETS = 10_000
SEED = "2024"

# A matrix of equally long features holds at most this many bytes at a time.
MATRIX_BYTES = 1 << 22

# A feature of more bytes is hashed alone: its matrix would have one row and a step for each byte.
LONG = 512


def _crc_table() -> np.ndarray:
    crc = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        crc = (crc >> 1) ^ np.where(crc & 1, np.uint32(0xEDB88320), np.uint32(0))
    return crc


CRC_TABLE = _crc_table()


def crc32_of(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRC-32 of each substring: those of one length form a matrix that is worked column by column."""
    found = np.empty(len(starts), dtype=np.uint32)
    order = np.argsort(lengths, kind="stable")
    sizes, firsts = np.unique(lengths[order], return_index=True)
    for size, first, last in zip(sizes.tolist(), firsts, [*firsts[1:], len(order)]):
        if size > LONG:
            for k in order[first:last]:
                found[k] = zlib.crc32(data[starts[k] : starts[k] + size])
            continue
        most = max(1, MATRIX_BYTES // max(1, size))
        for part in range(first, last, most):
            rows = order[part : min(part + most, last)]
            matrix = data[starts[rows][:, None] + np.arange(size)]
            crc = np.full(len(rows), 0xFFFFFFFF, dtype=np.uint32)
            for column in range(size):
                crc = CRC_TABLE[(crc ^ matrix[:, column]) & 255] ^ (crc >> 8)
            found[rows] = ~crc
    return found


def _joined_runs(data: np.ndarray, starts: np.ndarray, stops: np.ndarray, rows: np.ndarray, n: int):
    """Bytes, starts, lengths and rows of all runs of `n` words of a row, joined by one space."""
    if n == 1:
        return data, starts, stops - starts, rows
    first = np.flatnonzero(rows[: len(rows) - n + 1] == rows[n - 1 :])
    words = first[:, None] + np.arange(n)
    sizes = (stops - starts)[words] + 1
    total = int(sizes.sum())
    source = np.repeat((starts[words] - np.cumsum(sizes).reshape(sizes.shape) + sizes).ravel(), sizes.ravel())
    source += np.arange(total)
    ends = np.cumsum(sizes.sum(axis=1))
    spaces = np.cumsum(sizes.ravel()) - 1
    joined = data[np.minimum(source, len(data) - 1)]
    joined[spaces] = 32
    lengths = sizes.sum(axis=1) - 1
    return joined, ends - lengths - 1, lengths, rows[first]


def feature_buckets(text: pa.Array, words: int = 1, buckets: int = BUCKETS) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For each slice of a text column: first row, row count, and row and bucket of every feature,
    which are the runs of 1 to `words` words."""
    for first, count, data, offsets in text_slices(text):
        data = lower_ascii(data)
        starts, stops, rows = word_spans(data, offsets, PUNCTUATION)
        of, found = [], []
        for n in range(1, words + 1):
            if len(starts) < n:
                continue
            joined, at, lengths, owner = _joined_runs(data, starts, stops, rows, n)
            hashes = SubstringHash(joined).of(at, at + lengths)
            _, one, where = np.unique(hashes, return_index=True, return_inverse=True)
            crc = crc32_of(joined, at[one], lengths[one])
            of.append(owner)
            found.append((crc % np.uint32(buckets)).astype(np.int64)[where])
        none = np.zeros(0, dtype=np.int64)
        yield first, count, np.concatenate(of or [none]), np.concatenate(found or [none])


def bucket_counts(texts: DataFrame, column: str, words: int = 1, buckets: int = BUCKETS) -> DataFrame:
    """How often each bucket occurs in all texts: bucket, n. A task gives each bucket once."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for _, _, _, found in feature_buckets(batch.column(0), words, buckets):
                seen += np.bincount(found, minlength=buckets)
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(seen[at])], names=["bucket", "n"])

    counted = texts.select(F.col(f"`{column}`")).mapInArrow(count, "bucket long, n long")
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


@dataclass(frozen=True)
class Gains:
    """Thousandths of the log ratio per bucket."""

    values: np.ndarray
    words: int

    def weigh(self, text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Feature count and weight of every text."""
        n = np.zeros(len(text), dtype=np.int64)
        total = np.zeros(len(text), dtype=np.int64)
        for first, count, rows, found in feature_buckets(text, self.words, len(self.values)):
            n[first : first + count] = np.bincount(rows, minlength=count)
            # Sums of doubles below 2**53 are exact.
            total[first : first + count] = np.bincount(rows, self.values[found], minlength=count)
        return n, np.where(n > 0, total // np.maximum(n, 1), 0)


def gains_of(docs: DataFrame, target: DataFrame, words: int = 1, buckets: int = BUCKETS) -> Gains:
    """Gains of all buckets, counted over the whole `text` columns of both tables. One row per
    bucket reaches the driver. Null texts have no features; with both tables empty all gains are 0."""
    counts = bucket_counts(docs, "text", words, buckets).select("bucket", F.col("n").alias("s"), F.lit(0).alias("t"))
    aims = bucket_counts(target, "text", words, buckets).select("bucket", F.lit(0).alias("s"), F.col("n").alias("t"))
    table = counts.unionByName(aims).groupBy("bucket").agg(F.sum("s").alias("s"), F.sum("t").alias("t")).toArrow()
    at = table.column("bucket").to_numpy()
    s, t = np.zeros(buckets), np.zeros(buckets)
    s[at], t[at] = table.column("s").to_numpy(), table.column("t").to_numpy()
    ratio = (t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets))
    return Gains(np.array([math.floor(1000 * math.log(r)) for r in ratio], dtype=np.int64), words)


def _noise(doc_id: Column, seed: str) -> Column:
    """Gumbel noise in thousandths from the SHA-256 of the seed and the id; a null id counts as empty."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("long")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))


def _weigher(gains: Gains):
    kind = pa.struct([("n_features", pa.int64()), ("weight", pa.int64())])

    @F.arrow_udf("n_features long, weight long")
    def weigh(text: pa.Array) -> pa.Array:
        n, weight = gains.weigh(text)
        return pa.StructArray.from_arrays([pa.array(n), pa.array(weight)], fields=list(kind))

    return weigh


def weighed(docs: DataFrame, gains: Gains, seed: str = SEED) -> DataFrame:
    """doc_id, n_features, weight and score of every row; `n_words` holds the features of one word."""
    weigh = _weigher(gains)
    rows = docs.select("doc_id", weigh(F.col("text")).alias("_w"))
    score = F.col("_w.weight") + _noise(F.col("doc_id"), seed)
    return rows.select("doc_id", "_w.n_features", "_w.weight", score.cast("long").alias("score"))


def _last_score(scores: DataFrame, percent: int) -> tuple[int, int]:
    """How many to draw, and the score of the last of them, from the histogram of the scores."""
    table = scores.groupBy("score").agg(F.count(F.lit(1)).alias("n")).toArrow()
    score, n = table.column("score").to_numpy(), table.column("n").to_numpy()
    order = np.argsort(-score)
    through = np.cumsum(n[order])
    wanted = percent * int(through[-1]) // 100 if len(through) else 0
    return wanted, int(score[order][np.searchsorted(through, wanted)]) if wanted else 0


def ranked(scored: DataFrame, percent: int, eligible: Column) -> DataFrame:
    """`scored` (stored; with doc_id and score) and `rank`: 1, 2, 3 ... for the `percent` of the eligible
    rows with the highest scores, ties to the smaller doc_id (null last), null for all others. Rows that
    agree in both are ranked in the order of storage."""
    allowed = F.coalesce(eligible, F.lit(False))
    wanted, last = _last_score(scored.where(allowed), percent)
    none = F.lit(None).cast("long")
    if not wanted:
        return scored.withColumn("rank", none)
    near = allowed & (F.col("score") >= last)
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("_stored")]
    # The stored position parts rows that agree in all else, so no range holds more than its share.
    top = scored.where(near).withColumn("_stored", F.monotonically_increasing_id())
    top = top.repartitionByRange(*order).sortWithinPartitions(*order).drop("_stored")
    at = F.monotonically_increasing_id()
    top = stored(top.withColumns({"_piece": F.shiftright(at, 33), "_at": at.bitwiseAND((1 << 33) - 1)}), "ranked")
    # One row per range: as few as there are reducers.
    pieces = top.groupBy("_piece").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1))
    pieces = pieces.select("_piece", F.coalesce(before, F.lit(0)).alias("_before"))
    rank = F.col("_before") + F.col("_at") + 1
    top = top.join(F.broadcast(pieces), "_piece").withColumn("rank", F.when(rank <= wanted, rank))
    return scored.where(~near).withColumn("rank", none).unionByName(top.drop("_piece", "_at", "_before"))


def resampled(
    docs: DataFrame, target: DataFrame, percent: int = 10, least_words: int = 20, words: int = 1, seed: str = SEED
) -> DataFrame:
    """doc_id, n_features, weight, score and rank of every row of `docs` against the texts of `target`.

    Rows of fewer than `least_words` features are never drawn. Null and empty texts have no features and
    weight 0; a null doc_id has the noise of an empty name; rows that repeat are drawn each on its own; an
    empty table gives no rows, an empty target a flat one. Other columns are not read.
    """
    gains = gains_of(docs, target, words)
    return ranked(stored(weighed(docs, gains, seed), "weighed"), percent, F.col("n_features") >= least_words)


def drawn_documents(
    docs: DataFrame, target: DataFrame, percent: int = 10, least_words: int = 20, words: int = 1, seed: str = SEED
) -> DataFrame:
    """The drawn documents with all their columns. The last drawn row's score and doc_id are the whole
    rule, so the texts are neither stored nor shuffled; rows that agree with it in both stay all."""
    gains = gains_of(docs, target, words)
    told = ranked(stored(weighed(docs, gains, seed), "weighed"), percent, F.col("n_features") >= least_words)
    last = told.where("rank IS NOT NULL").orderBy(F.col("rank").desc()).limit(1).select("score", "doc_id").collect()
    if not last:
        return docs.limit(0)
    weigh, every = _weigher(gains), F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("row")
    rows = docs.select(every, F.col("doc_id").alias("id"), weigh(F.col("text")).alias("w"))
    score = F.col("w.weight") + _noise(F.col("id"), seed)
    cut, of = last[0]
    # A null doc_id comes last among equal scores.
    tie = F.lit(True) if of is None else F.coalesce(F.col("id") <= of, F.lit(False))
    return rows.where((F.col("w.n_features") >= least_words) & ((score > cut) | ((score == cut) & tie))).select("row.*")


SQL = r"""
WITH crc_table AS (
    SELECT list(list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0],
                            lambda x, i: xor(x >> 1, CASE WHEN x % 2 = 1 THEN 3988292384 ELSE 0 END)) ORDER BY n) AS t
    FROM (SELECT unnest(range(256))::BIGINT AS n)
), words AS (
    SELECT doc_id, nth, word
    FROM (SELECT doc_id, row_number() OVER () AS nth, unnest(regexp_extract_all(
              translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word
          FROM documents)
), aims AS (
    SELECT unnest(regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word
    FROM benchmark
), known AS (
    SELECT word, hex(encode(word)) AS h FROM (SELECT word FROM words UNION SELECT word FROM aims)
), hashed AS (
    SELECT word, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(
               range(length(h) // 2), lambda i: CAST('0x' || substr(h, 2 * i::INT + 1, 2) AS BIGINT))),
               lambda c, b: xor(c >> 8, t[xor(c, b) % 256 + 1])), 4294967295) % 10000 AS bucket
    FROM known, crc_table
), s AS (
    SELECT bucket, count(*) AS s FROM words JOIN hashed USING (word) GROUP BY bucket
), t AS (
    SELECT bucket, count(*) AS t FROM aims JOIN hashed USING (word) GROUP BY bucket
), gains AS (
    SELECT bucket, CAST(floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT count(*) FROM words) + 10000)::DOUBLE
               / ((s + 1)::DOUBLE * ((SELECT count(*) FROM aims) + 10000)::DOUBLE))) AS BIGINT) AS gain
    FROM s LEFT JOIN t USING (bucket)
), sums AS (
    SELECT doc_id, count(*) AS n, sum(gain) AS g FROM words JOIN hashed USING (word) JOIN gains USING (bucket)
    GROUP BY doc_id
), scored AS (
    SELECT d.doc_id, coalesce(n, 0) AS n_features,
           coalesce(CAST(g - ((g % n) + n) % n AS BIGINT) // n, 0) AS weight,
           (CAST('0x' || substr(sha256('2024:' || d.doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE AS u
    FROM documents d LEFT JOIN sums USING (doc_id)
), noisy AS (
    SELECT doc_id, n_features, weight, weight + CAST(floor(-1000 * ln(-ln(u))) AS BIGINT) AS score FROM scored
), drawn AS (
    SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS nth, count(*) OVER () AS total
    FROM noisy WHERE n_features >= 20
)
SELECT n.doc_id, n_features, CAST(weight AS BIGINT) AS weight, CAST(score AS BIGINT) AS score, nth AS rank
FROM noisy n LEFT JOIN (SELECT * FROM drawn WHERE nth <= 10 * total // 100) d USING (doc_id)
"""
