"""Mixing sources to target weights by systematic sampling.

Every document expects target / size copies of its source, at most `most` of them. The expected
copies are summed up along each source, one random offset per source is added, and a document is
taken once for each whole number that its stretch of the sum crosses. So it is taken floor(x) or
ceil(x) times for x expected copies, and along a source the taken copies never stray from the
expected ones by more than one.

Sums are whole numbers (units of 2**-24 copies), so neither order nor grouping of the additions
changes them. The running sum is kept per stretch of a source: documents that agree in the first six
bits of their size, parted by eight bits of a hash. Only the sums of whole stretches are added up
over a source, so a source that holds most rows is still summed by many tasks; and as the stretches
run by size, each size is sampled at the same rate and the taken words come near their target.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivulet.llm.tables import nested, unit_hash, word_count

UNIT = 1 << 24
SEED = "mix"


def source_targets(sizes: DataFrame, weights: Column, most: float = 3.0) -> DataFrame:
    """Targets that share the total size by weight, none above `most` times its source's size.

    sizes: one row per source with `source` and `source_size`; weights: a column over the rank
    (`nth`, from 0, by code point, null last). What a source cannot take is shared by the others by
    weight until none is above. That is one level of words per weight for all sources that are not
    full. With sources in order of how soon they fill, the level left when those before are full
    rises as long as the next is full as well and falls afterwards, so it is the largest of these
    levels. The windows span one row per source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sizes.withColumn("nth", F.row_number().over(by_name) - 1)
    ranked = ranked.withColumn("weight", weights.cast("double"))
    ranked = ranked.withColumn("cap", F.lit(most) * F.col("source_size"))
    everything = Window.partitionBy()
    fills = Window.orderBy((F.col("cap") / F.col("weight")).asc(), "nth")
    before = fills.rowsBetween(Window.unboundedPreceding, -1)
    ranked = ranked.select(
        "*",
        (
            (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
            / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
        ).alias("level"),
    )
    level = F.max("level").over(everything)
    return ranked.select("source", "source_size", F.least("cap", F.col("weight") * level).alias("target"))


def cyclic_weights(*weights: int) -> Column:
    """Weights that repeat over the ranked sources."""
    return F.element_at(F.array(*map(F.lit, weights)), (F.col("nth") % len(weights) + 1).cast("int"))


def _stretch(group: Column, size: Column, key: Column, seed: str) -> dict[str, Column]:
    bits = F.length(F.bin(size))
    return {
        "_group": group,
        "_bits": bits,
        "_lead": F.call_function("shiftright", size, F.greatest(bits - 6, F.lit(0))),
        "_salt": unit_hash(8, F.lit(seed), key),
    }


def systematic_copies(
    docs: DataFrame,
    expected: Column,
    group: Column,
    size: Column,
    key: Column,
    seed: str = SEED,
) -> DataFrame:
    """`docs` with `_copies`, how often each row is taken. `expected`: copies in units of 1 / UNIT.
    Rows that agree in group, size and key are interchangeable."""
    units = F.coalesce(expected, F.lit(0)).cast("long")
    stretch = _stretch(group, size, key, seed)
    rows = docs.withColumns({**stretch, "_units": units, "_size": size, "_key": key})
    inside = Window.partitionBy(*stretch).orderBy("_size", "_key").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_sum", F.sum("_units").over(inside))
    along = Window.partitionBy("_group").orderBy("_bits", "_lead", "_salt")
    bases = (
        docs.select(*[c.alias(name) for name, c in stretch.items()], units.alias("_units"))
        .groupBy(*stretch)
        .agg(F.sum("_units").alias("_whole"))
        .withColumn(
            "_base",
            F.coalesce(F.sum("_whole").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        )
        .select(*[F.col(name).alias(name + "_") for name in stretch], "_base")
    )
    matched = reduce(and_, [F.col(name).eqNullSafe(F.col(name + "_")) for name in stretch])
    end = F.col("_sum") + F.col("_base") + unit_hash(24, F.lit(seed), F.lit("offset"), F.col("_group"))
    whole = lambda x: F.floor(x / UNIT).cast("long")
    return (
        rows.join(bases, matched, "left")
        .withColumn("_copies", whole(end) - whole(end - F.col("_units")))
        .drop(*stretch, *[name + "_" for name in stretch], "_units", "_size", "_key", "_sum", "_base")
    )


def mixture(docs: DataFrame, weights: Column | None = None, most: float = 3.0, seed: str = SEED) -> DataFrame:
    """What the mix takes of each document: doc_id, size, source_size, target, copies, taken.

    Reads `doc_id`, `source` and `text` only, so other columns may bear any name. Null text has size
    0, a null source is a source of its own, rows that repeat are taken each on its own. A source
    without words has target 0 and its documents are not taken. An empty table gives no rows.
    """
    docs = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"))
    sizes = docs.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(sizes, cyclic_weights(1, 2, 3) if weights is None else weights, most)
    targets = targets.withColumnRenamed("source", "named")
    # One row per source: Spark measures the side and broadcasts it if it is small.
    docs = docs.join(targets, F.col("source").eqNullSafe(F.col("named")), "left").drop("named")
    expected = F.floor(F.try_divide("target", "source_size") * UNIT + 0.5)
    docs = systematic_copies(docs, expected, F.col("source"), F.col("size"), F.col("doc_id"), seed)
    return docs.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        F.col("_copies").alias("copies"),
        (F.col("_copies") * F.col("size")).alias("taken"),
    )


def mixed_documents(docs: DataFrame, weights: Column | None = None, most: float = 3.0, seed: str = SEED) -> DataFrame:
    """The documents of the mix with all their columns, each as often as it is taken. Rows that
    agree in doc_id, source and size are interchangeable."""
    rows = nested(docs, doc_id=F.col("doc_id"), source=F.col("source"), words=word_count(F.col("text")))
    sizes = rows.groupBy("source").agg(F.sum("words").alias("source_size"))
    targets = source_targets(sizes, cyclic_weights(1, 2, 3) if weights is None else weights, most)
    rate = F.floor(F.try_divide("target", "source_size") * UNIT + 0.5).cast("long")
    targets = targets.select(F.col("source").alias("named"), rate.alias("rate"))
    rows = rows.join(targets, F.col("source").eqNullSafe(F.col("named")), "left")
    rows = systematic_copies(rows, F.col("rate"), F.col("source"), F.col("words"), F.col("doc_id"), seed)
    repeated = F.array_repeat(F.lit(0), F.col("_copies").cast("int"))
    return rows.select("row", F.explode(repeated)).select("row.*")


SQL = rf"""
WITH d AS (
    SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
    FROM documents
), s AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source
), r AS (
    SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS nth FROM s
), w AS (
    SELECT *, CAST(nth % 3 + 1 AS DOUBLE) AS weight, 3.0::DOUBLE * source_size AS cap FROM r
), v AS (
    SELECT *, (sum(source_size) OVER ()
               - coalesce(sum(cap) OVER (ORDER BY cap / weight, nth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
              / (sum(weight) OVER ()
               - coalesce(sum(weight) OVER (ORDER BY cap / weight, nth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
              AS level
    FROM w
), t AS (
    SELECT source, source_size, least(cap, weight * max(level) OVER ()) AS target FROM v
), e AS (
    SELECT d.doc_id, d.source, size, source_size, target,
           CAST(coalesce(floor(target / nullif(source_size, 0) * {UNIT} + 0.5), 0) AS BIGINT) AS units,
           length(bin(size)) AS bits, size >> greatest(length(bin(size)) - 6, 0) AS lead,
           CAST('0x' || substr(md5('{SEED}|' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 2) AS BIGINT) AS salt
    FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), c AS (
    SELECT *, CAST(sum(units) OVER (PARTITION BY source ORDER BY bits, lead, salt, size, doc_id
                                    ROWS UNBOUNDED PRECEDING) AS BIGINT)
              + CAST('0x' || substr(md5('{SEED}|offset|' || coalesce(source, '')), 1, 6) AS BIGINT) AS through
    FROM e
), k AS (
    SELECT *, through // {UNIT} - (through - units) // {UNIT} AS copies FROM c
)
SELECT doc_id, size, source_size, target, copies, copies * size AS taken FROM k
"""
