"""Order of suffixes by the difference-cover algorithm, for many strings at once.

Strings are arrays of symbols (positive numbers); a string is followed by zeros. Of every three
positions, the second and third are sampled:

1. the triples of symbols at sampled positions are sorted, and their rank becomes their name,
2. if a name is borne by several triples that may still differ further on, the names of the second
   positions of a string make a string, and those of the third, whose suffixes are ordered in the same way,
3. the other suffixes are a symbol and a sampled suffix, and are merged into that order.

Suffixes that agree on `limit` bytes need no order, nor do those that are equal to their ends, so a level
that names as much is the last. Triples are counted before they are sorted and equal suffixes are one
row, so text that stands in very many places is no larger to sort than text that stands twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivulet.llm.tables import by_few, forget, stored

TRIPLE = ["t0", "t1", "t2"]


def _at(array: str, i: Column) -> Column:
    return F.coalesce(F.get(array, i), F.lit(0))


def sampled_ranks(strings: DataFrame, limit: int, tasks: int | None) -> tuple[DataFrame, list[DataFrame]]:
    """`string`, `i` and `rank` of the sampled suffixes of `strings` (string, symbols, bytes), and the stored
    frames that they are read from. `bytes` are those each symbol stands for. A rank is the name and, where
    names did not tell, the rank of the string of names from there on."""
    places = F.filter(F.sequence(F.lit(0), F.size("symbols") - 1), lambda i: i % 3 != 0)
    triples = strings.select("string", "symbols", "bytes", F.explode(places).alias("i")).select(
        "string",
        "i",
        *[_at("symbols", F.col("i") + k).alias(name) for k, name in enumerate(TRIPLE)],
        sum(_at("bytes", F.col("i") + k) for k in range(3)).alias("bytes"),
    )
    names = triples.groupBy(*TRIPLE).agg(F.first("bytes").alias("bytes"), F.count("*").alias("n"))
    names = by_few(names, tasks).repartitionByRange(*TRIPLE).sortWithinPartitions(*TRIPLE)
    # Numbers that rise over sorted partitions: ranks with gaps.
    names = stored(names.withColumn("name", F.monotonically_increasing_id() + 1), "names", tasks)
    named = triples.drop("bytes").join(names, TRIPLE)
    unsettled = (F.col("n") > 1) & (F.col("bytes") < limit) & (F.col("t2") != 0)
    named = named.select("string", "i", (F.col("i") % 3).alias("kind"), "name", "bytes", unsettled.alias("unsettled"))
    named = stored(named, "named", tasks)
    forget(names)
    none = F.lit(0).cast("long")
    settled = named.where("NOT unsettled").select("string", "i", F.struct("name", none.alias("further")).alias("rank"))
    if named.where("unsettled").isEmpty():
        return settled, [named]
    # A settled name ends every comparison that reaches it: strings of names are cut behind it, and what
    # begins with one is not looked at.
    along = Window.partitionBy("string", "kind").orderBy("i")
    so_far = F.sum(F.when(F.col("unsettled"), 0).otherwise(1)).over(along.rowsBetween(Window.unboundedPreceding, -1))
    pieces = (
        named.withColumns(
            {
                "piece": F.coalesce(so_far, F.lit(0)),
                "goes_on": F.lag("unsettled", 1, False).over(along),
            }
        )
        .where("unsettled OR goes_on")
        .groupBy("string", "kind", "piece")
        .agg(F.sort_array(F.collect_list(F.struct("i", "name", "bytes"))).alias("told"))
        .select(F.col("string").alias("of"), "told.i", F.col("told.name").alias("symbols"), "told.bytes")
    )
    pieces = stored(pieces.withColumn("string", F.monotonically_increasing_id()), "pieces", tasks)
    found = suffix_ranks(pieces.select("string", "symbols", "bytes"), limit, tasks)
    ranked = found.join(pieces.select("string", "of", F.col("i").alias("places")), "string").select(
        F.col("of").alias("string"), F.get("places", F.col("i")).alias("i"), F.col("rank").alias("further")
    )
    further = named.where("unsettled").select("string", "i", "name").join(ranked, ["string", "i"])
    return settled.union(further.select("string", "i", F.struct("name", "further").alias("rank"))), [named, pieces, found]


def keyed_suffixes(strings: DataFrame, limit: int, tasks: int | None = None) -> DataFrame:
    """Every suffix (`string`, `i`) with what orders it: its kind, its first two symbols, and the ranks of
    the sampled suffixes among the three that begin at it, at the next and at the one after."""
    ranks, used = sampled_ranks(strings, limit, tasks)
    ranks = ranks.groupBy("string").agg(F.map_from_entries(F.collect_list(F.struct("i", "rank"))).alias("ranks"))
    every = strings.join(ranks.select(F.col("string").alias("of"), "ranks"), F.col("string") == F.col("of"), "left")
    every = every.select("string", "symbols", "ranks", F.explode(F.sequence(F.lit(0), F.size("symbols") - 1)).alias("i"))

    none = F.struct(F.lit(0).cast("long").alias("name"), F.lit(0).cast("long").alias("further"))

    def rank(k: int) -> Column:
        return F.coalesce(F.try_element_at("ranks", F.col("i") + k), none)

    kind = F.col("i") % 3
    keyed = every.select(
        "string",
        "i",
        kind.alias("kind"),
        _at("symbols", F.col("i")).alias("s0"),
        _at("symbols", F.col("i") + 1).alias("s1"),
        F.when(kind != 0, rank(0)).otherwise(none).alias("r0"),
        F.when(kind != 2, rank(1)).otherwise(none).alias("r1"),
        F.when(kind != 1, rank(2)).otherwise(none).alias("r2"),
    )
    keyed = stored(keyed, "suffixes", tasks)
    forget(*used)
    return keyed


KEY = ["kind", "s0", "s1", "r0", "r1", "r2"]


def _later(a: str, b: Column) -> Column:
    return F.when(F.col(a) > b, F.col(a)).otherwise(b)


def distinct_suffixes(keyed: DataFrame, tasks: int | None) -> DataFrame:
    """The distinct suffixes, with `n`, how many there are."""
    return stored(keyed.groupBy(*KEY).agg(F.count("*").alias("n")), "distinct-suffixes", tasks)


def merged(distinct: DataFrame) -> DataFrame:
    """The distinct suffixes with `base` and `after`: within a first symbol (`s0`), the order by base,
    after and r1 is that of the suffixes.

    Unsampled suffixes are placed behind the last sampled one that does not exceed them: among those of
    second positions by the rank of the next suffix, among those of third positions by the next symbol
    and the rank of the suffix after it."""
    none = F.struct(F.lit(0).cast("long").alias("name"), F.lit(0).cast("long").alias("further"))
    second = Window.partitionBy("s0").orderBy("r1")
    third = Window.partitionBy("s0").orderBy("s1", "r2")
    below = F.max(F.when(F.col("kind") == 1, F.col("r0"))).over(second)
    placed = distinct.where("kind < 2").withColumn("low", F.coalesce(below, none))
    rest = placed.where("kind = 0").unionByName(
        distinct.where("kind = 2").withColumn("low", none)
    )
    below = F.max(F.when(F.col("kind") == 2, F.col("r0"))).over(third)
    rest = rest.withColumn("low", _later("low", F.coalesce(below, none))).where("kind = 0")
    sampled = distinct.where("kind > 0")
    return rest.withColumns({"base": F.col("low"), "after": F.lit(1)}).drop("low").unionByName(
        sampled.withColumns({"base": F.col("r0"), "after": F.lit(0)})
    )


def suffix_ranks(strings: DataFrame, limit: int, tasks: int | None = None) -> DataFrame:
    """`string`, `i` and `rank` of every suffix of `strings`, stored."""
    keyed = keyed_suffixes(strings, limit, tasks)
    distinct = distinct_suffixes(keyed, tasks)
    order = ["s0", "base", "after", "r1"]
    ranks = by_few(merged(distinct), tasks).repartitionByRange(*order).sortWithinPartitions(*order)
    ranks = stored(ranks.select(*KEY, (F.monotonically_increasing_id() + 1).alias("rank")), "ranks", tasks)
    forget(distinct)
    ranked = stored(keyed.join(ranks, KEY).select("string", "i", "rank"), "ranked", tasks)
    forget(keyed, ranks)
    return ranked


def neighbours_agree(distinct: DataFrame) -> DataFrame:
    """The distinct suffixes that share their first two symbols with another suffix: those that are there
    more than once, or agree with the one before or behind them in the order."""
    by = Window.partitionBy("s0").orderBy("base", "after", "r1")
    told = merged(distinct).withColumns({"before": F.lag("s1").over(by), "behind": F.lead("s1").over(by)})
    agrees = (F.col("n") > 1) | (F.col("s1") == F.col("before")) | (F.col("s1") == F.col("behind"))
    return told.where((F.col("s1") != 0) & agrees).select(key_hash().alias("suffix"))


def key_hash() -> Column:
    """A short form of the key, for joins in which a rare false match does no harm."""
    return F.xxhash64(*KEY)
