"""Benchmark decontamination that also sees questions with other numbers, names and units.

Texts are brought to templates: numbers, mid-sentence capitalised words and the units after numbers
become typed placeholders. An item is parted into one block more than tokens may differ at the wanted
coverage, so an occurrence holds one block whole; blocks are joined by hash with the windows at every
place of a document. A hit proposes where in the document the item would begin; there the templates are compared token by
token, and names must map one to one: an item's "Ann" may be "Bob", but then everywhere, and nothing
else may be "Bob". Of a number or unit with several values in the document the most frequent one counts,
each other place is a token that differs; two numbers may become one.

Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.llm.tables import let, nested

WINDOW = 4
MIN_TOKENS = 7
COVERAGE = 0.8
BROADCAST_WINDOWS = 200_000

NAME, NUMBER, UNIT = "0n", "0d", "0u"
PLACEHOLDERS = (NAME, NUMBER, UNIT)

# Units that may follow a number.
UNITS = (
    "mm cm m km in inch inches ft foot feet yard yards mile miles mg g kg t lb lbs oz ounces pounds grams kilograms "
    "ml l liters litres gallons s sec seconds min minutes h hours days weeks months years cents dollars euros usd eur "
    "percent degrees meters metres kilometers kilometres"
).split()

# Stands for a comma or full stop within a number; a letter to the patterns below.
_POINT = "ː"
_APART = r"[^\p{L}\p{M}\p{N}]+"


def _even(text: Column) -> Column:
    text = F.regexp_replace(text, r"(?<=\d)[.,](?=\d)", _POINT)
    return F.regexp_replace(text, r"(?<=\d)(?=[A-Za-z])", " ")


def _tokens(text: Column) -> Column:
    return F.filter(F.split(text, _APART), lambda token: token != "")


def values(text: Column) -> Column:
    """The tokens of a text in lower case."""
    return _tokens(F.lower(_even(text)))


def template(text: Column) -> Column:
    """The tokens of a text with placeholders, one for each of `values`."""
    text = F.regexp_replace(_even(text), r"[\s\p{Z}]{2,}|[\s\p{Z}&&[^ ]]", " ")
    text = F.regexp_replace(text, r"(?<=[\p{Ll}\p{N},;] )\p{Lu}[\p{L}\p{M}]*(?![\p{N}])", NAME)
    text = F.regexp_replace(F.lower(text), rf"(?<![\p{{L}}\p{{N}}])\d[\d{_POINT}]*(?![\p{{L}}\p{{N}}])", NUMBER)
    text = F.regexp_replace(text, rf"(?<={NUMBER} )(?:{'|'.join(UNITS)})(?![\p{{L}}\p{{N}}])", UNIT)
    return _tokens(text)


def _windows(tokens: Column, length: int) -> Column:
    """(length, hash, at) of the windows of a fixed length, at every place."""
    windows = F.transform(
        F.sequence(F.lit(0), F.size(tokens) - length),
        lambda i: F.struct(
            F.lit(length).alias("length"),
            F.xxhash64(*[F.get(tokens, i + k) for k in range(length)]).alias("hash"),
            i.alias("at"),
        ),
    )
    return F.when(F.size(tokens) >= length, windows).otherwise(F.array().cast(_WINDOWS))


_WINDOWS = "array<struct<length:int,hash:bigint,at:int>>"


def items(benchmark: DataFrame) -> DataFrame:
    """item_id, template and values of the items that can be told from common text."""
    told = benchmark.where("text IS NOT NULL").select(
        "item_id", template(F.col("text")).alias("template"), values(F.col("text")).alias("values")
    )
    return told.where(F.size("template") >= MIN_TOKENS).distinct()


def item_windows(questions: DataFrame, coverage: float) -> DataFrame:
    """length, hash, item_id, item_at and tokens (of the item) of one window in each block of the items."""
    tokens = F.size("template")
    # As many tokens may differ as leave the coverage; of one block more, one at least is whole.
    blocks = tokens - F.ceil(tokens * coverage - 1e-9).cast("int") + 1
    begin = lambda k: F.floor(k * tokens / blocks).cast("int")
    every = questions.select("item_id", "template", tokens.alias("tokens"), blocks.alias("blocks"), F.explode(
        F.transform(F.sequence(F.lit(0), blocks - 1), lambda k: F.struct(begin(k).alias("at"), begin(k + 1).alias("end")))
    ).alias("block")).where("block.end > block.at")
    every = every.withColumn("length", F.least(F.lit(WINDOW), F.col("block.end") - F.col("block.at")))
    parts = None
    for length in range(1, WINDOW + 1):
        hashed = F.xxhash64(*[F.get("template", F.col("block.at") + k) for k in range(length)])
        part = every.where(F.col("length") == length).select(
            "length", hashed.alias("hash"), "item_id", F.col("block.at").alias("item_at"), "tokens"
        )
        parts = part if parts is None else parts.union(part)
    return parts


def leaks(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """doc_id, item_id, covered (share of the item's tokens), n_slots and n_changed of every item
    found in a document.

    Reads `doc_id` and `text` of `docs`, `item_id` and `text` of `benchmark`; other columns may bear
    any name. Null and empty texts hold nothing; items of fewer than `MIN_TOKENS` tokens are not
    looked for. Rows that repeat a doc_id are one document to the result, and so are rows without
    one. Each pair is given once, with its best occurrence. Empty tables give no rows.
    """
    docs = docs.select("doc_id", "text")
    questions = items(benchmark)
    wanted = item_windows(questions, coverage)
    lengths = [row["length"] for row in wanted.select("length").distinct().collect()]
    if wanted.count() <= BROADCAST_WINDOWS:
        wanted = F.broadcast(wanted)

    def all_windows(tokens: Column) -> Column:
        parts = [_windows(tokens, length) for length in sorted(lengths)]
        return F.concat(*parts) if parts else F.array().cast(_WINDOWS)

    proposed = (
        docs.select("doc_id", F.explode(let(template(F.col("text")), all_windows)).alias("window"))
        .select("doc_id", "window.length", "window.hash", "window.at")
        .join(wanted, ["length", "hash"])
        .select("doc_id", F.struct("item_id", (F.col("at") - F.col("item_at")).alias("start"), "tokens").alias("place"))
        .groupBy(F.col("doc_id").alias("in_doc"))
        .agg(F.collect_set("place").alias("places"))
    )

    def stretch(tokens: Column, place: Column) -> Column:
        """The tokens from the proposed start on, nulls where the document has none."""
        at = F.sequence(place["start"], place["start"] + place["tokens"] - 1)
        return F.transform(at, lambda k: F.when(k >= 0, F.get(tokens, k)))

    def cut(of: Column, said: Column) -> Column:
        return F.transform(
            "places",
            lambda p: F.struct(p["item_id"].alias("item_id"), p["tokens"].alias("tokens"), stretch(of, p).alias("of_doc"), stretch(said, p).alias("doc_values")),
        )

    # Few rows against whole texts: Spark sees how few and picks the join. A text is parted once for all places.
    found = (
        proposed.join(docs, F.col("in_doc").eqNullSafe(F.col("doc_id")))
        .select("doc_id", F.explode(let(template(F.col("text")), lambda t: let(values(F.col("text")), lambda v: cut(t, v)))).alias("place"))
        .select("doc_id", "place.*")
        .join(questions.withColumn("tokens", F.size("template")), ["item_id", "tokens"])
    )
    return _verified(found, coverage)


def _verified(found: DataFrame, coverage: float) -> DataFrame:
    """Compare the templates where an item would begin, and the values of their placeholders."""

    here = found.select(
        "doc_id",
        "item_id",
        F.col("template").alias("of_item"),
        F.col("values").alias("item_values"),
        "of_doc",
        "doc_values",
    )
    same = F.filter(
        F.transform(
            F.arrays_zip("of_item", "of_doc", "item_values", "doc_values"),
            lambda t: F.when(
                t["of_item"] == t["of_doc"],
                F.struct(
                    t["of_item"].isin(*PLACEHOLDERS).alias("slot"),
                    (t["of_item"] == NAME).alias("name"),
                    t["item_values"].alias("said"),
                    t["doc_values"].alias("says"),
                ),
            ),
        ),
        lambda t: t.isNotNull(),
    )
    here = here.select("doc_id", "item_id", F.size("of_item").alias("tokens"), same.alias("same"))
    here = here.withColumn("slots", F.filter("same", lambda t: t["slot"]))
    here = here.withColumns(
        {"names": F.filter("slots", lambda t: t["name"]), "numbers": F.filter("slots", lambda t: ~t["name"])}
    )
    pairs = F.size(F.array_distinct(F.transform("names", lambda t: F.struct(t["said"], t["says"]))))
    one_to_one = (pairs == F.size(F.array_distinct(F.transform("names", lambda t: t["said"])))) & (
        pairs == F.size(F.array_distinct(F.transform("names", lambda t: t["says"])))
    )
    # For each value of the item, at how many places the document has the same one, at most.
    alike = F.transform(
        F.array_distinct(F.transform("numbers", lambda t: t["said"])),
        lambda said: F.array_max(
            F.transform(
                F.filter("numbers", lambda t: t["said"] == said),
                lambda t: F.size(F.filter("numbers", lambda u: (u["said"] == said) & (u["says"] == t["says"]))),
            )
        ),
    )
    consistent = F.aggregate(alike, F.lit(0), lambda n, k: n + k)
    covered = (F.size("same") - F.size("numbers") + consistent) / F.col("tokens")
    best = F.struct(
        covered.alias("covered"),
        F.size("slots").alias("n_slots"),
        F.size(F.filter("slots", lambda t: t["said"] != t["says"])).alias("n_changed"),
    )
    return (
        here.where((covered >= coverage) & one_to_one)
        .groupBy("doc_id", "item_id")
        .agg(F.max(best).alias("best"))
        .select("doc_id", "item_id", "best.covered", "best.n_slots", "best.n_changed")
    )


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no item, with all their columns. Rows are judged by doc_id and text: rows that
    share a doc_id, or have none, go or stay each for its own text. Cases as for `leaks`."""
    named = F.struct(F.col("doc_id").alias("id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"))
    held = leaks(docs.select(named.alias("doc_id"), "text"), benchmark).select("doc_id.*").distinct().toDF("of", "with")
    rows = nested(docs, id=F.col("doc_id"), text_hash=named["text_hash"])
    same = F.col("id").eqNullSafe(F.col("of")) & (F.col("text_hash") == F.col("with"))
    return rows.join(held, same, "left_anti").select("row.*")
