"""Quality rules whose thresholds follow the corpus: quantile sketches per language and source.

The sketch of a metric is a histogram over buckets that keep the first `SKETCH_BITS` bits of a whole
number, so a quantile is off by at most 2**(1 - SKETCH_BITS) of its value. Sketches merge by adding
counts: per task, then per language and source, then per language and over everything. Nothing is
sampled and the order of merging leaves no trace.

A group holds out what is far above its own habit: above one and a half times the rate that 99 of 100 of
its documents stay within. That quantile is drawn towards the one of the language, and that towards
the one of all documents, each as if `PRIOR` documents of the wider group were in it: a large group
decides alone, a small one hardly, and none by a switch. No fixed number takes part.

Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivulet.llm.tables import let, stored

SKETCH_BITS = 7
QUANTILE = 99  # of a hundred
PRIOR = 200
WINDOW = 5
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\f\r"

# Rates per thousand, each judged by its own quantiles.
METRICS = ["symbol_rate", "line_rate", "repeat_rate", "length_rate"]
MIN_WORDS = 10
MOST_REPEATED_PERCENT = 20


def words_of(text: Column) -> Column:
    even = F.translate(text, BLANKS, " " * len(BLANKS))
    return F.filter(F.split(even, " "), lambda w: w != "")


def _without(text: Column, characters: str) -> Column:
    return F.length(F.translate(text, characters, ""))


def lines_of(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda line: _without(line, BLANKS) > 0)


def repeated_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier one."""
    return let(lines_of(text), lambda lines: F.size(lines) - F.size(F.array_distinct(lines)))


def repeated_words(words: Column) -> Column:
    """Words in windows of `WINDOW` words that stand in the text more than once.

    Hashes of all windows are sorted with their positions; neighbours of equal hash are repeated, and
    along their positions each adds the words that the one before did not reach. Texts without a
    repeated window, which are most, stop after counting distinct hashes.
    """

    def by_hash(windows: Column) -> Column:
        last = F.size(windows)
        numbered = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def neighbours(ordered: Column) -> Column:
            def same(k: Column, other: Column) -> Column:
                return F.get(ordered, k)["h"] == F.get(ordered, other)["h"]

            hits = F.filter(ordered, lambda _, k: ((k > 0) & same(k, k - 1)) | ((k + 1 < last) & same(k, k + 1)))
            return F.array_sort(F.transform(hits, lambda hit: hit["i"]))

        return let(numbered, neighbours)

    def covered(positions: Column) -> Column:
        start = F.struct(F.lit(0).alias("words"), F.lit(-WINDOW).alias("at"))
        return F.aggregate(
            positions,
            start,
            lambda seen, i: F.struct(
                (seen["words"] + F.least(F.lit(WINDOW), i - seen["at"])).alias("words"), i.alias("at")
            ),
            lambda seen: seen["words"],
        )

    def hashes(w: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(w) - WINDOW)
        return F.transform(starts, lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(WINDOW)]))

    def count(windows: Column) -> Column:
        distinct = F.size(F.array_distinct(windows))
        return F.when(distinct == F.size(windows), F.lit(0)).otherwise(covered(by_hash(windows)))

    return F.when(F.size(words) <= WINDOW, F.lit(0)).otherwise(let(words, lambda w: let(hashes(w), count)))


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source and the counts of every document, one row for each row of `docs`."""
    text = F.coalesce("text", F.lit(""))
    words = words_of(text)
    return docs.select(
        "doc_id",
        "lang",
        "source",
        let(
            text,
            lambda t: F.struct(
                F.size(lines_of(t)).cast("long").alias("n_lines"),
                _without(t, BLANKS).cast("long").alias("word_chars"),
                (F.length(t) - _without(t, SYMBOLS)).cast("long").alias("n_symbols"),
                repeated_lines(t).cast("long").alias("n_dup_lines"),
            ),
        ).alias("of_text"),
        let(
            words,
            lambda w: F.struct(
                F.size(w).cast("long").alias("n_words"), repeated_words(w).cast("long").alias("n_repeat_words")
            ),
        ).alias("of_words"),
    ).select(
        "doc_id",
        "lang",
        "source",
        "of_words.n_words",
        "of_text.word_chars",
        "of_text.n_symbols",
        "of_text.n_lines",
        "of_text.n_dup_lines",
        "of_words.n_repeat_words",
    )


def rates(counts: DataFrame) -> DataFrame:
    """The metrics as whole numbers per thousand."""

    def per_mille(part: str, whole: str) -> Column:
        return F.floor(F.col(part) * 1000 / F.greatest(F.col(whole), F.lit(1))).cast("long")

    return counts.withColumns(
        {
            "symbol_rate": per_mille("n_symbols", "word_chars"),
            "line_rate": per_mille("n_dup_lines", "n_lines"),
            "repeat_rate": per_mille("n_repeat_words", "n_words"),
            "length_rate": per_mille("word_chars", "n_words"),
        }
    )


def bucket(value: Column) -> Column:
    """The smallest number that shares the first `SKETCH_BITS` bits and the length with `value`."""
    spare = F.greatest(F.length(F.bin(value)) - SKETCH_BITS, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, spare), spare)


def sketches(metrics: DataFrame, by: list[str], names: list[str]) -> DataFrame:
    """One row per group, metric and bucket with its count. Tasks count before anything is
    shuffled, so a hot group sends a few hundred rows from each of them."""
    pairs = [F.struct(F.lit(n).alias("metric"), bucket(F.col(n)).alias("bucket")) for n in names]
    return (
        metrics.select(*by, F.explode(F.array(*pairs)).alias("pair"))
        .groupBy(*by, "pair")
        .agg(F.count("*").alias("n"))
        .select(*by, "pair.metric", "pair.bucket", "n")
    )


def merged(sketch: DataFrame, by: list[str]) -> DataFrame:
    """Sketches of finer groups as those of coarser ones."""
    return sketch.groupBy(*by, "metric", "bucket").agg(F.sum("n").alias("n"))


def quantiles(sketch: DataFrame, by: list[str]) -> DataFrame:
    """Per group and metric: rows and the bucket that `QUANTILE` of a hundred rows do not exceed."""
    upto = Window.partitionBy(*by, "metric").orderBy("bucket")
    ranked = sketch.withColumns(
        {"upto": F.sum("n").over(upto), "rows": F.sum("n").over(Window.partitionBy(*by, "metric"))}
    )
    reached = F.when(F.col("upto") * 100 >= F.col("rows") * QUANTILE, F.col("bucket"))
    return ranked.groupBy(*by, "metric").agg(F.max("rows").alias("rows"), F.min(reached).alias("high"))


def thresholds(metrics: DataFrame) -> DataFrame:
    """What documents of every language and source may reach, one column (`most_...`) per metric."""
    fine = sketches(metrics, ["lang", "source"], METRICS)
    by_lang = merged(fine, ["lang"])

    def wide(sketch: DataFrame, by: list[str], prefix: str) -> DataFrame:
        return (
            quantiles(sketch, by)
            .groupBy(*by)
            .agg(
                F.max("rows").alias(prefix + "rows"),
                *[F.max(F.when(F.col("metric") == n, F.col("high"))).alias(prefix + n) for n in METRICS],
            )
        )

    own = wide(fine, ["lang", "source"], "own_")
    lang = wide(by_lang, ["lang"], "lang_").withColumnRenamed("lang", "of_lang")
    every = wide(merged(by_lang, []).withColumn("all", F.lit(0)), ["all"], "all_")
    joined = own.join(lang, F.col("lang").eqNullSafe(F.col("of_lang")), "left")
    joined = joined.withColumn("all", F.lit(0)).join(every, "all", "left")

    def drawn(prefix: str, name: str, towards: Column) -> Column:
        rows = F.col(prefix + "rows")
        return F.floor((rows * F.col(prefix + name) + PRIOR * towards) / (rows + PRIOR))

    def most(name: str) -> Column:
        return F.floor(drawn("own_", name, drawn("lang_", name, F.col("all_" + name))) * 3 / 2)

    return joined.select("lang", "source", *[most(n).alias("most_" + n) for n in METRICS])


def judged(docs: DataFrame) -> DataFrame:
    """Counts and verdict of every document, one row for each row of `docs`, whose columns
    `doc_id`, `lang`, `source` and `text` are read and whose other columns may bear any name.

    Null text has no words and fails. Null languages and sources are groups of their own. Rows that
    repeat are judged alike. An empty table gives no rows.
    """
    metrics = stored(rates(measured(docs)), "quality-counts")
    base_failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words")
    )
    # What the base holds out takes no part in the habits of its group.
    limits = thresholds(metrics.where(~base_failed)).withColumnsRenamed({"lang": "of_lang", "source": "of_source"})
    # One row per language and source.
    of_group = F.col("lang").eqNullSafe(F.col("of_lang")) & F.col("source").eqNullSafe(F.col("of_source"))
    within = F.lit(True)
    for name in METRICS:
        within = within & (F.col(name) <= F.col("most_" + name))
    return metrics.join(limits, of_group, "left").select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        base_failed.alias("base_failed"),
        (~base_failed & F.coalesce(within, F.lit(False))).alias("kept"),
    )


_RATES = {
    "symbol_rate": "n_symbols * 1000 // greatest(word_chars, 1)",
    "line_rate": "n_dup_lines * 1000 // greatest(n_lines, 1)",
    "repeat_rate": "n_repeat_words * 1000 // greatest(n_words, 1)",
    "length_rate": "word_chars * 1000 // greatest(n_words, 1)",
}


def _quantile_sql(name: str, alias: str, by: str) -> str:
    return f"""{alias}_{name} AS (
    SELECT {by}, max(n) AS n, min(b) AS q FROM (
        SELECT {by}, b, count(*) OVER (PARTITION BY {by} ORDER BY b) AS upto, count(*) OVER (PARTITION BY {by}) AS n
        FROM (SELECT {by}, ({name} >> greatest(length(bin({name})) - {SKETCH_BITS}, 0))
                     << greatest(length(bin({name})) - {SKETCH_BITS}, 0) AS b FROM m WHERE NOT base_failed))
    WHERE upto * 100 >= n * {QUANTILE} GROUP BY {by})"""


SQL = (
    r"""
WITH w AS (
    SELECT row_number() OVER () AS row_id, doc_id, lang, source, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), '[^ 	-
]+') AS words,
           list_filter(string_split(coalesce(text, ''), chr(10)),
                       lambda x: regexp_matches(x, '[^ 	-
]')) AS lines
    FROM documents
), g AS (
    SELECT row_id, unnest(range(1, len(words) - 3)) AS i, words FROM w WHERE len(words) >= 5
), h AS (
    SELECT row_id, i, count(*) OVER (PARTITION BY row_id, array_to_string(words[i:i + 4], ' ')) AS n FROM g
), p AS (
    SELECT row_id, count(DISTINCT pos) AS n_repeat_words
    FROM (SELECT row_id, unnest(range(i, i + 5)) AS pos FROM h WHERE n > 1) GROUP BY row_id
), c AS (
    SELECT doc_id, lang, source, len(words) AS n_words, len(array_to_string(words, '')) AS word_chars,
           len(text) - len(translate(text, '#*$%&|<>', '')) AS n_symbols, len(lines) AS n_lines,
           len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
    FROM w LEFT JOIN p USING (row_id)
), m AS (
    SELECT *, 0 AS whole, n_words < """
    + f"{MIN_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED_PERCENT} * n_words AS base_failed, "
    + ", ".join(f"{expression} AS {name}" for name, expression in _RATES.items())
    + """ FROM c
), """
    + ", ".join(
        _quantile_sql(name, alias, by)
        for name in METRICS
        for alias, by in (("own", "lang, source"), ("lang", "lang"), ("every", "whole"))
    )
    + f"""
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       base_failed, NOT base_failed"""
    + "".join(
        f"""
       AND {name} <= (SELECT ((o.n * o.q + {PRIOR} * ((l.n * l.q + {PRIOR} * e.q) // (l.n + {PRIOR}))) // (o.n + {PRIOR})) * 3 // 2
                      FROM own_{name} o, lang_{name} l, every_{name} e
                      WHERE o.lang IS NOT DISTINCT FROM m.lang AND o.source IS NOT DISTINCT FROM m.source
                        AND l.lang IS NOT DISTINCT FROM m.lang)"""
        for name in METRICS
    )
    + """ AS kept
FROM m
"""
)
