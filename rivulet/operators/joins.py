"""Join shapes the reports share. No join forces a broadcast: Spark broadcasts a side it measures
to be small and shuffles otherwise."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.functions.text import account_number
from rivulet.sources.layout import in_window


def semi(left: DataFrame, keys: DataFrame, key: str, right_key: str | None = None) -> DataFrame:
    """Rows of `left` whose key occurs in `keys`."""
    return left.join(keys.select(F.col(right_key or key).alias(key)), key, "left_semi")


def splittable(keyed: DataFrame) -> DataFrame:
    """The computed side of a join with raw facts, prepared so that a hot key may be split.

    AQE splits a skewed reducer only where both sides arrive through an exchange of the join. What
    comes out of an aggregation, window or join is already laid out by the key and has none.
    Rebalancing gives it one; the rows it moves are one per key, few next to the facts.
    """
    return keyed.hint("rebalance")


def facts_of(facts: DataFrame, keys: DataFrame, key: str, right_key: str | None = None) -> DataFrame:
    """`semi` for raw facts against computed keys, of which one may hold a large part of the rows."""
    return semi(facts, splittable(keys), key, right_key)


def restrict(df: DataFrame, cohort: DataFrame | None, key: str, cohort_key: str | None = None) -> DataFrame:
    """`df` cut to a cohort supplied from outside, or unchanged without one."""
    return df if cohort is None else semi(df, cohort, key, cohort_key)


def active_keys(sales: DataFrame, key: str) -> DataFrame:
    """The keys that have sales: the universe is derived from activity, not the reverse."""
    return sales.select(key).distinct()


def no_activity(
    left: DataFrame,
    facts: DataFrame,
    key: str,
    fact_key: str,
    date: str,
    start: dt.date,
    before: dt.date,
) -> DataFrame:
    """Rows of `left` with no fact in `start <= date < before`. Facts shrink to distinct keys
    before they are shuffled, so a key with many facts costs no more than one with few."""
    busy = in_window(facts, date, start, before).select(F.col(fact_key).alias(key)).distinct()
    return left.join(busy, key, "left_anti")


def lookup(df: DataFrame, dim: DataFrame, code: str, dim_code: str, label: str, into: str) -> DataFrame:
    """Add the label of a code, or the code itself where the catalog lacks it."""
    names = dim.select(F.col(dim_code).alias("_code"), F.col(label).alias("_label"))
    joined = df.join(names, F.col(code) == F.col("_code"), "left")
    return joined.withColumn(into, F.coalesce("_label", code)).drop("_code", "_label")


def key_cast_join(left: DataFrame, right: DataFrame, text_key: str, number_key: str, how: str = "inner") -> DataFrame:
    """Join a text account column to a numeric one; text that is no number matches nothing."""
    keyed = left.withColumn("_key", account_number(text_key))
    return keyed.join(right, F.col("_key") == F.col(number_key), how).drop("_key")


def first_row_join(left: DataFrame, ranked: DataFrame, key: str, how: str = "left") -> DataFrame:
    """Attach the rank-1 row of `ranked` (column `rn`)."""
    return left.join(ranked.filter(F.col("rn") == 1).drop("rn"), key, how)


def supervisor_rollup(df: DataFrame, vendors: DataFrame, vendor: str, values: list[str]) -> DataFrame:
    """Totals per supervisor, by the vendor table's reference to itself."""
    totals = df.groupBy(F.col(vendor).alias("_vendor")).agg(*[F.sum(v).alias(v) for v in values])
    own = vendors.select(F.col("Codigo").alias("_vendor"), "CodSup")
    heads = vendors.select(F.col("Codigo").alias("_head"), F.col("Descrp").alias("Supervisor"))
    return (
        totals.join(own, "_vendor")
        .join(heads, F.col("CodSup") == F.col("_head"), "left")
        .groupBy("CodSup", "Supervisor")
        .agg(*[F.sum(v).alias(v) for v in values])
    )


def to_parent(df: DataFrame, hierarchy: DataFrame, key: str, values: list[str]) -> DataFrame:
    """Totals per parent account; an account without a parent is its own. Rows are summed per
    account first, so a busy account is one row when it is joined."""
    totals = df.groupBy(key).agg(*[F.sum(v).alias(v) for v in values])
    links = hierarchy.groupBy(F.col("IdCliente").alias(key)).agg(F.min("Cta_Madre").alias("Cta_Madre"))
    parent = F.coalesce("Cta_Madre", key)
    return (
        totals.join(links, key, "left").groupBy(parent.alias("Cuenta")).agg(*[F.sum(v).alias(v) for v in values])
    )


def open_items(ledger: DataFrame) -> DataFrame:
    """Documents with what is still open after the receipts and credit notes applied to them.
    One aggregation over `the document a row belongs to` replaces the self join."""
    applied = F.col("CodApl").isNotNull() & F.col("NroApl").isNotNull()
    own = ~applied
    rows = ledger.select(
        F.when(applied, F.col("CodApl")).otherwise(F.col("CodMov")).alias("CodMov"),
        F.when(applied, F.col("NroApl")).otherwise(F.col("NroMov")).alias("NroMov"),
        F.when(own, account_number("NroCta")).alias("cuenta"),
        F.when(own, F.col("FchMov")).alias("fecha"),
        F.when(own, F.col("Import")).alias("documento"),
        F.when(applied, F.col("Import")).alias("aplicado"),
    )
    zero = F.lit(0)
    return (
        rows.groupBy("CodMov", "NroMov")
        .agg(
            F.max("cuenta").alias("NroCta"),
            F.to_date(F.min("fecha")).alias("FchMov"),
            F.sum("documento").alias("Importe"),
            F.coalesce(F.sum("aplicado"), zero).alias("Aplicado"),
        )
        .filter(F.col("Importe").isNotNull())
        .withColumn("Saldo", F.col("Importe") + F.col("Aplicado"))
    )


def with_columns(df: DataFrame, exprs: dict[str, Column]) -> DataFrame:
    """Per-row expressions by name, each free to use the columns `df` has."""
    return df.withColumns(exprs)


def not_in(df: DataFrame, column: str, listed: DataFrame, listed_column: str) -> DataFrame:
    """`column NOT IN (SELECT listed_column FROM listed)` as SQL has it: an empty list keeps every row, a NULL
    in the list keeps none, and else a row whose column is NULL goes.

    The list may be long: it meets the rows in an ordinary anti join on its distinct values, which Spark
    broadcasts only when it measures them to be small; what NULLs and emptiness decide is one row of
    counts. (Spark's own plan for NOT IN broadcasts the list whatever its size.)
    """
    keys = listed.select(F.col(listed_column).alias("_listed"))
    counts = keys.agg(F.struct(F.count(F.lit(1)).alias("n"), F.count("_listed").alias("known"))).scalar()
    kept = df.withColumn("_counts", counts)
    absent = kept.join(keys.filter("_listed IS NOT NULL").distinct(), F.col(column) == F.col("_listed"), "left_anti")
    some = (F.col("_counts.n") == F.col("_counts.known")) & F.col(column).isNotNull()
    return absent.filter((F.col("_counts.n") == 0) | some).drop("_counts")
