"""Money collected per route."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.functions import rules
from rivulet.functions.dates import day_after, first_of_month, fmt_my, month_start
from rivulet.functions.exprs import signed
from rivulet.functions.text import account_number, trailing_digits, try_int
from rivulet.operators.joins import lookup
from rivulet.plans.customers import active_customers, with_terms, with_type
from rivulet.sources.tables import Tables


def attribute_route(receipts: DataFrame, customers: DataFrame, blank_route_as_zero: bool = False) -> DataFrame:
    """Receipts per RUTA, Mes and CodCpt: cash goes to the route its reference text ends with, any
    other method to the customer's route. Receipts of neither are dropped.

    All cash sits on one treasury account, so cash rows carry no account here, and everything is
    summed before the join.
    """
    digits = trailing_digits("Refern")
    parsed = try_int(digits)
    if blank_route_as_zero:
        parsed = F.when(digits == "", 0).otherwise(parsed)
    is_cash = F.col("CodCpt") == rules.CASH_METHOD
    totals = (
        receipts.select(
            F.when(is_cash, F.lit(None)).otherwise(account_number("NroCta")).alias("NroCta"),
            F.when(is_cash, parsed).alias("_cash_route"),
            month_start("FchMov").alias("Mes"),
            "CodCpt",
            signed("Import", "DebHab").alias("Total"),
        )
        .groupBy("NroCta", "_cash_route", "Mes", "CodCpt")
        .agg(F.sum("Total").alias("Total"))
    )
    is_cash = F.col("CodCpt") == rules.CASH_METHOD
    cash = totals.filter(is_cash & F.col("_cash_route").isNotNull()).withColumn("RUTA", F.col("_cash_route"))
    other = totals.filter(~is_cash).join(customers.select("NroCta", "RUTA"), "NroCta")
    columns = ["RUTA", "Mes", "CodCpt", "Total"]
    both = cash.select(*columns).unionByName(other.select(*columns))
    return both.groupBy("RUTA", "Mes", "CodCpt").agg(F.sum("Total").alias("Total"))


def receipts_by_route(
    t: Tables,
    as_of: dt.date,
    months: int = 5,
    routes: Sequence[int] | None = rules.COLLECTION_ROUTES,
    blank_route_as_zero: bool = False,
) -> DataFrame:
    """(RUTA, Mes, CodCpt, Total) over `months` full months before that of `as_of` and the part of
    it up to that day. A customer on several routes counts on its first, so no money is doubled."""
    window = t.between("MovTes", first_of_month(as_of, -months), day_after(as_of))
    receipts = window.filter((F.col("DebHab") == "D") & ~F.col("CodCpt").isin(*rules.INTERNAL_METHODS))
    customers = with_type(t, with_terms(t, active_customers(t, routes)))
    return attribute_route(receipts, customers, blank_route_as_zero)


def collections_by_route(
    t: Tables,
    as_of: dt.date,
    months: int = 5,
    routes: Sequence[int] | None = rules.COLLECTION_ROUTES,
    blank_route_as_zero: bool = False,
) -> DataFrame:
    """Total collected per route, month and payment method."""
    totals = receipts_by_route(t, as_of, months, routes, blank_route_as_zero)
    named = lookup(totals, t["CptTes"], "CodCpt", "Codigo", "Descrp", "Descripcion")
    return named.select("RUTA", fmt_my("Mes").alias("Mes"), "Descripcion", "Total")
