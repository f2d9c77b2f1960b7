"""Customer debt."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.functions import rules
from rivulet.functions.exprs import clamp0
from rivulet.plans.customers import active_customers, closed_customers, one_per_account, with_terms, with_type
from rivulet.plans.ledgers import cash_balance, credit_balance
from rivulet.sources.tables import Tables


def customer_debt(
    t: Tables,
    as_of: dt.date,
    routes: Sequence[int] | None = rules.GASTRO_DEBT_ROUTES,
    exclude: Sequence[int] = rules.DEBT_EXCLUDED_ROUTES,
    clamp_cash: bool = False,
) -> DataFrame:
    """Debt before `as_of` per customer of the routes, cash or credit by its payment terms and never
    both. An account in both customer tables counts once, as active."""
    columns = ["NroCta", "RUTA", "CndPag", "TipCli"]

    def labelled(people: DataFrame) -> DataFrame:
        return with_type(t, with_terms(t, people.filter(F.col("NroCta") != 0)))

    active = labelled(active_customers(t, routes, exclude).select(*columns))
    closed = labelled(closed_customers(t, routes, exclude).select(*columns, "FecBaj", "IdClienteBaja"))
    customers = one_per_account(active, closed)
    cash = cash_balance(t, as_of).withColumnRenamed("IdCliente", "NroCta")
    credit = credit_balance(t, as_of).withColumnRenamed("IdCliente", "NroCta")
    joined = customers.join(cash, "NroCta", "left").join(credit, "NroCta", "left")
    cash_amount = clamp0("DeudaContado") if clamp_cash else F.col("DeudaContado")
    own_cash, own_credit = rules.exclusive_debt("CndPagCod", cash_amount, F.col("DeudaCtaCte"))
    return joined.select(
        "NroCta", "RUTA", "MediodePago", own_cash.alias("DeudaContado"), own_credit.alias("DeudaCtaCte")
    ).filter((F.col("DeudaContado") != 0) | (F.col("DeudaCtaCte") != 0))


def debt_by_route(t: Tables, as_of: dt.date, routes: Sequence[int] | None = rules.GASTRO_DEBT_ROUTES,
                  exclude: Sequence[int] = rules.DEBT_EXCLUDED_ROUTES) -> DataFrame:
    """Debt per route, cash and credit apart."""
    debts = customer_debt(t, as_of, routes, exclude)
    return debts.groupBy("RUTA").agg(
        F.sum("DeudaContado").alias("DeudaContado"),
        F.sum("DeudaCtaCte").alias("DeudaCtaCte"),
        F.sum(F.col("DeudaContado") + F.col("DeudaCtaCte")).alias("DeudaTotal"),
    )
