"""Customer balances."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.functions.exprs import clamp0
from rivulet.functions.text import account_number
from rivulet.operators.aggregates import balance
from rivulet.sources.tables import Tables


def cash_balance(t: Tables, before: dt.date | None = None) -> DataFrame:
    """(IdCliente, DeudaContado): sales less payments of the cash ledger and its adjustments."""
    moves = t.between("Movimientos_Caja", before=before)
    adjustments = t.between("Movimientos_Caja_Ajustes", before=before).withColumnRenamed("idCliente", "IdCliente")
    return balance([moves, adjustments], "IdCliente", "Importe").withColumnRenamed("Importe", "DeudaContado")


def credit_balance(t: Tables, before: dt.date | None = None) -> DataFrame:
    """(IdCliente, DeudaCtaCte): balance of the credit ledger, a balance in favour counted as 0.
    The account is text there; text that is no number belongs to no customer."""
    rows = t.between("CtaCteVT", before=before).select(account_number("NroCta").alias("IdCliente"), "Import")
    # Accounts without a customer never join, and would all meet in one reducer.
    known = rows.filter(F.col("IdCliente").isNotNull())
    return known.groupBy("IdCliente").agg(clamp0(F.sum("Import")).alias("DeudaCtaCte"))
