"""Monthly sales matrix."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.functions import rules
from rivulet.functions.dates import closed_months, first_of_month, legacy_day_number, month_start
from rivulet.functions.exprs import clamp0
from rivulet.operators.joins import semi
from rivulet.operators.pivots import month_cells, month_columns
from rivulet.plans.customers import one_per_account, with_terms, with_type
from rivulet.plans.ledgers import cash_balance, credit_balance
from rivulet.plans.orders import amount, raw_lines
from rivulet.sources.layout import in_window
from rivulet.sources.tables import Tables

GRAIN = ["NroCta", "Ruta", "idProducto"]


def _monthly_cells(
    t: Tables, start: dt.date, before: dt.date, vendors: Sequence[int] | DataFrame | None
) -> DataFrame:
    """Units and revenue of paid lines of water and soda per customer, vendor, product and month. Rows are
    already summed when they meet the products' attributes."""
    orders = t.between("Pedidos", start, before).select(
        "idPedido",
        F.col("idCliente").alias("NroCta"),
        F.col("idVendedor").alias("Ruta"),
        month_start("Fecha_Pedido").alias("Mes"),
    )
    if isinstance(vendors, DataFrame):
        orders = orders.join(vendors.select(F.col("Vendedor").alias("Ruta")), "Ruta", "left_semi")
    elif vendors is not None:
        orders = orders.filter(F.col("Ruta").isin(*vendors))
    else:
        orders = orders.filter(F.col("Ruta").isNotNull())
    lines = orders.join(raw_lines(t, paid=True, window=(start, before)), "idPedido")
    lines = lines.join(_liquid_products(t).select("idProducto"), "idProducto", "left_semi")
    return lines.groupBy(*GRAIN, "Mes").agg(F.sum("Cantidad").alias("Unidades"), F.sum(amount()).alias("Facturacion"))


def _liquid_products(t: Tables) -> DataFrame:
    return t["Productos"].filter(F.col("Litros") != 0).select("idProducto", "Abreviatura", "Litros")


def monthly_sales(
    t: Tables, start: dt.date, before: dt.date, vendors: Sequence[int] | DataFrame | None = rules.SALES_VENDORS
) -> DataFrame:
    """Litres (Cantidad) and revenue (Facturacion) of paid water and soda per customer, vendor,
    product and month. `vendors` is a short list, or a DataFrame with a `Vendedor` column."""
    cells = _monthly_cells(t, start, before, vendors)
    return cells.join(_liquid_products(t), "idProducto").select(
        *GRAIN, "Abreviatura", "Mes", (F.col("Unidades") * F.col("Litros")).alias("Cantidad"), "Facturacion"
    )


def customer_card(
    t: Tables,
    closed_since: dt.date,
    machines_until: dt.date,
    legacy_sentinels: bool = False,
    keys: DataFrame | None = None,
) -> DataFrame:
    """One row per account: contact, terms, both debts and its machines. Accounts closed before
    `closed_since` are left out; an active record goes before a closed one. `keys` (`NroCta`) limits
    it to some accounts."""
    columns = ["NroCta", "Nombre", "Direcc", "FecAlt", "CndPag", "TipCli"]
    closed = in_window(t["ClientesBaja"], "FecBaj", closed_since)

    def labelled(people: DataFrame) -> DataFrame:
        return with_type(t, with_terms(t, people))

    active = labelled(t["Clientes"].select(*columns))
    accounts = one_per_account(active, labelled(closed.select(*columns, "FecBaj", "IdClienteBaja")))
    if keys is not None:
        accounts = semi(accounts, keys, "NroCta")
    cash = cash_balance(t).withColumnRenamed("IdCliente", "NroCta")
    credit = credit_balance(t).withColumnRenamed("IdCliente", "NroCta")
    installed = in_window(t["ClientesServicios"].filter(F.col("Fecha_Baja").isNull()), "Fecha_Desde", None, machines_until)
    machines = installed.groupBy(F.col("IdCliente").alias("NroCta")).agg(F.count_distinct("Nro_Serie").alias("Q_FC"))
    own_cash, own_credit = rules.exclusive_debt("CndPagCod", clamp0("DeudaContado"), clamp0("DeudaCtaCte"))
    joined = accounts.join(cash, "NroCta", "left").join(credit, "NroCta", "left").join(machines, "NroCta", "left")
    return joined.select(
        "NroCta",
        "Nombre",
        F.col("Direcc").alias("Direccion"),
        "FecAlt",
        (legacy_day_number("FecBaj") if legacy_sentinels else F.to_date("FecBaj")).alias("FecBaj"),
        "MediodePago",
        own_cash.alias("DeudaContado"),
        own_credit.alias("DeudaCtaCte"),
        F.col("TipCliDes").alias("CATEGORIA"),
        F.coalesce("Q_FC", F.lit(0)).alias("Q_FC"),
    )


def monthly_sales_matrix(
    t: Tables,
    as_of: dt.date,
    months: int = 24,
    vendors: Sequence[int] | DataFrame | None = rules.SALES_VENDORS,
    legacy_sentinels: bool = False,
) -> DataFrame:
    """Litres and revenue of each closed month side by side, per customer, vendor and product,
    with the customer's card. Sales drive the result: a customer appears because it bought."""
    span = closed_months(as_of, months)
    before = first_of_month(as_of)
    metrics = {"Unidades": "CANT", "Facturacion": "FACT"}
    matrix = month_cells(_monthly_cells(t, span[0], before, vendors), GRAIN, "Mes", metrics)
    # The months stay a map through both joins and are spread last.
    columns = month_columns(matrix, span, metrics, {"Unidades": F.col("Litros")})
    card = customer_card(t, span[0], before, legacy_sentinels)
    return matrix.join(_liquid_products(t), "idProducto").join(card, "NroCta", "left").select(
        "NroCta", "Nombre", "Ruta", "Direccion", "FecAlt", "FecBaj", "MediodePago", "DeudaContado", "DeudaCtaCte",
        "CATEGORIA", "Q_FC", "idProducto", "Abreviatura", *columns,
    )
