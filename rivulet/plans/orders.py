"""Order lines and order sequences shared by the reports."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.functions.exprs import safe_div
from rivulet.operators.windows import nth_orders
from rivulet.sources.tables import Tables


def amount() -> Column:
    return F.col("Cantidad") * F.col("Precio")


def volume() -> Column:
    return F.col("Cantidad") * F.col("Litros")


def packs() -> Column:
    return safe_div("Cantidad", "cantidad_x_bulto")


def _products(t: Tables, liquid: str | None) -> DataFrame:
    products = t["Productos"].select("idProducto", "Abreviatura", "Unidad", "Litros", "cantidad_x_bulto")
    if liquid == "positive":
        return products.filter(F.col("Litros") > 0)
    if liquid == "nonzero":
        return products.filter(F.col("Litros") != 0)
    return products


Window = tuple[dt.date | None, dt.date | None]
ALL_TIME: Window = (None, None)


def raw_lines(t: Tables, paid: bool = False, window: Window = ALL_TIME) -> DataFrame:
    """Order lines, of the months of `window` only where they are stored by month."""
    lines = t.months("Pedidos_Productos", *window).select("idPedido", "idProducto", "Cantidad", "Precio")
    return lines.filter(F.col("Precio") > 0) if paid else lines


def sales_lines(t: Tables, paid: bool = False, liquid: str | None = None) -> DataFrame:
    """Order lines with their product's litres and pack size.

    `paid` keeps lines with a price. `liquid` keeps products by volume: "positive" or "nonzero".
    Without `liquid`, a line of an unknown product stays, with NULL litres.
    """
    return raw_lines(t, paid).join(_products(t, liquid), "idProducto", "inner" if liquid else "left")


def lines_of(
    t: Tables, orders: DataFrame, paid: bool = False, liquid: str | None = None, window: Window = ALL_TIME
) -> DataFrame:
    """The same for a set of orders, which is joined first: where the products are too many to
    broadcast, only lines of these orders are shuffled to meet them. `window` is the one the orders were
    cut to, and prunes the lines as well."""
    joined = orders.join(raw_lines(t, paid, window), "idPedido")
    return joined.join(_products(t, liquid), "idProducto", "inner" if liquid else "left")


def order_totals(lines: DataFrame, *carried: str) -> DataFrame:
    """Per order, with what its lines carry of it: amount, litres, units, packs and whether a line was free. Summed in the map tasks
    first, so an order with very many lines reaches its reducer as a few rows."""
    return lines.groupBy("idPedido", *carried).agg(
        F.sum(amount()).alias("Importe"),
        F.sum(volume()).alias("LitrosPedido"),
        F.sum("Cantidad").alias("CantidadPedido"),
        F.sum(packs()).alias("BultosPedido"),
        F.max(F.when(F.col("Precio") == 0, 1).otherwise(0)).alias("LineaPrecio0"),
    )


def purchases(t: Tables, kind: str, orders: DataFrame | None = None, window: Window = ALL_TIME) -> DataFrame:
    """Orders that count as purchases: `all`, those with a `liquid` line, or with a `paid` liquid
    line. The latter two carry the totals of those lines; `paid` ones are dated by day. Only lines of
    `orders` are summed."""
    orders = t["Pedidos"] if orders is None else orders
    date = F.to_date("Fecha_Pedido") if kind == "paid" else F.col("Fecha_Pedido")
    picked = orders.select("idPedido", "idCliente", date.alias("Fecha_Pedido"))
    if kind == "all":
        return picked
    lines = lines_of(t, picked, paid=kind == "paid", liquid="positive", window=window)
    return order_totals(lines, "idCliente", "Fecha_Pedido")


def first_order(t: Tables, kind: str, orders: DataFrame | None = None, window: Window = ALL_TIME) -> DataFrame:
    """The first purchase of each customer, by date and then order number."""
    ranked = nth_orders(purchases(t, kind, orders, window), "idCliente", ["Fecha_Pedido", "idPedido"], 1)
    return ranked.drop("rn")
