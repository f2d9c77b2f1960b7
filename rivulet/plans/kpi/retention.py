"""Measures over silent equipment customers."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.functions import rules
from rivulet.functions.dates import day_after, days_between
from rivulet.operators.aggregates import share_of_total
from rivulet.plans.customers import customer_route
from rivulet.sources.tables import Tables


def event_mix(retention: DataFrame) -> DataFrame:
    """Customers per outcome of the month, and their share."""
    counts = retention.groupBy("TipoEvento", "EstadoFinal").agg(F.count(F.lit(1)).alias("Clientes"))
    return share_of_total(counts, "Clientes", "Pct")


def silence(
    t: Tables, as_of: dt.date, days: int = 120, exclude: Sequence[int] = rules.NON_COMMERCIAL_ROUTES
) -> DataFrame:
    """Equipment customers with more than `days` days since their last order (or no order at all,
    then without a count), with their machines and route. Orders shrink to one date per customer
    before the join."""
    holders = t["ClientesServicios"].filter(F.col("Fecha_Baja").isNull())
    machines = holders.groupBy(F.col("IdCliente").alias("NroCta")).agg(F.count_distinct("Nro_Serie").alias("Equipos"))
    orders = t.between("Pedidos", before=day_after(as_of))
    last = orders.groupBy(F.col("idCliente").alias("NroCta")).agg(F.to_date(F.max("Fecha_Pedido")).alias("UltimoPedido"))
    joined = machines.join(last, "NroCta", "left").join(customer_route(t, exclude=exclude), "NroCta", "left")
    idle = joined.withColumn("DiasSinConsumo", days_between("UltimoPedido", F.lit(as_of)))
    return idle.filter(F.col("DiasSinConsumo").isNull() | (F.col("DiasSinConsumo") > days))


def call_list(retention: DataFrame, silent: DataFrame) -> DataFrame:
    """Customers still without consumption this month that are also silent for long: the ones to
    call, with their route and days."""
    waiting = retention.filter(F.col("TipoEvento") == rules.STILL_SILENT[0])
    days = silent.select("NroCta", "RUTA", "UltimoPedido", "DiasSinConsumo")
    return waiting.select("NroCta", "Nombre", "Direcc", "Telefn").join(days, "NroCta")


def retrieval_queue(silent: DataFrame) -> DataFrame:
    """Customers and machines waiting per route."""
    return silent.groupBy("RUTA").agg(F.count(F.lit(1)).alias("Clientes"), F.sum("Equipos").alias("Equipos"))
