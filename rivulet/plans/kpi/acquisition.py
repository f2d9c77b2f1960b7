"""Measures over new customers (see `acquisitions_by_channel` and `repurchase`)."""

from __future__ import annotations

import calendar
import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.functions.dates import day_after, days_between, fmt_ym, month_start, month_window, week_of_month
from rivulet.operators.aggregates import share_of_total
from rivulet.operators.joins import facts_of
from rivulet.plans.customers import with_type
from rivulet.plans.orders import first_order, lines_of, raw_lines, volume
from rivulet.sources.layout import in_window
from rivulet.sources.tables import Tables


def _registered(acq: DataFrame) -> DataFrame:
    return acq.withColumn("_alta", F.to_date("FECALT", "dd/MM/yyyy"))


def acquisition_grid(acq: DataFrame, month: dt.date, week: int | None = None) -> DataFrame:
    """Acquisitions per route and day of the month, their total, and a last row over all routes
    (RUTA is NULL). `week` keeps one week of the month. Only the counts per route and day, not the
    rows, take part in the grand total."""
    start, before = month_window(month)
    rows = _registered(acq).filter((F.col("_alta") >= F.lit(start)) & (F.col("_alta") < F.lit(before)))
    if week is not None:
        rows = rows.filter(week_of_month("_alta") == week)
    counts = rows.groupBy("RUTA", F.dayofmonth("_alta").alias("_day")).agg(F.count(F.lit(1)).alias("_n"))
    days = range(1, calendar.monthrange(start.year, start.month)[1] + 1)
    columns = [F.coalesce(F.sum(F.when(F.col("_day") == d, F.col("_n"))), F.lit(0)).alias(f"d{d:02d}") for d in days]
    return counts.rollup("RUTA").agg(*columns, F.sum("_n").alias("Total"))


def acquisitions_by_month(acq: DataFrame) -> DataFrame:
    """Acquisitions per route and month."""
    return _registered(acq).groupBy("RUTA", fmt_ym("_alta").alias("Mes")).agg(F.count(F.lit(1)).alias("Altas"))


def _cohort_days(t: Tables, acq: DataFrame, as_of: dt.date) -> DataFrame:
    """The cohort with its litres per day up to `as_of`; a customer without any has one row."""
    cohort = _registered(acq).groupBy("NroCta", "RUTA").agg(F.min("_alta").alias("_alta"))
    before = day_after(as_of)
    orders = facts_of(t.between("Pedidos", None, before), cohort, "idCliente", "NroCta").select(
        "idPedido", F.col("idCliente").alias("NroCta"), F.to_date("Fecha_Pedido").alias("_fecha")
    )
    lines = lines_of(t, orders, liquid="positive", window=(None, before))
    daily = lines.groupBy("NroCta", "_fecha").agg(F.sum(volume()).alias("_litros"))
    return cohort.join(daily, "NroCta", "left")


def cohort_litres(t: Tables, acq: DataFrame, as_of: dt.date, by: str = "week") -> DataFrame:
    """Litres per route and week (or month) since registration up to `as_of`, one row for each `Periodo`
    (from 0) with sales, and the route's customers. All that the cohort bought is there: the litres of a
    route add up to its own. A route whose customers bought nothing has a row without period."""
    if by == "week":
        period = F.floor(days_between("_alta", "_fecha") / 7)
    else:
        period = F.months_between(month_start("_fecha"), month_start("_alta"))
    days = _cohort_days(t, acq, as_of).withColumn("Periodo", period.cast("int"))
    litres = days.groupBy("RUTA", "Periodo").agg(F.sum("_litros").alias("Litros"))
    sizes = acq.groupBy("RUTA").agg(F.count_distinct("NroCta").alias("Clientes"))
    bought = litres.filter(F.col("Periodo").isNotNull())
    return sizes.join(bought, "RUTA", "left")


def cohort_litres_by_registration(t: Tables, acq: DataFrame, as_of: dt.date) -> DataFrame:
    """Litres up to `as_of` per route and week of registration (its Monday)."""
    days = _cohort_days(t, acq, as_of).withColumn("SemanaAlta", F.to_date(F.date_trunc("week", "_alta")))
    return days.groupBy("RUTA", "SemanaAlta").agg(
        F.count_distinct("NroCta").alias("Clientes"), F.coalesce(F.sum("_litros"), F.lit(0)).alias("Litros")
    )


def promo_share(acq: DataFrame) -> DataFrame:
    """First purchases per kind of promotion, and their share."""
    counts = acq.groupBy("TipoPromo").agg(F.count(F.lit(1)).alias("Altas"))
    return share_of_total(counts, "Altas", "Pct")


def promo_cost(
    t: Tables,
    prices: DataFrame,
    since: dt.date | None = None,
    as_of: dt.date | None = None,
    accounts: DataFrame | None = None,
) -> DataFrame:
    """List value (`idProducto`, `PrecioLista`) of the free units in first orders up to `as_of`, per product.

    `accounts` (`NroCta`) limits it to some customers, such as those registered from `since` on: their
    first order is not older, so nothing before `since` is read.
    """
    window = (since, None if as_of is None else day_after(as_of))
    orders = t.between("Pedidos", *window)
    if accounts is not None:
        orders = facts_of(orders, accounts, "idCliente", "NroCta")
    first = first_order(t, "all", orders, window).select("idPedido")
    free = lines_of(t, first, liquid="positive", window=window).filter(F.col("Precio") == 0)
    units = free.groupBy("idProducto").agg(F.sum("Cantidad").alias("Unidades"))
    priced = units.join(prices.select("idProducto", "PrecioLista"), "idProducto", "left")
    return priced.withColumn("CostoBonificado", F.col("Unidades") * F.col("PrecioLista"))


def second_order_cohort(rep: DataFrame) -> DataFrame:
    """Per month of registration: customers, those with a first and with a second order, and the
    mean days between."""
    return rep.groupBy(fmt_ym("FecAlt").alias("MesAlta")).agg(
        F.count(F.lit(1)).alias("Clientes"),
        F.count("FechaPrimeraCompra").alias("ConPrimera"),
        F.count("FechaSegundaCompra").alias("ConSegunda"),
        F.avg("DiasEntreCompras").alias("DiasPromedio"),
    )


def pending_second_order(rep: DataFrame, as_of: dt.date, days: int = 30) -> DataFrame:
    """Customers with a first order and no second, still before day `days`: the list to call."""
    waiting = days_between("FechaPrimeraCompra", F.lit(as_of))
    return (
        rep.filter(F.col("FechaPrimeraCompra").isNotNull() & F.col("FechaSegundaCompra").isNull())
        .withColumn("DiasEsperando", waiting)
        .filter((F.col("DiasEsperando") >= 0) & (F.col("DiasEsperando") < days))
    )


def realised_by_month(t: Tables, as_of: dt.date, max_days: int = 60) -> DataFrame:
    """Per month of the first paid order and customer type: customers whose first paid order came
    within `max_days` of registration, and the mean days it took."""
    orders = in_window(t["Pedidos"], "Fecha_Pedido", None, day_after(as_of))
    liquid = t["Productos"].filter(F.col("Litros") > 0).select("idProducto")
    paid = raw_lines(t, paid=True, window=(None, day_after(as_of))).join(liquid, "idProducto", "left_semi")
    bought = orders.join(paid.select("idPedido"), "idPedido", "left_semi")
    first = bought.groupBy(F.col("idCliente").alias("NroCta")).agg(F.to_date(F.min("Fecha_Pedido")).alias("_primera"))
    people = with_type(t, t["Clientes"].filter(F.col("NroCta") != 0)).select("NroCta", "TipCliDes", "FecAlt")
    waited = people.join(first, "NroCta").withColumn("_days", days_between("FecAlt", "_primera"))
    return (
        waited.filter(F.col("_days").between(0, max_days))
        .groupBy(fmt_ym("_primera").alias("Mes"), F.col("TipCliDes").alias("Segmento"))
        .agg(F.count(F.lit(1)).alias("Concretadas"), F.avg("_days").alias("DiasPromedio"))
    )
