"""Sales lost to a holiday."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.functions.dates import day_after, shift_months, sunday_first_weekday, weekday
from rivulet.functions.exprs import percent, sum_if, try_decimal
from rivulet.plans.orders import amount, lines_of, volume
from rivulet.sources.tables import Tables


def daily_route_sales(t: Tables, holiday: dt.date, months: int) -> DataFrame:
    """(Ruta, Fecha, Consumo, Litros) for the days of the holiday's weekday from `months` back to
    the holiday itself. Other weekdays never leave the scan."""
    orders = (
        t.between("Pedidos", shift_months(holiday, -months), day_after(holiday))
        .filter((weekday("Fecha_Pedido") == sunday_first_weekday(holiday)) & (F.col("idCliente") != 0))
        .select("idPedido", F.col("idVendedor").alias("Ruta"), F.to_date("Fecha_Pedido").alias("Fecha"))
    )
    lines = lines_of(t, orders, liquid="nonzero", window=(shift_months(holiday, -months), day_after(holiday)))
    return lines.groupBy("Ruta", "Fecha").agg(
        sum_if(F.col("Precio") > 0, amount()).alias("Consumo"), F.sum(volume()).alias("Litros")
    )


def weekday_baseline(daily: DataFrame, holiday: dt.date, min_days: int) -> DataFrame:
    """Per route: mean of the ordinary days next to the holiday's own sales, for routes with at
    least `min_days` of the former. The mean counts only days with sales."""
    ordinary = F.col("Fecha") != F.lit(holiday)
    zero = F.lit(0)

    def mean(column: str) -> Column:
        return F.avg(F.when(ordinary, F.col(column)))

    def on_holiday(column: str) -> Column:
        return F.coalesce(F.sum(F.when(~ordinary, F.col(column))), zero)

    return (
        daily.groupBy("Ruta")
        .agg(
            F.count(F.when(ordinary, 1)).alias("DiasBaseProm"),
            mean("Consumo").alias("PromConsumo"),
            mean("Litros").alias("PromLitros"),
            on_holiday("Consumo").alias("VtaFeriadoConsumo"),
            on_holiday("Litros").alias("VtaFeriadoLitros"),
        )
        .filter(F.col("DiasBaseProm") >= min_days)
    )


def holiday_recovery(t: Tables, holiday: dt.date, months: int = 2, min_days: int = 4) -> DataFrame:
    """What each route usually sells on this weekday, what it sold on the holiday, and the
    difference to recover. A share that does not fit its type is NULL."""
    base = weekday_baseline(daily_route_sales(t, holiday, months), holiday, min_days)
    gap = F.col("PromConsumo") - F.col("VtaFeriadoConsumo")
    return base.select(
        "Ruta",
        "DiasBaseProm",
        F.col("PromConsumo").cast("decimal(12,2)").alias("PromedioConsumo"),
        F.col("PromLitros").cast("decimal(12,2)").alias("PromedioLitros"),
        "VtaFeriadoConsumo",
        "VtaFeriadoLitros",
        gap.cast("decimal(12,2)").alias("ARecuperarConsumo"),
        try_decimal(percent(gap, "PromConsumo"), 5, 1).alias("PctRecupero"),
    )
