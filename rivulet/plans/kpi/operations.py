"""Holiday table and debt ranking."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.functions.dates import day_after, shift_months, sunday_first_weekday, weekday
from rivulet.functions.exprs import percent, sum_if, try_decimal
from rivulet.operators.aggregates import share_of_total
from rivulet.plans.orders import amount, lines_of
from rivulet.sources.tables import Tables


def holiday_table(t: Tables, holidays: Sequence[dt.date], months: int = 2, min_days: int = 4) -> DataFrame:
    """The holiday report for each of a list of days, with weekday, supervisor and totals to slice by.

    Sales of the holidays' weekdays are read once and brought to route and day; only those few rows are then matched with
    the holidays whose window they fall in.
    """
    first = shift_months(min(holidays), -months)
    orders = (
        t.between("Pedidos", first, day_after(max(holidays)))
        .filter(weekday("Fecha_Pedido").isin(sorted({sunday_first_weekday(h) for h in holidays})))
        .filter(F.col("idCliente") != 0)
        .select("idPedido", F.col("idVendedor").alias("Ruta"), F.to_date("Fecha_Pedido").alias("Fecha"))
    )
    lines = lines_of(t, orders, liquid="nonzero", window=(first, day_after(max(holidays))))
    daily = lines.groupBy("Ruta", "Fecha").agg(sum_if(F.col("Precio") > 0, amount()).alias("Consumo"))
    windows = F.array(
        *[F.struct(F.lit(h).alias("Feriado"), F.lit(shift_months(h, -months)).alias("desde")) for h in holidays]
    )
    matching = F.filter(
        windows,
        lambda w: (weekday(w["Feriado"]) == weekday("Fecha"))
        & (F.col("Fecha") >= w["desde"])
        & (F.col("Fecha") <= w["Feriado"]),
    )
    matched = daily.select("Ruta", "Fecha", "Consumo", F.explode(matching).alias("_w")).withColumn(
        "Feriado", F.col("_w.Feriado")
    )
    ordinary = F.col("Fecha") != F.col("Feriado")
    base = matched.groupBy("Feriado", "Ruta").agg(
        F.count(F.when(ordinary, 1)).alias("DiasBaseProm"),
        F.avg(F.when(ordinary, F.col("Consumo"))).alias("PromSem"),
        sum_if(~ordinary, "Consumo").alias("VtaFeriado"),
    )
    gap = F.col("PromSem") - F.col("VtaFeriado")
    vendors = t["repartos"].select(F.col("Codigo").alias("Ruta"), "CodSup")
    heads = t["repartos"].select(F.col("Codigo").alias("CodSup"), F.col("Descrp").alias("Supervisor"))
    return (
        base.filter(F.col("DiasBaseProm") >= min_days)
        .join(vendors, "Ruta", "left")
        .join(heads, "CodSup", "left")
        .select(
            "Feriado",
            weekday("Feriado").alias("DiaSemana"),
            "Supervisor",
            "Ruta",
            "DiasBaseProm",
            F.col("PromSem").cast("decimal(18,2)").alias("PromSem"),
            F.col("VtaFeriado").cast("decimal(18,2)").alias("VtaFeriado"),
            gap.cast("decimal(18,2)").alias("ARecuperar"),
            try_decimal(percent(gap, "PromSem"), 5, 1).alias("Pct"),
        )
    )


SLICES = [
    ["Feriado", "Supervisor", "Ruta"],
    ["Feriado", "Supervisor"],
    ["Feriado"],
    ["DiaSemana", "Supervisor"],
    ["DiaSemana"],
    ["Supervisor"],
    [],
]


def holiday_slices(table: DataFrame, slices: Sequence[Sequence[str]] = SLICES) -> DataFrame:
    """The holiday table (see `holiday_table`) cut by date, weekday and supervisor, each with its totals, in
    one pass. `corte` tells the slice: a bit for each of Feriado, DiaSemana, Supervisor, Ruta, in this
    order, set where the column is summed over. The share is that of the totals."""
    dims = ["Feriado", "DiaSemana", "Supervisor", "Ruta"]
    sums = {name: F.sum(name).cast("decimal(18,2)") for name in ("PromSem", "VtaFeriado", "ARecuperar")}
    cut = table.groupingSets([[F.col(c) for c in one] for one in slices], *dims).agg(
        F.grouping_id().cast("int").alias("corte"),
        F.count(F.lit(1)).alias("Filas"),
        *[column.alias(name) for name, column in sums.items()],
    )
    return cut.withColumn("Pct", try_decimal(percent(F.col("ARecuperar"), "PromSem"), 5, 1))


def exposure_rank(debt: DataFrame) -> DataFrame:
    """Routes by exposure, with each one's share; sorted from the largest."""
    return share_of_total(debt, "DeudaTotal", "PctExposicion").orderBy(F.desc("DeudaTotal"))
