"""Collection measures over receipts per RUTA, Mes and CodCpt (see `receipts_by_route`)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.functions.dates import first_of_month, month_start
from rivulet.functions.exprs import ratio, sum_if
from rivulet.functions.text import account_number
from rivulet.operators.aggregates import top1
from rivulet.plans.customers import customer_region
from rivulet.plans.orders import amount, lines_of
from rivulet.sources.tables import Tables

# Treasury methods behind the mix measures, and the tolerated collection cost.
WITHHOLDINGS = ("RET",)
MIX = {
    "PctEfectivo": ("EFE",),
    "PctDigital": ("DIG",),
    "PctCheques": ("CHQ",),
    "PctTransferencia": ("TRF",),
    "PctRetenciones": ("RET",),
}
COST_TOLERANCE = 0.02


def total_collected(rc: DataFrame, by: Sequence[str] = (), exclude: Sequence[str] = ()) -> DataFrame:
    """Total collected, without the excluded methods."""
    kept = ~F.col("CodCpt").isin(*exclude) if exclude else F.lit(True)
    return rc.groupBy(*by).agg(sum_if(kept, "Total").alias("TotalCobrado"))


def _share(methods: Sequence[str]) -> Column:
    return ratio(sum_if(F.col("CodCpt").isin(*methods), "Total"), F.sum("Total"))


def share(rc: DataFrame, methods: Sequence[str], by: Sequence[str], name: str = "Pct") -> DataFrame:
    """Part of the total that came by a group of methods."""
    return rc.groupBy(*by).agg(_share(methods).alias(name))


def rest_share(rc: DataFrame, methods: Sequence[str], by: Sequence[str], name: str = "PctResto") -> DataFrame:
    """Part of the total that came by any other method."""
    rest = sum_if(~F.col("CodCpt").isin(*methods), "Total")
    return rc.groupBy(*by).agg(ratio(rest, F.sum("Total")).alias(name))


def collection_mix(rc: DataFrame, by: Sequence[str], groups: Mapping[str, Sequence[str]] = MIX) -> DataFrame:
    """Total, share of each group of methods, and share of all but cash, in one pass."""
    rest = sum_if(F.col("CodCpt") != "EFE", "Total")
    return rc.groupBy(*by).agg(
        F.sum("Total").alias("TotalCobrado"),
        *[_share(methods).alias(name) for name, methods in groups.items()],
        ratio(rest, F.sum("Total")).alias("PctResto"),
    )


def collection_cost(rc: DataFrame, rates: DataFrame, by: Sequence[str]) -> DataFrame:
    """Amount times the rate of its method (`CodCpt`, `Tasa`); a method without a rate is free."""
    totals = rc.groupBy(*by, "CodCpt").agg(F.sum("Total").alias("Total"))
    rated = totals.join(rates.select("CodCpt", "Tasa"), "CodCpt", "left")
    cost = F.col("Total") * F.coalesce("Tasa", F.lit(0))
    real = ~F.col("CodCpt").isin(*WITHHOLDINGS)
    return rated.groupBy(*by).agg(F.sum(cost).alias("Costo"), sum_if(real, "Total").alias("CobradoReal"))


def cost_ratio(rc: DataFrame, rates: DataFrame, by: Sequence[str]) -> DataFrame:
    """Cost over what was collected without withholdings."""
    cost = collection_cost(rc, rates, by)
    return cost.withColumn("PctCosto", ratio("Costo", "CobradoReal"))


def over_threshold(cost: DataFrame, limit: float = COST_TOLERANCE) -> DataFrame:
    """Cost ratios with a flag for those above tolerance."""
    above = F.coalesce(F.col("PctCosto") > F.lit(limit), F.lit(False))
    return cost.withColumn("SobreUmbral", F.when(above, 1).otherwise(0))


def vendor_count(rc: DataFrame) -> DataFrame:
    return rc.agg(F.count_distinct("RUTA").alias("Vendedores"))


def dominant_method(rc: DataFrame, by: Sequence[str]) -> DataFrame:
    """The method that brought most money; the smaller code wins a tie."""
    return top1(rc, by, "CodCpt", "Total").withColumnRenamed("CodCpt", "MedioDominante")


def dso(debt: DataFrame, sales: DataFrame, workdays: DataFrame, by: Sequence[str]) -> DataFrame:
    """Days outstanding: `Deuda` over the mean sales of a day worked (`Ventas` / `Dias`). `sales`
    and `workdays` join on those of the `by` columns they have."""
    joined = debt
    for other in (sales, workdays):
        joined = joined.join(other, [c for c in by if c in other.columns], "left")
    return joined.withColumn("DiasCalle", ratio("Deuda", ratio("Ventas", "Dias")))


def dso_by_region(
    t: Tables, months: Sequence[dt.date], threshold: float, by: Sequence[str] = ("CodSup", "CuentaGrande", "Mes")
) -> DataFrame:
    """Days outstanding of consecutive months by region and account size: debt of both ledgers at the end
    of each month, net sales, and days worked. An account is large if its sales of all the months reach
    `threshold`."""
    start, before = months[0], first_of_month(months[-1], 1)
    sold = customer_month_sales(t, start, before)
    accounts = customer_region(t).join(account_size(sold, threshold), "NroCta", "left").select(
        "NroCta", "CodSup", F.coalesce("CuentaGrande", F.lit("No")).alias("CuentaGrande")
    )
    cash = t["Movimientos_Caja"].select(F.col("IdCliente").alias("NroCta"), "Fecha", "Importe")
    adjusted = t["Movimientos_Caja_Ajustes"].select(F.col("idCliente").alias("NroCta"), "Fecha", "Importe")
    credit = t["CtaCteVT"].select(
        account_number("NroCta").alias("NroCta"), F.col("FchMov").alias("Fecha"), F.col("Import").alias("Importe")
    )
    moves = cash.unionByName(adjusted).unionByName(credit).filter(F.col("NroCta").isNotNull())
    debt = monthly_debt(moves, ["NroCta"], months).join(accounts, "NroCta").groupBy(*by).agg(F.sum("Deuda").alias("Deuda"))
    sales = sold.join(accounts, "NroCta").groupBy(*by).agg(F.sum("Ventas").alias("Ventas"))
    return dso(debt, sales, work_days(t, start, before), by)


def dso_grid(rows: DataFrame, by: Sequence[str], months: Sequence[dt.date]) -> DataFrame:
    """Days outstanding with one column per month (`yyyy-MM`)."""
    named = rows.withColumn("_mes", F.date_format("Mes", "yyyy-MM"))
    return named.groupBy(*by).pivot("_mes", [m.strftime("%Y-%m") for m in months]).agg(F.first("DiasCalle"))


def monthly_debt(moves: DataFrame, by: Sequence[str], months: Sequence[dt.date]) -> DataFrame:
    """Balance of a ledger (`Fecha`, `Importe`) at the end of each month, as rows of Mes and Deuda.
    All months come from one pass over the ledger."""
    ends = [first_of_month(m, 1) for m in months]
    sums = [
        sum_if(F.col("Fecha") < F.lit(end.isoformat()).cast("timestamp_ntz"), "Importe").alias(f"_m{i}")
        for i, end in enumerate(ends)
    ]
    wide = moves.filter(F.col("Fecha") < F.lit(ends[-1].isoformat()).cast("timestamp_ntz")).groupBy(*by).agg(*sums)
    cells = F.array(*[F.struct(F.lit(m).alias("Mes"), F.col(f"_m{i}").alias("Deuda")) for i, m in enumerate(months)])
    return wide.select(*by, F.explode(cells).alias("_cell")).select(*by, "_cell.Mes", "_cell.Deuda")


def customer_month_sales(t: Tables, start: dt.date, before: dt.date, liquid: str | None = None) -> DataFrame:
    """(NroCta, Mes, Ventas): net sales per customer and month, services included unless `liquid` keeps
    products by volume."""
    orders = t.between("Pedidos", start, before).select(
        "idPedido", F.col("idCliente").alias("NroCta"), month_start("Fecha_Pedido").alias("Mes")
    )
    lines = lines_of(t, orders, liquid=liquid, window=(start, before))
    return lines.groupBy("NroCta", "Mes").agg(F.sum(amount()).alias("Ventas"))


def account_size(sales: DataFrame, threshold: float) -> DataFrame:
    """(NroCta, CuentaGrande): whether the account's sales reach the threshold."""
    totals = sales.groupBy("NroCta").agg(F.sum("Ventas").alias("_total"))
    return totals.select("NroCta", F.when(F.col("_total") >= threshold, "Si").otherwise("No").alias("CuentaGrande"))


def work_days(t: Tables, start: dt.date, before: dt.date) -> DataFrame:
    """(Mes, Dias): days with at least one order, for callers without a calendar of their own."""
    days = t.between("Pedidos", start, before).select(F.to_date("Fecha_Pedido").alias("_day")).distinct()
    return days.groupBy(month_start("_day").alias("Mes")).agg(F.count(F.lit(1)).alias("Dias"))
