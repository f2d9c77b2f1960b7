"""Values against the month before and the same month a year ago."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.functions.dates import first_of_month, month_start
from rivulet.functions.exprs import ratio
from rivulet.plans.orders import amount, lines_of, volume
from rivulet.sources.tables import Tables


def trend(df: DataFrame, value: str, by: Sequence[str], as_of: dt.date, months: int = 14) -> DataFrame:
    """Rows of `by` and Mes for each of the last `months` months up to that of `as_of`: the value,
    the month before, the same month a year ago, and both changes. `df` holds `Mes` and `value`
    and may have several rows per month; a month without rows is 0.

    The months of a group travel as one small map (at most months + 12 entries), so neither a
    calendar join nor a window is needed.
    """
    last = first_of_month(as_of)
    first = first_of_month(as_of, 1 - months)
    span = df.filter((F.col("Mes") >= F.lit(first_of_month(first, -12))) & (F.col("Mes") <= F.lit(last)))
    monthly = span.groupBy(*by, "Mes").agg(F.sum(value).alias(value))
    data_type = monthly.schema[value].dataType
    gathered = monthly.groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct("Mes", value))).alias("_months"))
    calendar = F.sequence(F.lit(first), F.lit(last), F.expr("interval 1 month"))
    rows = gathered.select(*by, "_months", F.explode(calendar).alias("Mes"))

    def at(offset: int) -> Column:
        found = F.try_element_at("_months", F.add_months("Mes", offset))
        return F.coalesce(found, F.lit(0).cast(data_type))

    valued = rows.select(
        *by, "Mes", at(0).alias(value), at(-1).alias("MesAnterior"), at(-12).alias("AnioAnterior")
    )
    return valued.withColumns(
        {
            "VarMes": ratio(F.col(value) - F.col("MesAnterior"), "MesAnterior"),
            "VarAnio": ratio(F.col(value) - F.col("AnioAnterior"), "AnioAnterior"),
        }
    )


def route_sales(t: Tables, start: dt.date, before: dt.date) -> DataFrame:
    """Litres, paid litres and revenue per route (Ruta), product family (Unidad) and month."""
    orders = t.between("Pedidos", start, before).select(
        "idPedido", F.col("idVendedor").alias("Ruta"), month_start("Fecha_Pedido").alias("Mes")
    )
    lines = lines_of(t, orders, liquid="nonzero", window=(start, before))
    return lines.groupBy("Ruta", "Unidad", "Mes").agg(
        F.sum(volume()).alias("Litros"),
        F.sum(F.when(F.col("Precio") > 0, volume()).otherwise(0)).alias("LitrosConCargo"),
        F.sum(amount()).alias("Facturacion"),
    )


def paid_litres(sales: DataFrame, by: Sequence[str]) -> DataFrame:
    """Litres charged next to all litres."""
    return sales.groupBy(*by).agg(F.sum("LitrosConCargo").alias("LitrosConCargo"), F.sum("Litros").alias("Litros"))


def paid_litres_by_region(t: Tables, sales: DataFrame) -> DataFrame:
    """The same per region (CodSup). Routes are summed before they meet their supervisors."""
    routes = paid_litres(sales, ["Ruta"])
    heads = t["repartos"].select(F.col("Codigo").alias("Ruta"), "CodSup")
    return paid_litres(routes.join(heads, "Ruta"), ["CodSup"])


def band_label(change: Column, band: float) -> Column:
    """Out of tolerance below or above, or within."""
    return F.when(change < -band, "BAJA").when(change > band, "SUBE").when(change.isNotNull(), "EN BANDA")


def route_variance(sales: DataFrame, benchmark: DataFrame, as_of: dt.date, band: float = 0.05) -> DataFrame:
    """Litres per route in the month of `as_of` against the month before, the year before and a
    benchmark (`Ruta`, `Benchmark`), each with its tolerance label."""
    month = trend(sales, "Litros", ["Ruta"], as_of, months=1).drop("Mes")
    joined = month.join(benchmark.select("Ruta", "Benchmark"), "Ruta", "left")
    compared = joined.withColumn("VarBenchmark", ratio(F.col("Litros") - F.col("Benchmark"), "Benchmark"))
    return compared.withColumns(
        {f"Banda{name}": band_label(F.col(f"Var{name}"), band) for name in ("Mes", "Anio", "Benchmark")}
    )


def family_of(families: Mapping[str, Sequence[str]], column: str, rest: str = "Resto") -> Column:
    """Family name by the listed codes, `rest` for any other."""
    label = F.lit(rest)
    for name, codes in families.items():
        label = F.when(F.col(column).isin(*codes), name).otherwise(label)
    return label


def family_revenue(
    sales: DataFrame, families: Mapping[str, Sequence[str]], as_of: dt.date, column: str = "Unidad"
) -> DataFrame:
    """Revenue per product family in the month of `as_of`, the month before and the year before."""
    named = sales.withColumn("Familia", family_of(families, column))
    return trend(named, "Facturacion", ["Familia"], as_of, months=1)
