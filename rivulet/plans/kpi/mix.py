"""Which products customers buy, and how equipment is used."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.functions.dates import closed_months, first_of_month, month_start
from rivulet.functions.exprs import ratio, valid_at
from rivulet.operators.joins import facts_of, semi
from rivulet.plans.orders import lines_of, volume
from rivulet.sources.tables import Tables

Families = Mapping[str, Sequence[str]]


def _end_of(month: dt.date) -> Column:
    return F.lit(first_of_month(month, 1).isoformat()).cast("timestamp_ntz")


def machines_by_month(t: Tables, months: Sequence[dt.date]) -> DataFrame:
    """(NroCta, _equipos): machines in place at the end of each month, as an array in month order.
    A machine listed twice counts once."""
    flags = [
        F.max(F.when(valid_at("Fecha_Desde", "Fecha_Baja", _end_of(m)), 1).otherwise(0)).alias(f"_m{i}")
        for i, m in enumerate(months)
    ]
    each = t["ClientesServicios"].groupBy(F.col("IdCliente").alias("NroCta"), "Nro_Serie").agg(*flags)
    sums = [F.sum(f"_m{i}").alias(f"_m{i}") for i in range(len(months))]
    counts = each.groupBy("NroCta").agg(*sums)
    return counts.select("NroCta", F.array(*[F.col(f"_m{i}") for i in range(len(months))]).alias("_equipos"))


def _month_index(months: Sequence[dt.date]) -> Column:
    """Position of Mes in the month list, from 1."""
    return (F.months_between("Mes", F.lit(months[0])) + 1).cast("int")


def customer_months(
    t: Tables, start: dt.date, before: dt.date, families: Families, column: str, accounts: DataFrame | None = None
) -> DataFrame:
    """Per customer and month: litres, and for each family its litres and whether it was bought. `accounts`
    (`NroCta`) keeps the orders of others from their lines."""
    orders = t.between("Pedidos", start, before).select(
        "idPedido", F.col("idCliente").alias("NroCta"), month_start("Fecha_Pedido").alias("Mes")
    )
    if accounts is not None:
        orders = facts_of(orders, accounts, "NroCta")
    lines = lines_of(t, orders, liquid="positive", window=(start, before))
    parts = []
    for name, codes in families.items():
        inside = F.col(column).isin(*codes)
        parts.append(F.max(F.when(inside, 1).otherwise(0)).alias(f"_tiene_{name}"))
        parts.append(F.sum(F.when(inside, volume()).otherwise(0)).alias(f"_litros_{name}"))
    return lines.groupBy("NroCta", "Mes").agg(F.sum(volume()).alias("Litros"), *parts)


def product_mix(
    t: Tables,
    families: Families,
    as_of: dt.date,
    months: int = 14,
    column: str = "Unidad",
    accounts: DataFrame | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """Per month, and per value of the `by` columns of `accounts` (one row per `NroCta`): customers that bought,
    the share of them that bought each family, each family's litres and share of litres, and the share of
    customers with equipment. `accounts` without `by` are the segment the figures are of. A customer counts
    once per month because rows are first brought to customer and month."""
    span = closed_months(as_of, months)
    bought = customer_months(t, span[0], first_of_month(as_of), families, column)
    if by:
        bought = bought.join(accounts.select("NroCta", *by), "NroCta")
    elif accounts is not None:
        bought = semi(bought, accounts, "NroCta")
    machines = machines_by_month(t, span)
    joined = bought.join(machines, "NroCta", "left").withColumn(
        "_con_equipo", F.when(F.coalesce(F.col("_equipos")[_month_index(span) - 1], F.lit(0)) > 0, 1).otherwise(0)
    )
    customers = F.count(F.lit(1))
    measures = [customers.alias("Clientes"), F.sum("Litros").alias("Litros")]
    for name in families:
        litres = F.sum(f"_litros_{name}")
        measures += [
            ratio(F.sum(f"_tiene_{name}"), customers).alias(f"PctClientes{name}"),
            litres.alias(f"Litros{name}"),
            ratio(litres, F.sum("Litros")).alias(f"PctLitros{name}"),
        ]
    measures.append(ratio(F.sum("_con_equipo"), customers).alias("PctClientesFC"))
    return joined.groupBy(*by, "Mes").agg(*measures)


def machine_productivity(t: Tables, as_of: dt.date, months: int) -> DataFrame:
    """Litres per machine for each customer with machines and each closed month, 0 litres included."""
    span = closed_months(as_of, months)
    litres = customer_months(t, span[0], first_of_month(as_of), {}, "Unidad")
    monthly = litres.groupBy("NroCta").agg(F.map_from_entries(F.collect_list(F.struct("Mes", "Litros"))).alias("_litros"))
    calendar = F.posexplode(F.array(*[F.lit(m) for m in span])).alias("_pos", "Mes")
    rows = machines_by_month(t, span).select("NroCta", "_equipos", calendar)
    held = rows.withColumn("Q_FC", F.col("_equipos")[F.col("_pos")]).filter(F.col("Q_FC") > 0)
    found = F.coalesce(F.try_element_at("_litros", F.col("Mes")), F.lit(0))
    return held.join(monthly, "NroCta", "left").select(
        "NroCta", "Mes", "Q_FC", found.alias("Litros"), ratio(found, "Q_FC").alias("LitrosPorEquipo")
    )


def underused(productivity: DataFrame, threshold: float) -> DataFrame:
    """Customers and months whose machines move fewer litres than the threshold."""
    return productivity.filter(F.col("LitrosPorEquipo") < threshold)


def promo_panel(
    t: Tables,
    segment: DataFrame,
    as_of: dt.date,
    months: int,
    bottle: Sequence[str],
    soda: Sequence[str],
    column: str = "Unidad",
) -> DataFrame:
    """Per closed month over the whole segment (`NroCta`): customers, and the shares that bought
    bottles only, soda, both, and nothing."""
    span = closed_months(as_of, months)
    population = segment.select("NroCta").distinct()
    families = {"botellon": bottle, "soda": soda}
    bought = customer_months(t, span[0], first_of_month(as_of), families, column, population)
    flags = F.struct(F.col("_tiene_botellon").alias("b"), F.col("_tiene_soda").alias("s"))
    monthly = bought.groupBy("NroCta").agg(F.map_from_entries(F.collect_list(F.struct("Mes", flags))).alias("_months"))
    rows = population.join(monthly, "NroCta", "left").select(
        F.explode(F.array(*[F.lit(m) for m in span])).alias("Mes"), "_months"
    )
    seen = rows.select("Mes", F.try_element_at("_months", F.col("Mes")).alias("f"))
    has_bottle = F.coalesce(F.col("f.b"), F.lit(0)) == 1
    has_soda = F.coalesce(F.col("f.s"), F.lit(0)) == 1
    total = F.count(F.lit(1))

    def part(test: Column) -> Column:
        return F.count(F.when(test, 1)) / total

    return seen.groupBy("Mes").agg(
        total.alias("TotalClientes"),
        part(has_bottle & ~has_soda).alias("PctBotellon"),
        part(has_soda).alias("PctSoda"),
        part(has_soda & has_bottle).alias("PctSodaYBotellon"),
        part(F.col("f").isNull()).alias("PctSinCompras"),
    )
