"""Litres moved by installed equipment."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.functions.exprs import safe_div, valid_at
from rivulet.operators.joins import facts_of
from rivulet.plans.orders import lines_of, volume
from rivulet.sources.tables import Tables


def machines_at(t: Tables, cut: dt.date) -> DataFrame:
    """(NroCta, Q_FC): distinct machines in place at the cut."""
    day = F.lit(cut.isoformat()).cast("timestamp_ntz")
    alive = t["ClientesServicios"].filter(valid_at("Fecha_Desde", "Fecha_Baja", day))
    counts = alive.groupBy(F.col("IdCliente").alias("NroCta")).agg(F.count_distinct("Nro_Serie").alias("Q_FC"))
    return counts.filter(F.col("Q_FC") > 0)


def litres_per_equipment(t: Tables, cut: dt.date, from_: dt.date, to: dt.date) -> DataFrame:
    """Litres in `from_ <= date < to` per customer with machines at the cut, and per machine.
    Only orders of those customers meet their lines, and litres are summed per customer."""
    orders = t.between("Pedidos", from_, to).select("idPedido", F.col("idCliente").alias("NroCta"))
    machines = machines_at(t, cut)
    lines = lines_of(t, facts_of(orders, machines, "NroCta"), liquid="positive", window=(from_, to))
    litres = lines.groupBy("NroCta").agg(F.sum(volume()).alias("ConsumoLitros"))
    ratio = safe_div("ConsumoLitros", "Q_FC").cast("decimal(12,2)")
    return machines.join(litres, "NroCta").withColumn("LitrosPorEquipo", ratio)
