"""Events of a month for equipment customers."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.functions.dates import fmt_dmy
from rivulet.functions.rules import DISPENSER, event_priority, event_text, retirement_event
from rivulet.operators.aggregates import joined_text
from rivulet.operators.joins import semi
from rivulet.operators.rowsets import union_events
from rivulet.sources.tables import Tables


def month_events(t: Tables, customers: DataFrame, start: dt.date, before: dt.date) -> DataFrame:
    """Orders (E2) and equipment retirements (E1, E3, E4, EC) of the customers in the month, as
    (NroCta, FechaEvento, TipoEvento, IdReparto) and how often each occurred.

    Equal events are counted before the customers are matched, so a customer with very many is a
    few rows by then; where the customers fit a broadcast, Spark matches them first.
    """
    orders = t.between("Pedidos", start, before).select(
        F.col("idCliente").alias("NroCta"),
        F.to_date("Fecha_Pedido").alias("FechaEvento"),
        F.col("idVendedor").alias("IdReparto"),
        F.lit("E2").alias("TipoEvento"),
    )
    moves = t.between("Movimientos_Equipos", start, before).filter(
        (F.col("Tipo_Movimiento") == "R")
        & (F.col("IdProducto") == DISPENSER)
        & (F.coalesce("Anulado", F.lit(0)) == 0)
    )
    retirements = moves.select(
        F.col("IdCliente").alias("NroCta"),
        F.to_date("Fecha").alias("FechaEvento"),
        "IdReparto",
        retirement_event("IdReparto", "IdRecambio").alias("TipoEvento"),
    )
    counted = (
        union_events(orders, retirements)
        .groupBy("NroCta", "FechaEvento", "TipoEvento", "IdReparto")
        .agg(F.count(F.lit(1)).cast("int").alias("_times"))
    )
    return semi(counted, customers, "NroCta")


def event_summary(counted: DataFrame) -> DataFrame:
    """Per customer: the event that wins, how many kinds occurred, and the text of all.

    What is gathered per customer is bounded by days x kinds x routes, whatever the number of
    events, and one pass over it yields all three results.
    """
    route = F.when(F.col("IdReparto").isNull(), "").otherwise(F.concat(F.lit(" - R"), F.col("IdReparto")))
    text = F.concat(
        "TipoEvento", F.lit(":"), event_text("TipoEvento"), F.lit(" ("), fmt_dmy("FechaEvento"), route, F.lit(")")
    )
    in_order = F.struct("FechaEvento", "TipoEvento", "IdReparto", text.alias("_text"), "_times")
    latest_first = F.date_diff(F.lit("9999-12-31").cast("date"), F.col("FechaEvento"))
    by_rank = F.struct(
        event_priority("TipoEvento").alias("rank"), latest_first.alias("age"), "IdReparto", "TipoEvento", "FechaEvento"
    )
    summary = counted.groupBy("NroCta").agg(
        F.min(by_rank).alias("_winner"),
        F.size(F.collect_set("TipoEvento")).alias("CantEventosDistintos"),
        F.sort_array(F.collect_list(in_order)).alias("_events"),
    )
    return summary.select(
        "NroCta",
        F.col("_winner.TipoEvento").alias("TipoEvento"),
        F.col("_winner.FechaEvento").alias("FechaEvento"),
        F.col("_winner.IdReparto").alias("IdReparto"),
        "CantEventosDistintos",
        joined_text(F.col("_events"), " | ").alias("AccionesMes"),
    )
