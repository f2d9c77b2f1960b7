"""Equipment customers that stopped buying."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.functions import rules
from rivulet.functions.dates import day_after, month_window
from rivulet.operators.joins import no_activity, semi
from rivulet.plans.customers import active_customers, closed_customers, one_per_account
from rivulet.plans.events import event_summary, month_events
from rivulet.sources.tables import Tables

CONTACT = ["NroCta", "Nombre", "Direcc", "Telefn"]


def silent_equipment_customers(t: Tables, start: dt.date, silent_days: int = 60, min_age_days: int = 90) -> DataFrame:
    """(NroCta) with a machine still installed for `min_age_days` at `start` and no order in the
    `silent_days` before it."""
    oldest = F.lit(day_after(start, -min_age_days).isoformat()).cast("timestamp_ntz")
    holders = (
        t["ClientesServicios"]
        .filter(F.col("Fecha_Baja").isNull() & (F.col("Fecha_Desde") <= oldest))
        .select(F.col("IdCliente").alias("NroCta"))
        .distinct()
    )
    return no_activity(
        holders, t["Pedidos"], "NroCta", "idCliente", "Fecha_Pedido", day_after(start, -silent_days), start
    )


def equipment_retention(
    t: Tables,
    month: dt.date,
    silent_days: int = 60,
    min_age_days: int = 90,
    cohort: DataFrame | None = None,
    exclude: Sequence[int] = rules.NON_COMMERCIAL_ROUTES,
) -> DataFrame:
    """What happened in the month to each silent equipment customer: the event that wins, a
    flag for several kinds of event, and the text of all. `cohort` (its `NroCta`) replaces the
    silent customers. An active record goes before a closed one of the same account."""
    start, before = month_window(month)
    silent = silent_equipment_customers(t, start, silent_days, min_age_days) if cohort is None else cohort
    active = active_customers(t, exclude=exclude).select(*CONTACT)
    closed = closed_customers(t, exclude=exclude).select(*CONTACT, "FecBaj", "IdClienteBaja")
    customers = semi(one_per_account(active, closed), silent, "NroCta").select(*CONTACT)
    summary = event_summary(month_events(t, silent, start, before))
    default_code, default_text = rules.STILL_SILENT
    return customers.join(summary, "NroCta", "left").select(
        F.lit(start.strftime("%Y-%m")).alias("Mes"),
        *CONTACT,
        F.coalesce("TipoEvento", F.lit(default_code)).alias("TipoEvento"),
        F.coalesce(rules.event_text("TipoEvento"), F.lit(default_text)).alias("EstadoFinal"),
        "FechaEvento",
        "IdReparto",
        F.when(F.coalesce("CantEventosDistintos", F.lit(0)) > 1, 1).otherwise(0).alias("FlagConflicto"),
        "AccionesMes",
    )
