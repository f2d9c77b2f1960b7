"""Customers told apart by the text of their address."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.functions.dates import month_name
from rivulet.functions.rules import community_patterns
from rivulet.functions.text import any_like, classify_like
from rivulet.operators.joins import facts_of
from rivulet.plans.customers import active_customers, with_segment, with_terms, with_type
from rivulet.plans.orders import amount, lines_of, packs, volume
from rivulet.sources.tables import Tables


def community_customers(t: Tables, patterns: Sequence[tuple[str, str]] | None = None) -> DataFrame:
    """(NroCta, RUTA, Urbanizacion, Atributo) of the customers whose address matches a pattern;
    the first match names the community."""
    patterns = community_patterns() if patterns is None else patterns
    people = active_customers(t).filter(any_like("Direcc", [p for p, _ in patterns]))
    labelled = with_segment(t, with_type(t, with_terms(t, people)), "left")
    return labelled.select(
        "NroCta", "RUTA", classify_like("Direcc", patterns).alias("Urbanizacion"), F.col("AtrDes").alias("Atributo")
    )


def community_consumption(t: Tables, patterns: Sequence[tuple[str, str]] | None = None) -> DataFrame:
    """Litres, units, packs and spend per community customer and month."""
    customers = community_customers(t, patterns)
    orders = facts_of(t["Pedidos"].select("idPedido", "idCliente", "Fecha_Pedido"), customers, "idCliente", "NroCta")
    lines = lines_of(t, orders, liquid="positive")
    monthly = lines.groupBy(
        "idCliente",
        F.year("Fecha_Pedido").alias("AÑO"),
        F.month("Fecha_Pedido").alias("_month"),
        month_name("Fecha_Pedido").alias("MES"),
    ).agg(
        F.sum(volume()).alias("LITROS"),
        F.sum("Cantidad").alias("CANTIDAD"),
        F.sum(packs()).cast("decimal(18,4)").alias("BULTOS"),
        F.sum(amount()).alias("CONSUMO_$"),
    )
    return monthly.join(customers, F.col("idCliente") == F.col("NroCta")).select(
        "idCliente", "Urbanizacion", "Atributo", "AÑO", "MES", "LITROS", "CANTIDAD", "BULTOS", "CONSUMO_$"
    )
