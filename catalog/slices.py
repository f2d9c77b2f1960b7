"""Queries over hierarchies of any depth, slices with totals, counts that add up, and long lists."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog.measures import FAMILIES, HOLIDAYS
from catalog.registry import ORACLE, query
from catalog.star_sql import num, star_query
from rivulet.functions import text
from rivulet.operators import bitmaps, hierarchy, joins
from rivulet.operators.rowsets import keep
from rivulet.plans.kpi import acquisition as ka
from rivulet.plans.kpi import mix as km
from rivulet.plans.kpi import operations as ko
from rivulet.sources.tables import Tables

D = dt.date

# --- hierarchies

# Every account belongs to a third of its number; three of them belong to each other in a ring.
TREE = """
enlaces AS (SELECT c_custkey AS hijo, CASE c_custkey WHEN 60 THEN 90 WHEN 90 THEN 120 WHEN 120 THEN 60 ELSE c_custkey // 3 END AS padre
  FROM customer WHERE c_custkey >= 3),
vueltas AS (SELECT hijo AS desde, padre AS en, [hijo] AS paso FROM enlaces
  UNION ALL SELECT desde, padre, list_append(paso, en) FROM vueltas JOIN enlaces ON hijo = en WHERE NOT list_contains(paso, en)),
arboles AS (SELECT hijo, padre FROM enlaces
  WHERE hijo NOT IN (SELECT list_min(paso) FROM vueltas WHERE desde = en)),
arriba AS (SELECT hijo, padre, 1 AS nivel FROM arboles
  UNION ALL SELECT r.hijo, a.padre, nivel + 1 FROM arriba r JOIN arboles a ON a.hijo = r.padre)
"""


def _tree(t: Tables) -> DataFrame:
    people = t["Clientes"].select("NroCta").unionByName(t["ClientesBaja"].select("NroCta"))
    key = F.col("NroCta")
    ring = F.when(key == 60, 90).when(key == 90, 120).when(key == 120, 60).otherwise(F.floor(key / 3))
    return people.filter(key >= 3).select(key.alias("IdCliente"), ring.cast("long").alias("Cta_Madre"))


def _recursive(sql: str) -> str:
    return "WITH RECURSIVE" + sql.removeprefix("WITH")


@query(
    "j13_any_depth",
    _recursive(
        star_query(
            f"""SELECT coalesce(cima, o_custkey) AS Cuenta, {num("sum(CAST(o_totalprice AS DECIMAL(18,2)))", "Import")}
FROM orders LEFT JOIN (SELECT hijo, arg_max(padre, nivel) AS cima FROM arriba GROUP BY hijo) ON hijo = o_custkey GROUP BY 1""",
            TREE,
        )
    ),
)
def j13_any_depth(t: Tables) -> DataFrame:
    """Receipts per topmost account, through as many levels as there are."""
    receipts = t["MovTes"].select(text.account_number("NroCta").alias("IdCliente"), "Import")
    return hierarchy.to_head(receipts, _tree(t), "IdCliente", ["Import"])


@query(
    "j13_levels",
    _recursive(
        star_query(
            f"""SELECT nodo, max(nivel) AS niveles, {num("sum(CAST(o_totalprice AS DECIMAL(18,2)))", "Import")} FROM orders
JOIN (SELECT c_custkey AS hijo, c_custkey AS nodo, 0 AS nivel FROM customer UNION ALL SELECT hijo, padre, nivel FROM arriba) ON hijo = o_custkey GROUP BY nodo""",
            TREE,
        )
    ),
)
def j13_levels(t: Tables) -> DataFrame:
    """Receipts of every account with all accounts below it."""
    receipts = t["MovTes"].select(text.account_number("NroCta").alias("IdCliente"), "Import")
    return hierarchy.rollup_levels(receipts, _tree(t), "IdCliente", ["Import"], "IdCliente", "Cta_Madre")


@query(
    "j12_chain",
    star_query(
        """SELECT nodo, max(nivel) AS niveles, CAST(sum(n) AS BIGINT) AS pedidos
FROM (SELECT idVendedor, count(*) AS n FROM Pedidos GROUP BY 1) JOIN (
  SELECT n_nationkey AS v, n_nationkey AS nodo, 0 AS nivel FROM nation
  UNION ALL SELECT n_nationkey, n_regionkey + 1000, 1 FROM nation UNION ALL SELECT n_nationkey, 2000, 2 FROM nation) ON v = idVendedor GROUP BY nodo"""
    ),
)
def j12_chain(t: Tables) -> DataFrame:
    """Orders of vendors, supervisors and whom those report to. Supervisors report to themselves in the table;
    here to a manager."""
    own = F.col("CodSup") == F.col("Codigo")
    vendors = t["repartos"].select("Codigo", F.when(own, 2000).otherwise(F.col("CodSup")).alias("CodSup"))
    counts = t["Pedidos"].groupBy("idVendedor").agg(F.count(F.lit(1)).alias("pedidos"))
    return hierarchy.rollup_levels(counts, vendors, "idVendedor", ["pedidos"], "Codigo", "CodSup")


# --- slices with totals


@query(
    "k20_holiday_slices",
    ORACLE["k20_holiday_table"].replace("\nSELECT strftime(Feriado", ",\nferiados AS (SELECT strftime(Feriado", 1)
    + f""")
SELECT Feriado, DiaSemana, Supervisor, Ruta, grouping(Feriado, DiaSemana, Supervisor, Ruta) AS corte, count(*) AS Filas, {num("sum(PromSem)", "PromSem")},
  {num("sum(VtaFeriado)", "VtaFeriado")}, {num("sum(ARecuperar)", "ARecuperar")},
  {num("CAST(100 * sum(ARecuperar) / nullif(sum(PromSem), 0) + 1e-9 AS DECIMAL(5,1))", "Pct")}
FROM feriados GROUP BY GROUPING SETS ((Feriado, Supervisor, Ruta), (Feriado, Supervisor), (Feriado), (DiaSemana, Supervisor), (DiaSemana), (Supervisor), ())""",
)
def k20_holiday_slices(t: Tables) -> DataFrame:
    return ko.holiday_slices(ko.holiday_table(t, HOLIDAYS, months=24))


# --- counts that add up


@query(
    "k11_distinct_ranges",
    star_query(
        """SELECT CodSup, CAST(year(Fecha_Pedido) AS INTEGER) AS anio, CAST(quarter(Fecha_Pedido) AS INTEGER) AS trimestre, count(DISTINCT idCliente) AS clientes
FROM Pedidos JOIN repartos ON Codigo = idVendedor GROUP BY GROUPING SETS ((1, 2, 3), (2, 3), (2), (1), ())"""
    ),
)
def k11_distinct_ranges(t: Tables) -> DataFrame:
    """Customers per region and quarter, per quarter, per year, per region and of all time, from the bitmaps of
    regions and months."""
    region = t["repartos"].select(F.col("Codigo").alias("idVendedor"), "CodSup")
    orders = t["Pedidos"].select("idCliente", "idVendedor", F.trunc("Fecha_Pedido", "month").alias("Mes"))
    facts = orders.join(region, "idVendedor")
    known = bitmaps.numbered(t["Clientes"].select(F.col("NroCta").alias("idCliente")), "idCliente")
    numbers = keep(bitmaps.numbered(orders, "idCliente", keep(known)))
    stored = keep(bitmaps.bitmaps(facts, "idCliente", numbers, ["CodSup", "Mes"]))
    year, quarter = F.year("Mes").alias("anio"), F.quarter("Mes").alias("trimestre")
    cuts = [["CodSup", year, quarter], [year, quarter], [year], ["CodSup"], []]
    parts = [bitmaps.distinct_count(stored, cut) for cut in cuts]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part, allowMissingColumns=True)
    return whole


# --- long lists


@query(
    "p06_not_in_list",
    star_query(
        """SELECT o_orderkey AS idPedido, 'lista' AS caso FROM orders WHERE o_custkey NOT IN (SELECT NroCta FROM Clientes)
UNION ALL SELECT o_orderkey, 'vacia' FROM orders WHERE nullif(o_custkey % 3, 0) NOT IN (SELECT NroCta FROM Clientes WHERE NroCta < 0)
UNION ALL SELECT o_orderkey, 'sin dato' FROM orders WHERE nullif(o_custkey % 9, 0) NOT IN (SELECT NroCta FROM Clientes WHERE NroCta < 5)
UNION ALL SELECT o_orderkey, 'con NULL' FROM orders WHERE o_custkey NOT IN (SELECT nullif(NroCta, 1) FROM ClientesBaja UNION ALL SELECT NULL)"""
    ),
)
def p06_not_in_list(t: Tables) -> DataFrame:
    orders = t["Pedidos"].select("idPedido", F.col("idCliente").alias("c"))
    listed = t["Clientes"].select("NroCta")
    third, ninth = (orders.withColumn("c", F.nullif(F.col("c") % n, F.lit(0))) for n in (3, 9))
    holed = t["ClientesBaja"].select("NroCta").unionByName(t.spark.range(1).select(F.lit(None).cast("long").alias("NroCta")))
    cases = {
        "lista": joins.not_in(orders, "c", listed, "NroCta"),
        "vacia": joins.not_in(third, "c", listed.filter("NroCta < 0"), "NroCta"),
        "sin dato": joins.not_in(ninth, "c", listed.filter("NroCta < 5"), "NroCta"),
        "con NULL": joins.not_in(orders, "c", holed, "NroCta"),
    }
    parts = [df.select("idPedido", F.lit(name).alias("caso")) for name, df in cases.items()]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


# --- segments and days of measures


@query(
    "k18_mix_segment",
    ORACLE["k18_mix"].replace("FROM cm LEFT JOIN", "FROM (SELECT * FROM cm WHERE IdCliente IN (SELECT NroCta FROM Clientes WHERE TipCli = 'BUILDING')) cm LEFT JOIN"),
)
def k18_mix_segment(t: Tables) -> DataFrame:
    """The mix of one segment."""
    segment = t["Clientes"].filter(F.col("TipCli") == "BUILDING")
    return km.product_mix(t, FAMILIES, D(2001, 8, 15), months=14, accounts=segment)


@query(
    "k30_promo_cost_day",
    star_query(
        f"""SELECT v.idProducto, {num("sum(Cantidad)", "Unidades")}, {num("CAST(p_retailprice AS DECIMAL(15,2))", "PrecioLista")},
{num("sum(Cantidad) * CAST(p_retailprice AS DECIMAL(15,2))", "CostoBonificado")}
FROM Ventas v JOIN (SELECT idPedido, row_number() OVER (PARTITION BY idCliente ORDER BY Fecha_Pedido, idPedido) AS rn FROM Pedidos
  WHERE Fecha_Pedido >= DATE '1995-03-01' AND Fecha_Pedido < DATE '1996-01-01' AND idCliente IN (SELECT NroCta FROM Clientes WHERE FecAlt >= DATE '1995-03-01')) f
  ON f.idPedido = v.idPedido AND rn = 1
JOIN part ON p_partkey = v.idProducto WHERE Litros > 0 AND Precio = 0 GROUP BY v.idProducto, p_retailprice"""
    ),
)
def k30_promo_cost_day(t: Tables) -> DataFrame:
    """Promotions of customers registered since a day, as of another."""
    new = t["Clientes"].filter(F.col("FecAlt") >= F.lit("1995-03-01").cast("timestamp_ntz"))
    return ka.promo_cost(t, t["PreciosLista"], D(1995, 3, 1), D(1995, 12, 31), new)
