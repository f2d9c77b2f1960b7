"""Business rules B01-B09 and dashboard measures K01-K32."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog.registry import query
from catalog.reports import HOLIDAY, NEW_CUSTOMERS, pairs, R01_CTES, R04_CTES, R05_CTES, R07_CTES, RECEIPTS
from catalog.star_sql import day, num, star_query
from rivulet.functions import exprs, rules
from rivulet.operators import aggregates, joins, rowsets
from rivulet.plans import customers, events, orders
from rivulet.plans.kpi import acquisition as ka
from rivulet.plans.kpi import collections as kc
from rivulet.plans.kpi import mix as km
from rivulet.plans.kpi import operations as ko
from rivulet.plans.kpi import retention as kr
from rivulet.plans.kpi import trend as kt
from rivulet.plans.ledgers import cash_balance, credit_balance
from rivulet.plans.reports import acquisition, collections, operations, retention, risk, segmentation
from rivulet.sources.tables import Tables

D = dt.date

# --- business rules


@query(
    "b01_promo_class",
    star_query(
        """SELECT idPedido, CASE WHEN sum(Monto) = 0 THEN 'SIN CARGO' WHEN min(Precio) = 0 THEN '2x1/BONIF' ELSE 'NORMAL' END AS promo
FROM Ventas GROUP BY 1"""
    ),
)
def b01_promo_class(t: Tables) -> DataFrame:
    totals = orders.order_totals(orders.sales_lines(t))
    return totals.select("idPedido", rules.promo_class(F.col("idPedido"), "Importe", "LineaPrecio0").alias("promo"))


@query(
    "b02_channel",
    star_query("SELECT CASE WHEN Categoria IN ('CAT-A', 'CAT-B') THEN 'RTO' ELSE 'Digital' END AS canal, count(*) AS n FROM cuentas GROUP BY 1"),
)
def b02_channel(t: Tables) -> DataFrame:
    people = t["Clientes"].select("Categoria").unionByName(t["ClientesBaja"].select("Categoria"))
    return people.groupBy(rules.channel("Categoria").alias("canal")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "b03_universe",
    star_query(
        """SELECT NroCta, RUTA, 'Activo' AS Estado FROM Clientes JOIN (SELECT NroCta, arg_min(RUTA, OrdRut) AS RUTA FROM ruteo
WHERE RUTA NOT IN (3, 7) GROUP BY NroCta) USING (NroCta)
UNION ALL SELECT NroCta, Vnddor, 'Baja' FROM ClientesBaja JOIN Rutas ON CdRuta = Codigo WHERE Vnddor NOT IN (3, 7)"""
    ),
)
def b03_universe(t: Tables) -> DataFrame:
    active = customers.active_customers(t, range(25), (3, 7)).select("NroCta", "RUTA")
    closed = customers.closed_customers(t, range(25), (3, 7)).select("NroCta", "RUTA")
    return rowsets.union_states(active, closed)


@query(
    "b04_sales_lines",
    star_query(
        f"""SELECT idPedido, {num("sum(CASE WHEN Precio > 0 THEN Volumen END)", "pagos")}, count(*) AS n FROM Ventas WHERE Litros > 0 GROUP BY 1"""
    ),
)
def b04_sales_lines(t: Tables) -> DataFrame:
    lines = orders.sales_lines(t, liquid="positive")
    paid = F.sum(F.when(F.col("Precio") > 0, orders.volume()))
    return lines.groupBy("idPedido").agg(paid.alias("pagos"), F.count(F.lit(1)).alias("n"))


@query(
    "b05_retention_state",
    star_query(
        f"""SELECT NroCta, tipo AS TipoEvento, {day("f", "FechaEvento")}, reparto AS IdReparto, tipos AS CantEventosDistintos, todo AS AccionesMes
FROM gana JOIN acciones USING (NroCta)""",
        R05_CTES,
    ),
)
def b05_retention_state(t: Tables) -> DataFrame:
    everyone = t["Clientes"].select("NroCta").union(t["ClientesBaja"].select("NroCta"))
    return events.event_summary(events.month_events(t, everyone, D(2001, 5, 1), D(2001, 6, 1)))


@query(
    "b06_exclusive_debt",
    star_query(
        f"""SELECT NroCta, {num("CASE WHEN CndPag = 1 THEN coalesce(contado, 0) ELSE 0 END", "contado")},
{num("CASE WHEN CndPag IN (2, 3, 4) THEN coalesce(credito, 0) ELSE 0 END", "credito")} FROM Clientes
LEFT JOIN (SELECT IdCliente, sum(Importe) AS contado FROM Caja GROUP BY 1) a ON a.IdCliente = NroCta
LEFT JOIN (SELECT IdCliente, greatest(sum(Import), 0) AS credito FROM CtaCte GROUP BY 1) b ON b.IdCliente = NroCta"""
    ),
)
def b06_exclusive_debt(t: Tables) -> DataFrame:
    people = t["Clientes"].select("NroCta", "CndPag")
    cash = cash_balance(t).withColumnRenamed("IdCliente", "NroCta")
    credit = credit_balance(t).withColumnRenamed("IdCliente", "NroCta")
    own_cash, own_credit = rules.exclusive_debt("CndPag", F.col("DeudaContado"), F.col("DeudaCtaCte"))
    joined = people.join(cash, "NroCta", "left").join(credit, "NroCta", "left")
    return joined.select("NroCta", own_cash.alias("contado"), own_credit.alias("credito"))


def receipts(t: Tables) -> DataFrame:
    return collections.receipts_by_route(t, D(2001, 7, 20), routes=range(25))


@query("b07_attribute_route", star_query(f"SELECT RUTA, {day('Mes', 'Mes')}, CodCpt, {num('Total', 'Total')} FROM recibos", RECEIPTS))
def b07_attribute_route(t: Tables) -> DataFrame:
    return receipts(t)


@query(
    "b08_weekday_baseline",
    star_query(
        f"""SELECT b.Ruta, dias AS DiasBaseProm, {num("pc", "PromConsumo")}, {num("pl", "PromLitros")},
{num("coalesce(f.Consumo, 0)", "VtaFeriadoConsumo")}, {num("coalesce(f.Litros, 0)", "VtaFeriadoLitros")} FROM base b LEFT JOIN feriado f USING (Ruta)""",
        HOLIDAY,
    ),
)
def b08_weekday_baseline(t: Tables) -> DataFrame:
    holiday = D(2001, 5, 1)
    return operations.weekday_baseline(operations.daily_route_sales(t, holiday, 24), holiday, 4)


@query(
    "b09_active_keys",
    star_query("SELECT NroCta, Nombre FROM Clientes WHERE NroCta IN (SELECT o_custkey FROM orders)"),
)
def b09_active_keys(t: Tables) -> DataFrame:
    keys = joins.active_keys(t["Pedidos"], "idCliente")
    return joins.semi(t["Clientes"], keys, "NroCta", "idCliente").select("NroCta", "Nombre")


# --- collections


@query(
    "k01_total_collected",
    star_query(
        f"""SELECT RUTA, {num("sum(CASE WHEN CodCpt NOT IN ('RET') THEN Total ELSE 0 END)", "TotalCobrado")} FROM recibos GROUP BY RUTA""", RECEIPTS
    ),
)
def k01_total_collected(t: Tables) -> DataFrame:
    return kc.total_collected(receipts(t), ["RUTA"], kc.WITHHOLDINGS)


REGIONAL = (
    RECEIPTS
    + """,
regional AS (SELECT r.*, CodSup FROM recibos r JOIN repartos ON Codigo = RUTA)"""
)


CASH = "'EFE'"
BANKS = "'DIG', 'TRF'"


def _part(codes: str) -> str:
    return f"CAST(sum(CASE WHEN CodCpt IN ({codes}) THEN Total ELSE 0 END) AS DOUBLE) / sum(Total)"


def regional_receipts(t: Tables) -> DataFrame:
    heads = t["repartos"].select(F.col("Codigo").alias("RUTA"), "CodSup")
    return receipts(t).join(heads, "RUTA")


@query(
    "k02_cash_share",
    star_query(
        f"""SELECT CodSup, {day("Mes", "Mes")}, {num("sum(Total)", "TotalCobrado")}, {num(_part("'EFE'"), "PctEfectivo")}, {num(_part("'DIG'"), "PctDigital")},
{num(_part("'CHQ'"), "PctCheques")}, {num(_part("'TRF'"), "PctTransferencia")}, {num(_part("'RET'"), "PctRetenciones")},
{num("CAST(sum(CASE WHEN CodCpt <> 'EFE' THEN Total ELSE 0 END) AS DOUBLE) / sum(Total)", "PctResto")} FROM regional GROUP BY CodSup, Mes""",
        REGIONAL,
    ),
)
def k02_cash_share(t: Tables) -> DataFrame:
    return kc.collection_mix(regional_receipts(t), ["CodSup", "Mes"])


@query("k03_rest_share", star_query(f"SELECT RUTA, {num('1 - ' + _part(CASH), 'PctResto')} FROM recibos GROUP BY RUTA", RECEIPTS))
def k03_rest_share(t: Tables) -> DataFrame:
    return kc.rest_share(receipts(t), ["EFE"], ["RUTA"])


@query("k04_digital_share", star_query(f"SELECT RUTA, {num(_part(BANKS), 'Pct')} FROM recibos GROUP BY RUTA", RECEIPTS))
def k04_digital_share(t: Tables) -> DataFrame:
    return kc.share(receipts(t), ["DIG", "TRF"], ["RUTA"])


DSO_MONTHS = [D(2001, m, 1) for m in range(3, 8)]
DSO_CTES = """
region_de AS (SELECT r.NroCta, CodSup FROM ruta_de r JOIN repartos ON Codigo = RUTA),
meses AS (SELECT CAST(unnest(generate_series(DATE '2001-03-01', DATE '2001-07-01', INTERVAL 1 MONTH)) AS DATE) AS Mes),
venta_mes AS (
  SELECT idCliente, CAST(date_trunc('month', Fecha) AS DATE) AS Mes, sum(Monto) AS v FROM Ventas
  WHERE Fecha >= DATE '2001-03-01' AND Fecha < DATE '2001-08-01' GROUP BY 1, 2),
grandes AS (SELECT idCliente, CASE WHEN sum(v) >= 5000000 THEN 'Si' ELSE 'No' END AS CuentaGrande FROM venta_mes GROUP BY 1),
cuenta AS (SELECT NroCta, CodSup, coalesce(CuentaGrande, 'No') AS CuentaGrande FROM region_de LEFT JOIN grandes ON idCliente = NroCta),
movs AS (SELECT IdCliente, Fecha, Importe FROM Caja UNION ALL SELECT IdCliente, FchMov, Import FROM CtaCte),
deuda AS (
  SELECT CodSup, CuentaGrande, Mes, coalesce(sum(Importe) FILTER (WHERE Fecha < Mes + INTERVAL 1 MONTH), 0) AS Deuda
  FROM movs JOIN cuenta ON NroCta = IdCliente CROSS JOIN meses WHERE Fecha < DATE '2001-08-01' GROUP BY 1, 2, 3),
venta AS (SELECT CodSup, CuentaGrande, Mes, sum(v) AS Ventas FROM venta_mes JOIN cuenta ON NroCta = idCliente GROUP BY 1, 2, 3),
dias AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS Mes, count(DISTINCT o_orderdate) AS Dias FROM orders
  WHERE o_orderdate >= DATE '2001-03-01' AND o_orderdate < DATE '2001-08-01' GROUP BY 1)
"""


@query(
    "k08_dso",
    star_query(
        f"""SELECT CodSup, CuentaGrande, {day("Mes", "Mes")}, {num("Deuda", "Deuda")}, {num("Ventas", "Ventas")}, Dias,
{num("CAST(Deuda AS DOUBLE) / nullif(CAST(Ventas AS DOUBLE) / nullif(Dias, 0), 0)", "DiasCalle")}
FROM deuda LEFT JOIN venta USING (CodSup, CuentaGrande, Mes) LEFT JOIN dias USING (Mes)""",
        DSO_CTES,
    ),
)
def k08_dso(t: Tables) -> DataFrame:
    return kc.dso_by_region(t, DSO_MONTHS, 5_000_000)


@query(
    "k08_dso_grid",
    star_query(
        "SELECT CodSup, "
        + ", ".join(num(f"max(dias_calle) FILTER (WHERE Mes = DATE '{m}')", f"{m:%Y-%m}") for m in DSO_MONTHS)
        + """ FROM (SELECT CodSup, Mes, CAST(sum(Deuda) AS DOUBLE) / nullif(CAST(sum(Ventas) AS DOUBLE) / nullif(max(Dias), 0), 0) AS dias_calle
FROM deuda LEFT JOIN venta USING (CodSup, CuentaGrande, Mes) LEFT JOIN dias USING (Mes) GROUP BY 1, 2) GROUP BY CodSup""",
        DSO_CTES,
    ),
)
def k08_dso_grid(t: Tables) -> DataFrame:
    rows = kc.dso_by_region(t, DSO_MONTHS, 5_000_000, ["CodSup", "Mes"])
    return kc.dso_grid(rows, ["CodSup"], DSO_MONTHS)


RATES = [("CHQ", 0.012), ("TRF", 0.004), ("DIG", 0.035), ("EFE", 0.02)]
COST_CTES = (
    RECEIPTS
    + """,
tasas AS (SELECT * FROM (VALUES ('CHQ', 0.012), ('TRF', 0.004), ('DIG', 0.035), ('EFE', 0.02)) v(cod, tasa)),
costos AS (
  SELECT RUTA, sum(Total * coalesce(tasa, 0)) AS costo, sum(CASE WHEN CodCpt <> 'RET' THEN Total ELSE 0 END) AS cobrado
  FROM recibos LEFT JOIN tasas ON cod = CodCpt GROUP BY RUTA)"""
)


def rates(t: Tables) -> DataFrame:
    return rowsets.values(t.spark, RATES, ["CodCpt", "Tasa"])


@query("k09_cost", star_query(f"SELECT RUTA, {num('costo', 'Costo')}, {num('cobrado', 'CobradoReal')} FROM costos", COST_CTES))
def k09_cost(t: Tables) -> DataFrame:
    return kc.collection_cost(receipts(t), rates(t), ["RUTA"])


@query(
    "k10_cost_ratio",
    star_query(
        f"SELECT RUTA, {num('costo', 'Costo')}, {num('cobrado', 'CobradoReal')}, {num('CAST(costo AS DOUBLE) / nullif(cobrado, 0)', 'PctCosto')} FROM costos ORDER BY PctCosto DESC",
        COST_CTES,
    ),
)
def k10_cost_ratio(t: Tables) -> DataFrame:
    return aggregates.rank_desc(kc.cost_ratio(receipts(t), rates(t), ["RUTA"]), "PctCosto")


@query("k11_vendor_count", star_query("SELECT count(DISTINCT RUTA) AS Vendedores FROM recibos", RECEIPTS))
def k11_vendor_count(t: Tables) -> DataFrame:
    return kc.vendor_count(receipts(t))


@query(
    "k12_over_threshold",
    star_query("SELECT RUTA, CASE WHEN CAST(costo AS DOUBLE) / nullif(cobrado, 0) > 0.02 THEN 1 ELSE 0 END AS SobreUmbral FROM costos", COST_CTES),
)
def k12_over_threshold(t: Tables) -> DataFrame:
    return kc.over_threshold(kc.cost_ratio(receipts(t), rates(t), ["RUTA"])).select("RUTA", "SobreUmbral")


@query(
    "k13_dominant",
    star_query(
        f"""SELECT RUTA, CodCpt AS MedioDominante, {num("total", "Total")} FROM (SELECT *, row_number() OVER (PARTITION BY RUTA ORDER BY total DESC, CodCpt) AS rn
FROM (SELECT RUTA, CodCpt, sum(Total) AS total FROM recibos GROUP BY 1, 2)) WHERE rn = 1""",
        RECEIPTS,
    ),
)
def k13_dominant(t: Tables) -> DataFrame:
    return kc.dominant_method(receipts(t), ["RUTA"])


@query(
    "k14_share_of_total",
    star_query(
        f"""SELECT RUTA, {num("sum(Total)", "TotalCobrado")}, {num("CAST(sum(Total) AS DOUBLE) / (SELECT sum(Total) FROM recibos)", "PctDelTotal")}
FROM recibos WHERE RUTA < 10 GROUP BY RUTA""",
        RECEIPTS,
    ),
)
def k14_share_of_total(t: Tables) -> DataFrame:
    everything = kc.total_collected(receipts(t), ["RUTA"]).withColumn("TotalCobrado", F.col("TotalCobrado").cast("double"))
    return aggregates.share_of_total(everything, "TotalCobrado", "PctDelTotal").filter(F.col("RUTA") < 10)


@query(
    "k15_divide",
    star_query(
        f"""SELECT RUTA, {num("coalesce(CAST(sum(CASE WHEN CodCpt = 'RET' THEN Total ELSE 0 END) AS DOUBLE) / nullif(sum(CASE WHEN CodCpt = 'XXX' THEN Total ELSE 0 END), 0), -1)", "nada")},
{num("coalesce(CAST(sum(CASE WHEN CodCpt = 'RET' THEN Total ELSE 0 END) AS DOUBLE) / nullif(sum(Total), 0), -1)", "algo")} FROM recibos GROUP BY RUTA""",
        RECEIPTS,
    ),
)
def k15_divide(t: Tables) -> DataFrame:
    code = F.col("CodCpt")
    totals = receipts(t).groupBy("RUTA").agg(
        exprs.sum_if(code == "RET", "Total").cast("double").alias("r"),
        exprs.sum_if(code == "XXX", "Total").cast("double").alias("x"),
        F.sum("Total").cast("double").alias("s"),
    )
    return totals.select("RUTA", exprs.divide("r", "x", -1).alias("nada"), exprs.divide("r", "s", -1).alias("algo"))


# --- retention


@query(
    "k16_event_mix",
    star_query(
        f"""SELECT TipoEvento, EstadoFinal, count(*) AS Clientes, {num("count(*) / CAST((SELECT count(*) FROM r05) AS DOUBLE)", "Pct")} FROM r05 GROUP BY 1, 2""",
        R05_CTES,
    ),
)
def k16_event_mix(t: Tables) -> DataFrame:
    return kr.event_mix(retention.equipment_retention(t, D(2001, 5, 1)))


SILENCE = """
ociosos AS (
  SELECT IdCliente AS NroCta, RUTA, Equipos, ultimo, date_diff('day', ultimo, DATE '2001-05-01') AS dias
  FROM (SELECT IdCliente, count(DISTINCT Nro_Serie) AS Equipos FROM maquinas WHERE Fecha_Baja IS NULL GROUP BY 1)
  LEFT JOIN (SELECT o_custkey, max(CAST(o_orderdate AS DATE)) AS ultimo FROM orders WHERE o_orderdate < DATE '2001-05-02' GROUP BY 1) ON o_custkey = IdCliente
  LEFT JOIN ruta_de ON NroCta = IdCliente)
"""


@query(
    "k17_silence",
    star_query(f"SELECT NroCta, RUTA, Equipos, {day('ultimo', 'UltimoPedido')}, dias AS DiasSinConsumo FROM ociosos WHERE dias IS NULL OR dias > 120", SILENCE),
)
def k17_silence(t: Tables) -> DataFrame:
    return kr.silence(t, D(2001, 5, 1))


@query(
    "k17_retrieval_queue",
    star_query("SELECT RUTA, count(*) AS Clientes, CAST(sum(Equipos) AS BIGINT) AS Equipos FROM ociosos WHERE dias IS NULL OR dias > 60 GROUP BY RUTA", SILENCE),
)
def k17_retrieval_queue(t: Tables) -> DataFrame:
    return kr.retrieval_queue(kr.silence(t, D(2001, 5, 1), days=60))


@query(
    "k17_call_list",
    star_query(
        f"""SELECT NroCta, Nombre, Direcc, Telefn, o.RUTA, {day("ultimo", "UltimoPedido")}, dias AS DiasSinConsumo
FROM r05 JOIN ociosos o USING (NroCta) WHERE TipoEvento = 'E5' AND (dias IS NULL OR dias > 120)""",
        R05_CTES + "," + SILENCE,
    ),
)
def k17_call_list(t: Tables) -> DataFrame:
    return kr.call_list(retention.equipment_retention(t, D(2001, 5, 1)), kr.silence(t, D(2001, 5, 1)))


# --- product mix and equipment

FAMILIES = {"Premium": ["LARGE", "PROMO"], "Soda": ["STANDARD"]}
MIX_CTES = """
meses AS (SELECT CAST(unnest(generate_series(DATE '2000-06-01', DATE '2001-07-01', INTERVAL 1 MONTH)) AS DATE) AS Mes),
cm AS (
  SELECT idCliente, CAST(date_trunc('month', Fecha) AS DATE) AS Mes, sum(Volumen) AS litros,
    max(CASE WHEN Unidad IN ('LARGE', 'PROMO') THEN 1 ELSE 0 END) AS p, max(CASE WHEN Unidad = 'STANDARD' THEN 1 ELSE 0 END) AS s,
    sum(CASE WHEN Unidad IN ('LARGE', 'PROMO') THEN Volumen ELSE 0 END) AS lp, sum(CASE WHEN Unidad = 'STANDARD' THEN Volumen ELSE 0 END) AS ls
  FROM Ventas WHERE Fecha >= DATE '2000-06-01' AND Fecha < DATE '2001-08-01' AND Litros > 0 GROUP BY 1, 2),
fc AS (
  SELECT IdCliente, Mes, count(DISTINCT Nro_Serie) AS q FROM maquinas JOIN meses
    ON Fecha_Desde < Mes + INTERVAL 1 MONTH AND (Fecha_Baja IS NULL OR Fecha_Baja > Mes + INTERVAL 1 MONTH) GROUP BY 1, 2)
"""


@query(
    "k18_mix",
    star_query(
        f"""SELECT {day("Mes", "Mes")}, count(*) AS Clientes, {num("sum(litros)", "Litros")}, {num("sum(p) / CAST(count(*) AS DOUBLE)", "PctClientesPremium")},
{num("sum(lp)", "LitrosPremium")}, {num("CAST(sum(lp) AS DOUBLE) / sum(litros)", "PctLitrosPremium")}, {num("sum(s) / CAST(count(*) AS DOUBLE)", "PctClientesSoda")},
{num("sum(ls)", "LitrosSoda")}, {num("CAST(sum(ls) AS DOUBLE) / sum(litros)", "PctLitrosSoda")}, {num("count(q) / CAST(count(*) AS DOUBLE)", "PctClientesFC")}
FROM cm LEFT JOIN fc USING (IdCliente, Mes) GROUP BY Mes""",
        MIX_CTES,
    ),
)
def k18_mix(t: Tables) -> DataFrame:
    return km.product_mix(t, FAMILIES, D(2001, 8, 15), months=14)


@query(
    "k18_mix_region",
    star_query(
        f"""SELECT CodSup, {day("Mes", "Mes")}, count(*) AS Clientes, {num("sum(litros)", "Litros")}, {num("sum(p) / CAST(count(*) AS DOUBLE)", "PctClientesPremium")},
{num("sum(lp)", "LitrosPremium")}, {num("CAST(sum(lp) AS DOUBLE) / sum(litros)", "PctLitrosPremium")}, {num("sum(s) / CAST(count(*) AS DOUBLE)", "PctClientesSoda")},
{num("sum(ls)", "LitrosSoda")}, {num("CAST(sum(ls) AS DOUBLE) / sum(litros)", "PctLitrosSoda")}, {num("count(q) / CAST(count(*) AS DOUBLE)", "PctClientesFC")}
FROM cm LEFT JOIN fc USING (IdCliente, Mes)
JOIN (SELECT NroCta, CodSup FROM ruta_de JOIN repartos ON Codigo = RUTA) ON NroCta = IdCliente GROUP BY CodSup, Mes""",
        MIX_CTES,
    ),
)
def k18_mix_region(t: Tables) -> DataFrame:
    regions = customers.customer_region(t)
    return km.product_mix(t, FAMILIES, D(2001, 8, 15), months=14, accounts=regions, by=["CodSup"])


@query(
    "k18_mix_trend",
    star_query(
        f"""SELECT {day("DATE '2001-07-01'", "Mes")}, {num("v", "PctClientesSoda")}, {num("p", "MesAnterior")}, {num("y", "AnioAnterior")},
{num("(v - p) / nullif(p, 0)", "VarMes")}, {num("(v - y) / nullif(y, 0)", "VarAnio")} FROM (
  SELECT max(pct) FILTER (WHERE Mes = DATE '2001-07-01') AS v, max(pct) FILTER (WHERE Mes = DATE '2001-06-01') AS p,
    max(pct) FILTER (WHERE Mes = DATE '2000-07-01') AS y FROM (SELECT Mes, sum(s) / CAST(count(*) AS DOUBLE) AS pct FROM cm GROUP BY Mes))""",
        MIX_CTES,
    ),
)
def k18_mix_trend(t: Tables) -> DataFrame:
    mix = km.product_mix(t, FAMILIES, D(2001, 8, 15), months=14)
    return kt.trend(mix, "PctClientesSoda", [], D(2001, 7, 31), months=1)


@query(
    "k31_underused",
    star_query(
        f"""SELECT fc.IdCliente AS NroCta, {day("Mes", "Mes")}, q AS Q_FC, {num("coalesce(litros, 0)", "Litros")}, {num("coalesce(CAST(litros AS DOUBLE), 0) / q", "LitrosPorEquipo")}
FROM fc LEFT JOIN cm USING (IdCliente, Mes) WHERE Mes >= DATE '2001-02-01' AND coalesce(CAST(litros AS DOUBLE), 0) / q < 500""",
        MIX_CTES,
    ),
)
def k31_underused(t: Tables) -> DataFrame:
    return km.underused(km.machine_productivity(t, D(2001, 8, 15), months=6), 500)


@query(
    "k26_promo",
    star_query(
        f"""SELECT {day("c.Mes", "Mes")}, count(*) AS TotalClientes, {num("count(*) FILTER (WHERE p = 1 AND s = 0) / CAST(count(*) AS DOUBLE)", "PctBotellon")},
{num("count(*) FILTER (WHERE s = 1) / CAST(count(*) AS DOUBLE)", "PctSoda")}, {num("count(*) FILTER (WHERE p = 1 AND s = 1) / CAST(count(*) AS DOUBLE)", "PctSodaYBotellon")},
{num("count(*) FILTER (WHERE litros IS NULL) / CAST(count(*) AS DOUBLE)", "PctSinCompras")}
FROM (SELECT NroCta, Mes FROM Clientes JOIN ruta_de USING (NroCta) CROSS JOIN meses WHERE Direcc ILIKE '%machinery%' AND Mes >= DATE '2001-02-01') c
LEFT JOIN cm ON cm.idCliente = c.NroCta AND cm.Mes = c.Mes GROUP BY c.Mes""",
        MIX_CTES,
    ),
)
def k26_promo(t: Tables) -> DataFrame:
    segment = segmentation.community_customers(t, [("%machinery%", "MACHINERY")])
    return km.promo_panel(t, segment, D(2001, 8, 15), 6, FAMILIES["Premium"], FAMILIES["Soda"])


# --- trends

TREND = """
rv AS (
  SELECT idVendedor AS Ruta, Unidad, CAST(date_trunc('month', Fecha) AS DATE) AS Mes, sum(Volumen) AS litros, sum(Monto) AS pesos,
    sum(CASE WHEN Precio > 0 THEN Volumen ELSE 0 END) AS cargo
  FROM Ventas WHERE Fecha >= DATE '1999-01-01' AND Fecha < DATE '2001-08-01' AND Litros <> 0 GROUP BY 1, 2, 3),
rm AS (SELECT Ruta, Mes, sum(litros) AS litros FROM rv GROUP BY 1, 2),
grilla AS (SELECT DISTINCT Ruta, m AS Mes FROM (SELECT DISTINCT Ruta FROM rm WHERE Mes >= DATE '1999-06-01') CROSS JOIN
  (SELECT CAST(unnest(generate_series(DATE '2000-06-01', DATE '2001-07-01', INTERVAL 1 MONTH)) AS DATE) AS m)),
tendencia AS (
  SELECT g.Ruta, g.Mes, coalesce(a.litros, 0) AS v, coalesce(b.litros, 0) AS p, coalesce(c.litros, 0) AS y FROM grilla g
  LEFT JOIN rm a ON a.Ruta = g.Ruta AND a.Mes = g.Mes LEFT JOIN rm b ON b.Ruta = g.Ruta AND b.Mes = g.Mes - INTERVAL 1 MONTH
  LEFT JOIN rm c ON c.Ruta = g.Ruta AND c.Mes = g.Mes - INTERVAL 1 YEAR)
"""


def route_sales(t: Tables) -> DataFrame:
    return kt.route_sales(t, D(1999, 1, 1), D(2001, 8, 1))


@query(
    "k19_trend",
    star_query(
        f"""SELECT Ruta, {day("Mes", "Mes")}, {num("v", "Litros")}, {num("p", "MesAnterior")}, {num("y", "AnioAnterior")},
{num("CAST(v - p AS DOUBLE) / nullif(p, 0)", "VarMes")}, {num("CAST(v - y AS DOUBLE) / nullif(y, 0)", "VarAnio")} FROM tendencia""",
        TREND,
    ),
)
def k19_trend(t: Tables) -> DataFrame:
    return kt.trend(route_sales(t), "Litros", ["Ruta"], D(2001, 7, 31), months=14)


def _band(change: str, name: str) -> str:
    return f"CASE WHEN {change} < -0.05 THEN 'BAJA' WHEN {change} > 0.05 THEN 'SUBE' WHEN {change} IS NOT NULL THEN 'EN BANDA' END AS {name}"


@query(
    "k23_route_var",
    star_query(
        f"""SELECT Ruta, {num("v", "Litros")}, {num("p", "MesAnterior")}, {num("y", "AnioAnterior")}, {num("CAST(v - p AS DOUBLE) / nullif(p, 0)", "VarMes")},
{num("CAST(v - y AS DOUBLE) / nullif(y, 0)", "VarAnio")}, {num("ref", "Benchmark")}, {num("CAST(v - ref AS DOUBLE) / nullif(ref, 0)", "VarBenchmark")},
{_band("CAST(v - p AS DOUBLE) / nullif(p, 0)", "BandaMes")}, {_band("CAST(v - y AS DOUBLE) / nullif(y, 0)", "BandaAnio")},
{_band("CAST(v - ref AS DOUBLE) / nullif(ref, 0)", "BandaBenchmark")}
FROM tendencia LEFT JOIN (SELECT Ruta, CAST(sum(litros) AS DOUBLE) / 12 AS ref FROM rm WHERE Mes >= DATE '2000-08-01' GROUP BY 1) USING (Ruta)
WHERE Mes = DATE '2001-07-01'""",
        TREND,
    ),
)
def k23_route_var(t: Tables) -> DataFrame:
    litres = route_sales(t)
    year = litres.filter(F.col("Mes") >= F.lit(D(2000, 8, 1)))
    benchmark = year.groupBy("Ruta").agg((F.sum("Litros").cast("double") / 12).alias("Benchmark"))
    return kt.route_variance(litres, benchmark, D(2001, 7, 31))


@query("k24_paid_litres", star_query(f"SELECT Ruta, {num('sum(cargo)', 'LitrosConCargo')}, {num('sum(litros)', 'Litros')} FROM rv GROUP BY Ruta", TREND))
def k24_paid_litres(t: Tables) -> DataFrame:
    return kt.paid_litres(route_sales(t), ["Ruta"])


@query(
    "k24_region",
    star_query(
        f"""SELECT CodSup, {num("sum(cargo)", "LitrosConCargo")}, {num("sum(litros)", "Litros")}
FROM rv JOIN repartos ON Codigo = Ruta GROUP BY CodSup""",
        TREND,
    ),
)
def k24_region(t: Tables) -> DataFrame:
    return kt.paid_litres_by_region(t, route_sales(t))


@query(
    "k25_family",
    star_query(
        f"""SELECT Familia, {day("DATE '2001-07-01'", "Mes")}, {num("v", "Facturacion")}, {num("p", "MesAnterior")}, {num("y", "AnioAnterior")},
{num("CAST(v - p AS DOUBLE) / nullif(p, 0)", "VarMes")}, {num("CAST(v - y AS DOUBLE) / nullif(y, 0)", "VarAnio")}
FROM (SELECT CASE WHEN Unidad IN ('LARGE', 'PROMO') THEN 'Premium' WHEN Unidad = 'STANDARD' THEN 'Soda' ELSE 'Resto' END AS Familia,
  sum(CASE WHEN Mes = DATE '2001-07-01' THEN pesos ELSE 0 END) AS v, sum(CASE WHEN Mes = DATE '2001-06-01' THEN pesos ELSE 0 END) AS p,
  sum(CASE WHEN Mes = DATE '2000-07-01' THEN pesos ELSE 0 END) AS y FROM rv GROUP BY 1)""",
        TREND,
    ),
)
def k25_family(t: Tables) -> DataFrame:
    return kt.family_revenue(route_sales(t), FAMILIES, D(2001, 7, 31))


# --- holidays, debt

HOLIDAYS = [D(2001, 5, 1), D(2000, 12, 25), D(2001, 7, 9)]


@query(
    "k20_holiday_table",
    star_query(
        f"""SELECT {day("Feriado", "Feriado")}, dayofweek(Feriado) + 1 AS DiaSemana, s.Descrp AS Supervisor, Ruta, dias AS DiasBaseProm,
{num("CAST(prom + 1e-9 AS DECIMAL(18,2))", "PromSem")}, {num("vta", "VtaFeriado")}, {num("CAST(prom - vta + 1e-9 AS DECIMAL(18,2))", "ARecuperar")},
{num("TRY_CAST(100 * (prom - vta) / nullif(prom, 0) + 1e-9 AS DECIMAL(5,1))", "Pct")}
FROM (SELECT Feriado, Ruta, count(*) FILTER (WHERE Fecha <> Feriado) AS dias,
    CAST(sum(c) FILTER (WHERE Fecha <> Feriado) AS DOUBLE) / count(*) FILTER (WHERE Fecha <> Feriado) AS prom,
    coalesce(sum(c) FILTER (WHERE Fecha = Feriado), 0) AS vta
  FROM (SELECT idVendedor AS Ruta, Fecha, sum(CASE WHEN Precio > 0 THEN Monto ELSE 0 END) AS c FROM Ventas WHERE Litros <> 0 AND idCliente <> 0 GROUP BY 1, 2)
  JOIN (VALUES (DATE '2001-05-01'), (DATE '2000-12-25'), (DATE '2001-07-09')) h(Feriado)
    ON dayofweek(Fecha) = dayofweek(Feriado) AND Fecha <= Feriado AND Fecha >= Feriado - INTERVAL 24 MONTH
  GROUP BY 1, 2)
LEFT JOIN repartos v ON v.Codigo = Ruta LEFT JOIN repartos s ON s.Codigo = v.CodSup WHERE dias >= 4"""
    ),
)
def k20_holiday_table(t: Tables) -> DataFrame:
    return ko.holiday_table(t, HOLIDAYS, months=24)


@query(
    "k32_exposure_rank",
    star_query(
        f"""SELECT RUTA, {num("DeudaContado", "DeudaContado")}, {num("DeudaCtaCte", "DeudaCtaCte")}, {num("DeudaTotal", "DeudaTotal")},
{num("CAST(DeudaTotal AS DOUBLE) / (SELECT sum(DeudaTotal) FROM r07)", "PctExposicion")} FROM r07 ORDER BY DeudaTotal DESC""",
        R07_CTES,
    ),
)
def k32_exposure_rank(t: Tables) -> DataFrame:
    return ko.exposure_rank(risk.debt_by_route(t, D(2000, 8, 15), routes=range(25), exclude=()))


# --- acquisitions


def acquired(t: Tables) -> DataFrame:
    return acquisition.acquisitions_by_channel(t, D(1995, 7, 15), exclude=(3, 7))


def registered(t: Tables) -> DataFrame:
    return acquisition.registrations(t, D(1995, 7, 15), exclude=(3, 7))


K21_DAYS = ", ".join(f"count(*) FILTER (WHERE day(alta) = {d}) AS d{d:02d}" for d in range(1, 32))


@query(
    "k21_daily_grid",
    star_query(
        f"""SELECT RUTA, {K21_DAYS}, count(*) AS Total FROM r01
WHERE alta >= DATE '1995-05-01' AND alta < DATE '1995-06-01' GROUP BY ROLLUP (RUTA)""",
        R01_CTES,
    ),
)
def k21_daily_grid(t: Tables) -> DataFrame:
    return ka.acquisition_grid(registered(t), D(1995, 5, 20))


def _cohort_sql(period: str) -> str:
    return f"""SELECT RUTA, Clientes, Periodo, {num("litros", "Litros")}
FROM (SELECT RUTA, count(DISTINCT NroCta) AS Clientes FROM r01 GROUP BY RUTA) LEFT JOIN (
  SELECT RUTA, {period} AS Periodo, sum(Volumen) AS litros
  FROM r01 JOIN (SELECT * FROM Ventas WHERE Litros > 0 AND Fecha <= DATE '2001-07-31') v ON v.idCliente = NroCta GROUP BY 1, 2) USING (RUTA)"""


@query("k22_cohort", star_query(_cohort_sql("CAST(floor(date_diff('day', CAST(alta AS DATE), Fecha) / 7.0) AS INTEGER)"), R01_CTES))
def k22_cohort(t: Tables) -> DataFrame:
    return ka.cohort_litres(t, registered(t), D(2001, 7, 31))


@query(
    "k22_cohort_month",
    star_query(_cohort_sql("CAST((year(Fecha) - year(alta)) * 12 + month(Fecha) - month(alta) AS INTEGER)"), R01_CTES),
)
def k22_cohort_month(t: Tables) -> DataFrame:
    return ka.cohort_litres(t, registered(t), D(2001, 7, 31), by="month")


@query(
    "k22_alta_week",
    star_query(
        f"""SELECT RUTA, {day("date_trunc('week', alta)", "SemanaAlta")}, count(DISTINCT NroCta) AS Clientes, {num("coalesce(sum(Volumen), 0)", "Litros")}
FROM r01 LEFT JOIN (SELECT * FROM Ventas WHERE Litros > 0 AND Fecha <= DATE '2001-07-31') v ON v.idCliente = NroCta GROUP BY 1, 2""",
        R01_CTES,
    ),
)
def k22_alta_week(t: Tables) -> DataFrame:
    return ka.cohort_litres_by_registration(t, registered(t), D(2001, 7, 31))


@query(
    "k27_second_order",
    star_query(
        f"""SELECT strftime(FecAlt, '%Y-%m') AS MesAlta, count(*) AS Clientes, count(FechaPrimeraCompra) AS ConPrimera, count(FechaSegundaCompra) AS ConSegunda,
{num("avg(DiasEntreCompras)", "DiasPromedio")} FROM r04 GROUP BY 1""",
        R04_CTES,
    ),
)
def k27_second_order(t: Tables) -> DataFrame:
    return ka.second_order_cohort(acquisition.repurchase(t, D(1995, 7, 15)))


@query(
    "k27_pending",
    star_query(
        """SELECT NroCta, date_diff('day', p.Fecha, DATE '2001-07-31') AS DiasEsperando FROM nuevos n
JOIN compras p ON p.idCliente = n.NroCta AND p.rn = 1 LEFT JOIN compras s ON s.idCliente = n.NroCta AND s.rn = 2
WHERE s.idCliente IS NULL AND p.Fecha <= DATE '2001-07-31' AND date_diff('day', p.Fecha, DATE '2001-07-31') < 2000""",
        NEW_CUSTOMERS + "," + pairs("2001-08-01"),
    ),
)
def k27_pending(t: Tables) -> DataFrame:
    rep = acquisition.repurchase(t, D(2001, 7, 31), months=None)
    return ka.pending_second_order(rep, D(2001, 7, 31), days=2000).select("NroCta", "DiasEsperando")


@query(
    "k28_realised_month",
    star_query(
        f"""SELECT strftime(primera, '%Y-%m') AS Mes, TipCli AS Segmento, count(*) AS Concretadas, {num("avg(date_diff('day', CAST(FecAlt AS DATE), primera))", "DiasPromedio")}
FROM Clientes JOIN (SELECT idCliente, min(Fecha) AS primera FROM Ventas WHERE Litros > 0 AND Precio > 0 AND Fecha <= DATE '1996-12-31' GROUP BY 1) ON idCliente = NroCta
WHERE NroCta <> 0 AND date_diff('day', CAST(FecAlt AS DATE), primera) BETWEEN 0 AND 60 GROUP BY 1, 2"""
    ),
)
def k28_realised_month(t: Tables) -> DataFrame:
    return ka.realised_by_month(t, D(1996, 12, 31))


@query("k29_acq_route_month", star_query("SELECT RUTA, strftime(alta, '%Y-%m') AS Mes, count(*) AS Altas FROM r01 GROUP BY 1, 2", R01_CTES))
def k29_acq_route_month(t: Tables) -> DataFrame:
    return ka.acquisitions_by_month(registered(t))


@query(
    "k30_promo_share",
    star_query(f"SELECT TipoPromo, count(*) AS Altas, {num('count(*) / CAST((SELECT count(*) FROM r01) AS DOUBLE)', 'Pct')} FROM r01 GROUP BY 1", R01_CTES),
)
def k30_promo_share(t: Tables) -> DataFrame:
    return ka.promo_share(acquired(t))


@query(
    "k30_promo_cost",
    star_query(
        f"""SELECT v.idProducto, {num("sum(Cantidad)", "Unidades")}, {num("CAST(p_retailprice AS DECIMAL(15,2))", "PrecioLista")},
{num("sum(Cantidad) * CAST(p_retailprice AS DECIMAL(15,2))", "CostoBonificado")}
FROM Ventas v JOIN (SELECT idPedido, row_number() OVER (PARTITION BY idCliente ORDER BY Fecha_Pedido, idPedido) AS rn FROM Pedidos) f ON f.idPedido = v.idPedido AND rn = 1
JOIN part ON p_partkey = v.idProducto WHERE Litros > 0 AND Precio = 0 GROUP BY v.idProducto, p_retailprice"""
    ),
)
def k30_promo_cost(t: Tables) -> DataFrame:
    return ka.promo_cost(t, t["PreciosLista"])
