"""Reports R01-R12."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from catalog.registry import query
from catalog.star_sql import day, num, star_query
from rivulet.plans.reports import (
    acquisition,
    audit,
    collections,
    equipment,
    operations,
    retention,
    risk,
    sales,
    segmentation,
)
from rivulet.sources.tables import Tables

COMMUNITIES = [("%machinery%", "MACHINERY"), ("%0007%", "SIETE"), ("%house%9%", "NUNCA"), ("%9 - house%", "NUEVE")]

R01_CTES = """
altas AS (
  SELECT r.RUTA, FecAlt, CAST(NULL AS TIMESTAMP) AS FecBaj, NroCta, 'Activo' AS Estado, Categoria, Nombre, Direcc, Telefn
  FROM Clientes JOIN (SELECT NroCta, arg_min(RUTA, OrdRut) AS RUTA FROM ruteo WHERE RUTA NOT IN (3, 7) GROUP BY NroCta) r USING (NroCta)
  UNION ALL
  SELECT Vnddor, FecAlt, FecBaj, NroCta, 'Baja', Categoria, Nombre, Direcc, Telefn
  FROM ClientesBaja JOIN Rutas ON CdRuta = Codigo WHERE Vnddor NOT IN (3, 7)),
recientes AS (SELECT * FROM altas WHERE NroCta <> 0 AND FecAlt >= DATE '1995-04-01' AND FecAlt < DATE '1995-07-16'),
por_pedido AS (
  SELECT idCliente, idPedido, Fecha_Pedido, sum(Monto) AS total, max(CASE WHEN Precio = 0 THEN 1 ELSE 0 END) AS cero
  FROM Ventas WHERE Litros > 0 AND Fecha_Pedido < DATE '1995-07-16' GROUP BY ALL),
primeras AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY idCliente ORDER BY Fecha_Pedido, idPedido) AS rn FROM por_pedido)
  WHERE rn = 1),
r01 AS (
  SELECT RUTA, strftime(FecAlt, '%d/%m/%Y') AS FECALT, strftime(FecBaj, '%d/%m/%Y') AS FECBAJ, a.NroCta, Estado,
    CASE WHEN a.Categoria IN ('CAT-C', 'CAT-D') THEN 'Digital' ELSE 'RTO' END AS Categoria, Nombre, Direcc, Telefn, Descripcion,
    idPedido AS PrimerPedido, Fecha_Pedido AS FechaPrimerPedido, total AS TotalImportePedido, cero AS TieneLineaPrecio0,
    CASE WHEN idPedido IS NULL THEN 'SIN COMPRA' WHEN total = 0 THEN 'SIN CARGO' WHEN cero = 1 THEN '2x1/BONIF' ELSE 'NORMAL' END AS TipoPromo,
    FecAlt AS alta
  FROM recientes a JOIN Categorias c ON c.Categoria = a.Categoria LEFT JOIN primeras p ON p.idCliente = a.NroCta)
"""

R01_SELECT = f"""
SELECT RUTA, FECALT, FECBAJ, NroCta, Estado, Categoria, Nombre, Direcc, Telefn, Descripcion, PrimerPedido,
  {day("FechaPrimerPedido", "FechaPrimerPedido")}, {num("TotalImportePedido", "TotalImportePedido")}, TieneLineaPrecio0, TipoPromo
FROM r01
"""


@query("r01_acquisitions", star_query(R01_SELECT, R01_CTES))
def r01_acquisitions(t: Tables) -> DataFrame:
    return acquisition.acquisitions_by_channel(t, dt.date(1995, 7, 15), exclude=(3, 7))


NEW_CUSTOMERS = """
nuevos AS (
  SELECT k.NroCta, Nombre, Direcc AS Direccion, FecAlt, RUTA, tc.Descrp AS TipCli, ca.Descripcion AS Categoria,
         a.AtrDes AS Atributo, cp.Descrp AS CndPag
  FROM Clientes k JOIN ruta_de USING (NroCta) JOIN CondPAGO cp ON cp.Codigo = CndPag JOIN TiposCli tc ON tc.Codigo = TipCli
  LEFT JOIN Categorias ca ON ca.Categoria = k.Categoria LEFT JOIN ClientesAtrLis a ON a.AtrNro = 5 AND a.AtrCod = Atrib5
  WHERE k.NroCta <> 0)
"""


@query(
    "r02_realised",
    star_query(
        f"""
SELECT n.NroCta, Nombre, Direccion, {day("FecAlt", "FecAlt")}, RUTA, TipCli, Categoria, Atributo, CndPag,
  strftime(v.Fecha_Pedido, '%Y-%m') AS Periodo, {day("primera", "FechaPrimeraCompra")},
  {num("sum(Monto)", "Consumo")}, {num("sum(Bultos)", "Bultos")}
FROM nuevos n JOIN Ventas v ON v.idCliente = n.NroCta AND Precio > 0
JOIN (SELECT idCliente, min(Fecha) AS primera FROM Ventas WHERE Precio > 0 GROUP BY idCliente) p ON p.idCliente = n.NroCta
WHERE FecAlt > DATE '1995-04-01' AND Atributo IS NOT NULL AND Fecha BETWEEN DATE '1995-06-01' AND DATE '1995-07-31'
  AND primera BETWEEN DATE '1995-06-01' AND DATE '1995-07-31' AND RUTA BETWEEN 0 AND 24
GROUP BY n.NroCta, Nombre, Direccion, FecAlt, RUTA, TipCli, Categoria, Atributo, CndPag, Periodo, primera
""",
        NEW_CUSTOMERS,
    ),
)
def r02_realised(t: Tables) -> DataFrame:
    return acquisition.realised_acquisitions(t, dt.date(1995, 6, 1), dt.date(1995, 7, 31), routes=range(25))


@query(
    "r03_first_purchase",
    star_query(
        f"""
SELECT idCliente AS NroCta, idProducto, Abreviatura, {num("sum(Monto)", "TotalImporteProducto")},
  max(CASE WHEN Precio = 0 THEN 1 ELSE 0 END) AS TieneLineaPrecio0,
  CASE WHEN sum(Monto) = 0 THEN 'SIN CARGO' WHEN min(Precio) = 0 THEN '2x1/BONIF' ELSE 'NORMAL' END AS TipoPromo
FROM Ventas JOIN (SELECT idPedido, row_number() OVER (PARTITION BY idCliente ORDER BY Fecha_Pedido, idPedido) AS rn FROM Pedidos)
  USING (idPedido)
WHERE rn = 1 AND Litros > 0 GROUP BY idCliente, idProducto, Abreviatura
"""
    ),
)
def r03_first_purchase(t: Tables) -> DataFrame:
    return acquisition.first_purchase_products(t)




def pairs(before: str) -> str:
    """Paid orders before a day, numbered per customer."""
    return f"""
compras AS (
  SELECT *, row_number() OVER (PARTITION BY idCliente ORDER BY Fecha, idPedido) AS rn
  FROM (SELECT idCliente, idPedido, Fecha, sum(Monto) AS importe FROM Ventas
        WHERE Litros > 0 AND Precio > 0 AND Fecha < DATE '{before}' GROUP BY ALL))
"""


R04_CTES = (
    NEW_CUSTOMERS
    + ","
    + pairs("1995-07-16")
    + """,
r04 AS (
  SELECT n.*, p.Fecha AS FechaPrimeraCompra, p.importe AS ImportePrimeraCompra, s.Fecha AS FechaSegundaCompra,
         s.importe AS ImporteSegundaCompra, date_diff('day', p.Fecha, s.Fecha) AS DiasEntreCompras
  FROM nuevos n LEFT JOIN compras p ON p.idCliente = n.NroCta AND p.rn = 1
  LEFT JOIN compras s ON s.idCliente = n.NroCta AND s.rn = 2
  WHERE FecAlt > DATE '1995-04-01' AND FecAlt < DATE '1995-07-16')
"""
)


@query(
    "r04_repurchase",
    star_query(
        f"""
SELECT NroCta, Nombre, Direccion, {day("FecAlt", "FecAlt")}, RUTA, TipCli, Categoria, Atributo, CndPag,
  {day("FechaPrimeraCompra", "FechaPrimeraCompra")}, {num("ImportePrimeraCompra", "ImportePrimeraCompra")},
  {day("FechaSegundaCompra", "FechaSegundaCompra")}, {num("ImporteSegundaCompra", "ImporteSegundaCompra")}, DiasEntreCompras
FROM r04
""",
        R04_CTES,
    ),
)
def r04_repurchase(t: Tables) -> DataFrame:
    return acquisition.repurchase(t, dt.date(1995, 7, 15))


R05_CTES = """
callados AS (
  SELECT DISTINCT IdCliente AS NroCta FROM maquinas m
  WHERE Fecha_Baja IS NULL AND Fecha_Desde <= DATE '2001-05-01' - 90
    AND NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = m.IdCliente AND o_orderdate >= DATE '2001-05-01' - 60 AND o_orderdate < DATE '2001-05-01')),
gente AS (
  SELECT NroCta, Nombre, Direcc, Telefn FROM Clientes JOIN ruta_de USING (NroCta)
  UNION ALL SELECT NroCta, Nombre, Direcc, Telefn FROM ClientesBaja JOIN Rutas ON CdRuta = Codigo),
eventos AS (
  SELECT idCliente AS NroCta, Fecha_Pedido AS f, idVendedor AS reparto, 'E2' AS tipo FROM Pedidos
  WHERE Fecha_Pedido >= DATE '2001-05-01' AND Fecha_Pedido < DATE '2001-06-01'
  UNION ALL
  SELECT IdCliente, Fecha, IdReparto, CASE WHEN IdRecambio IS NOT NULL THEN 'EC' WHEN IdReparto = 146 THEN 'E3' WHEN IdReparto = 147 THEN 'E4' ELSE 'E1' END
  FROM Movimientos_Equipos WHERE Fecha >= DATE '2001-05-01' AND Fecha < DATE '2001-06-01' AND coalesce(Anulado, 0) = 0),
textos AS (SELECT * FROM (VALUES ('E3', 'FUGADO', 1), ('E4', 'CORRECCIÓN INTERNA', 2), ('E1', 'RTO/SUPER/TÉCNICO', 3), ('EC', 'CAMBIO', 4), ('E2', 'VOLVIÓ A COMPRAR', 5)) v(tipo, texto, prioridad)),
eventos_t AS (SELECT * FROM eventos JOIN textos USING (tipo)),
gana AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY NroCta ORDER BY prioridad, f DESC, reparto) AS rn FROM eventos_t) WHERE rn = 1),
acciones AS (
  SELECT NroCta, count(DISTINCT tipo) AS tipos,
    string_agg(tipo || ':' || texto || ' (' || strftime(f, '%d/%m/%Y') || coalesce(' - R' || reparto, '') || ')', ' | ' ORDER BY f, tipo, reparto) AS todo
  FROM eventos_t GROUP BY NroCta),
r05 AS (
  SELECT '2001-05' AS Mes, NroCta, Nombre, Direcc, Telefn, coalesce(tipo, 'E5') AS TipoEvento,
    coalesce(texto, 'SIGUE SIN CONSUMO') AS EstadoFinal, f AS FechaEvento, reparto AS IdReparto,
    CASE WHEN tipos > 1 THEN 1 ELSE 0 END AS FlagConflicto, todo AS AccionesMes
  FROM gente JOIN callados USING (NroCta) LEFT JOIN gana USING (NroCta) LEFT JOIN acciones USING (NroCta))
"""


@query(
    "r05_retention",
    star_query(
        f"""SELECT Mes, NroCta, Nombre, Direcc, Telefn, TipoEvento, EstadoFinal, {day("FechaEvento", "FechaEvento")},
  IdReparto, FlagConflicto, AccionesMes FROM r05""",
        R05_CTES,
    ),
)
def r05_retention(t: Tables) -> DataFrame:
    return retention.equipment_retention(t, dt.date(2001, 5, 1))


@query(
    "r06_litres_equipment",
    star_query(
        f"""
SELECT m.IdCliente AS NroCta, Q_FC, {num("sum(Volumen)", "ConsumoLitros")},
  round(CAST(CAST(CAST(sum(Volumen) AS DOUBLE) / Q_FC + 1e-9 AS DECIMAL(12,2)) AS DOUBLE), 4) AS LitrosPorEquipo
FROM (SELECT IdCliente, count(DISTINCT Nro_Serie) AS Q_FC FROM maquinas
      WHERE Fecha_Desde < DATE '2001-05-01' AND (Fecha_Baja IS NULL OR Fecha_Baja > DATE '2001-05-01') GROUP BY IdCliente) m
JOIN Ventas v ON v.idCliente = m.IdCliente
WHERE Fecha_Pedido >= DATE '2001-04-01' AND Fecha_Pedido < DATE '2001-05-01' AND Litros > 0
GROUP BY m.IdCliente, Q_FC
"""
    ),
)
def r06_litres_equipment(t: Tables) -> DataFrame:
    return equipment.litres_per_equipment(t, dt.date(2001, 5, 1), dt.date(2001, 4, 1), dt.date(2001, 5, 1))


R07_CTES = """
padron AS (
  SELECT NroCta, RUTA, CndPag FROM Clientes JOIN ruta_de USING (NroCta) WHERE NroCta <> 0
  UNION ALL SELECT NroCta, Vnddor, CndPag FROM ClientesBaja JOIN Rutas ON CdRuta = Codigo WHERE NroCta <> 0),
deudas AS (
  SELECT RUTA, CASE WHEN CndPag = 1 THEN coalesce(contado, 0) ELSE 0 END AS contado,
         CASE WHEN CndPag IN (2, 3, 4) THEN coalesce(credito, 0) ELSE 0 END AS credito
  FROM padron
  LEFT JOIN (SELECT IdCliente, sum(Importe) AS contado FROM Caja WHERE Fecha < DATE '2000-08-15' GROUP BY 1) a ON a.IdCliente = NroCta
  LEFT JOIN (SELECT IdCliente, greatest(sum(Import), 0) AS credito FROM CtaCte WHERE FchMov < DATE '2000-08-15' GROUP BY 1) b ON b.IdCliente = NroCta),
r07 AS (
  SELECT RUTA, sum(contado) AS DeudaContado, sum(credito) AS DeudaCtaCte, sum(contado + credito) AS DeudaTotal
  FROM deudas WHERE contado <> 0 OR credito <> 0 GROUP BY RUTA)
"""


@query(
    "r07_debt_route",
    star_query(
        f"SELECT RUTA, {num('DeudaContado', 'DeudaContado')}, {num('DeudaCtaCte', 'DeudaCtaCte')}, {num('DeudaTotal', 'DeudaTotal')} FROM r07",
        R07_CTES,
    ),
)
def r07_debt_route(t: Tables) -> DataFrame:
    return risk.debt_by_route(t, dt.date(2000, 8, 15), routes=range(25), exclude=())


@query(
    "r08_text_segment",
    star_query(
        f"""
SELECT idCliente, Urbanizacion, AtrDes AS Atributo, CAST(year(Fecha) AS INTEGER) AS "AÑO", strftime(Fecha, '%B') AS "MES",
  {num("sum(Volumen)", "LITROS")}, {num("sum(Cantidad)", "CANTIDAD")}, {num("sum(Bultos)", "BULTOS")}, {num("sum(Monto)", "CONSUMO_$")}
FROM Ventas JOIN (
  SELECT NroCta, Atrib5, CASE WHEN Direcc ILIKE '%machinery%' THEN 'MACHINERY' WHEN Direcc ILIKE '%0007%' THEN 'SIETE'
    WHEN Direcc ILIKE '%house%9%' THEN 'NUNCA' WHEN Direcc ILIKE '%9 - house%' THEN 'NUEVE' END AS Urbanizacion
  FROM Clientes JOIN ruta_de USING (NroCta)) c ON c.NroCta = idCliente AND Urbanizacion IS NOT NULL
LEFT JOIN ClientesAtrLis a ON a.AtrNro = 5 AND a.AtrCod = Atrib5
WHERE Litros > 0 GROUP BY idCliente, Urbanizacion, AtrDes, "AÑO", "MES"
"""
    ),
)
def r08_text_segment(t: Tables) -> DataFrame:
    return segmentation.community_consumption(t, COMMUNITIES)


R09_MONTHS = [dt.date(1999 + (7 + i) // 12, (7 + i) % 12 + 1, 1) for i in range(24)]
R09_CTES = """
celdas AS (
  SELECT idCliente AS NroCta, idVendedor AS Ruta, idProducto, Abreviatura, strftime(Fecha, '%Y-%m') AS mes,
         sum(Volumen) AS litros, sum(Monto) AS pesos
  FROM Ventas WHERE Fecha >= DATE '1999-08-01' AND Fecha < DATE '2001-08-01' AND Litros <> 0 AND Precio > 0
    AND idVendedor IS NOT NULL
  GROUP BY ALL),
ficha AS (
  SELECT NroCta, Nombre, Direcc AS Direccion, FecAlt, FecBaj, cp.Descrp AS MediodePago, tc.Descrp AS CATEGORIA, coalesce(maq, 0) AS Q_FC,
    CASE WHEN CndPag = 1 THEN greatest(coalesce(contado, 0), 0) ELSE 0 END AS DeudaContado,
    CASE WHEN CndPag IN (2, 3, 4) THEN greatest(coalesce(credito, 0), 0) ELSE 0 END AS DeudaCtaCte
  FROM (SELECT NroCta, Nombre, Direcc, FecAlt, CAST(NULL AS TIMESTAMP) AS FecBaj, CndPag, TipCli FROM Clientes
        UNION ALL SELECT NroCta, Nombre, Direcc, FecAlt, FecBaj, CndPag, TipCli FROM ClientesBaja WHERE FecBaj >= DATE '1999-08-01') k
  JOIN CondPAGO cp ON cp.Codigo = CndPag JOIN TiposCli tc ON tc.Codigo = TipCli
  LEFT JOIN (SELECT IdCliente, sum(Importe) AS contado FROM Caja GROUP BY 1) a ON a.IdCliente = NroCta
  LEFT JOIN (SELECT IdCliente, sum(Import) AS credito FROM CtaCte GROUP BY 1) b ON b.IdCliente = NroCta
  LEFT JOIN (SELECT IdCliente, count(DISTINCT Nro_Serie) AS maq FROM maquinas WHERE Fecha_Baja IS NULL AND Fecha_Desde < DATE '2001-08-01' GROUP BY 1) m
    ON m.IdCliente = NroCta)
"""
R09_CELLS = ",\n".join(
    num(f"coalesce(sum({source}) FILTER (WHERE mes = '{m:%Y-%m}'), 0)", f"{m:%Y-%m} {suffix}")
    for m in R09_MONTHS
    for source, suffix in (("litros", "CANT"), ("pesos", "FACT"))
)


@query(
    "r09_sales_matrix",
    star_query(
        f"""
SELECT c.NroCta, Nombre, Ruta, Direccion, {day("FecAlt", "FecAlt")}, {day("FecBaj", "FecBaj")}, MediodePago,
  {num("DeudaContado", "DeudaContado")}, {num("DeudaCtaCte", "DeudaCtaCte")}, CATEGORIA, Q_FC, idProducto, Abreviatura, {R09_CELLS}
FROM celdas c LEFT JOIN ficha f ON f.NroCta = c.NroCta
GROUP BY c.NroCta, Nombre, Ruta, Direccion, FecAlt, FecBaj, MediodePago, DeudaContado, DeudaCtaCte, CATEGORIA, Q_FC, idProducto, Abreviatura
""",
        R09_CTES,
    ),
)
def r09_sales_matrix(t: Tables) -> DataFrame:
    return sales.monthly_sales_matrix(t, dt.date(2001, 8, 15), vendors=None)


RECEIPTS = """
sueltos AS (
  SELECT CASE WHEN CodCpt = 'EFE' THEN TRY_CAST(nullif(regexp_extract(trim(Refern), '([0-9]+)$', 1), '') AS INTEGER) ELSE c.RUTA END AS destino,
         date_trunc('month', FchMov) AS Mes, CodCpt, CASE WHEN DebHab = 'D' THEN Import ELSE -Import END AS importe
  FROM MovTes LEFT JOIN (SELECT NroCta, RUTA FROM Clientes JOIN ruta_de USING (NroCta)) c USING (NroCta)
  WHERE FchMov >= DATE '2001-02-01' AND FchMov < DATE '2001-07-21' AND CodCpt <> 'CCB' AND DebHab = 'D'),
recibos AS (
  SELECT destino AS RUTA, Mes, CodCpt, sum(importe) AS Total FROM sueltos WHERE destino IS NOT NULL GROUP BY destino, Mes, CodCpt)
"""


@query(
    "r10_collections",
    star_query(
        f"""SELECT RUTA, strftime(Mes, '%m-%y') AS Mes, coalesce(Descrp, CodCpt) AS Descripcion, {num("Total", "Total")}
FROM recibos LEFT JOIN CptTes ON Codigo = CodCpt""",
        RECEIPTS,
    ),
)
def r10_collections(t: Tables) -> DataFrame:
    return collections.collections_by_route(t, dt.date(2001, 7, 20), routes=range(25))


HOLIDAY = """
diario AS (
  SELECT idVendedor AS Ruta, Fecha, sum(CASE WHEN Precio > 0 THEN Monto ELSE 0 END) AS Consumo, sum(Volumen) AS Litros
  FROM Ventas WHERE Fecha >= DATE '1999-05-01' AND Fecha <= DATE '2001-05-01' AND idCliente <> 0 AND Litros <> 0
  GROUP BY ALL),
base AS (
  SELECT Ruta, count(*) AS dias, sum(Consumo) / count(*) AS pc, sum(Litros) / count(*) AS pl FROM diario
  WHERE dayofweek(Fecha) = dayofweek(DATE '2001-05-01') AND Fecha <> DATE '2001-05-01' GROUP BY Ruta HAVING count(*) >= 4),
feriado AS (SELECT Ruta, Consumo, Litros FROM diario WHERE Fecha = DATE '2001-05-01')
"""


@query(
    "r11_holiday",
    star_query(
        f"""
SELECT b.Ruta, dias AS DiasBaseProm, {num("CAST(pc + 1e-9 AS DECIMAL(12,2))", "PromedioConsumo")}, {num("CAST(pl + 1e-9 AS DECIMAL(12,2))", "PromedioLitros")},
  {num("coalesce(f.Consumo, 0)", "VtaFeriadoConsumo")}, {num("coalesce(f.Litros, 0)", "VtaFeriadoLitros")},
  {num("CAST(pc - coalesce(f.Consumo, 0) + 1e-9 AS DECIMAL(12,2))", "ARecuperarConsumo")},
  {num("TRY_CAST(100 * (pc - coalesce(f.Consumo, 0)) / nullif(pc, 0) + 1e-9 AS DECIMAL(5,1))", "PctRecupero")}
FROM base b LEFT JOIN feriado f ON f.Ruta = b.Ruta
""",
        HOLIDAY,
    ),
)
def r11_holiday(t: Tables) -> DataFrame:
    return operations.holiday_recovery(t, dt.date(2001, 5, 1), months=24)


def _key_rule(table: str, source: str, columns: str) -> str:
    return f"""SELECT '{table}' AS Tabla, 'clave' AS Regla, '{columns}' AS Columnas, CAST(coalesce(sum(n), 0) AS BIGINT) AS Filas,
  CAST(0 AS BIGINT) AS Nulas, count(*) FILTER (WHERE n > 1) AS Claves, CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS Filas_Malas
FROM (SELECT count(*) AS n FROM {source} GROUP BY {columns})"""


def _reference_rule(table: str, column: str, parent: str, key: str) -> str:
    return f"""SELECT '{table}' AS Tabla, 'referencia' AS Regla, '{column}' AS Columnas, count(*) AS Filas,
  count(*) FILTER (WHERE {column} IS NULL) AS Nulas, count(DISTINCT CASE WHEN {key} IS NULL THEN {column} END) AS Claves,
  count(*) FILTER (WHERE {key} IS NULL AND {column} IS NOT NULL) AS Filas_Malas
FROM {table} LEFT JOIN (SELECT DISTINCT {key} FROM {parent}) ON {column} = {key}"""


@query(
    "r12_key_audit",
    star_query(
        " UNION ALL ".join(
            [
                _key_rule("Clientes", "Clientes", "NroCta"),
                _key_rule("Pedidos", "Pedidos", "idPedido"),
                _key_rule("Pedidos_Productos", "Lineas", "idPedido, idProducto"),
                _key_rule("ClientesServicios", "maquinas", "IdCliente"),
                _reference_rule("Pedidos", "idCliente", "Clientes", "NroCta"),
                _reference_rule("Movimientos_Equipos", "IdCliente", "ClientesBaja", "NroCta"),
            ]
        )
    ),
)
def r12_key_audit(t: Tables) -> DataFrame:
    """Keys that repeat and values that name no row: orders of closed accounts are orphans of the active ones."""
    keys = {
        "Clientes": ["NroCta"],
        "Pedidos": ["idPedido"],
        "Pedidos_Productos": ["idPedido", "idProducto"],
        "ClientesServicios": ["IdCliente"],
    }
    references = {
        ("Pedidos", "idCliente"): [("Clientes", "NroCta")],
        ("Movimientos_Equipos", "IdCliente"): [("ClientesBaja", "NroCta")],
    }
    return audit.key_audit(t, keys, references)


@query(
    "r12_counts",
    star_query(
        """
SELECT 'CondPAGO' AS Tabla, 4 AS Filas UNION ALL SELECT 'TiposCli', 5 UNION ALL SELECT 'Categorias', 4
UNION ALL SELECT 'ClientesAtrLis', 5 UNION ALL SELECT 'CteVtas', 2 UNION ALL SELECT 'CptTes', 4
UNION ALL SELECT 'Productos', count(*) FROM part UNION ALL SELECT 'Rutas', count(*) FROM nation
UNION ALL SELECT 'repartos', count(*) FROM repartos UNION ALL SELECT 'Clientes', count(*) FROM Clientes
UNION ALL SELECT 'ClientesBaja', count(*) FROM ClientesBaja UNION ALL SELECT 'ClientesRutas', count(*) FROM ClientesRutas
UNION ALL SELECT 'Clientes_Ctas_Madres_e_Hijas', count(*) FROM Madres
UNION ALL SELECT 'ClientesServicios', count(*) FROM maquinas
UNION ALL SELECT 'Movimientos_Equipos', count(*) FROM Movimientos_Equipos
UNION ALL SELECT 'Pedidos', count(*) FROM orders UNION ALL SELECT 'Pedidos_Productos', count(*) FROM lineitem
UNION ALL SELECT 'Movimientos_Caja', count(*) FROM Caja WHERE Importe <> 25.50
UNION ALL SELECT 'Movimientos_Caja_Ajustes', count(*) FROM orders WHERE o_custkey % 4 = 0 AND o_orderpriority = '1-URGENT'
UNION ALL SELECT 'CtaCteVT', count(*) FROM CtaCte UNION ALL SELECT 'MovTes', count(*) FROM orders
"""
    ),
)
def r12_counts(t: Tables) -> DataFrame:
    return audit.table_counts(t)
