"""SQL statement of the business tables on the star schema, as `rivulet/sources/star.py` derives them."""

from __future__ import annotations

TABLES = """
cuentas AS (
  SELECT c_custkey AS NroCta, c_name AS Nombre, c_name || ' - ' || c_mktsegment AS Direcc,
         'T' || c_custkey AS Telefn, ['CAT-A', 'CAT-B', 'CAT-C', 'CAT-D'][c_custkey % 4 + 1] AS Categoria,
         c_mktsegment AS TipCli, c_custkey % 4 + 1 AS CndPag, CAST(c_custkey % 5 AS VARCHAR) AS Atrib5,
         primer - to_days(CAST(c_custkey % 90 AS INTEGER)) AS FecAlt, primer, c_nationkey, c_acctbal
  FROM customer LEFT JOIN (SELECT o_custkey, min(o_orderdate) AS primer FROM orders GROUP BY o_custkey)
    ON o_custkey = c_custkey),
Clientes AS (SELECT * FROM cuentas WHERE c_acctbal >= 0),
ClientesBaja AS (
  SELECT *, NroCta AS IdClienteBaja, primer + to_days(CAST(NroCta % 2000 AS INTEGER)) AS FecBaj,
         'R' || lpad(CAST(c_nationkey AS VARCHAR), 4, '0') AS CdRuta
  FROM cuentas WHERE c_acctbal < 0),
ClientesRutas AS (
  SELECT c_custkey AS Cliente_Ruteo, 1 AS OrdRut, 'R' || lpad(CAST(c_nationkey AS VARCHAR), 4, '0') AS CdRuta FROM customer
  UNION ALL
  SELECT c_custkey, 2, 'R' || lpad(CAST((c_nationkey + 1) % 25 AS VARCHAR), 4, '0') FROM customer WHERE c_custkey % 10 = 0),
Rutas AS (SELECT 'R' || lpad(CAST(n_nationkey AS VARCHAR), 4, '0') AS Codigo, n_name AS Descrp, n_nationkey AS Vnddor FROM nation),
repartos AS (
  SELECT n_nationkey AS Codigo, n_name AS Descrp, n_regionkey + 1000 AS CodSup FROM nation
  UNION ALL SELECT r_regionkey + 1000, r_name, r_regionkey + 1000 FROM region),
CondPAGO AS (SELECT * FROM (VALUES (1, 'CONTADO'), (2, 'CTA CTE 30'), (3, 'CTA CTE 60'), (4, 'CTA CTE 90')) v(Codigo, Descrp)),
TiposCli AS (SELECT v AS Codigo, v AS Descrp FROM (VALUES ('AUTOMOBILE'), ('BUILDING'), ('FURNITURE'), ('HOUSEHOLD'), ('MACHINERY')) x(v)),
Categorias AS (SELECT * FROM (VALUES ('CAT-A', 'Premium'), ('CAT-B', 'Standard'), ('CAT-C', 'Basic'), ('CAT-D', 'Migrated')) v(Categoria, Descripcion)),
ClientesAtrLis AS (SELECT * FROM (VALUES (5, '1', 'Uno'), (5, '2', 'Dos'), (5, '3', 'Tres'), (5, '4', 'Cuatro'), (4, '1', 'Otro')) v(AtrNro, AtrCod, AtrDes)),
CptTes AS (SELECT * FROM (VALUES ('EFE', 'Efectivo'), ('CHQ', 'Cheque'), ('TRF', 'Transferencia'), ('DIG', 'Digital')) v(Codigo, Descrp)),
Productos AS (
  SELECT p_partkey AS idProducto, p_name AS Abreviatura, p_type AS Unidad,
         CAST(CASE WHEN p_type = 'SMALL' THEN 0 ELSE p_size END AS DECIMAL(10,2)) AS Litros,
         CASE WHEN p_type = 'PROMO' THEN 12 END AS cantidad_x_bulto
  FROM part),
Pedidos AS (
  SELECT o_orderkey AS idPedido, c_nationkey AS idVendedor, o_orderdate AS Fecha_Pedido, o_custkey AS idCliente
  FROM orders LEFT JOIN customer ON c_custkey = o_custkey),
Lineas AS (
  SELECT l_orderkey AS idPedido, l_partkey AS idProducto, CAST(l_quantity AS DECIMAL(10,2)) AS Cantidad,
         CASE WHEN CAST(l_discount AS DECIMAL(4,2)) = 0.10 THEN CAST(0 AS DECIMAL(15,2))
              ELSE CAST(l_extendedprice AS DECIMAL(15,2)) END AS Precio
  FROM lineitem),
Ventas AS (
  SELECT idPedido, idVendedor, Fecha_Pedido, CAST(Fecha_Pedido AS DATE) AS Fecha, idCliente, idProducto, Abreviatura,
         Unidad, Litros, cantidad_x_bulto, Cantidad, Precio, Cantidad * Litros AS Volumen, Cantidad * Precio AS Monto,
         CAST(Cantidad AS DOUBLE) / cantidad_x_bulto AS Bultos
  FROM Lineas JOIN Productos USING (idProducto) JOIN Pedidos USING (idPedido)),
maquinas AS (
  SELECT o_custkey AS IdCliente, concat(l_orderkey, '-', l_partkey) AS Nro_Serie, o_orderdate AS Fecha_Desde,
         CASE WHEN l_returnflag = 'R' THEN o_orderdate + to_days(400) END AS Fecha_Baja,
         l_suppkey, l_orderkey, l_linenumber, l_linestatus
  FROM lineitem JOIN part ON p_partkey = l_partkey AND p_type = 'LARGE' JOIN orders ON o_orderkey = l_orderkey),
Movimientos_Equipos AS (
  SELECT Fecha_Baja AS Fecha, CASE l_suppkey % 10 WHEN 0 THEN 146 WHEN 1 THEN 147 ELSE l_suppkey END AS IdReparto,
         IdCliente, CASE l_linenumber WHEN 7 THEN 1 WHEN 6 THEN 0 END AS Anulado,
         CASE WHEN l_linestatus = 'O' THEN l_orderkey END AS IdRecambio
  FROM maquinas WHERE Fecha_Baja IS NOT NULL),
Caja AS (
  SELECT o_custkey AS IdCliente, o_orderdate AS Fecha, CAST(o_totalprice AS DECIMAL(18,2)) AS Importe
  FROM orders WHERE o_custkey % 4 = 0
  UNION ALL SELECT o_custkey, o_orderdate, -CAST(o_totalprice AS DECIMAL(18,2))
  FROM orders WHERE o_custkey % 4 = 0 AND o_orderstatus = 'F'
  UNION ALL SELECT o_custkey, o_orderdate, CAST(25.50 AS DECIMAL(18,2))
  FROM orders WHERE o_custkey % 4 = 0 AND o_orderpriority = '1-URGENT'),
CtaCte AS (
  SELECT 'FACA' AS CodMov, o_orderkey AS NroMov, o_custkey AS IdCliente, o_orderdate AS FchMov,
         CAST(NULL AS VARCHAR) AS CodApl, CAST(NULL AS BIGINT) AS NroApl, CAST(o_totalprice AS DECIMAL(18,2)) AS Import
  FROM orders WHERE o_custkey % 4 <> 0
  UNION ALL SELECT 'RECA', o_orderkey, o_custkey, o_orderdate, 'FACA', o_orderkey, -CAST(o_totalprice AS DECIMAL(18,2))
  FROM orders WHERE o_custkey % 4 <> 0 AND o_orderstatus = 'F'),
MovTes AS (
  SELECT o_orderdate AS FchMov, o_custkey AS NroCta,
         CASE WHEN o_orderstatus = 'P' THEN 'SIN RUTA'
              ELSE 'CIERRE DIARIO RUTA ' || lpad(CAST(o_custkey % 25 AS VARCHAR), 4, '0') END AS Refern,
         CASE WHEN o_orderkey % 40 = 0 THEN 'CCB' WHEN o_orderpriority LIKE '1%' THEN 'EFE' WHEN o_orderpriority LIKE '2%' THEN 'CHQ'
              WHEN o_orderpriority LIKE '3%' THEN 'TRF' WHEN o_orderpriority LIKE '4%' THEN 'DIG'
              WHEN o_orderpriority LIKE '5%' THEN 'RET' END AS CodCpt,
         CAST(o_totalprice AS DECIMAL(18,2)) AS Import, CASE WHEN o_orderkey % 25 = 1 THEN 'H' ELSE 'D' END AS DebHab
  FROM orders),
Madres AS (SELECT c_custkey AS IdCliente, c_custkey - c_custkey % 10 AS Cta_Madre FROM customer WHERE c_custkey % 10 < 5),
ruteo AS (
  SELECT Cliente_Ruteo AS NroCta, Vnddor AS RUTA, OrdRut, CdRuta
  FROM ClientesRutas JOIN Rutas ON CdRuta = Codigo),
ruta_de AS (SELECT NroCta, arg_min(RUTA, OrdRut) AS RUTA FROM ruteo GROUP BY NroCta)
"""


def star_query(select: str, ctes: str = "") -> str:
    """A query over the tables above, with further named parts of its own."""
    parts = TABLES.strip() + (",\n" + ctes.strip() if ctes else "")
    return f"WITH {parts}\n{select.strip()}"


def num(expression: str, name: str) -> str:
    """A number as it is compared: double, four decimals."""
    return f'round(CAST({expression} AS DOUBLE), 4) AS "{name}"'


def day(expression: str, name: str) -> str:
    """A date as it is compared: ISO text."""
    return f"strftime({expression}, '%Y-%m-%d') AS \"{name}\""
