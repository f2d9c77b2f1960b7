"""One query per relational operator and column function the reports are made of."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog.registry import query
from catalog.star_sql import day, num, star_query
from rivulet.functions import dates, exprs, rules, text
from rivulet.operators import aggregates, joins, pivots, rowsets, windows
from rivulet.plans.customers import active_customers, customer_route, with_category, with_terms, with_type
from rivulet.plans.ledgers import cash_balance
from rivulet.plans.orders import amount, packs, sales_lines, volume
from rivulet.plans.reports.audit import order_by
from rivulet.sources.csv_files import load_all, read_csv
from rivulet.sources.layout import in_window, write, write_table
from rivulet.sources.schema import canonical_schema
from rivulet.sources.tables import Tables

D = dt.date


def sold(t: Tables) -> DataFrame:
    """Order lines with their order and product."""
    return t["Pedidos"].join(sales_lines(t, liquid=None), "idPedido")


# --- row sources and sinks


def _csv_of(t: Tables, names: list[str]) -> str:
    """Write tables as CSV files with a header, all columns of the schema, under the shared folder."""
    folder = rowsets.shared_folder(t.spark, "csv")

    def put(name: str, table: DataFrame) -> None:
        full = [
            (F.col(f.name) if f.name in table.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in canonical_schema(name).fields
        ]
        table.select(*full).write.options(header=True, timestampNTZFormat="yyyy-MM-dd HH:mm:ss").csv(
            f"{folder}/{name}.csv"
        )

    with rowsets.side_by_side(t.spark) as start:
        running = [start(put, name, t[name]) for name in names]
    for job in running:
        job.result()
    return folder


@query(
    "s01_read_csv",
    star_query(
        f"SELECT NroCta, Nombre, Direcc, Categoria, CndPag, {day('FecAlt', 'FecAlt')} FROM Clientes"
    ),
)
def s01_read_csv(t: Tables) -> DataFrame:
    folder = _csv_of(t, ["Clientes"])
    loaded = read_csv(t.spark, f"{folder}/Clientes.csv", "Clientes")
    return loaded.select("NroCta", "Nombre", "Direcc", "Categoria", "CndPag", "FecAlt")


# Where the star SQL has the rows of each table that is loaded.
LOADED = {
    **{n: n for n in ("CondPAGO", "TiposCli", "Categorias", "ClientesAtrLis", "Productos", "Rutas", "repartos", "Clientes")},
    **{n: n for n in ("ClientesBaja", "ClientesRutas", "Movimientos_Equipos", "Pedidos", "MovTes")},
    "Clientes_Ctas_Madres_e_Hijas": "Madres",
    "ClientesServicios": "maquinas",
    "Pedidos_Productos": "Lineas",
    "Movimientos_Caja": "Caja WHERE Importe <> 25.50",
    "Movimientos_Caja_Ajustes": "Caja WHERE Importe = 25.50",
    "CtaCteVT": "CtaCte",
}


@query(
    "s02_load_all",
    star_query(
        " UNION ALL ".join(f"SELECT '{name}' AS tabla, count(*) AS filas, false AS fallo FROM {source}" for name, source in LOADED.items())
        + " UNION ALL SELECT 'CteVtas', 2, false UNION ALL SELECT 'CptTes', NULL, true"
    ),
)
def s02_load_all(t: Tables) -> DataFrame:
    """All 21 tables, of which one has no file."""
    folder = _csv_of(t, [*LOADED, "CteVtas"])
    _, report = load_all(t.spark, folder, rowsets.shared_folder(t.spark, "loaded"))
    return report.select("tabla", "filas", F.col("error").isNotNull().alias("fallo"))


@query("s03_scan_by_name", star_query("SELECT Codigo, Descrp, CodSup FROM repartos"))
def s03_scan_by_name(t: Tables) -> DataFrame:
    t["repartos"].createOrReplaceTempView("repartos")
    return t.spark.sql("SELECT Codigo, Descrp, CodSup FROM repartos")


@query(
    "s04_values",
    star_query(
        "SELECT Vendedor, count(*) AS n FROM Pedidos JOIN (VALUES (1), (5), (9)) v(Vendedor) ON idVendedor = Vendedor GROUP BY 1"
    ),
)
def s04_values(t: Tables) -> DataFrame:
    vendors = rowsets.values(t.spark, [(1,), (5,), (9,)], ["Vendedor"])
    joined = t["Pedidos"].join(vendors, F.col("idVendedor") == F.col("Vendedor"))
    return joined.groupBy("Vendedor").agg(F.count(F.lit(1)).alias("n"))


@query("s05_restrict", star_query("SELECT NroCta, Nombre FROM Clientes WHERE NroCta IN (SELECT Cta_Madre FROM Madres)"))
def s05_restrict(t: Tables) -> DataFrame:
    cohort = t["Clientes_Ctas_Madres_e_Hijas"].select("Cta_Madre")
    return joins.restrict(t["Clientes"], cohort, "NroCta", "Cta_Madre").select("NroCta", "Nombre")


@query(
    "s06_calendar",
    star_query(
        f"""SELECT {day("Mes", "Mes")}, coalesce(n, 0) AS n
FROM (SELECT CAST(unnest(generate_series(DATE '1999-08-01', DATE '2001-07-01', INTERVAL 1 MONTH)) AS DATE) AS Mes)
LEFT JOIN (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS Mes, count(*) AS n FROM orders GROUP BY 1) USING (Mes)"""
    ),
)
def s06_calendar(t: Tables) -> DataFrame:
    months = rowsets.month_calendar(t.spark, D(1999, 8, 15), D(2001, 7, 31))
    sales = t["Pedidos"].groupBy(dates.month_start("Fecha_Pedido").alias("Mes")).agg(F.count(F.lit(1)).alias("n"))
    return months.join(sales, "Mes", "left").select("Mes", F.coalesce("n", F.lit(0)).alias("n"))


@query(
    "s07_keep",
    star_query("SELECT idVendedor, count(*) AS n, count(DISTINCT idCliente) AS clientes FROM Pedidos GROUP BY idVendedor"),
)
def s07_keep(t: Tables) -> DataFrame:
    kept = rowsets.keep(t["Pedidos"].groupBy("idVendedor", "idCliente").agg(F.count(F.lit(1)).alias("n")))
    totals = kept.groupBy("idVendedor").agg(F.sum("n").alias("n"))
    customers = kept.groupBy("idVendedor").agg(F.count(F.lit(1)).alias("clientes"))
    return totals.join(customers, "idVendedor")


@query(
    "s08_sink",
    star_query(
        """SELECT o_orderkey AS idPedido, o_custkey AS idCliente FROM orders
WHERE o_orderdate >= DATE '1999-03-10' AND o_orderdate < DATE '1999-05-01'"""
    ),
)
def s08_sink(t: Tables) -> DataFrame:
    path = rowsets.shared_folder(t.spark, "table")
    write_table(t["Pedidos"], path, "Pedidos")
    stored = t.spark.read.parquet(path)
    return in_window(stored, "Fecha_Pedido", D(1999, 3, 10), D(1999, 5, 1)).select("idPedido", "idCliente")


@query("s08_sink_by_route", star_query("SELECT RUTA, count(*) AS n FROM ruta_de GROUP BY RUTA"))
def s08_sink_by_route(t: Tables) -> DataFrame:
    path = rowsets.shared_folder(t.spark, "report")
    write(customer_route(t), path, "RUTA")
    return t.spark.read.parquet(path).groupBy("RUTA").agg(F.count(F.lit(1)).alias("n"))


# --- projection, filters, predicates


@query(
    "p01_projection",
    star_query(f"SELECT o_orderkey AS Pedido, o_custkey AS Cliente, {day('o_orderdate', 'Fecha')} FROM orders"),
)
def p01_projection(t: Tables) -> DataFrame:
    return t["Pedidos"].select(
        F.col("idPedido").alias("Pedido"), F.col("idCliente").alias("Cliente"), F.to_date("Fecha_Pedido").alias("Fecha")
    )


@query(
    "p02_all_plus_derived",
    star_query("SELECT Codigo, Descrp, CodSup, CASE WHEN Codigo = CodSup THEN 1 ELSE 0 END AS EsSupervisor FROM repartos"),
)
def p02_all_plus_derived(t: Tables) -> DataFrame:
    return t["repartos"].withColumn("EsSupervisor", F.when(F.col("Codigo") == F.col("CodSup"), 1).otherwise(0))


@query("p03_distinct", star_query("SELECT DISTINCT idVendedor, year(Fecha_Pedido) AS Anio FROM Pedidos"))
def p03_distinct(t: Tables) -> DataFrame:
    return t["Pedidos"].select("idVendedor", F.year("Fecha_Pedido").alias("Anio")).distinct()


@query(
    "p04_half_open_range",
    star_query(
        "SELECT idPedido FROM Pedidos WHERE Fecha_Pedido >= DATE '1998-02-01' AND Fecha_Pedido < DATE '1998-03-01' AND idVendedor <> 4"
    ),
)
def p04_half_open_range(t: Tables) -> DataFrame:
    return t.between("Pedidos", D(1998, 2, 1), D(1998, 3, 1)).filter(F.col("idVendedor") != 4).select("idPedido")


@query(
    "p05_between",
    star_query("SELECT idPedido FROM Pedidos WHERE CAST(Fecha_Pedido AS DATE) BETWEEN DATE '1998-02-01' AND DATE '1998-02-28'"),
)
def p05_between(t: Tables) -> DataFrame:
    return t["Pedidos"].filter(F.to_date("Fecha_Pedido").between(F.lit(D(1998, 2, 1)), F.lit(D(1998, 2, 28)))).select("idPedido")


@query(
    "p06_in_list",
    star_query("SELECT NroCta, Categoria FROM Clientes WHERE Categoria IN ('CAT-A', 'CAT-C') AND CndPag NOT IN (2, 4) AND TipCli NOT IN ('BUILDING')"),
)
def p06_in_list(t: Tables) -> DataFrame:
    people = t["Clientes"].filter(F.col("Categoria").isin("CAT-A", "CAT-C") & ~F.col("CndPag").isin(2, 4))
    return people.filter(~F.col("TipCli").isin("BUILDING")).select("NroCta", "Categoria")


@query(
    "p07_like",
    star_query("SELECT idProducto, Abreviatura FROM Productos WHERE Abreviatura ILIKE '%RING%' AND Abreviatura NOT ILIKE 'red%'"),
)
def p07_like(t: Tables) -> DataFrame:
    kept = text.like("Abreviatura", "%RING%") & text.like("Abreviatura", "red%", negate=True)
    return t["Productos"].filter(kept).select("idProducto", "Abreviatura")


@query(
    "p08_any_like",
    star_query("SELECT idProducto FROM Productos WHERE Abreviatura ILIKE '%ring%' OR Abreviatura ILIKE '%bolt%' OR Abreviatura ILIKE 'hot%'"),
)
def p08_any_like(t: Tables) -> DataFrame:
    return t["Productos"].filter(text.any_like("Abreviatura", ["%RING%", "%bolt%", "hot%"])).select("idProducto")


@query(
    "p09_is_null",
    star_query("SELECT IdCliente, count(*) AS vigentes FROM maquinas WHERE Fecha_Baja IS NULL GROUP BY IdCliente"),
)
def p09_is_null(t: Tables) -> DataFrame:
    current = t["ClientesServicios"].filter(F.col("Fecha_Baja").isNull())
    return current.groupBy("IdCliente").agg(F.count(F.lit(1)).alias("vigentes"))


@query(
    "p10_coalesce",
    star_query("SELECT coalesce(Anulado, 0) AS Anulado, count(*) AS n FROM Movimientos_Equipos GROUP BY 1"),
)
def p10_coalesce(t: Tables) -> DataFrame:
    value = F.coalesce(F.col("Anulado").cast("int"), F.lit(0)).alias("Anulado")
    return t["Movimientos_Equipos"].groupBy(value).agg(F.count(F.lit(1)).alias("n"))


@query(
    "p11_safe_div",
    star_query(f"SELECT idVendedor, Unidad, {num('CAST(sum(Monto) AS DOUBLE) / nullif(sum(Volumen), 0)', 'PrecioLitro')} FROM Ventas GROUP BY 1, 2"),
)
def p11_safe_div(t: Tables) -> DataFrame:
    totals = sold(t).groupBy("idVendedor", "Unidad").agg(F.sum(amount()).alias("a"), F.sum(volume()).alias("v"))
    return totals.select("idVendedor", "Unidad", exprs.safe_div(F.col("a").cast("double"), "v").alias("PrecioLitro"))


@query(
    "p12_case",
    star_query(
        """SELECT NroCta, CASE CndPag WHEN 1 THEN 'contado' WHEN 2 THEN '30' ELSE 'mas' END AS plazo,
CASE WHEN NroCta < 100 AND TipCli = 'BUILDING' THEN 1 ELSE 0 END AS marca FROM Clientes"""
    ),
)
def p12_case(t: Tables) -> DataFrame:
    terms = F.when(F.col("CndPag") == 1, "contado").when(F.col("CndPag") == 2, "30").otherwise("mas")
    flag = F.when((F.col("NroCta") < 100) & (F.col("TipCli") == "BUILDING"), 1).otherwise(0)
    return t["Clientes"].select("NroCta", terms.alias("plazo"), flag.alias("marca"))


@query(
    "p13_classify",
    star_query(
        """SELECT idProducto, CASE WHEN Abreviatura ILIKE '%ring%' THEN 'R' WHEN Abreviatura ILIKE 'red%' THEN 'ROJO'
WHEN Abreviatura ILIKE '%bolt%' THEN 'B' END AS grupo FROM Productos"""
    ),
)
def p13_classify(t: Tables) -> DataFrame:
    label = text.classify_like("Abreviatura", [("%RING%", "R"), ("red%", "ROJO"), ("%bolt%", "B")])
    return t["Productos"].select("idProducto", label.alias("grupo"))


@query(
    "p14_typed_null",
    star_query("SELECT NroCta, CAST(NULL AS VARCHAR) AS FecBaj, 0 AS Cero, 'Activo' AS Estado FROM Clientes"),
)
def p14_typed_null(t: Tables) -> DataFrame:
    return t["Clientes"].select(
        "NroCta", exprs.typed_null("date").alias("FecBaj"), F.lit(0).alias("Cero"), F.lit("Activo").alias("Estado")
    )


@query(
    "p15_valid_at",
    star_query(
        "SELECT IdCliente, Nro_Serie FROM maquinas WHERE Fecha_Desde < DATE '2000-03-01' AND (Fecha_Baja > DATE '2000-03-01' OR Fecha_Baja IS NULL)"
    ),
)
def p15_valid_at(t: Tables) -> DataFrame:
    cut = F.lit("2000-03-01").cast("timestamp_ntz")
    return t["ClientesServicios"].filter(exprs.valid_at("Fecha_Desde", "Fecha_Baja", cut)).select("IdCliente", "Nro_Serie")


@query(
    "p16_month_window",
    star_query("SELECT count(*) AS n FROM orders WHERE o_orderdate >= DATE '2000-01-01' AND o_orderdate < DATE '2000-02-01'"),
)
def p16_month_window(t: Tables) -> DataFrame:
    return t.between("Pedidos", *dates.month_window(D(2000, 3, 31), -2)).agg(F.count(F.lit(1)).alias("n"))


# --- joins


@query(
    "j01_inner_star",
    star_query(
        """SELECT NroCta, RUTA, cp.Descrp AS plazo, tc.Descrp AS tipo, ca.Descripcion AS categoria
FROM Clientes k JOIN ruta_de USING (NroCta) JOIN CondPAGO cp ON cp.Codigo = CndPag JOIN TiposCli tc ON tc.Codigo = TipCli
JOIN Categorias ca ON ca.Categoria = k.Categoria"""
    ),
)
def j01_inner_star(t: Tables) -> DataFrame:
    people = with_category(t, with_type(t, with_terms(t, active_customers(t))), "inner")
    return people.select(
        "NroCta",
        "RUTA",
        F.col("MediodePago").alias("plazo"),
        F.col("TipCliDes").alias("tipo"),
        F.col("Descripcion").alias("categoria"),
    )


@query(
    "j02_left_join",
    star_query("SELECT Codigo, coalesce(n, 0) AS pedidos FROM repartos LEFT JOIN (SELECT idVendedor, count(*) AS n FROM Pedidos GROUP BY 1) ON idVendedor = Codigo"),
)
def j02_left_join(t: Tables) -> DataFrame:
    counts = t["Pedidos"].groupBy(F.col("idVendedor").alias("Codigo")).agg(F.count(F.lit(1)).alias("n"))
    return t["repartos"].join(counts, "Codigo", "left").select("Codigo", F.coalesce("n", F.lit(0)).alias("pedidos"))


@query(
    "j03_null_rejecting",
    star_query("SELECT NroCta, Vnddor FROM ClientesBaja JOIN Rutas ON CdRuta = Codigo WHERE Vnddor NOT IN (3, 7)"),
)
def j03_null_rejecting(t: Tables) -> DataFrame:
    routes = t["Rutas"].select(F.col("Codigo").alias("CdRuta"), "Vnddor")
    joined = t["ClientesBaja"].join(routes, "CdRuta", "left")
    return joined.filter(~F.col("Vnddor").isin(3, 7)).select("NroCta", "Vnddor")


@query("j04_semi", star_query("SELECT idPedido FROM Pedidos WHERE idCliente IN (SELECT NroCta FROM ClientesBaja)"))
def j04_semi(t: Tables) -> DataFrame:
    return joins.semi(t["Pedidos"], t["ClientesBaja"], "idCliente", "NroCta").select("idPedido")


@query(
    "j05_anti",
    star_query(
        """SELECT NroCta FROM Clientes c WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c.NroCta
AND o_orderdate >= DATE '2000-03-01' AND o_orderdate < DATE '2001-03-01')"""
    ),
)
def j05_anti(t: Tables) -> DataFrame:
    return joins.no_activity(
        t["Clientes"], t["Pedidos"], "NroCta", "idCliente", "Fecha_Pedido", D(2000, 3, 1), D(2001, 3, 1)
    ).select("NroCta")


@query(
    "j06_lateral",
    star_query(
        """SELECT NroCta, count(*) AS n, max(TRY_CAST(nullif(regexp_extract(trim(Refern), '([0-9]+)$', 1), '') AS INTEGER)) AS ruta,
max(length(Refern)) AS largo FROM MovTes GROUP BY NroCta"""
    ),
)
def j06_lateral(t: Tables) -> DataFrame:
    extra = {"ruta": text.try_int(text.trailing_digits("Refern")), "largo": F.length("Refern")}
    rows = joins.with_columns(t["MovTes"].withColumn("NroCta", text.account_number("NroCta")), extra)
    return rows.groupBy("NroCta").agg(F.count(F.lit(1)).alias("n"), F.max("ruta").alias("ruta"), F.max("largo").alias("largo"))


@query(
    "j07_lookup",
    star_query("SELECT coalesce(Descrp, CodCpt) AS Descripcion, count(*) AS n FROM MovTes LEFT JOIN CptTes ON Codigo = CodCpt GROUP BY 1"),
)
def j07_lookup(t: Tables) -> DataFrame:
    totals = t["MovTes"].groupBy("CodCpt").agg(F.count(F.lit(1)).alias("n"))
    return joins.lookup(totals, t["CptTes"], "CodCpt", "Codigo", "Descrp", "Descripcion").select("Descripcion", "n")


SEQUENCE = "numerados AS (SELECT *, row_number() OVER (PARTITION BY idCliente ORDER BY Fecha_Pedido, idPedido) AS rn FROM Pedidos)"


@query(
    "j08_nth_pair",
    star_query(
        f"""SELECT a.idCliente, a.idPedido AS p1, b.idPedido AS p2, {day("a.Fecha_Pedido", "f1")}, {day("b.Fecha_Pedido", "f2")}
FROM numerados a LEFT JOIN numerados b ON b.idCliente = a.idCliente AND b.rn = 2 WHERE a.rn = 1""",
        SEQUENCE,
    ),
)
def j08_nth_pair(t: Tables) -> DataFrame:
    return windows.nth_pair(
        t["Pedidos"], "idCliente", ["Fecha_Pedido", "idPedido"], {"idPedido": ("p1", "p2"), "Fecha_Pedido": ("f1", "f2")}
    )


@query(
    "j09_first_row_join",
    star_query("SELECT NroCta, Nombre, idPedido FROM Clientes LEFT JOIN numerados ON idCliente = NroCta AND rn = 1", SEQUENCE),
)
def j09_first_row_join(t: Tables) -> DataFrame:
    ranked = windows.nth_orders(t["Pedidos"], "idCliente", ["Fecha_Pedido", "idPedido"], 1)
    picked = ranked.select(F.col("idCliente").alias("NroCta"), "idPedido", "rn")
    return joins.first_row_join(t["Clientes"].select("NroCta", "Nombre"), picked, "NroCta")


@query(
    "j10_key_cast",
    star_query(f"SELECT c.NroCta, {num('sum(Import)', 'Saldo')} FROM CtaCte JOIN Clientes c ON c.NroCta = IdCliente GROUP BY c.NroCta"),
)
def j10_key_cast(t: Tables) -> DataFrame:
    ledger = t["CtaCteVT"].groupBy(F.col("NroCta").alias("cuenta")).agg(F.sum("Import").alias("Saldo"))
    return joins.key_cast_join(ledger, t["Clientes"].select("NroCta"), "cuenta", "NroCta").select("NroCta", "Saldo")


@query(
    "j12_hierarchy",
    star_query(
        """SELECT v.CodSup, s.Descrp AS Supervisor, count(*) AS pedidos FROM Pedidos p JOIN repartos v ON v.Codigo = p.idVendedor
LEFT JOIN repartos s ON s.Codigo = v.CodSup GROUP BY 1, 2"""
    ),
)
def j12_hierarchy(t: Tables) -> DataFrame:
    counts = t["Pedidos"].groupBy("idVendedor").agg(F.count(F.lit(1)).alias("pedidos"))
    return joins.supervisor_rollup(counts, t["repartos"], "idVendedor", ["pedidos"])


@query(
    "j13_parent",
    star_query(
        f"""SELECT coalesce(Cta_Madre, o_custkey) AS Cuenta, {num("sum(CAST(o_totalprice AS DECIMAL(18,2)))", "Import")}
FROM orders LEFT JOIN Madres ON IdCliente = o_custkey GROUP BY 1"""
    ),
)
def j13_parent(t: Tables) -> DataFrame:
    receipts = t["MovTes"].select(text.account_number("NroCta").alias("IdCliente"), "Import")
    return joins.to_parent(receipts, t["Clientes_Ctas_Madres_e_Hijas"], "IdCliente", ["Import"])


@query(
    "j14_open_items",
    star_query(
        f"""SELECT f.CodMov, f.NroMov, f.IdCliente AS NroCta, {day("f.FchMov", "FchMov")}, {num("f.Import", "Importe")},
{num("coalesce(sum(r.Import), 0)", "Aplicado")}, {num("f.Import + coalesce(sum(r.Import), 0)", "Saldo")}
FROM CtaCte f LEFT JOIN CtaCte r ON r.CodApl = f.CodMov AND r.NroApl = f.NroMov WHERE f.CodApl IS NULL
GROUP BY f.CodMov, f.NroMov, f.IdCliente, f.FchMov, f.Import"""
    ),
)
def j14_open_items(t: Tables) -> DataFrame:
    return joins.open_items(t["CtaCteVT"])


# --- aggregation


@query("a01_sum_product", star_query(f"SELECT idVendedor, {num('sum(Monto)', 'pesos')}, {num('sum(Volumen)', 'litros')} FROM Ventas GROUP BY 1"))
def a01_sum_product(t: Tables) -> DataFrame:
    return sold(t).groupBy("idVendedor").agg(F.sum(amount()).alias("pesos"), F.sum(volume()).alias("litros"))


@query("a02_first_date", star_query(f"SELECT idCliente, {day('min(Fecha_Pedido)', 'primera')} FROM Pedidos GROUP BY 1"))
def a02_first_date(t: Tables) -> DataFrame:
    return t["Pedidos"].groupBy("idCliente").agg(F.to_date(F.min("Fecha_Pedido")).alias("primera"))


@query("a03_count", star_query("SELECT TipCli, count(*) AS n FROM Clientes GROUP BY TipCli"))
def a03_count(t: Tables) -> DataFrame:
    return t["Clientes"].groupBy("TipCli").agg(F.count(F.lit(1)).alias("n"))


@query("a04_count_distinct", star_query("SELECT idVendedor, count(DISTINCT idProducto) AS productos, count(DISTINCT idCliente) AS clientes FROM Ventas GROUP BY 1"))
def a04_count_distinct(t: Tables) -> DataFrame:
    return sold(t).groupBy("idVendedor").agg(
        F.count_distinct("idProducto").alias("productos"), F.count_distinct("idCliente").alias("clientes")
    )


@query("a05_mean", star_query(f"SELECT idVendedor, {num('avg(CAST(Monto AS DOUBLE))', 'media')} FROM Ventas WHERE Precio > 0 GROUP BY 1"))
def a05_mean(t: Tables) -> DataFrame:
    return sold(t).filter(F.col("Precio") > 0).groupBy("idVendedor").agg(F.avg(amount()).alias("media"))


@query("a06_any_flag", star_query("SELECT idPedido, max(CASE WHEN Precio = 0 THEN 1 ELSE 0 END) AS cero FROM Lineas GROUP BY 1"))
def a06_any_flag(t: Tables) -> DataFrame:
    return t["Pedidos_Productos"].groupBy("idPedido").agg(exprs.any_flag(F.col("Precio") == 0).alias("cero"))


@query(
    "a07_sum_if",
    star_query(f"SELECT idPedido, {num('coalesce(sum(CASE WHEN Precio > 0 THEN Cantidad END), 0)', 'pagas')} FROM Lineas GROUP BY 1"),
)
def a07_sum_if(t: Tables) -> DataFrame:
    return t["Pedidos_Productos"].groupBy("idPedido").agg(exprs.sum_if(F.col("Precio") > 0, "Cantidad").alias("pagas"))


@query("a08_having", star_query("SELECT IdCliente, count(DISTINCT Nro_Serie) AS n FROM maquinas GROUP BY 1 HAVING count(DISTINCT Nro_Serie) > 5"))
def a08_having(t: Tables) -> DataFrame:
    counts = t["ClientesServicios"].groupBy("IdCliente").agg(F.count_distinct("Nro_Serie").alias("n"))
    return counts.filter(F.col("n") > 5)


@query(
    "a09_group_by_expression",
    star_query(
        "SELECT strftime(Fecha_Pedido, '%Y-%m') AS Periodo, year(Fecha_Pedido) AS Anio, strftime(Fecha_Pedido, '%B') AS Mes, count(*) AS n FROM Pedidos GROUP BY 1, 2, 3"
    ),
)
def a09_group_by_expression(t: Tables) -> DataFrame:
    return t["Pedidos"].groupBy(
        dates.fmt_ym("Fecha_Pedido").alias("Periodo"),
        F.year("Fecha_Pedido").alias("Anio"),
        dates.month_name("Fecha_Pedido").alias("Mes"),
    ).agg(F.count(F.lit(1)).alias("n"))


@query("a10_cascade", star_query(f"SELECT IdCliente, {num('sum(Importe)', 'DeudaContado')} FROM Caja WHERE Fecha < DATE '2000-06-15' GROUP BY 1"))
def a10_cascade(t: Tables) -> DataFrame:
    return cash_balance(t, D(2000, 6, 15))


@query(
    "a11_two_level",
    star_query(
        f"""SELECT idVendedor, count(*) AS dias, {num("sum(q) / CAST(count(*) AS DOUBLE)", "Cantidad")}
FROM (SELECT idVendedor, Fecha, CAST(sum(Cantidad) AS DOUBLE) AS q FROM Ventas GROUP BY 1, 2) GROUP BY 1"""
    ),
)
def a11_two_level(t: Tables) -> DataFrame:
    rows = sold(t).withColumn("Fecha", F.to_date("Fecha_Pedido"))
    return aggregates.day_then_mean(rows, ["idVendedor"], "Fecha", ["Cantidad"])


@query(
    "a12_listagg",
    star_query(
        """SELECT idCliente, string_agg(strftime(Fecha_Pedido, '%d/%m/%Y') || ' R' || idVendedor, ' | ' ORDER BY Fecha_Pedido) AS texto
FROM Pedidos GROUP BY idCliente"""
    ),
)
def a12_listagg(t: Tables) -> DataFrame:
    orders = t["Pedidos"].withColumn("Fecha", F.to_date("Fecha_Pedido"))
    entry = F.concat(dates.fmt_dmy("Fecha"), F.lit(" R"), "idVendedor")
    return aggregates.audit_text(orders, "idCliente", ["Fecha"], entry, " | ")


@query(
    "a12_audit_parts",
    star_query(
        """SELECT idCliente, (n - 1) // 4 AS parte, string_agg(texto, ' | ' ORDER BY n) AS texto FROM (
  SELECT idCliente, texto, row_number() OVER (PARTITION BY idCliente ORDER BY Fecha, texto) AS n FROM (
    SELECT idCliente, CAST(Fecha_Pedido AS DATE) AS Fecha, strftime(Fecha_Pedido, '%d/%m/%Y') || ' R' || idVendedor AS texto
    FROM Pedidos)) GROUP BY 1, 2"""
    ),
)
def a12_audit_parts(t: Tables) -> DataFrame:
    orders = t["Pedidos"].withColumn("Fecha", F.to_date("Fecha_Pedido"))
    entry = F.concat(dates.fmt_dmy("Fecha"), F.lit(" R"), "idVendedor")
    return aggregates.audit_parts(orders, "idCliente", "Fecha", [], entry, " | ", entries=4)


@query(
    "a13_clamp",
    star_query(f"SELECT IdCliente, {num('greatest(sum(Importe - 100000), 0)', 'saldo')} FROM Caja GROUP BY 1"),
)
def a13_clamp(t: Tables) -> DataFrame:
    moves = t["Movimientos_Caja"].select("IdCliente", "Importe").unionByName(
        t["Movimientos_Caja_Ajustes"].select(F.col("idCliente").alias("IdCliente"), "Importe")
    )
    return moves.groupBy("IdCliente").agg(exprs.clamp0(F.sum(F.col("Importe") - 100000)).alias("saldo"))


UNITS = ["STANDARD", "ECONOMY", "MEDIUM", "PROMO", "LARGE", "SMALL"]


@query(
    "a14_pivot",
    star_query(
        "SELECT idVendedor, "
        + ", ".join(num(f"sum(Cantidad) FILTER (WHERE Unidad = '{u}')", u) for u in UNITS[:4])
        + f""", {num(f"sum(Cantidad) FILTER (WHERE Unidad NOT IN {tuple(UNITS[:4])})", "Resto")} FROM Ventas GROUP BY 1"""
    ),
)
def a14_pivot(t: Tables) -> DataFrame:
    return pivots.pivot(sold(t), ["idVendedor"], "Unidad", UNITS[:4], "Cantidad", rest="Resto")


A15_MONTHS = dates.closed_months(D(2001, 8, 1), 24)


@query(
    "a15_dyn_pivot",
    star_query(
        "SELECT idVendedor, Unidad, "
        + ", ".join(
            num(f"coalesce(sum({v}) FILTER (WHERE strftime(Fecha, '%Y-%m') = '{m:%Y-%m}'), 0)", f"{m:%Y-%m} {s}")
            for m in A15_MONTHS
            for v, s in (("Volumen", "CANT"), ("Monto", "FACT"))
        )
        + " FROM Ventas WHERE Fecha >= DATE '1999-08-01' AND Fecha < DATE '2001-08-01' GROUP BY 1, 2"
    ),
)
def a15_dyn_pivot(t: Tables) -> DataFrame:
    orders = t.between("Pedidos", A15_MONTHS[0], D(2001, 8, 1))
    lines = orders.join(sales_lines(t), "idPedido").withColumn("Mes", dates.month_start("Fecha_Pedido"))
    cells = lines.groupBy("idVendedor", "Unidad", "Mes").agg(F.sum(volume()).alias("l"), F.sum(amount()).alias("p"))
    return pivots.month_matrix(cells, ["idVendedor", "Unidad"], "Mes", A15_MONTHS, {"l": "CANT", "p": "FACT"})


@query(
    "a16_fill0",
    star_query(
        "SELECT idVendedor, idProducto, "
        + ", ".join(num(f"coalesce(sum(Cantidad) FILTER (WHERE Unidad = '{u}'), 0)", u) for u in UNITS)
        + " FROM Ventas GROUP BY 1, 2"
    ),
)
def a16_fill0(t: Tables) -> DataFrame:
    return pivots.fill0(pivots.pivot(sold(t), ["idVendedor", "idProducto"], "Unidad", UNITS, "Cantidad"), UNITS)


@query("a17_group_constant", star_query("SELECT idProducto, Abreviatura, count(*) AS n FROM Ventas GROUP BY 1, 2"))
def a17_group_constant(t: Tables) -> DataFrame:
    return sold(t).groupBy("idProducto").agg(F.first("Abreviatura").alias("Abreviatura"), F.count(F.lit(1)).alias("n"))


# --- windows, order, unions


@query("w01_dedupe", star_query("SELECT NroCta, CdRuta FROM (SELECT *, row_number() OVER (PARTITION BY NroCta ORDER BY OrdRut DESC) AS rn FROM ruteo) WHERE rn = 1"))
def w01_dedupe(t: Tables) -> DataFrame:
    stops = t["ClientesRutas"].select(F.col("Cliente_Ruteo").alias("NroCta"), "OrdRut", "CdRuta")
    return windows.dedupe_one(stops, "NroCta", [F.desc("OrdRut"), "CdRuta"]).select("NroCta", "CdRuta")


@query("w02_sequence", star_query("SELECT idCliente, idPedido, rn FROM numerados WHERE rn <= 3", SEQUENCE))
def w02_sequence(t: Tables) -> DataFrame:
    return windows.nth_orders(t["Pedidos"], "idCliente", ["Fecha_Pedido", "idPedido"], 3).select("idCliente", "idPedido", "rn")


EVENTS = """
sucesos AS (
  SELECT IdCliente, Fecha, IdReparto, CASE WHEN IdRecambio IS NOT NULL THEN 'EC' WHEN IdReparto = 146 THEN 'E3' WHEN IdReparto = 147 THEN 'E4' ELSE 'E1' END AS tipo
  FROM Movimientos_Equipos
  UNION ALL SELECT idCliente, Fecha_Pedido, idVendedor, 'E2' FROM Pedidos)
"""


def _events(t: Tables) -> DataFrame:
    moves = t["Movimientos_Equipos"].select(
        "IdCliente", "Fecha", "IdReparto", rules.retirement_event("IdReparto", "IdRecambio").alias("tipo")
    )
    orders = t["Pedidos"].select(
        F.col("idCliente").alias("IdCliente"),
        F.col("Fecha_Pedido").alias("Fecha"),
        F.col("idVendedor").alias("IdReparto"),
        F.lit("E2").alias("tipo"),
    )
    return rowsets.union_events(moves, orders)


@query(
    "w03_priority",
    star_query(
        f"""SELECT IdCliente, tipo, {day("Fecha", "Fecha")}, IdReparto FROM (SELECT *, row_number() OVER (PARTITION BY IdCliente
ORDER BY CASE tipo WHEN 'E3' THEN 1 WHEN 'E4' THEN 2 WHEN 'E1' THEN 3 WHEN 'EC' THEN 4 WHEN 'E2' THEN 5 ELSE 99 END, Fecha DESC, IdReparto) AS rn
FROM sucesos) WHERE rn = 1""",
        EVENTS,
    ),
)
def w03_priority(t: Tables) -> DataFrame:
    return windows.prioritise(_events(t), "IdCliente", rules.event_priority("tipo"), "Fecha", ["IdReparto"])


@query("o01_order_by", star_query("SELECT Unidad, idProducto, Abreviatura FROM Productos ORDER BY Unidad DESC, idProducto"))
def o01_order_by(t: Tables) -> DataFrame:
    return order_by(t["Productos"].select("Unidad", "idProducto", "Abreviatura"), "-Unidad", "idProducto")


@query(
    "o03_top1",
    star_query(
        f"""SELECT idVendedor, Unidad, {num("q", "Cantidad")} FROM (SELECT *, row_number() OVER (PARTITION BY idVendedor ORDER BY q DESC, Unidad) AS rn
FROM (SELECT idVendedor, Unidad, sum(Cantidad) AS q FROM Ventas GROUP BY 1, 2)) WHERE rn = 1"""
    ),
)
def o03_top1(t: Tables) -> DataFrame:
    return aggregates.top1(sold(t), ["idVendedor"], "Unidad", "Cantidad")


@query("o04_rank_desc", star_query("SELECT idVendedor, count(*) AS n FROM Pedidos GROUP BY 1 ORDER BY n DESC, idVendedor DESC"))
def o04_rank_desc(t: Tables) -> DataFrame:
    counts = t["Pedidos"].groupBy("idVendedor").agg(F.count(F.lit(1)).alias("n"))
    return aggregates.rank_desc(counts, "n", "idVendedor")


@query("u01_union_states", star_query("SELECT NroCta, 'Activo' AS Estado FROM Clientes UNION ALL SELECT NroCta, 'Baja' FROM ClientesBaja"))
def u01_union_states(t: Tables) -> DataFrame:
    return rowsets.union_states(t["Clientes"].select("NroCta"), t["ClientesBaja"].select("NroCta"))


@query("u02_union_events", star_query("SELECT tipo, count(*) AS n, count(DISTINCT IdCliente) AS clientes FROM sucesos GROUP BY 1", EVENTS))
def u02_union_events(t: Tables) -> DataFrame:
    return _events(t).groupBy("tipo").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("IdCliente").alias("clientes"))


# --- scalar functions


@query(
    "f02_date_functions",
    star_query(
        f"""SELECT idPedido, {day("Fecha_Pedido + INTERVAL 1 MONTH", "mas_mes")}, {day("Fecha_Pedido - INTERVAL 60 DAY", "menos_60")},
{day("date_trunc('month', Fecha_Pedido)", "mes")}, {day("last_day(Fecha_Pedido - INTERVAL 1 MONTH)", "fin_previo")},
year(Fecha_Pedido) AS anio, month(Fecha_Pedido) AS nmes, strftime(Fecha_Pedido, '%B') AS nombre, dayofweek(Fecha_Pedido) + 1 AS dia,
date_diff('day', Fecha_Pedido, TIMESTAMP '2001-08-15') AS dias FROM Pedidos"""
    ),
)
def f02_date_functions(t: Tables) -> DataFrame:
    when = F.col("Fecha_Pedido")
    return t["Pedidos"].select(
        "idPedido",
        F.add_months(when, 1).alias("mas_mes"),
        F.date_add(when, -60).alias("menos_60"),
        dates.month_start(when).alias("mes"),
        dates.month_end(when, -1).alias("fin_previo"),
        F.year(when).alias("anio"),
        F.month(when).alias("nmes"),
        dates.month_name(when).alias("nombre"),
        dates.weekday(when).alias("dia"),
        dates.days_between(when, F.lit(D(2001, 8, 15))).alias("dias"),
    )


@query(
    "f10_date_formats",
    star_query(
        """SELECT idPedido, strftime(Fecha_Pedido, '%d/%m/%Y') AS dmy, strftime(Fecha_Pedido, '%Y-%m') AS ym, strftime(Fecha_Pedido, '%m-%y') AS my,
CAST(ceil(day(Fecha_Pedido) / 7.0) AS INTEGER) AS semana FROM Pedidos"""
    ),
)
def f10_date_formats(t: Tables) -> DataFrame:
    when = "Fecha_Pedido"
    return t["Pedidos"].select(
        "idPedido",
        dates.fmt_dmy(when).alias("dmy"),
        dates.fmt_ym(when).alias("ym"),
        dates.fmt_my(when).alias("my"),
        dates.week_of_month(when).alias("semana"),
    )


@query(
    "f13_decimal_cast",
    star_query(f"SELECT idPedido, {num('sum(Cantidad)', 'unidades')}, {num('sum(Bultos)', 'bultos')} FROM Ventas GROUP BY 1"),
)
def f13_decimal_cast(t: Tables) -> DataFrame:
    return sales_lines(t).groupBy("idPedido").agg(
        F.sum("Cantidad").cast("decimal(12,2)").alias("unidades"), F.sum(packs()).cast("decimal(18,4)").alias("bultos")
    )


@query(
    "f16_trailing_digits",
    star_query(
        """SELECT ruta, texto, count(*) AS n FROM (SELECT regexp_extract(trim(Refern), '([0-9]+)$', 1) AS texto,
TRY_CAST(nullif(regexp_extract(trim(Refern), '([0-9]+)$', 1), '') AS INTEGER) AS ruta FROM MovTes) GROUP BY 1, 2"""
    ),
)
def f16_trailing_digits(t: Tables) -> DataFrame:
    digits = text.trailing_digits("Refern")
    return t["MovTes"].groupBy(text.try_int(digits).alias("ruta"), digits.alias("texto")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "f18_concat",
    star_query("SELECT IdCliente, Nro_Serie || coalesce(' hasta ' || strftime(Fecha_Baja, '%d/%m/%Y'), '') AS texto FROM maquinas"),
)
def f18_concat(t: Tables) -> DataFrame:
    ended = F.when(F.col("Fecha_Baja").isNull(), "").otherwise(F.concat(F.lit(" hasta "), dates.fmt_dmy("Fecha_Baja")))
    return t["ClientesServicios"].select("IdCliente", F.concat("Nro_Serie", ended).alias("texto"))


@query("f20_quoted_names", star_query('SELECT idPedido, idCliente AS "cliente de `ruta`" FROM Pedidos'))
def f20_quoted_names(t: Tables) -> DataFrame:
    name = "cliente de `ruta`"
    named = t["Pedidos"].withColumnRenamed("idCliente", name)
    return named.select("idPedido", exprs.quote(name))


@query(
    "f21_arithmetic",
    star_query(f"SELECT idVendedor, {num('100 * CAST(sum(CASE WHEN Precio > 0 THEN Volumen ELSE 0 END) AS DOUBLE) / sum(Volumen)', 'pct')} FROM Ventas GROUP BY 1"),
)
def f21_arithmetic(t: Tables) -> DataFrame:
    totals = sold(t).groupBy("idVendedor").agg(
        exprs.sum_if(F.col("Precio") > 0, volume()).cast("double").alias("p"), F.sum(volume()).alias("v")
    )
    return totals.select("idVendedor", exprs.percent("p", "v").alias("pct"))


@query("f22_signed", star_query(f"SELECT NroCta, {num("sum(CASE WHEN DebHab = 'D' THEN Import ELSE -Import END)", "neto")} FROM MovTes GROUP BY 1"))
def f22_signed(t: Tables) -> DataFrame:
    return t["MovTes"].groupBy(text.account_number("NroCta").alias("NroCta")).agg(
        F.sum(exprs.signed("Import", "DebHab")).alias("neto")
    )


@query(
    "f23_legacy_dates",
    star_query(
        """SELECT IdCliente, Nro_Serie, coalesce(strftime(Fecha_Baja, '%d/%m/%Y'), '0') AS texto,
coalesce(date_diff('day', DATE '1900-01-01', CAST(Fecha_Baja AS DATE)), 0) AS dias FROM maquinas"""
    ),
)
def f23_legacy_dates(t: Tables) -> DataFrame:
    return t["ClientesServicios"].select(
        "IdCliente",
        "Nro_Serie",
        dates.legacy_text_date("Fecha_Baja").alias("texto"),
        dates.legacy_day_number("Fecha_Baja").alias("dias"),
    )
