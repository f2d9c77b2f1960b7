"""Queries over stored tables: loads with rejects, rows sent again, compaction, tables as of a day."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog.reports import R07_CTES
from catalog.registry import query
from catalog.star_sql import day, num, star_query
from rivulet.operators.rowsets import shared_folder
from rivulet.plans.orders import amount, raw_lines
from rivulet.plans.reports import risk
from rivulet.sources.csv_files import load_all, rejects
from rivulet.sources.layout import compact, write_lot
from rivulet.sources.lots import LOT, MONTH, Lots, expire
from rivulet.sources.schema import canonical_schema
from rivulet.sources.tables import Tables

D = dt.date


def whole(df: DataFrame, table: str) -> DataFrame:
    """A derived table with all columns of its schema."""
    have = df.columns
    return df.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in canonical_schema(table).fields
        ]
    )


# --- loads with rejects


def _broken_orders(t: Tables) -> str:
    """Orders as CSV of which some cannot be read: a text as key, a vendor and a half, a day that is none."""
    folder = shared_folder(t.spark, "csv")
    nth = F.col("idPedido") % 50
    rows = whole(t["Pedidos"], "Pedidos").select(
        F.when(nth == 0, F.concat(F.lit("x"), "idPedido")).otherwise(F.col("idPedido").cast("string")).alias("idPedido"),
        F.when(nth == 1, F.lit("1.5")).otherwise(F.col("idVendedor").cast("string")).alias("idVendedor"),
        F.when(nth == 2, F.lit("tomorrow")).otherwise(F.date_format("Fecha_Pedido", "yyyy-MM-dd HH:mm:ss")).alias("Fecha_Pedido"),
        *[F.col(f.name).cast("string").alias(f.name) for f in canonical_schema("Pedidos").fields[3:]],
    )
    rows.write.options(header=True).csv(f"{folder}/Pedidos.csv")
    whole(t["repartos"], "repartos").write.options(header=True).csv(f"{folder}/repartos.csv")
    return folder


@query(
    "s02_quarantine",
    star_query(
        """SELECT 'Pedidos' AS tabla, count(*) FILTER (WHERE o_orderkey % 50 > 2) AS filas,
  count(*) FILTER (WHERE o_orderkey % 50 <= 2) AS rechazadas, count(*) FILTER (WHERE o_orderkey % 50 <= 2) AS guardadas FROM orders
UNION ALL SELECT 'repartos', count(*), 0, 0 FROM repartos"""
    ),
)
def s02_quarantine(t: Tables) -> DataFrame:
    """What a load took and what it refused, next to the rows that are kept as refused."""
    stored = shared_folder(t.spark, "loaded")
    _, report = load_all(t.spark, _broken_orders(t), stored, ["Pedidos", "repartos"], quarantine=True)
    kept = [rejects(t.spark, stored, n).groupBy().agg(F.count(F.lit(1)).alias("guardadas")).withColumn("tabla", F.lit(n)) for n in ("Pedidos", "repartos")]
    return report.select("tabla", "filas", "rechazadas").join(kept[0].unionByName(kept[1]), "tabla")


@query(
    "s02_rejects",
    star_query(
        """SELECT o_orderkey AS pedido, 0 AS lote, CASE o_orderkey % 50 WHEN 0 THEN 'idPedido' WHEN 1 THEN 'idVendedor' ELSE 'Fecha_Pedido' END AS columna
FROM orders WHERE o_orderkey % 50 <= 2"""
    ),
)
def s02_rejects(t: Tables) -> DataFrame:
    """The refused orders by the text that was kept of them."""
    stored = shared_folder(t.spark, "loaded")
    load_all(t.spark, _broken_orders(t), stored, ["Pedidos"], quarantine=True)
    text = F.col("_corrupt_record")
    # A row that reads but holds a fraction in a whole column is kept as JSON, others as they stood in the file.
    key = F.coalesce(F.get_json_object(text, "$.idPedido"), F.regexp_extract(text, r"^x?(\d+),", 1))
    column = F.when(text.startswith("x"), "idPedido").when(text.startswith("{"), "idVendedor").otherwise("Fecha_Pedido")
    return rejects(t.spark, stored, "Pedidos").select(
        key.cast("double").cast("long").alias("pedido"), F.col(LOT).alias("lote"), column.alias("columna")
    )


# --- rows that are sent again


def _sent_again(t: Tables) -> str:
    """Orders and lines in two lots. The second moves every 7th order by 40 days, and doubles the quantities
    of every 14th, whose lines come again."""
    folder = shared_folder(t.spark, "stored")
    orders, lines = whole(t["Pedidos"], "Pedidos"), whole(t["Pedidos_Productos"], "Pedidos_Productos")
    write_lot(orders, f"{folder}/Pedidos", "Pedidos", 0)
    write_lot(lines, f"{folder}/Pedidos_Productos", "Pedidos_Productos", 0, orders)
    moved = (F.col("Fecha_Pedido") + F.expr("interval 40 days")).cast("timestamp_ntz")
    write_lot(orders.where("idPedido % 7 = 0").withColumn("Fecha_Pedido", moved), f"{folder}/Pedidos", "Pedidos", 1)
    double = (F.col("Cantidad") * 2).cast("decimal(10,2)")
    again = lines.where("idPedido % 14 = 0").withColumn("Cantidad", double)
    dated = Lots(t.spark, f"{folder}/Pedidos", "Pedidos").read()
    write_lot(again, f"{folder}/Pedidos_Productos", "Pedidos_Productos", 1, dated)
    return folder


RESENT = """
reenviados AS (SELECT idPedido, idCliente, CASE WHEN idPedido % 7 = 0 THEN Fecha_Pedido + INTERVAL 40 DAY ELSE Fecha_Pedido END AS Fecha FROM Pedidos),
vendidos AS (SELECT r.idPedido, r.Fecha, CASE WHEN r.idPedido % 14 = 0 THEN 2 ELSE 1 END * Cantidad AS Cantidad, Precio
  FROM reenviados r JOIN Lineas USING (idPedido))
"""


def _monthly(t: Tables, *window: dt.date) -> DataFrame:
    orders = t.between("Pedidos", *window).select("idPedido", F.trunc("Fecha_Pedido", "month").alias("Mes"))
    lines = orders.join(raw_lines(t, window=window), "idPedido")
    return lines.groupBy("Mes").agg(
        F.count_distinct("idPedido").alias("pedidos"), F.sum("Cantidad").alias("unidades"), F.sum(amount()).alias("monto")
    )


MONTHLY = f"""SELECT {day("date_trunc('month', Fecha)", "Mes")}, count(DISTINCT idPedido) AS pedidos, {num("sum(Cantidad)", "unidades")},
  {num("sum(Cantidad * Precio)", "monto")} FROM vendidos WHERE Fecha >= DATE '1999-03-10' AND Fecha < DATE '1999-07-01' GROUP BY 1"""


@query("s08_sent_again", star_query(MONTHLY, RESENT))
def s08_sent_again(t: Tables) -> DataFrame:
    """Sales of a window over two lots, of which the second replaces orders and lines of the first."""
    stored = Tables.from_parquet(t.spark, _sent_again(t), ["Pedidos", "Pedidos_Productos"])
    return _monthly(stored, D(1999, 3, 10), D(1999, 7, 1))


@query(
    "s08_compacted",
    star_query(
        f"""SELECT *, 0 AS fuera FROM ({MONTHLY})""",
        RESENT,
    ),
)
def s08_compacted(t: Tables) -> DataFrame:
    """The same after both tables became one lot each and the old ones went; `fuera` counts lines that do not
    lie in the month of their order."""
    folder = _sent_again(t)
    compact(t.spark, f"{folder}/Pedidos", "Pedidos")
    compact(t.spark, f"{folder}/Pedidos_Productos", "Pedidos_Productos", Lots(t.spark, f"{folder}/Pedidos", "Pedidos").read())
    for name in ("Pedidos", "Pedidos_Productos"):
        expire(t.spark, f"{folder}/{name}")
    stored = Tables.from_parquet(t.spark, folder, ["Pedidos", "Pedidos_Productos"])
    orders = stored["Pedidos"].select("idPedido", F.trunc("Fecha_Pedido", "month").alias("Mes"))
    apart = orders.join(stored["Pedidos_Productos"].select("idPedido", F.col(MONTH).alias("_en")), "idPedido")
    apart = apart.groupBy("Mes").agg(F.sum((~F.col("Mes").eqNullSafe(F.col("_en"))).cast("int")).alias("fuera"))
    return _monthly(stored, D(1999, 3, 10), D(1999, 7, 1)).join(apart, "Mes")


# --- tables as of a day

DEBT_TABLES = [
    "Clientes", "ClientesBaja", "ClientesRutas", "Rutas", "CondPAGO", "TiposCli",
    "Movimientos_Caja", "Movimientos_Caja_Ajustes", "CtaCteVT",
]


def _later_closures(t: Tables) -> str:
    """The tables of the debt report as known on 1 August 2000, and a load of 1 September that closes every
    second active customer and drops all routes but the first five."""
    folder = shared_folder(t.spark, "stored")
    first, second = D(2000, 8, 1), D(2000, 9, 1)
    for name in DEBT_TABLES:
        write_lot(whole(t[name], name), f"{folder}/{name}", name, 0, day=first)
    people, closed = whole(t["Clientes"], "Clientes"), whole(t["ClientesBaja"], "ClientesBaja")
    gone = people.where("NroCta % 2 = 0").withColumns(
        {"FecBaj": F.lit("2000-08-20").cast("timestamp_ntz"), "CdRuta": F.lit("R0003"), "IdClienteBaja": F.col("NroCta")}
    )
    write_lot(people.where("NroCta % 2 <> 0"), f"{folder}/Clientes", "Clientes", 1, day=second)
    write_lot(closed.unionByName(whole(gone, "ClientesBaja")), f"{folder}/ClientesBaja", "ClientesBaja", 1, day=second)
    write_lot(whole(t["Rutas"].where("Vnddor < 5"), "Rutas"), f"{folder}/Rutas", "Rutas", 1, day=second)
    return folder


@query(
    "s03_as_of_day",
    star_query(
        f"SELECT RUTA, {num('DeudaContado', 'DeudaContado')}, {num('DeudaCtaCte', 'DeudaCtaCte')}, {num('DeudaTotal', 'DeudaTotal')} FROM r07",
        R07_CTES,
    ),
)
def s03_as_of_day(t: Tables) -> DataFrame:
    """Debt by route of 15 August, run after the load of 1 September: as it was then."""
    stored = Tables.from_parquet(t.spark, _later_closures(t), DEBT_TABLES, as_of=D(2000, 8, 15))
    return risk.debt_by_route(stored, D(2000, 8, 15), routes=range(25), exclude=())


@query(
    "s03_as_of_later",
    star_query(
        "SELECT CAST(count(*) FILTER (WHERE NroCta % 2 <> 0) AS BIGINT) AS activos, "
        "(SELECT count(*) FROM ClientesBaja) + count(*) FILTER (WHERE NroCta % 2 = 0) AS bajas, 5 AS rutas FROM Clientes"
    ),
)
def s03_as_of_later(t: Tables) -> DataFrame:
    """The same tables as known after the second load."""
    stored = Tables.from_parquet(t.spark, _later_closures(t), DEBT_TABLES, as_of=D(2000, 9, 1))
    counts = [stored[n].groupBy().agg(F.count(F.lit(1)).alias(as_)) for n, as_ in (("Clientes", "activos"), ("ClientesBaja", "bajas"), ("Rutas", "rutas"))]
    return t.spark.range(1).select(*[c.scalar().alias(c.columns[0]) for c in counts])
