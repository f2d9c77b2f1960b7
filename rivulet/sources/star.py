"""The business tables derived from a star schema of customers, orders, lines and parts.

Every table is a lazy view over the Parquet files, so a report on it reads only the files and columns
it needs. `catalog/star_sql.py` states the same definitions in SQL.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.operators.joins import splittable
from rivulet.operators.rowsets import values
from rivulet.sources.tables import Tables

SUPERVISOR_BASE = 1000

# Small catalogs the star schema has no table for.
PAYMENT_TERMS = [(1, "CONTADO", 0), (2, "CTA CTE 30", 30), (3, "CTA CTE 60", 60), (4, "CTA CTE 90", 90)]
CATEGORIES = [("CAT-A", "Premium"), ("CAT-B", "Standard"), ("CAT-C", "Basic"), ("CAT-D", "Migrated")]
ATTRIBUTES = [(5, "1", "Uno"), (5, "2", "Dos"), (5, "3", "Tres"), (5, "4", "Cuatro"), (4, "1", "Otro")]
METHODS = [("EFE", "Efectivo", "D"), ("CHQ", "Cheque", "D"), ("TRF", "Transferencia", "D"), ("DIG", "Digital", "D")]
DOCUMENTS = [("FACA", "Factura", "D"), ("RECA", "Recibo", "H")]
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def star_tables(spark: SparkSession, sf_dir: str) -> Tables:
    """The 21 tables over the star schema at `sf_dir`."""

    @functools.cache
    def read(name: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")

    def clientes() -> DataFrame:
        return _accounts(read, closed=False).select(
            "NroCta", "Nombre", "Direcc", "Telefn", "Categoria", "TipCli", "CndPag", "Atrib5", "FecAlt"
        )

    def clientes_baja() -> DataFrame:
        return _accounts(read, closed=True).select(
            F.col("NroCta").alias("IdClienteBaja"), "NroCta", "Nombre", "Direcc", "Telefn", "Categoria",
            "TipCli", "CndPag", "Atrib5", "FecAlt",
            (F.col("primer") + F.make_dt_interval(days=(F.col("NroCta") % 2000).cast("int"))).alias("FecBaj"),
            _route_code(F.col("c_nationkey")).alias("CdRuta"),
        )

    def clientes_rutas() -> DataFrame:
        home = F.col("c_nationkey")
        second = (home + 1) % 25
        stops = F.when(F.col("c_custkey") % 10 == 0, F.array(home, second)).otherwise(F.array(home))
        return read("customer").select(
            F.col("c_custkey").alias("Cliente_Ruteo"), F.posexplode(stops).alias("pos", "stop")
        ).select("Cliente_Ruteo", (F.col("pos") + 1).alias("OrdRut"), _route_code(F.col("stop")).alias("CdRuta"),
                 F.lit(1).alias("Estado"))

    def rutas() -> DataFrame:
        return read("nation").select(
            _route_code(F.col("n_nationkey")).alias("Codigo"),
            F.col("n_name").alias("Descrp"),
            F.col("n_nationkey").alias("Vnddor"),
        )

    def repartos() -> DataFrame:
        supervisor = F.col("n_regionkey") + SUPERVISOR_BASE
        vendors = read("nation").select(
            F.col("n_nationkey").alias("Codigo"), F.col("n_name").alias("Descrp"), supervisor.alias("CodSup")
        )
        own = F.col("r_regionkey") + SUPERVISOR_BASE
        heads = read("region").select(own.alias("Codigo"), F.col("r_name").alias("Descrp"), own.alias("CodSup"))
        return vendors.unionByName(heads)

    def productos() -> DataFrame:
        return read("part").select(
            F.col("p_partkey").alias("idProducto"),
            F.col("p_name").alias("Descripcion"),
            F.col("p_name").alias("Abreviatura"),
            F.when(F.col("p_type") == "SMALL", 0).otherwise(F.col("p_size")).cast("decimal(10,2)").alias("Litros"),
            F.col("p_type").alias("Unidad"),
            F.when(F.col("p_type") == "PROMO", 12).alias("cantidad_x_bulto"),
        )

    def pedidos() -> DataFrame:
        # Keyed by the aggregate, so Spark drops this join from plans that need no vendor.
        vendor = read("customer").groupBy("c_custkey").agg(F.max("c_nationkey").alias("idVendedor"))
        orders = read("orders").select(
            F.col("o_orderkey").alias("idPedido"),
            F.col("o_custkey").alias("idCliente"),
            F.col("o_orderdate").alias("Fecha_Pedido"),
            F.lit("PR").alias("Status"),
        )
        joined = orders.join(splittable(vendor), F.col("idCliente") == F.col("c_custkey"), "left")
        return joined.select("idPedido", "idVendedor", "Fecha_Pedido", "idCliente", "Status")

    def pedidos_productos() -> DataFrame:
        # Discounts are whole cents; comparing doubles spares a decimal conversion per line.
        free = F.abs(F.col("l_discount") - 0.10) < 0.005
        price = F.when(free, 0).otherwise(F.col("l_extendedprice").cast("decimal(15,2)"))
        return read("lineitem").select(
            F.col("l_orderkey").alias("idPedido"),
            F.col("l_partkey").alias("idProducto"),
            F.col("l_quantity").cast("decimal(10,2)").alias("Cantidad"),
            price.cast("decimal(15,2)").alias("Precio"),
        )

    def clientes_servicios() -> DataFrame:
        return _equipment(read).select("IdCliente", "Nro_Serie", "Fecha_Desde", "Fecha_Baja", F.lit("AC").alias("IdProducto"))

    def movimientos_equipos() -> DataFrame:
        unit = F.col("l_suppkey") % 10
        return (
            _equipment(read)
            .filter(F.col("Fecha_Baja").isNotNull())
            .select(
                F.col("Fecha_Baja").alias("Fecha"),
                F.when(unit == 0, 146).when(unit == 1, 147).otherwise(F.col("l_suppkey")).cast("int").alias("IdReparto"),
                "IdCliente",
                F.lit("AC").alias("IdProducto"),
                F.lit("R").alias("Tipo_Movimiento"),
                F.when(F.col("l_linenumber") == 7, 1).when(F.col("l_linenumber") == 6, 0).cast("short").alias("Anulado"),
                F.when(F.col("l_linestatus") == "O", F.col("l_orderkey")).alias("IdRecambio"),
            )
        )

    def movimientos_caja() -> DataFrame:
        amount = F.col("o_totalprice").cast("decimal(18,2)")
        return (
            read("orders")
            .filter(_cash())
            .select(
                F.col("o_custkey").alias("IdCliente"),
                F.col("o_orderkey").alias("IdPedido"),
                F.col("o_orderdate").alias("Fecha"),
                F.explode(_settled(amount)).alias("Importe"),
            )
        )

    def ajustes() -> DataFrame:
        return (
            read("orders")
            .filter(_cash() & (F.col("o_orderpriority") == "1-URGENT"))
            .select(
                F.col("o_orderkey").alias("idAjuste"),
                F.col("o_custkey").alias("idCliente"),
                F.col("o_orderdate").alias("Fecha"),
                F.lit("25.50").cast("decimal(18,2)").alias("Importe"),
                F.lit("JOB_AJUSTE").alias("Usuario"),
            )
        )

    def cta_cte() -> DataFrame:
        amount = F.col("o_totalprice").cast("decimal(18,2)")
        paid = F.col("pos") == 1
        return (
            read("orders")
            .filter(~_cash())
            .select("o_orderkey", "o_custkey", "o_orderdate", F.posexplode(_settled(amount)).alias("pos", "Import"))
            .select(
                F.when(paid, "RECA").otherwise("FACA").alias("CodMov"),
                F.col("o_orderkey").alias("NroMov"),
                F.lit(1).alias("NrItem"),
                F.col("o_orderdate").alias("FchMov"),
                F.col("o_custkey").cast("string").alias("NroCta"),
                F.when(paid, "FACA").alias("CodApl"),
                F.when(paid, F.col("o_orderkey")).alias("NroApl"),
                "Import",
            )
        )

    def mov_tes() -> DataFrame:
        level = F.substring("o_orderpriority", 1, 1)
        # Treasury method per order priority.
        codes = {"1": "EFE", "2": "CHQ", "3": "TRF", "4": "DIG", "5": "RET"}
        method = F.when(F.col("o_orderkey") % 40 == 0, "CCB")
        for digit, code in codes.items():
            method = method.when(level == digit, code)
        closing = F.concat(
            F.lit("CIERRE DIARIO RUTA "), F.lpad((F.col("o_custkey") % 25).cast("string"), 4, "0")
        )
        return read("orders").select(
            F.lit("RC").alias("CodMov"),
            F.col("o_orderkey").alias("NroMov"),
            F.lit(1).alias("NrItem"),
            F.col("o_orderdate").alias("FchMov"),
            F.col("o_custkey").cast("string").alias("NroCta"),
            F.when(F.col("o_orderstatus") == "P", "SIN RUTA").otherwise(closing).alias("Refern"),
            method.alias("CodCpt"),
            F.col("o_totalprice").cast("decimal(18,2)").alias("Import"),
            F.when(F.col("o_orderkey") % 25 == 1, "H").otherwise("D").alias("DebHab"),
        )

    def parents() -> DataFrame:
        key = F.col("c_custkey")
        return read("customer").filter(key % 10 < 5).select(
            key.alias("IdCliente"), (key - key % 10).alias("Cta_Madre")
        )

    def precios() -> DataFrame:
        return read("part").select(
            F.col("p_partkey").alias("idProducto"), F.col("p_retailprice").cast("decimal(15,2)").alias("PrecioLista")
        )

    return Tables(
        spark,
        {
            "CondPAGO": lambda: values(spark, PAYMENT_TERMS, ["Codigo", "Descrp", "DiasCR"]),
            "TiposCli": lambda: values(spark, [(s, s) for s in SEGMENTS], ["Codigo", "Descrp"]),
            "Categorias": lambda: values(spark, CATEGORIES, ["Categoria", "Descripcion"]),
            "ClientesAtrLis": lambda: values(spark, ATTRIBUTES, ["AtrNro", "AtrCod", "AtrDes"]),
            "CteVtas": lambda: values(spark, DOCUMENTS, ["Codigo", "Descrp", "DebHab"]),
            "CptTes": lambda: values(spark, METHODS, ["Codigo", "Descrp", "DebHab"]),
            "Productos": productos,
            "Rutas": rutas,
            "repartos": repartos,
            "Clientes": clientes,
            "ClientesBaja": clientes_baja,
            "ClientesRutas": clientes_rutas,
            "Clientes_Ctas_Madres_e_Hijas": parents,
            "ClientesServicios": clientes_servicios,
            "Movimientos_Equipos": movimientos_equipos,
            "Pedidos": pedidos,
            "Pedidos_Productos": pedidos_productos,
            "Movimientos_Caja": movimientos_caja,
            "Movimientos_Caja_Ajustes": ajustes,
            "CtaCteVT": cta_cte,
            "MovTes": mov_tes,
        },
        extra={"PreciosLista": precios},
    )


def _route_code(nation: Column) -> Column:
    return F.concat(F.lit("R"), F.lpad(nation.cast("string"), 4, "0"))


def _cash() -> Column:
    return F.col("o_custkey") % 4 == 0


def _settled(amount: Column) -> Column:
    """The sale, and its payment once the order is finished."""
    return F.when(F.col("o_orderstatus") == "F", F.array(amount, (-amount).cast("decimal(18,2)"))).otherwise(
        F.array(amount)
    )


def _accounts(read, closed: bool) -> DataFrame:
    first = read("orders").groupBy("o_custkey").agg(F.min("o_orderdate").alias("primer"))
    balance = F.col("c_acctbal")
    people = read("customer").filter(balance < 0 if closed else balance >= 0)
    key = F.col("c_custkey")
    category = F.element_at(F.array(*[F.lit(code) for code, _ in CATEGORIES]), (key % 4 + 1).cast("int"))
    return people.join(first, people.c_custkey == first.o_custkey, "left").select(
        key.alias("NroCta"),
        F.col("c_name").alias("Nombre"),
        F.concat("c_name", F.lit(" - "), "c_mktsegment").alias("Direcc"),
        F.concat(F.lit("T"), key.cast("string")).alias("Telefn"),
        category.alias("Categoria"),
        F.col("c_mktsegment").alias("TipCli"),
        (key % 4 + 1).cast("int").alias("CndPag"),
        (key % 5).cast("string").alias("Atrib5"),
        (F.col("primer") - F.make_dt_interval(days=(key % 90).cast("int"))).alias("FecAlt"),
        "primer",
        "c_nationkey",
    )


def _equipment(read) -> DataFrame:
    """One machine per line of a LARGE part."""
    machines = read("part").filter(F.col("p_type") == "LARGE").select("p_partkey")
    lines = read("lineitem").join(machines, F.col("l_partkey") == F.col("p_partkey"), "left_semi")
    orders = read("orders").select("o_orderkey", "o_custkey", "o_orderdate")
    ended = F.col("o_orderdate") + F.make_dt_interval(days=F.lit(400))
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("IdCliente"),
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_partkey").cast("string")).alias("Nro_Serie"),
        F.col("o_orderdate").alias("Fecha_Desde"),
        F.when(F.col("l_returnflag") == "R", ended).alias("Fecha_Baja"),
        "l_suppkey",
        "l_orderkey",
        "l_linenumber",
        "l_linestatus",
    )
