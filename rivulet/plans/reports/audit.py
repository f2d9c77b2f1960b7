"""Row counts, an audit of keys, and the order each report is shown in."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.sources.tables import Tables

# Sort keys of the reports, `-` for descending.
REPORT_ORDER = {
    "acquisitions_by_channel": ["RUTA", "NroCta"],
    "realised_acquisitions": ["NroCta", "Periodo"],
    "first_purchase_products": ["NroCta", "idProducto"],
    "repurchase": ["NroCta"],
    "equipment_retention": ["NroCta"],
    "litres_per_equipment": ["-ConsumoLitros"],
    "debt_by_route": ["-DeudaTotal"],
    "monthly_sales_matrix": ["NroCta", "Ruta", "idProducto"],
    "holiday_recovery": ["-ARecuperarConsumo"],
    "table_counts": ["-Filas"],
}

# The columns that name a row of each table.
KEYS: dict[str, list[str]] = {
    "CondPAGO": ["Codigo"],
    "TiposCli": ["Codigo"],
    "Categorias": ["Categoria"],
    "ClientesAtrLis": ["AtrNro", "AtrCod"],
    "CteVtas": ["Codigo"],
    "CptTes": ["Codigo"],
    "Productos": ["idProducto"],
    "Rutas": ["Codigo"],
    "repartos": ["Codigo"],
    "Clientes": ["NroCta"],
    "ClientesBaja": ["IdClienteBaja"],
    "ClientesRutas": ["CdRuta", "Cliente_Ruteo"],
    "Clientes_Ctas_Madres_e_Hijas": ["IdCliente"],
    "ClientesServicios": ["IdCliente", "IdServicio", "NrItem"],
    "Movimientos_Equipos": ["IdMovimiento"],
    "Pedidos": ["idPedido"],
    "Movimientos_Caja": ["IdMovimiento"],
    "Movimientos_Caja_Ajustes": ["idAjuste"],
    "CtaCteVT": ["CodMov", "NroMov", "NrItem"],
    "MovTes": ["CodMov", "NroMov", "NrItem"],
}

ACCOUNTS = [("Clientes", "NroCta"), ("ClientesBaja", "NroCta")]

# Columns that name a row of another table, or of one of two.
REFERENCES: dict[tuple[str, str], list[tuple[str, str]]] = {
    ("Clientes", "CndPag"): [("CondPAGO", "Codigo")],
    ("Clientes", "TipCli"): [("TiposCli", "Codigo")],
    ("Clientes", "Categoria"): [("Categorias", "Categoria")],
    ("ClientesRutas", "CdRuta"): [("Rutas", "Codigo")],
    ("ClientesRutas", "Cliente_Ruteo"): ACCOUNTS,
    ("Clientes_Ctas_Madres_e_Hijas", "Cta_Madre"): ACCOUNTS,
    ("ClientesServicios", "IdCliente"): ACCOUNTS,
    ("Movimientos_Equipos", "IdCliente"): ACCOUNTS,
    ("Pedidos", "idCliente"): ACCOUNTS,
    ("Pedidos", "idVendedor"): [("repartos", "Codigo")],
    ("Pedidos_Productos", "idPedido"): [("Pedidos", "idPedido")],
    ("Pedidos_Productos", "idProducto"): [("Productos", "idProducto")],
    ("Movimientos_Caja", "IdCliente"): ACCOUNTS,
    ("Movimientos_Caja_Ajustes", "idCliente"): ACCOUNTS,
    ("MovTes", "CodCpt"): [("CptTes", "Codigo")],
}


def key_audit(
    t: Tables,
    keys: Mapping[str, Sequence[str]] = KEYS,
    references: Mapping[tuple[str, str], Sequence[tuple[str, str]]] = REFERENCES,
) -> DataFrame:
    """(Tabla, Regla, Columnas, Filas, Nulas, Claves, Filas_Malas): each key (`clave`: rows beyond the first of a
    key) and each reference (`referencia`: rows whose value no row of the named tables has). Rows with a null in the
    columns are counted in Nulas only; Claves are the distinct values that break the rule.

    Each rule reads its own columns and counts rows per value before anything is joined, so a hot value is one
    row of the anti join.
    """
    rules = []

    def counted(table: str, columns: Sequence[str]) -> DataFrame:
        whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
        rows = t[table].select(*[F.col(c).alias(f"_{i}") for i, c in enumerate(columns)], whole.alias("_whole"))
        return rows.groupBy(*[f"_{i}" for i in range(len(columns))], "_whole").agg(F.count(F.lit(1)).alias("_n"))

    def rule(table: str, name: str, columns: Sequence[str], values: DataFrame, bad: Column) -> DataFrame:
        wrong = F.col("_whole") & (bad > 0)
        none = F.lit(0).cast("long")
        total = lambda amount: F.coalesce(F.sum(amount), none)
        return values.agg(
            total(F.col("_n")).alias("Filas"),
            total(F.when(~F.col("_whole"), F.col("_n"))).alias("Nulas"),
            F.count_if(wrong).alias("Claves"),
            total(F.when(wrong, bad)).alias("Filas_Malas"),
        ).select(
            F.lit(table).alias("Tabla"), F.lit(name).alias("Regla"), F.lit(", ".join(columns)).alias("Columnas"),
            "Filas", "Nulas", "Claves", "Filas_Malas",
        )

    for table, columns in keys.items():
        rules.append(rule(table, "clave", columns, counted(table, columns), F.col("_n") - 1))
    for (table, column), parents in references.items():
        known = reduce(DataFrame.unionByName, [t[name].select(F.col(c).alias("_of")) for name, c in parents])
        known = known.distinct().withColumn("_known", F.lit(True))
        values = counted(table, [column]).join(known, F.col("_0") == F.col("_of"), "left")
        rules.append(rule(table, "referencia", [column], values, F.when(F.col("_known").isNull(), F.col("_n"))))
    return reduce(DataFrame.unionByName, rules)


def table_counts(t: Tables) -> DataFrame:
    """Rows of every table."""
    counts = [
        t[name].agg(F.count(F.lit(1)).alias("Filas")).select(F.lit(name).alias("Tabla"), "Filas") for name in t.names()
    ]
    return reduce(DataFrame.unionByName, counts)


def order_by(df: DataFrame, *keys: str) -> DataFrame:
    """Sorted by the keys, `-key` descending. A sort is the last step of a report: inside a plan it
    only costs an exchange."""
    return df.orderBy(*[F.desc(k[1:]) if k.startswith("-") else F.asc(k) for k in keys])


def in_report_order(df: DataFrame, report: str) -> DataFrame:
    """A report's rows in the order it is shown."""
    if report == "collections_by_route":
        return df.orderBy("RUTA", F.substring("Mes", 4, 2), F.substring("Mes", 1, 2))
    if report == "community_consumption":
        month = F.to_date(F.concat_ws(" ", "AÑO", "MES"), "yyyy MMMM")
        return df.orderBy("Urbanizacion", "idCliente", month)
    return order_by(df, *REPORT_ORDER[report])
