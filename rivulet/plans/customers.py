"""Customer universe shared by the reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.functions.rules import SEGMENT_ATTRIBUTE
from rivulet.operators.rowsets import union_states
from rivulet.operators.windows import dedupe_one
from rivulet.sources.tables import Tables


def route_test(column: str, routes: Sequence[int] | None, exclude: Sequence[int] | None) -> Column:
    """The route is known, in `routes` and not in `exclude`. A customer with no route fails either
    list, as a comparison with NULL does."""
    test = F.col(column).isNotNull()
    if routes is not None:
        test = test & F.col(column).isin(*routes)
    if exclude:
        test = test & ~F.col(column).isin(*exclude)
    return test


def customer_route(
    t: Tables, routes: Sequence[int] | None = None, exclude: Sequence[int] | None = None
) -> DataFrame:
    """(NroCta, RUTA), one row per customer: the first of its assigned routes that passes the test,
    by visiting order and then code. Deduplicated before any join, so a customer on many routes is
    one row from here on."""
    vendors = t["Rutas"].select("Codigo", F.col("Vnddor").alias("RUTA"))
    stops = t["ClientesRutas"].select(F.col("Cliente_Ruteo").alias("NroCta"), "OrdRut", "CdRuta")
    joined = stops.join(vendors, stops.CdRuta == vendors.Codigo).filter(route_test("RUTA", routes, exclude))
    return dedupe_one(joined, "NroCta", ["OrdRut", "CdRuta"]).select("NroCta", "RUTA")


def customer_region(t: Tables) -> DataFrame:
    """(NroCta, CodSup): the supervisor of each customer's route."""
    heads = t["repartos"].select(F.col("Codigo").alias("RUTA"), "CodSup")
    return customer_route(t).join(heads, "RUTA").select("NroCta", "CodSup")


def active_customers(
    t: Tables, routes: Sequence[int] | None = None, exclude: Sequence[int] | None = None
) -> DataFrame:
    """Active customers on a route that passes, with that route as `RUTA`."""
    return t["Clientes"].join(customer_route(t, routes, exclude), "NroCta")


def closed_customers(
    t: Tables, routes: Sequence[int] | None = None, exclude: Sequence[int] | None = None
) -> DataFrame:
    """Closure records on a route that passes; an account closed twice has two."""
    vendors = t["Rutas"].select(F.col("Codigo").alias("CdRuta"), F.col("Vnddor").alias("RUTA"))
    return t["ClientesBaja"].join(vendors, "CdRuta").filter(route_test("RUTA", routes, exclude))


def latest_closure(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The most recent closure record per key."""
    return dedupe_one(df, keys, [F.desc_nulls_last("FecBaj"), F.desc("IdClienteBaja")])


def one_per_account(active: DataFrame, closed: DataFrame) -> DataFrame:
    """Both customer tables as one row per account: the active record if there is one, else the
    latest closure. Closures are reduced before the union, where that still happens in the map
    tasks."""
    people = union_states(active, latest_closure(closed, ["NroCta"]))
    return dedupe_one(people, "NroCta", ["Estado"])


def with_terms(t: Tables, df: DataFrame) -> DataFrame:
    """Payment code and label (CndPagCod, MediodePago); customers of unknown terms drop."""
    dim = t["CondPAGO"].select(F.col("Codigo").alias("CndPagCod"), F.rtrim("Descrp").alias("MediodePago"))
    return df.join(dim, df.CndPag == dim.CndPagCod)


def with_type(t: Tables, df: DataFrame) -> DataFrame:
    """Label of the customer type (TipCliDes); customers of unknown type drop."""
    dim = t["TiposCli"].select(F.col("Codigo").alias("_tipo"), F.col("Descrp").alias("TipCliDes"))
    return df.join(dim, df.TipCli == dim._tipo).drop("_tipo")


def with_category(t: Tables, df: DataFrame, how: str) -> DataFrame:
    """Label of the category (Descripcion)."""
    dim = t["Categorias"].select(F.col("Categoria").alias("_categoria"), "Descripcion")
    return df.join(dim, df.Categoria == dim._categoria, how).drop("_categoria")


def with_segment(t: Tables, df: DataFrame, how: str) -> DataFrame:
    """Label of the segment attribute (AtrDes). The attribute number is part of the join, and a
    code listed twice counts once, so no customer is multiplied."""
    rows = t["ClientesAtrLis"].filter(F.col("AtrNro") == SEGMENT_ATTRIBUTE)
    dim = rows.groupBy(F.col("AtrCod").alias("_atributo")).agg(F.min("AtrDes").alias("AtrDes"))
    return df.join(dim, df.Atrib5 == dim._atributo, how).drop("_atributo")
