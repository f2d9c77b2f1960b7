"""New customers: where they come from, what they first buy, and whether they come back."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rivulet.functions import rules
from rivulet.functions.dates import day_after, days_between, first_of_month, fmt_dmy, fmt_ym, legacy_text_date
from rivulet.functions.exprs import any_flag
from rivulet.functions.text import like
from rivulet.operators.joins import facts_of, restrict
from rivulet.operators.rowsets import union_states
from rivulet.operators.windows import nth_pair
from rivulet.plans.customers import (
    active_customers,
    closed_customers,
    latest_closure,
    with_category,
    with_segment,
    with_terms,
    with_type,
)
from rivulet.plans.orders import amount, first_order, lines_of, order_totals, purchases
from rivulet.sources.layout import in_window
from rivulet.sources.tables import Tables


def _orders_of(t: Tables, accounts: DataFrame, before: dt.date | None = None) -> DataFrame:
    """Orders of the accounts. A report passes the accounts by registration date alone: a narrow
    scan that holds all its customers, without computing them twice."""
    return facts_of(t.between("Pedidos", before=before), accounts, "idCliente", "NroCta")


def _registered_since(t: Tables, table: str, since: dt.date, before: dt.date | None = None) -> DataFrame:
    return in_window(t[table], "FecAlt", since, before).filter(F.col("NroCta") != 0).select("NroCta")


def registrations(
    t: Tables,
    as_of: dt.date,
    months: int = 3,
    exclude: Sequence[int] = rules.NON_COMMERCIAL_ROUTES,
    legacy_sentinels: bool = False,
) -> DataFrame:
    """Customers registered from the start of the month `months` back to `as_of`, by channel and state.
    No order is read.

    A customer both active and closed has a row for each state. Customers without a commercial
    route do not count.
    """
    since = first_of_month(as_of, -months)
    columns = ["NroCta", "RUTA", "FecAlt", "canal", "Nombre", "Direcc", "Telefn", "Categoria"]

    def registered(people: DataFrame) -> DataFrame:
        recent = in_window(people, "FecAlt", since, day_after(as_of)).filter(
            (F.col("NroCta") != 0) & like("Direcc", f"%{rules.DEPOT_ADDRESS}%", negate=True)
        )
        return recent.withColumn("canal", rules.channel("Categoria")).filter(F.col("canal").isNotNull())

    active = registered(active_customers(t, exclude=exclude)).select(*columns)
    closed = latest_closure(registered(closed_customers(t, exclude=exclude)), ["NroCta", "canal"])
    customers = union_states(active, closed.select(*columns, F.to_date("FecBaj").alias("FecBaj")))
    closed_on = legacy_text_date("FecBaj") if legacy_sentinels else fmt_dmy("FecBaj")
    return with_category(t, customers, "inner").select(
        "RUTA",
        fmt_dmy("FecAlt").alias("FECALT"),
        closed_on.alias("FECBAJ"),
        "NroCta",
        "Estado",
        F.col("canal").alias("Categoria"),
        "Nombre",
        "Direcc",
        "Telefn",
        "Descripcion",
    )


def acquisitions_by_channel(
    t: Tables,
    as_of: dt.date,
    months: int = 3,
    exclude: Sequence[int] = rules.NON_COMMERCIAL_ROUTES,
    legacy_sentinels: bool = False,
) -> DataFrame:
    """The `registrations` with their first order of water or soda up to `as_of` and the kind of
    promotion it was. A rerun for the same day gives the same answer, whatever was sold since."""
    customers = registrations(t, as_of, months, exclude, legacy_sentinels)
    since, before = first_of_month(as_of, -months), day_after(as_of)
    accounts = _registered_since(t, "Clientes", since, before).union(
        _registered_since(t, "ClientesBaja", since, before)
    )
    first = first_order(t, "liquid", _orders_of(t, accounts, before), (None, before)).select(
        F.col("idCliente").alias("NroCta"),
        F.col("idPedido").alias("PrimerPedido"),
        F.col("Fecha_Pedido").alias("FechaPrimerPedido"),
        F.col("Importe").alias("TotalImportePedido"),
        F.col("LineaPrecio0").alias("TieneLineaPrecio0"),
    )
    return customers.join(first, "NroCta", "left").select(
        *customers.columns,
        "PrimerPedido",
        "FechaPrimerPedido",
        "TotalImportePedido",
        "TieneLineaPrecio0",
        rules.promo_class(F.col("PrimerPedido"), "TotalImportePedido", "TieneLineaPrecio0").alias("TipoPromo"),
    )


def _new_customers(t: Tables, registered_after: dt.date | None, routes: Sequence[int] | None, segment: str) -> DataFrame:
    """Active routed customers with their labels, registered strictly after a day."""
    people = active_customers(t, routes).filter((F.col("NroCta") != 0) & (F.col("Direcc") != rules.DEPOT_ADDRESS))
    if registered_after is not None:
        people = people.filter(F.col("FecAlt") > F.lit(registered_after.isoformat()).cast("timestamp_ntz"))
    people = with_category(t, with_type(t, with_terms(t, people)), "left")
    return with_segment(t, people, segment).select(
        "NroCta",
        "Nombre",
        F.col("Direcc").alias("Direccion"),
        "FecAlt",
        "RUTA",
        F.col("TipCliDes").alias("TipCli"),
        F.col("Descripcion").alias("Categoria"),
        F.col("AtrDes").alias("Atributo"),
        F.col("MediodePago").alias("CndPag"),
    )


def realised_acquisitions(
    t: Tables,
    from_: dt.date,
    to: dt.date,
    routes: Sequence[int] = rules.GASTRO_ROUTES,
    registered_after: dt.date | None = None,
) -> DataFrame:
    """Customers whose first paid line falls in the window, with spend and packs per month.

    By default they registered after the start of the month two before the window's first. Orders
    after the window are never read; once the first one is in it, so are all that remain.
    """
    cut = first_of_month(from_, -2) if registered_after is None else registered_after
    customers = _new_customers(t, cut, routes, "inner")
    orders = _orders_of(t, _registered_since(t, "Clientes", cut), before=day_after(to)).select(
        "idPedido", "idCliente", F.to_date("Fecha_Pedido").alias("Fecha")
    )
    lines = lines_of(t, orders, paid=True, window=(None, day_after(to)))
    paid = order_totals(lines, "idCliente", "Fecha")
    monthly = paid.groupBy("idCliente", fmt_ym("Fecha").alias("Periodo")).agg(
        F.min("Fecha").alias("_first"),
        F.sum("Importe").alias("Consumo"),
        F.sum("BultosPedido").cast("decimal(18,4)").alias("Bultos"),
    )
    first = F.min("_first").over(Window.partitionBy("idCliente"))
    realised = monthly.withColumn("FechaPrimeraCompra", first).filter(F.col("FechaPrimeraCompra") >= F.lit(from_))
    return customers.join(realised.drop("_first"), F.col("NroCta") == F.col("idCliente")).drop("idCliente")


def first_purchase_products(t: Tables) -> DataFrame:
    """Products of each customer's first order, with the kind of promotion.

    The first order counts all orders, so one without water or soda yields no row.
    """
    first = first_order(t, "all").select("idPedido", "idCliente")
    lines = first.join(t["Pedidos_Productos"], "idPedido")
    bought = lines.groupBy(F.col("idCliente").alias("NroCta"), "idProducto").agg(
        F.sum(amount()).alias("TotalImporteProducto"), any_flag(F.col("Precio") == 0).alias("TieneLineaPrecio0")
    )
    products = t["Productos"].filter(F.col("Litros") > 0).select("idProducto", "Abreviatura")
    return bought.join(products, "idProducto").select(
        "NroCta",
        "idProducto",
        "Abreviatura",
        "TotalImporteProducto",
        "TieneLineaPrecio0",
        rules.promo_class(None, "TotalImporteProducto", "TieneLineaPrecio0").alias("TipoPromo"),
    )


def repurchase(
    t: Tables,
    as_of: dt.date,
    months: int | None = 3,
    cohort: DataFrame | None = None,
) -> DataFrame:
    """First and second paid order, up to `as_of`, of the customers registered after the start of
    the month `months` back (all of them without `months`) and by `as_of`, and the days between. A
    customer yet to buy, or to buy again, stays with NULLs. `cohort` limits the report to its `NroCta`."""
    cut, before = None if months is None else first_of_month(as_of, -months), day_after(as_of)
    customers = in_window(_new_customers(t, cut, None, "left"), "FecAlt", None, before)
    customers = restrict(customers, cohort, "NroCta")
    orders = t.between("Pedidos", None, before)
    if cut is not None:
        orders = _orders_of(t, _registered_since(t, "Clientes", cut, before), before)
    orders = restrict(orders, cohort, "idCliente", "NroCta")
    pair = nth_pair(
        purchases(t, "paid", orders, (None, before)),
        "idCliente",
        ["Fecha_Pedido", "idPedido"],
        {
            "Fecha_Pedido": ("FechaPrimeraCompra", "FechaSegundaCompra"),
            "Importe": ("ImportePrimeraCompra", "ImporteSegundaCompra"),
        },
    )
    joined = customers.join(pair, F.col("NroCta") == F.col("idCliente"), "left").drop("idCliente")
    return joined.withColumn("DiasEntreCompras", days_between("FechaPrimeraCompra", "FechaSegundaCompra"))
