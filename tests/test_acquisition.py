import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F
from world import acquisitions_world

from rivulet.plans.kpi import acquisition as ka
from rivulet.plans.reports import acquisition

AS_OF = dt.date(2026, 5, 19)


def test_channels_states_and_promotions(spark):
    rows = acquisition.acquisitions_by_channel(acquisitions_world(spark), AS_OF).collect()
    got = {(r.NroCta, r.Estado): (r.RUTA, r.Categoria, r.FECBAJ, r.PrimerPedido, r.TipoPromo) for r in rows}
    assert len(rows) == len(got)
    assert got == {
        # Registered on the first day of the window; in both tables, so once per state.
        (1, "Activo"): (1, "RTO", None, 10, "2x1/BONIF"),
        (1, "Baja"): (1, "RTO", "30/04/2026", 10, "2x1/BONIF"),
        # First by visiting order of two routes; the service order does not count, the free one does.
        (2, "Activo"): (2, "Digital", None, 21, "SIN CARGO"),
        (6, "Activo"): (1, "Digital", None, None, "SIN COMPRA"),
        # Closed twice: the latest closure.
        (8, "Baja"): (1, "RTO", "15/04/2026", 80, "NORMAL"),
    }


def test_legacy_sentinel_for_open_accounts(spark):
    rows = acquisition.acquisitions_by_channel(acquisitions_world(spark), AS_OF, legacy_sentinels=True).collect()
    assert {r.FECBAJ for r in rows if r.Estado == "Activo"} == {"0"}


def test_route_filter_applies_before_the_first_route_is_chosen(spark):
    rows = acquisition.acquisitions_by_channel(acquisitions_world(spark), AS_OF, exclude=(2,)).collect()
    assert [r.RUTA for r in rows if r.NroCta == 2] == [155]


def test_realised_counts_any_paid_line_and_the_whole_last_day(spark):
    t = acquisitions_world(spark)
    april = acquisition.realised_acquisitions(t, dt.date(2026, 4, 1), dt.date(2026, 4, 30))
    assert april.count() == 0  # first paid line was a service in March
    both = acquisition.realised_acquisitions(t, dt.date(2026, 3, 1), dt.date(2026, 4, 30)).collect()
    got = {(r.NroCta, r.Periodo): (r.Consumo, r.Bultos, r.RUTA, r.Atributo) for r in both}
    assert got == {
        (2, "2026-03"): (Decimal(500), None, 155, "Restaurante"),
        (2, "2026-04"): (Decimal(390), Decimal(2), 155, "Restaurante"),
    }
    assert {r.FechaPrimeraCompra for r in both} == {dt.date(2026, 3, 11)}


def test_first_purchase_skips_service_only_orders(spark):
    rows = acquisition.first_purchase_products(acquisitions_world(spark)).collect()
    got = {(r.NroCta, r.idProducto): (r.TotalImporteProducto, r.TieneLineaPrecio0, r.TipoPromo) for r in rows}
    assert got == {
        (1, "E"): (Decimal(100), 1, "2x1/BONIF"),
        (8, "E"): (Decimal(100), 0, "NORMAL"),
    }


def test_repurchase_pairs_and_keeps_the_silent(spark):
    t = acquisitions_world(spark)
    rows = {r.NroCta: r for r in acquisition.repurchase(t, AS_OF).collect()}
    # Strictly after the first of the month; routed; the depot text must match whole.
    assert set(rows) == {2, 3, 5, 6}
    pair = rows[2]
    assert (pair.FechaPrimeraCompra, pair.FechaSegundaCompra) == (dt.date(2026, 4, 5), dt.date(2026, 4, 30))
    assert (pair.ImportePrimeraCompra, pair.ImporteSegundaCompra) == (Decimal(240), Decimal(150))
    assert pair.DiasEntreCompras == 25
    assert rows[6].FechaPrimeraCompra is None and rows[6].Atributo is None


def test_repurchase_cohort(spark):
    t = acquisitions_world(spark)
    cohort = spark.createDataFrame([(2,), (1,)], "NroCta long")
    everyone = acquisition.repurchase(t, AS_OF, months=None, cohort=cohort).collect()
    assert {r.NroCta for r in everyone} == {1, 2}
    assert [r.DiasEntreCompras for r in everyone if r.NroCta == 1] == [40]


def test_grid_totals(spark):
    acq = acquisition.acquisitions_by_channel(acquisitions_world(spark), AS_OF)
    grid = {r.RUTA: r for r in ka.acquisition_grid(acq, dt.date(2026, 3, 1)).collect()}
    assert grid[None].Total == 2 and grid[1].d01 == 1 and grid[2].d10 == 1 and grid[1].d10 == 0
    second_week = {r.RUTA: r.Total for r in ka.acquisition_grid(acq, dt.date(2026, 3, 1), week=2).collect()}
    assert second_week == {None: 1, 2: 1}


def test_cohort_litres_keeps_customers_without_orders(spark):
    t = acquisitions_world(spark)
    acq = acquisition.acquisitions_by_channel(t, AS_OF)
    rows = ka.cohort_litres(t, acq, AS_OF).collect()
    litres = {(r.RUTA, r.Periodo): r.Litros for r in rows}
    assert litres[2, 0] == 20 and litres[2, 3] == 36
    assert {r.RUTA: r.Clientes for r in rows} == {1: 3, 2: 1}
    # Nothing is cut off: the periods of a route add up to what its customers bought, by either reading.
    whole = {r.RUTA: r.Litros for r in ka.cohort_litres_by_registration(t, acq, AS_OF).groupBy("RUTA").agg(F.sum("Litros").alias("Litros")).collect()}
    assert whole == {ruta: sum(v or 0 for (r, _), v in litres.items() if r == ruta) for ruta in whole}


def test_as_of_is_the_upper_end(spark):
    t = acquisitions_world(spark)
    early = dt.date(2026, 3, 31)
    rows = {(r.NroCta, r.Estado): r for r in acquisition.acquisitions_by_channel(t, early).collect()}
    assert rows and all(dt.datetime.strptime(r.FECALT, "%d/%m/%Y").date() <= early for r in rows.values())
    assert all(r.FechaPrimerPedido is None or r.FechaPrimerPedido.date() <= early for r in rows.values())
    pair = {r.NroCta: r for r in acquisition.repurchase(t, dt.date(2026, 4, 10)).collect()}[2]
    assert pair.FechaPrimeraCompra == dt.date(2026, 4, 5) and pair.FechaSegundaCompra is None


def test_registrations_read_no_order(spark):
    plan = acquisition.registrations(acquisitions_world(spark), AS_OF)._jdf.queryExecution().optimizedPlan().toString()
    assert "idPedido" not in plan


def test_pending_and_cohort(spark):
    t = acquisitions_world(spark)
    # On 20 April the order of the 30th has not been placed yet.
    april = acquisition.repurchase(t, dt.date(2026, 4, 20), months=None)
    assert [r.NroCta for r in ka.pending_second_order(april, dt.date(2026, 4, 20), 60).collect()] == [2]
    rep = acquisition.repurchase(t, AS_OF, months=None)
    assert ka.pending_second_order(rep, AS_OF, 60).count() == 0
    cohort = {r.MesAlta: r for r in ka.second_order_cohort(rep).collect()}
    assert cohort["2026-03"].ConSegunda == 1 and cohort["2026-03"].DiasPromedio == 25


def test_realised_by_month_obeys_the_sixty_days(spark):
    t = acquisitions_world(spark)
    rows = {(r.Mes, r.Segmento): r for r in ka.realised_by_month(t, AS_OF).collect()}
    assert rows[("2026-02", "Hogar")].Concretadas == 1 and rows[("2026-02", "Hogar")].DiasPromedio == 2
    assert rows[("2026-04", "Gastronomia")].DiasPromedio == 26
    assert not ka.realised_by_month(t, AS_OF, max_days=1).collect()
