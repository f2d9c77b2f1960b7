import datetime as dt
from decimal import Decimal

import world
from world import adjustment, cash, closed, credit, customer, line, machine, move, order, receipt, stop, tables

from rivulet.operators.joins import open_items, to_parent
from rivulet.plans.kpi import retention as kr
from rivulet.plans.reports import audit, collections, equipment, operations, retention, risk, sales, segmentation

MONTH = dt.date(2026, 4, 1)


def retention_world(spark):
    keys = range(11, 22)
    return tables(
        spark,
        Clientes=[customer(k) for k in keys],
        ClientesBaja=[closed(21, 211, "2025-05-05"), closed(22, 221, "2026-01-01"), closed(22, 222, "2026-02-01")],
        ClientesRutas=[stop(k, "R0146" if k == 20 else "R0001") for k in keys],
        ClientesServicios=[machine(k, f"S{k}", "2025-01-01") for k in (11, 12, 13, 14, 15, 16, 17, 20, 21, 22)]
        + [machine(18, "S18", "2026-02-01"), machine(19, "S19", "2025-01-01", "2026-03-01"), machine(11, "S11b", "2025-02-01")],
        Pedidos=[
            order(1, 12, "2026-04-10 09:00"), order(2, 15, "2026-04-11"), order(3, 15, "2026-04-11 15:00"),
            order(4, 17, "2026-03-15"), order(5, 15, "2026-05-01"), order(6, 11, "2026-01-15"),
        ],
        Movimientos_Equipos=[
            move(1, 12, "2026-04-10", 179), move(2, 13, "2026-04-20", 146), move(3, 13, "2026-04-02", 1, IdRecambio=9),
            move(4, 14, "2026-04-30 23:00", 147), move(5, 16, "2026-04-05", 1, Anulado=1), move(6, 16, None, 1),
            move(7, 11, "2026-04-05", 1, Tipo_Movimiento="I"), move(8, 21, "2026-04-05", None, Anulado=0),
        ],
    )


def test_retention_states(spark):
    rows = {r.NroCta: r for r in retention.equipment_retention(retention_world(spark), MONTH).collect()}
    assert set(rows) == {11, 12, 13, 14, 15, 16, 21, 22}
    assert {k: r.TipoEvento for k, r in rows.items()} == {
        11: "E5", 12: "E1", 13: "E3", 14: "E4", 15: "E2", 16: "E5", 21: "E1", 22: "E5",
    }
    assert rows[11].EstadoFinal == "SIGUE SIN CONSUMO" and rows[11].AccionesMes is None
    assert rows[12].FlagConflicto == 1
    assert rows[12].AccionesMes == "E1:RTO/SUPER/TÉCNICO (10/04/2026 - R179) | E2:VOLVIÓ A COMPRAR (10/04/2026 - R1)"
    assert rows[13].AccionesMes == "EC:CAMBIO (02/04/2026 - R1) | E3:FUGADO (20/04/2026 - R146)"
    again = "E2:VOLVIÓ A COMPRAR (11/04/2026 - R1)"
    assert rows[15].FlagConflicto == 0 and rows[15].AccionesMes == f"{again} | {again}"
    assert rows[21].Nombre == "C21" and rows[21].AccionesMes == "E1:RTO/SUPER/TÉCNICO (05/04/2026)"
    assert rows[22].Nombre == "B222"  # closed twice: the later record


def test_retention_cohort_replaces_the_silent(spark):
    cohort = spark.createDataFrame([(17,), (18,)], "NroCta long")
    rows = retention.equipment_retention(retention_world(spark), MONTH, cohort=cohort).collect()
    assert {r.NroCta for r in rows} == {17, 18}


def test_event_mix_and_silence(spark):
    t = retention_world(spark)
    mix = {r.TipoEvento: r.Clientes for r in kr.event_mix(retention.equipment_retention(t, MONTH)).collect()}
    assert mix == {"E5": 3, "E1": 2, "E3": 1, "E4": 1, "E2": 1}
    idle = {r.NroCta: r for r in kr.silence(t, dt.date(2026, 5, 20), days=120).collect()}
    assert idle[11].DiasSinConsumo == 125 and idle[11].Equipos == 2 and idle[13].DiasSinConsumo is None
    assert 17 not in idle
    queue = {r.RUTA: r.Equipos for r in kr.retrieval_queue(kr.silence(t, dt.date(2026, 5, 20))).collect()}
    assert queue[1] == 7 and queue[None] == 2


def test_litres_per_equipment_interval_ends(spark):
    t = tables(
        spark,
        ClientesServicios=[
            machine(1, "a", "2026-04-30"), machine(1, "a", "2025-01-01"), machine(1, "b", "2026-05-01"),
            machine(1, "c", "2025-01-01", "2026-05-01"), machine(1, "d", "2025-01-01", "2026-05-02"),
            machine(1, "e", "2025-01-01", "2026-04-01"), machine(2, "f", "2025-01-01"), machine(3, "g", "2026-06-01"),
        ],
        Pedidos=[
            order(1, 1, "2026-04-01"), order(2, 1, "2026-04-30 23:59"), order(3, 1, "2026-05-01"), order(4, 3, "2026-04-02"),
        ],
        Pedidos_Productos=[line(1, "E", 2, 0), line(1, "AC", 1, 9), line(2, "m", 1, 5), line(3, "E", 9, 1), line(4, "E", 1, 1)],
    )
    rows = equipment.litres_per_equipment(t, dt.date(2026, 5, 1), MONTH, dt.date(2026, 5, 1)).collect()
    assert [(r.NroCta, r.Q_FC, r.ConsumoLitros, r.LitrosPorEquipo) for r in rows] == [
        (1, 2, Decimal("41.5"), Decimal("20.75"))
    ]


def debt_world(spark):
    return tables(
        spark,
        Clientes=[
            customer(1), customer(2, CndPag=2), customer(3, CndPag=3), customer(4), customer(5), customer(0), customer(6, CndPag=9),
        ],
        ClientesBaja=[closed(1, 11, "2026-01-01", "R0157"), closed(7, 71, "2026-01-01", "R0157", CndPag=4), closed(7, 72, "2026-02-01", "R0155", CndPag=4)],
        ClientesRutas=[stop(k, "R0157") for k in (0, 1, 2, 3, 6)] + [stop(4, "R0001"), stop(1, "R0155", 2)],
        Movimientos_Caja=[cash(1, "2026-04-01", 100), cash(1, "2026-04-02", -250), cash(1, "2026-05-01", 999), cash(2, "2026-01-01", 70), cash(4, "2026-01-01", 5)],
        Movimientos_Caja_Ajustes=[adjustment(1, "2026-04-03", 30)],
        CtaCteVT=[
            credit("2", "2026-04-01", 500), credit("2 ", "2026-04-05", -200, "RECA", 2, 1), credit("3", "2026-04-01", -80),
            credit("1", "2026-04-01", 40), credit("XX", "2026-04-01", 40), credit("7", "2026-04-30 10:00", 60), credit("7", "2026-05-01", 1),
        ],
    )


def test_debt_keeps_cash_and_credit_apart(spark):
    t = debt_world(spark)
    as_of = dt.date(2026, 5, 1)
    people = {r.NroCta: (r.RUTA, r.DeudaContado, r.DeudaCtaCte) for r in risk.customer_debt(t, as_of, exclude=()).collect()}
    assert people == {1: (157, Decimal(-120), 0), 2: (157, 0, Decimal(300)), 7: (157, 0, Decimal(60))}
    [route] = risk.debt_by_route(t, as_of).collect()
    assert (route.RUTA, route.DeudaContado, route.DeudaCtaCte, route.DeudaTotal) == (157, -120, 360, 240)
    clamped = {r.NroCta for r in risk.customer_debt(t, as_of, clamp_cash=True).collect()}
    assert clamped == {2, 7}


def test_community_first_match_and_packs(spark):
    t = tables(
        spark,
        Clientes=[
            customer(1, Direcc="Calle 5 - Nordelta, los lagos", Atrib5="S2"), customer(2, Direcc="LOS LAGOS 12"), customer(3),
            customer(4, Direcc="NORDELTA"),
        ],
        ClientesRutas=[stop(1, "R0001"), stop(1, "R0002", 2), stop(2, "R0001"), stop(3, "R0001")],
        Pedidos=[order(1, 1, "2026-01-05"), order(2, 1, "2026-01-25"), order(3, 2, "2025-12-31 22:00"), order(4, 3, "2026-01-01"), order(5, 4, "2026-01-01")],
        Pedidos_Productos=[line(1, "m", 6, 10), line(2, "E", 1, 0), line(2, "AC", 1, 50), line(3, "E", 2, 100), line(4, "E", 1, 1), line(5, "E", 1, 1)],
    )
    rows = segmentation.community_consumption(t).collect()
    got = {(r.idCliente, r["AÑO"], r.MES): (r.Urbanizacion, r.Atributo, r.LITROS, r.CANTIDAD, r.BULTOS, r["CONSUMO_$"]) for r in rows}
    assert got == {
        (1, 2026, "January"): ("NORDELTA", "Restaurante", Decimal(29), Decimal(7), Decimal("0.5"), Decimal(60)),
        (2, 2025, "December"): ("LOS LAGOS", "Casa", Decimal(40), Decimal(2), None, Decimal(200)),
    }


def sales_world(spark):
    t = debt_world(spark)
    rows = tables(
        spark,
        Pedidos=[
            order(1, 1, "2026-03-05"), order(2, 1, "2026-04-30 21:00"), order(3, 2, "2026-04-01"), order(4, 9, "2026-04-01", 2),
            order(5, 1, "2026-05-01"), order(6, 1, "2026-04-02", 146), order(7, 1, "2026-02-28"), order(8, 7, "2026-03-01"),
        ],
        Pedidos_Productos=[
            line(1, "E", 1, 100), line(2, "E", 2, 100), line(2, "E", 1, 0), line(2, "AC", 1, 70), line(3, "m", 4, 10),
            line(4, "E", 1, 1), line(5, "E", 1, 1), line(6, "E", 1, 1), line(7, "E", 1, 1), line(8, "E", 1, 7),
        ],
        ClientesServicios=[machine(2, "x", "2026-04-30"), machine(2, "y", "2026-05-01"), machine(2, "z", "2025-01-01", "2026-01-01")],
    )
    names = ["Clientes", "ClientesBaja", "ClientesRutas", "Movimientos_Caja", "Movimientos_Caja_Ajustes", "CtaCteVT"]
    frames = {n: (t if n in names else rows)[n] for n in t.names()}
    return world.Tables.from_frames(spark, frames)


def test_sales_matrix(spark):
    matrix = sales.monthly_sales_matrix(sales_world(spark), dt.date(2026, 5, 19), months=2)
    assert matrix.columns[-4:] == ["2026-03 CANT", "2026-03 FACT", "2026-04 CANT", "2026-04 FACT"]
    got = {(r.NroCta, r.Ruta, r.idProducto): tuple(r)[-4:] for r in matrix.collect()}
    assert got == {
        (1, 1, "E"): (20, 100, 40, 200),
        (2, 1, "m"): (0, 0, 6, 40),
        (7, 1, "E"): (20, 7, 0, 0),
        (9, 2, "E"): (0, 0, 20, 1),
    }
    cards = {r.NroCta: r for r in matrix.collect()}
    assert cards[1].DeudaContado == 879 and cards[1].DeudaCtaCte == 0 and cards[1].FecBaj is None
    assert cards[2].DeudaCtaCte == 300 and cards[2].Q_FC == 1
    assert cards[9].Nombre is None and cards[9].Q_FC is None  # sold to, but no account
    assert cards[7].Nombre is None  # closed before the window
    card = sales.customer_card(sales_world(spark), dt.date(2025, 1, 1), dt.date(2026, 5, 1), legacy_sentinels=True)
    numbers = {r.NroCta: r.FecBaj for r in card.collect()}
    assert numbers[1] == 0 and numbers[7] == 46052 and card.count() == len(numbers)


def test_collections_route_of_cash_and_others(spark):
    t = tables(
        spark,
        Clientes=[customer(1), customer(2)],
        ClientesRutas=[stop(1, "R0001"), stop(1, "R0002", 2), stop(2, "R0146")],
        MovTes=[
            receipt("999", "2026-04-01", "EFE", 10, "CIERRE DIARIO RUTA 0042  "), receipt("1", "2026-04-02", "EFE", 5, "RENDICION COBRANZA 42"),
            receipt(None, "2026-04-03", "EFE", 7, "SIN RUTA"), receipt("1", "2026-04-03", "EFE", 7, None),
            receipt("1", "2026-04-03", "EFE", 7, "X 123456789012"), receipt(" 1", "2026-04-04", "TRF", 100, "RUTA 9"),
            receipt("1", "2026-05-19 20:00", "RET", 3), receipt("1", "2026-05-20", "RET", 3), receipt("1", "2025-12-01", "TRF", 1),
            receipt("1", "2025-11-30", "TRF", 1), receipt("2", "2026-04-01", "TRF", 50), receipt("zz", "2026-04-01", "TRF", 50),
            receipt("1", "2026-04-01", "CCB", 50), receipt("1", "2026-04-01", "CPA", 50), receipt("1", "2026-04-01", "TRF", 50, side="H"),
            receipt("1", "2026-04-01", None, 50),
        ],
    )
    as_of = dt.date(2026, 5, 19)
    rows = collections.collections_by_route(t, as_of).collect()
    got = {(r.RUTA, r.Mes, r.Descripcion): r.Total for r in rows}
    assert len(rows) == len(got)
    assert got == {
        (42, "04-26", "Efectivo"): 15,
        (1, "04-26", "Transferencia"): 100,  # two routes, counted once
        (1, "05-26", "RET"): 3,  # no label: the code
        (1, "12-25", "Transferencia"): 1,
    }
    literal = collections.collections_by_route(t, as_of, blank_route_as_zero=True).collect()
    assert {r.Total for r in literal if r.RUTA == 0} == {7}


def test_holiday_recovery(spark):
    fridays = ["2026-03-27", "2026-04-03", "2026-04-10", "2026-04-17"]
    orders, lines = [], []

    def sale(vendor, day, quantity, price, product="E", who=1):
        key = len(orders) + 1
        orders.append(order(key, who, day, vendor))
        lines.append(line(key, product, quantity, price))

    for day in fridays:
        sale(1, day, 1, 100)
        sale(2, day, 2, 50)
        sale(4, day, 1, Decimal("0.01"))
    for day in fridays[:3]:
        sale(3, day, 1, 100)
    sale(1, "2026-04-16", 9, 100)  # another weekday
    sale(1, "2026-02-27", 9, 100)  # before the window
    sale(1, "2026-04-17", 1, 100, who=0)  # internal account
    sale(1, "2026-04-17", 1, 100, "AC")  # a service
    sale(1, "2026-05-01 10:00", 1, 30)
    sale(4, "2026-05-01", 1, 900000)
    t = tables(spark, Pedidos=orders, Pedidos_Productos=lines)
    rows = {r.Ruta: r for r in operations.holiday_recovery(t, dt.date(2026, 5, 1)).collect()}
    assert set(rows) == {1, 2, 4}  # route 3 has three samples
    assert (rows[1].PromedioConsumo, rows[1].VtaFeriadoConsumo, rows[1].ARecuperarConsumo, rows[1].PctRecupero) == (100, 30, 70, 70)
    assert (rows[2].VtaFeriadoConsumo, rows[2].VtaFeriadoLitros, rows[2].PctRecupero, rows[2].PromedioLitros) == (0, 0, 100, 40)
    assert rows[4].PctRecupero is None  # does not fit five digits


def test_counts_and_shown_order(spark):
    t = world.acquisitions_world(spark)
    counts = {r.Tabla: r.Filas for r in audit.table_counts(t).collect()}
    assert len(counts) == 21 and counts["Pedidos"] == 9 and counts["MovTes"] == 0
    shown = [r.Filas for r in audit.in_report_order(audit.table_counts(t), "table_counts").collect()]
    assert shown == sorted(shown, reverse=True)


def test_months_are_shown_in_calendar_order(spark):
    rows = spark.createDataFrame([(1, "01-26"), (1, "12-25"), (1, "02-26")], "RUTA int, Mes string")
    assert [r.Mes for r in audit.in_report_order(rows, "collections_by_route").collect()] == ["12-25", "01-26", "02-26"]


def test_open_items_and_parents(spark):
    t = debt_world(spark)
    items = {r.NroMov: r for r in open_items(t["CtaCteVT"].filter("NroCta in ('2', '2 ')")).collect()}
    assert items[1].Importe == 500 and items[1].Aplicado == -200 and items[1].Saldo == 300
    links = spark.createDataFrame([(2, 1), (2, 1)], "IdCliente long, Cta_Madre long")
    moves = t["Movimientos_Caja"].select("IdCliente", "Importe")
    totals = {r.Cuenta: r.Importe for r in to_parent(moves, links, "IdCliente", ["Importe"]).collect()}
    assert totals == {1: 100 - 250 + 999 + 70, 4: 5}
