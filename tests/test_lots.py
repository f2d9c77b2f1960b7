"""Stored tables: rejects, rows sent again, compaction, expiry, tables as of a day."""

import datetime as dt
import threading

import pytest
from test_sources import plan_of, put
from world import acquisitions_world, closed, customer, dec, line, order, tables

from rivulet.plans.orders import raw_lines
from rivulet.plans.reports.acquisition import acquisitions_by_channel, repurchase
from rivulet.plans.reports.risk import debt_by_route
from rivulet.sources.csv_files import CORRUPT, load_all, rejects
from rivulet.sources.layout import TooManyRejects, compact, loaded, write_lot
from rivulet.sources.lots import LOT, Folder, Lot, Lots, Manifest, Storage, expire, manifest_of, publish
from rivulet.sources.schema import columns_of
from rivulet.sources.tables import Tables
from rivulet.streaming.refresh import refresh_table

D = dt.date


def ids(df, key="idPedido"):
    return sorted(r[key] for r in df.collect())


# --- rejects

ORDERS = ",".join(n for n, _ in columns_of("Pedidos"))
BROKEN = f"{ORDERS}\n1,2,2026-05-01,3,,,,,PR,\nx2,2,2026-05-01,3,,,,,PR,\n3,2.5,2026-05-01,3,,,,,PR,\n4,2,never,3,,,,,PR,\n5,2\n6,2,2026-06-01,3,,,,,PR,\n"


def test_bad_rows_go_to_the_rejects(spark, tmp_path):
    put(tmp_path / "Pedidos.csv", BROKEN)
    out = str(tmp_path / "out")
    t, report = load_all(spark, str(tmp_path), out, ["Pedidos"], quarantine=True)
    [row] = report.collect()
    assert (row.filas, row.rechazadas, row.error) == (2, 4, None)
    assert ids(t["Pedidos"]) == [1, 6]
    bad = rejects(spark, out, "Pedidos").collect()
    assert len(bad) == 4 and {r[LOT] for r in bad} == {0} and all(r[CORRUPT] for r in bad)
    assert any("never" in r[CORRUPT] for r in bad) and any('"idVendedor":2.5' in r[CORRUPT] for r in bad)
    assert rejects(spark, out, "Pedidos").columns == [n for n, _ in columns_of("Pedidos")] + [CORRUPT, LOT]


def test_too_many_rejects_do_not_count(spark, tmp_path):
    put(tmp_path / "Pedidos.csv", BROKEN)
    out = str(tmp_path / "out")
    t, report = load_all(spark, str(tmp_path), out, ["Pedidos"], quarantine=True, most_rejected=3)
    assert "4 rows refused" in report.first().error and t.names() == []
    t, report = load_all(spark, str(tmp_path), out, ["Pedidos"], quarantine=True, most_rejected=4)
    assert report.first().error is None and ids(t["Pedidos"]) == [1, 6]


def test_the_write_counts_without_another_scan(spark, tmp_path):
    """Each row is evaluated once: an accumulator in the rows sees each of them once."""
    t = tables(spark, Pedidos=[order(i, 1, f"2026-0{i % 9 + 1}-15") for i in range(40)])
    seen = spark.sparkContext.accumulator(0)

    def touched(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = t["Pedidos"].mapInArrow(touched, t["Pedidos"].schema)
    assert tuple(write_lot(rows, str(tmp_path / "Pedidos"), "Pedidos", 0)) == (40, 0)
    assert seen.value == 40
    assert manifest_of(Storage(spark, str(tmp_path / "Pedidos"))).lots[0].rows == 40


def test_refresh_with_rejects(spark, tmp_path):
    drop, out = tmp_path / "drop", tmp_path / "Pedidos"
    drop.mkdir()
    put(drop / "a.csv", BROKEN)
    run = lambda: refresh_table(spark, "Pedidos", str(drop), str(out), str(tmp_path / "memory"), quarantine=True)
    run()
    put(drop / "b.csv", f"{ORDERS}\n6,9,2026-07-01,3,,,,,PR,\n7,2,2026-07-01,3,,,,,PR,\ny,2,2026-07-01,3,,,,,PR,\n")
    run()
    rows = {r.idPedido: r.idVendedor for r in loaded(spark, str(out), "Pedidos").collect()}
    assert rows == {1: 2, 6: 9, 7: 2}
    assert sorted(r[LOT] for r in rejects(spark, str(tmp_path), "Pedidos").collect()) == [1, 1, 1, 1, 2]


# --- rows sent again


@pytest.fixture
def stored(spark, tmp_path):
    """Orders of a year and their lines; a second lot moves order 3 from March to May and changes its line,
    replaces order 7 in its month, and brings order 13."""
    t = tables(
        spark,
        Pedidos=[order(i, 1, f"2026-{i:02d}-15") for i in range(1, 13)],
        Pedidos_Productos=[line(i, "E", i, 10) for i in range(1, 13)] + [line(3, "m", 1, 1), line(99, "E", 1, 1)],
    )
    later = tables(
        spark,
        Pedidos=[order(3, 1, "2026-05-20"), order(7, 2, "2026-07-15"), order(13, 1, "2026-12-30")],
        Pedidos_Productos=[line(3, "E", 100, 10), line(13, "E", 13, 10)],
    )
    for lot, x in enumerate((t, later)):
        write_lot(x["Pedidos"], str(tmp_path / "Pedidos"), "Pedidos", lot)
        parent = loaded(spark, str(tmp_path / "Pedidos"), "Pedidos")
        write_lot(x["Pedidos_Productos"], str(tmp_path / "Pedidos_Productos"), "Pedidos_Productos", lot, parent)
    return str(tmp_path)


def opened(spark, folder):
    return Tables.from_parquet(spark, folder, ["Pedidos", "Pedidos_Productos"])


def sales(t, start, before):
    orders = t.between("Pedidos", start, before).select("idPedido")
    return sorted((r.idPedido, int(r.Cantidad)) for r in orders.join(raw_lines(t, window=(start, before)), "idPedido").collect())


def test_the_last_lot_wins(spark, stored):
    t = opened(spark, stored)
    assert ids(t["Pedidos"]) == list(range(1, 14))
    rows = {r.idPedido: r for r in t["Pedidos"].collect()}
    assert rows[3].Fecha_Pedido.month == 5 and rows[7].idCliente == 2
    assert sales(t, D(2026, 3, 1), D(2026, 4, 1)) == []
    assert sales(t, D(2026, 5, 1), D(2026, 6, 1)) == [(3, 100), (5, 5)]
    assert sorted(r.idProducto for r in t["Pedidos_Productos"].where("idPedido = 3").collect()) == ["E"]


def test_lines_of_a_moved_order_are_found_where_they_lie(spark, stored):
    """Only the order is sent again: its lines still lie in the month it had."""
    later = tables(spark, Pedidos=[order(4, 1, "2026-10-02")])
    write_lot(later["Pedidos"], f"{stored}/Pedidos", "Pedidos", 2)
    t = opened(spark, stored)
    assert sales(t, D(2026, 10, 1), D(2026, 11, 1)) == [(4, 4), (10, 10)]
    assert sales(t, D(2026, 4, 1), D(2026, 5, 1)) == []


def test_untouched_months_are_plain_scans(spark, stored):
    t = opened(spark, stored)
    for name, start in (("Pedidos", 1), ("Pedidos", 9)):
        plan = plan_of(t.between(name, D(2026, start, 1), D(2026, start + 2, 1)))
        assert "Exchange" not in plan and "Join" not in plan
    assert "Join" in plan_of(t.between("Pedidos", D(2026, 3, 1), D(2026, 4, 1)))
    assert "Join" not in plan_of(raw_lines(t, window=(D(2026, 9, 1), D(2026, 10, 1))))


def test_rows_without_key_are_never_replaced(spark, tmp_path):
    rows = [{"Importe": dec(i), "IdCliente": 1, "Fecha": dt.datetime(2026, 5, i)} for i in (1, 2)]
    t = tables(spark, Movimientos_Caja=rows)
    for lot in (0, 1):
        write_lot(t["Movimientos_Caja"], str(tmp_path / "m"), "Movimientos_Caja", lot)
    assert loaded(spark, str(tmp_path / "m"), "Movimientos_Caja").count() == 4


def test_a_lot_of_many_months_and_ranges():
    """Ranges by the index: a folder is touched only by later lots that may hold its keys."""
    lots = Lots.__new__(Lots)
    a, b, c = Folder(0, "2026-01-01", 5, 1, 10), Folder(0, "2026-02-01", 5, 11, 20), Folder(1, "2026-02-01", 1, 10, 10)
    assert lots._later(a, [a, b, c]) == (c,) and lots._later(b, [a, b, c]) == () and lots._later(c, [a, b, c]) == ()
    assert Folder(0, None, 1).within(D(2026, 1, 1), D(2026, 1, 2)) and not Folder(0, None, 1).meets([(0, 9)])


# --- compaction and expiry


def files(folder):
    from pathlib import Path

    return [p for p in Path(folder).rglob("*.parquet")]


def test_compaction_moves_lines_to_their_month_and_keeps_the_rows(spark, stored):
    # The order of line 99 arrives now.
    write_lot(tables(spark, Pedidos=[order(99, 1, "2026-08-08")])["Pedidos"], f"{stored}/Pedidos", "Pedidos", 2)
    for lot in range(3, 9):
        write_lot(tables(spark, Pedidos=[order(100 + lot, 1, "2026-08-09")])["Pedidos"], f"{stored}/Pedidos", "Pedidos", lot)
    before = {name: sorted(map(str, opened(spark, stored)[name].drop("_mes").collect())) for name in ("Pedidos", "Pedidos_Productos")}
    opened_before = opened(spark, stored)
    frame = opened_before["Pedidos"]
    compact(spark, f"{stored}/Pedidos", "Pedidos")
    orders = loaded(spark, f"{stored}/Pedidos", "Pedidos")
    compact(spark, f"{stored}/Pedidos_Productos", "Pedidos_Productos", orders)
    t = opened(spark, stored)
    for name, rows in before.items():
        assert sorted(map(str, t[name].drop("_mes").collect())) == rows
        assert "Join" not in plan_of(t[name])
    lines = raw_lines(t, window=(D(2026, 8, 1), D(2026, 9, 1)))
    assert ids(lines) == [8, 99]
    # A reader that was open goes on with what it saw, until the old lots go.
    assert sorted(map(str, frame.drop("_mes").collect())) == before["Pedidos"]
    gone = expire(spark, f"{stored}/Pedidos")
    assert len(gone) == 9
    months = {p.parent.name for p in files(f"{stored}/Pedidos")}
    assert len(files(f"{stored}/Pedidos")) == len(months) == 11
    assert sorted(map(str, opened(spark, stored)["Pedidos"].drop("_mes").collect())) == before["Pedidos"]


def test_lots_that_arrive_meanwhile_stay_on_top(spark, stored, monkeypatch):
    from rivulet.sources import layout

    real = layout.indexed

    def slow(session, root, table, lot):
        if lot < 0:
            newer = tables(spark, Pedidos=[order(1, 5, "2026-01-16"), order(50, 5, "2026-11-16")])
            monkeypatch.setattr(layout, "indexed", real)
            write_lot(newer["Pedidos"], f"{stored}/Pedidos", "Pedidos", 2)
        return real(session, root, table, lot)

    monkeypatch.setattr(layout, "indexed", slow)
    compact(spark, f"{stored}/Pedidos", "Pedidos")
    rows = {r.idPedido: r.idCliente for r in loaded(spark, f"{stored}/Pedidos", "Pedidos").collect()}
    assert rows[1] == 5 and rows[50] == 5 and rows[7] == 2 and len(rows) == 14
    # A load that was folded already changes nothing when it is repeated.
    again = tables(spark, Pedidos=[order(7, 9, "2026-07-15")])
    assert tuple(write_lot(again["Pedidos"], f"{stored}/Pedidos", "Pedidos", 1)) == (0, 0)
    assert {r.idCliente for r in loaded(spark, f"{stored}/Pedidos", "Pedidos").where("idPedido = 7").collect()} == {2}


def test_writers_that_meet_both_count(spark, tmp_path):
    storage = Storage(spark, str(tmp_path))
    threads = [
        threading.Thread(target=publish, args=(storage, lambda now, n=n: now.with_lot(Lot(n, "2026-01-01", ()))))
        for n in range(8)
    ]
    [x.start() for x in threads]
    [x.join() for x in threads]
    now = manifest_of(storage)
    assert [x.lot for x in now.lots] == list(range(8)) and now.version == 8
    assert Manifest.of_text(now.as_text()) == now


def test_expiry_keeps_what_is_being_written(spark, stored):
    (files(f"{stored}/Pedidos")[0].parents[2] / f"{LOT}=7").mkdir()
    compact(spark, f"{stored}/Pedidos", "Pedidos")
    assert sorted(expire(spark, f"{stored}/Pedidos")) == [f"{LOT}=0", f"{LOT}=1"]
    assert f"{LOT}=7" in Storage(spark, f"{stored}/Pedidos").names()


# --- tables as of a day


def test_reports_of_an_earlier_day_see_its_customers(spark, tmp_path):
    t = acquisitions_world(spark)
    for name in t.names():
        write_lot(t[name], str(tmp_path / name), name, 0, t["Pedidos"], day=D(2026, 4, 1))
    people = t["Clientes"].where("NroCta <> 2")
    gone = tables(spark, ClientesBaja=[closed(2, 21, "2026-05-05", since="2026-03-10")])["ClientesBaja"]
    write_lot(people, str(tmp_path / "Clientes"), "Clientes", 1, day=D(2026, 6, 1))
    write_lot(t["ClientesBaja"].unionByName(gone), str(tmp_path / "ClientesBaja"), "ClientesBaja", 1, day=D(2026, 6, 1))
    write_lot(t["ClientesRutas"].where("Cliente_Ruteo > 2"), str(tmp_path / "ClientesRutas"), "ClientesRutas", 1, day=D(2026, 6, 1))
    day = D(2026, 5, 1)
    reports = [
        lambda x: acquisitions_by_channel(x, day),
        lambda x: repurchase(x, day),
        lambda x: debt_by_route(x, day, routes=None, exclude=()),
    ]
    then, now = Tables.from_parquet(spark, str(tmp_path), as_of=day), Tables.from_parquet(spark, str(tmp_path))
    rows = lambda df: sorted(map(str, df.collect()))
    for report in reports[:2]:
        assert rows(report(then)) == rows(report(t)) != []
        assert rows(report(now)) != rows(report(t))
    assert rows(reports[2](then)) == rows(reports[2](t))
    # Before the first load the first is all there is.
    assert Tables.from_parquet(spark, str(tmp_path), as_of=D(2020, 1, 1))["Clientes"].count() == t["Clientes"].count()


def test_old_lots_of_replaced_tables_expire(spark, tmp_path):
    for lot, month in enumerate((1, 2, 3, 4)):
        t = tables(spark, Clientes=[customer(lot)])
        write_lot(t["Clientes"], str(tmp_path / "Clientes"), "Clientes", lot, day=D(2026, month, 1))
    expire(spark, str(tmp_path / "Clientes"), before=D(2026, 3, 15))
    read = lambda day: ids(loaded(spark, str(tmp_path / "Clientes"), "Clientes", day), "NroCta")
    assert read(D(2026, 3, 15)) == [2] and read(D(2026, 4, 1)) == [3] and read(None) == [3]
    assert Storage(spark, str(tmp_path / "Clientes")).names()[-3:] == [f"{LOT}=2", f"{LOT}=3", "_lotes"]


def test_opening_tables_runs_no_job(spark, stored):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("opening", "opening")
    t = opened(spark, stored)
    t["Pedidos"], raw_lines(t, window=(D(2026, 1, 1), D(2026, 6, 1)))
    jobs = tracker.getJobIdsForGroup("opening")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert list(jobs) == []


def test_rejecting_raises_from_the_writer(spark, tmp_path):
    rows = tables(spark, Pedidos=[order(1, 1, "2026-01-01")])["Pedidos"].selectExpr("*", f"'bad' AS {CORRUPT}")
    with pytest.raises(TooManyRejects):
        write_lot(rows, str(tmp_path / "p"), "Pedidos", 0, most_rejected=0)
    assert manifest_of(Storage(spark, str(tmp_path / "p"))) is None
