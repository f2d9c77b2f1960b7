import datetime as dt
import threading
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from world import order, tables

from rivulet.operators.rowsets import keep, month_calendar, shared_folder, values
from rivulet.plans.orders import raw_lines
from rivulet.sources import csv_files, layout
from rivulet.sources.csv_files import CORRUPT, load_all, read_csv
from rivulet.sources.layout import MONTH, in_window, save_bucketed, write, write_lot, write_table
from rivulet.sources.schema import TABLE_COLUMNS, canonical_schema, columns_of
from rivulet.sources.tables import Tables
from rivulet.streaming.refresh import refresh_table


def put(path, text, newline="\n"):
    path.write_bytes(text.replace("\n", newline).encode("utf-8"))
    return str(path)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_schema_is_complete():
    assert len(TABLE_COLUMNS) == 21
    assert len(columns_of("Clientes")) == 64 and len(columns_of("ClientesBaja")) == 55
    assert canonical_schema("Pedidos")["idPedido"].dataType.simpleString() == "bigint"
    assert canonical_schema("Pedidos_Productos")["Precio"].dataType.simpleString() == "decimal(15,2)"


def test_csv_types_padding_quotes_and_line_ends(spark, tmp_path):
    text = (
        "idProducto,Descripcion,Abreviatura,Litros,Unidad,Orden,cantidad_x_bulto\n"
        'E,"Bidon, 20 ""litros""",20L,20.00,U,1,\n'
        "m,Soda áé,SODA,1.50,U,2,12.0\n"
    )
    for newline in ("\n", "\r\n"):
        path = put(tmp_path / f"Productos{len(newline)}.csv", text, newline)
        rows = {r.idProducto: r for r in read_csv(spark, path, "Productos").collect()}
        assert rows["E"].Descripcion == 'Bidon, 20 "litros"' and rows["E"].cantidad_x_bulto is None
        assert rows["m"].cantidad_x_bulto == 12 and rows["m"].Litros == Decimal("1.50")
        assert rows["m"].Descripcion == "Soda áé"


def test_csv_blank_padding_and_dates(spark, tmp_path):
    text = "Codigo,Descrp,DebHab\nEFE,Efectivo      ,D\n"
    [row] = read_csv(spark, put(tmp_path / "CptTes.csv", text), "CptTes").collect()
    assert row.Descrp == "Efectivo"
    header = ",".join(n for n, _ in columns_of("Pedidos"))
    text = f"{header}\n1,2,2026-05-01,3,,,,,PR,\n2,2,2026-05-01 10:20:30,3.0,,,,,PR,4.0\n"
    rows = read_csv(spark, put(tmp_path / "Pedidos.csv", text), "Pedidos").orderBy("idPedido").collect()
    assert rows[0].Fecha_Pedido == dt.datetime(2026, 5, 1)
    assert rows[1].Fecha_Pedido == dt.datetime(2026, 5, 1, 10, 20, 30)
    assert rows[1].idCliente == 3 and rows[1].IDCLIENTENUEVO == 4


def test_malformed_rows_are_kept_on_request(spark, tmp_path):
    path = put(tmp_path / "CondPAGO.csv", "Codigo,Descrp,DiasCR,Cuotas,CodAlt\n1,CONTADO,0,1,\nX,MAL,0,1,\n")
    rows = read_csv(spark, path, "CondPAGO", keep_corrupt=True).collect()
    assert len(rows) == 2 and [r.Codigo for r in rows if r[CORRUPT]] == [None]


def test_load_reports_each_table_and_goes_on(spark, tmp_path):
    put(tmp_path / "CondPAGO.csv", "Codigo,Descrp,DiasCR,Cuotas,CodAlt\n1,CONTADO,0,1,\n2,CC,30,1,\n")
    put(tmp_path / "Categorias.csv", "Categoria,Descripcion\nCAT-A,Premium\n")
    put(tmp_path / "CteVtas.csv", "Codigo,Descrp,DebHab\nFACA,Factura,D\n")
    put(tmp_path / "ClientesAtrLis.csv", "AtrNro,AtrCod,AtrDes\nnada,1,x\n")
    names = ["CondPAGO", "TiposCli", "ClientesAtrLis", "Categorias", "CteVtas"]
    loaded, report = load_all(spark, str(tmp_path), str(tmp_path / "out"), names)
    rows = {r.tabla: r for r in report.collect()}
    assert [rows[n].filas for n in names] == [2, None, None, 1, 1]
    assert rows["TiposCli"].error and rows["ClientesAtrLis"].error and rows["CondPAGO"].error is None
    assert loaded.names() == ["CondPAGO", "Categorias", "CteVtas"]
    assert loaded["CondPAGO"].count() == 2


def test_tables_are_loaded_side_by_side_and_after_their_parent(spark, tmp_path, monkeypatch):
    for name, row in (("Categorias", "A,uno"), ("CteVtas", "FACA,Factura,D"), ("Pedidos", "1,2,2026-05-01,3,,,,,PR,")):
        put(tmp_path / f"{name}.csv", ",".join(n for n, _ in columns_of(name)) + f"\n{row}\n")
    put(tmp_path / "Pedidos_Productos.csv", ",".join(n for n, _ in columns_of("Pedidos_Productos")) + "\n1,A,N,1,10,\n")
    both = threading.Barrier(2, timeout=60)
    written = []

    def write_lot(df, path, table, *args):
        if table in ("Categorias", "CteVtas"):
            both.wait()
        written.append(table)
        return layout.write_lot(df, path, table, *args)

    monkeypatch.setattr(csv_files, "write_lot", write_lot)
    names = ["Pedidos_Productos", "Categorias", "Pedidos", "CteVtas"]
    loaded, report = load_all(spark, str(tmp_path), str(tmp_path / "out"), names)
    assert [(r.tabla, r.filas, r.error) for r in report.collect()] == [(n, 1, None) for n in [*names[1:], names[0]]]
    assert written.index("Pedidos") < written.index("Pedidos_Productos")
    assert [str(r[MONTH]) for r in loaded["Pedidos_Productos"].collect()] == ["2026-05-01"]


def test_month_folders_prune_the_scan(spark, tmp_path):
    t = tables(spark, Pedidos=[order(i, 1, f"2026-{m:02d}-15") for i, m in enumerate(range(1, 13))])
    write_table(t["Pedidos"], str(tmp_path / "Pedidos"), "Pedidos")
    stored = Tables.from_parquet(spark, str(tmp_path), ["Pedidos"])
    window = stored.between("Pedidos", dt.date(2026, 3, 10), dt.date(2026, 5, 1)).select("idPedido")
    assert sorted(r.idPedido for r in window.collect()) == [2, 3]
    plan = plan_of(window)
    assert f"PartitionFilters: [isnotnull({MONTH}" in plan and "GreaterThanOrEqual(Fecha_Pedido" in plan


def test_window_ends(spark):
    t = tables(spark, Pedidos=[order(1, 1, "2026-04-01"), order(2, 1, "2026-04-30 23:59"), order(3, 1, "2026-05-01")])
    kept = in_window(t["Pedidos"], "Fecha_Pedido", dt.date(2026, 4, 1), dt.date(2026, 5, 1))
    assert sorted(r.idPedido for r in kept.collect()) == [1, 2]


def test_bucketed_tables_join_without_exchange(spark):
    left = spark.range(100).selectExpr("id as k", "id * 2 as a")
    right = spark.range(100).selectExpr("id as k", "id * 3 as b")
    for name, df in (("cubo_a", left), ("cubo_b", right)):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        save_bucketed(df, name, "k", 4)
    joined = spark.table("cubo_a").hint("merge").join(spark.table("cubo_b"), "k")
    assert joined.count() == 100 and "Exchange hashpartitioning" not in plan_of(joined)
    for name in ("cubo_a", "cubo_b"):
        spark.sql(f"DROP TABLE {name}")


def test_partitioned_sink(spark, tmp_path):
    df = spark.range(100).selectExpr("id", "id % 4 as ruta")
    write(df, str(tmp_path / "r"), "ruta")
    assert spark.read.parquet(str(tmp_path / "r")).filter("ruta = 2").count() == 25


def test_kept_frames_are_scans_of_the_shared_folder(spark):
    kept = keep(spark.range(10).selectExpr("id * 2 as x"))
    assert kept.count() == 10 and "FileScan parquet" in plan_of(kept)
    assert shared_folder(spark, "a") != shared_folder(spark, "a")


def test_inline_values_and_calendar(spark):
    rows = values(spark, [(1, "it's \\ ok", None), (2, "b", dt.date(2026, 1, 1))], ["n", "s", "d"]).collect()
    assert rows[0].s == "it's \\ ok" and rows[0].d is None and rows[1].d == dt.date(2026, 1, 1)
    months = [r.Mes for r in month_calendar(spark, dt.date(2025, 11, 30), dt.date(2026, 2, 1)).collect()]
    assert months == [dt.date(2025, 11, 1), dt.date(2025, 12, 1), dt.date(2026, 1, 1), dt.date(2026, 2, 1)]


def test_refresh_loads_each_file_once(spark, tmp_path):
    drop = tmp_path / "drop"
    drop.mkdir()
    header = ",".join(n for n, _ in columns_of("Pedidos"))
    out, memory = str(tmp_path / "Pedidos"), str(tmp_path / "memory")

    def run():
        refresh_table(spark, "Pedidos", str(drop), out, memory)
        return sorted(r.idPedido for r in spark.read.parquet(out).collect())

    put(drop / "a.csv", f"{header}\n1,2,2026-05-01,3,,,,,PR,\n2,2,2026-06-01,3,,,,,PR,\n")
    assert run() == [1, 2]
    assert run() == [1, 2]
    put(drop / "b.csv", f"{header}\n3,2,2026-06-02,3,,,,,PR,\n")
    assert run() == [1, 2, 3]
    stored = Tables.from_parquet(spark, str(tmp_path), ["Pedidos"])
    june = stored.between("Pedidos", dt.date(2026, 6, 1), dt.date(2026, 7, 1))
    assert sorted(r.idPedido for r in june.collect()) == [2, 3]


def test_refresh_adds_to_what_was_loaded(spark, tmp_path):
    csv, out = tmp_path / "csv", tmp_path / "out"
    csv.mkdir()
    orders, lines = (",".join(n for n, _ in columns_of(x)) for x in ("Pedidos", "Pedidos_Productos"))
    people = ",".join(n for n, _ in columns_of("Categorias"))
    put(csv / "Pedidos.csv", f"{orders}\n1,2,2026-05-01,3,,,,,PR,\n2,2,2026-06-01,3,,,,,PR,\n")
    put(csv / "Pedidos_Productos.csv", f"{lines}\n1,A,N,1,10,\n2,A,N,2,10,\n9,A,N,3,10,\n")
    put(csv / "Categorias.csv", f"{people}\nA,uno\nB,dos\n")
    load_all(spark, str(csv), str(out), ["Pedidos_Productos", "Pedidos", "Categorias"])

    def refresh(table, name, text):
        drop = tmp_path / f"drop-{table}"
        drop.mkdir(exist_ok=True)
        if text:
            put(drop / name, text)
        refresh_table(spark, table, str(drop), str(out / table), str(tmp_path / f"memory-{table}"))

    def ids(table, key):
        return sorted(r[key] for r in Tables.from_parquet(spark, str(out), [table])[table].collect())

    refresh("Pedidos", "a.csv", f"{orders}\n3,2,2026-06-02,3,,,,,PR,\n")
    refresh("Pedidos", "a.csv", None)
    assert ids("Pedidos", "idPedido") == [1, 2, 3]
    refresh("Pedidos_Productos", "a.csv", f"{lines}\n3,B,N,4,10,\n")
    assert ids("Pedidos_Productos", "idPedido") == [1, 2, 3, 9]
    refresh("Categorias", "a.csv", f"{people}\nA,otra\n")
    assert ids("Categorias", "Descripcion") == ["otra"]

    t = Tables.from_parquet(spark, str(out))
    june = raw_lines(t, window=(dt.date(2026, 6, 1), dt.date(2026, 7, 1)))
    # Lines of June, and the one whose order is not there yet.
    assert sorted(r.idPedido for r in june.collect()) == [2, 3, 9]
    assert f"PartitionFilters: [(isnull({MONTH}" in plan_of(june)


def test_a_lot_that_is_written_again_counts_once(spark, tmp_path):
    t = tables(spark, Pedidos=[order(i, 1, "2026-04-01") for i in range(5)])
    for _ in range(2):
        write_lot(t["Pedidos"], str(tmp_path / "Pedidos"), "Pedidos", 1)
    assert Tables.from_parquet(spark, str(tmp_path), ["Pedidos"])["Pedidos"].count() == 5


def test_fractions_in_whole_columns_are_refused(spark, tmp_path):
    header = "Codigo,Descrp,DiasCR,Cuotas,CodAlt"
    put(tmp_path / "CondPAGO.csv", f"{header}\n1,CONTADO,30.0,1,\n2,MAL,1.5,1,\n")
    with pytest.raises(PySparkException):
        read_csv(spark, str(tmp_path / "CondPAGO.csv"), "CondPAGO").collect()
    rows = read_csv(spark, str(tmp_path / "CondPAGO.csv"), "CondPAGO", keep_corrupt=True).collect()
    assert [(r.Codigo, r.DiasCR, bool(r[CORRUPT])) for r in rows] == [(1, 30, False), (2, None, True)]


def test_a_cluster_must_name_its_shared_folder():
    class Cluster:
        master = "spark://somewhere:7077"

    class Session:
        sparkContext = Cluster()

        class conf:
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(ValueError):
        shared_folder(Session(), "x")
