"""Audit texts in parts, and the audit of keys."""

import datetime as dt
import random

from pyspark.sql import functions as F
from world import order, tables

from rivulet.operators import aggregates
from rivulet.plans.reports import audit

D = dt.date


def test_parts_join_to_the_whole_text(spark):
    rng = random.Random(5)
    days = [None, *[D(2026, 1, 1) + dt.timedelta(days=k) for k in range(9)]]
    rows = [("hot", rng.choice(days), rng.choice("abcdef")) for _ in range(3000)]
    rows += [("twin", D(2026, 1, 1), "x")] * 25 + [("one", None, "y"), (None, D(2026, 1, 2), "z")]
    events = spark.createDataFrame(rows, "k string, d date, s string")
    parts = aggregates.audit_parts(events, "k", "d", [], F.col("s"), "|", entries=10).collect()
    found = {}
    for r in sorted(parts, key=lambda r: (str(r.k), r.parte)):
        assert 1 <= len(r.texto.split("|")) <= 10
        found.setdefault(r.k, []).append(r.texto)
    told = {}
    for k, d, s in sorted(rows, key=lambda r: (str(r[0]), r[1] is not None, r[1] or D.min, r[2])):
        told.setdefault(k, []).append(s)
    assert {k: "|".join(v) for k, v in found.items()} == {k: "|".join(v) for k, v in told.items()}
    assert {k: len(v) for k, v in found.items()} == {"hot": 300, "twin": 3, "one": 1, None: 1}
    whole = {r.k: r.texto for r in aggregates.audit_text(events.where("d IS NOT NULL"), "k", ["d"], F.col("s"), "|").collect()}
    assert whole["twin"] == "|".join(found["twin"])


def test_parts_of_no_events(spark):
    none = spark.createDataFrame([], "k string, d date, s string")
    assert aggregates.audit_parts(none, "k", "d", [], F.col("s"), "|").count() == 0


def test_repeated_keys_and_orphans_are_found(spark):
    t = tables(
        spark,
        Clientes=[dict(NroCta=1), dict(NroCta=2), dict(NroCta=2), dict(NroCta=None)],
        ClientesBaja=[dict(IdClienteBaja=1, NroCta=3)],
        Pedidos=[
            order(10, 1, "2026-01-01"),
            order(11, 3, "2026-01-01"),
            order(12, 9, "2026-01-01"),
            order(13, 9, "2026-01-02"),
            order(13, None, "2026-01-02"),
        ],
    )
    found = {(r.Tabla, r.Regla, r.Columnas): tuple(r)[3:] for r in audit.key_audit(t).collect()}
    assert found["Clientes", "clave", "NroCta"] == (4, 1, 1, 1)
    assert found["Pedidos", "clave", "idPedido"] == (5, 0, 1, 1)
    assert found["Pedidos", "referencia", "idCliente"] == (5, 1, 1, 2)
    assert found["MovTes", "clave", "CodMov, NroMov, NrItem"] == (0, 0, 0, 0)
    assert len(found) == len(audit.KEYS) + len(audit.REFERENCES)
