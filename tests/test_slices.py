"""Hierarchies of any depth, counts that add up, NOT IN against a table, slices with totals."""

import datetime as dt
import random

import pytest
from test_sources import plan_of
from world import customer, line, order, tables

from rivulet.operators import bitmaps, hierarchy, joins
from rivulet.operators.rowsets import keep
from rivulet.plans.kpi.acquisition import promo_cost
from rivulet.plans.kpi.mix import product_mix
from rivulet.plans.kpi.operations import SLICES, holiday_slices, holiday_table

D = dt.date


def frame(spark, rows):
    return spark.createDataFrame(rows, "IdCliente long, Cta_Madre long")


def values_of(spark, rows):
    return spark.createDataFrame(rows, "c long, v long")


def plain_heads(links):
    """Topmost ancestors by walking up; a ring is cut above its smallest member."""
    up = dict(links)
    for start in sorted(up):
        path, at = [], start
        while at in up and at not in path:
            path.append(at)
            at = up[at]
        if at in path:
            del up[min(path[path.index(at) :])]

    def top(x):
        while x in up:
            x = up[x]
        return x

    return {x: top(x) for x in up}, up


def test_three_levels_and_a_ring(spark):
    links = [(1, 2), (2, 3), (4, 3), (3, 3), (5, None), (10, 11), (11, 12), (12, 10), (13, 12), (14, 13), (20, 21)]
    rows = values_of(spark, [(x, 1) for x in (1, 2, 3, 4, 5, 6, 10, 11, 12, 13, 14, 20)] + [(1, 5), (None, 9)])
    totals = {r.Cuenta: r.v for r in hierarchy.to_head(rows, frame(spark, links), "c", ["v"]).collect()}
    assert totals == {3: 9, 5: 1, 6: 1, 10: 5, 21: 1, None: 9}
    levels = hierarchy.rollup_levels(rows, frame(spark, links), "c", ["v"], "IdCliente", "Cta_Madre").collect()
    found = {r.nodo: (r.niveles, r.v) for r in levels}
    assert found[3] == (2, 9) and found[2] == (1, 7) and found[1] == (0, 6) and found[21] == (1, 1)
    assert found[10] == (3, 5) and found[12] == (2, 4)


@pytest.mark.parametrize("seed", range(4))
def test_heads_and_ancestors_against_walking_up(spark, seed):
    rng = random.Random(seed)
    links = [(x, rng.randrange(60) if seed % 2 else rng.randrange(x)) for x in range(1, 60) if rng.random() < 0.8]
    tree = hierarchy.without_cycles(hierarchy.links_of(frame(spark, links), "IdCliente", "Cta_Madre"))
    told, up = plain_heads([(c, p) for c, p in links if c != p])
    assert {r.hijo: r.padre for r in hierarchy.heads(tree).collect()} == told
    pairs = set()
    for x in up:
        at, level = x, 0
        while at in up:
            at, level = up[at], level + 1
            pairs.add((x, at, level))
    assert {tuple(r) for r in hierarchy.ancestors(tree).collect()} == pairs


def test_a_long_chain_and_no_links(spark):
    chain = frame(spark, [(x, x + 1) for x in range(300)])
    rows = values_of(spark, [(x, 1) for x in range(301)])
    assert [tuple(r) for r in hierarchy.to_head(rows, chain, "c", ["v"]).collect()] == [(300, 301)]
    none = hierarchy.to_head(rows, chain.limit(0), "c", ["v"])
    assert none.count() == 301


def test_bitmaps_unite_to_distinct_counts(spark):
    rng = random.Random(1)
    rows = [(rng.randrange(10**14, 10**14 + 900) * 7, rng.choice("ab"), rng.randrange(6)) for _ in range(4000)] + [(None, "a", 0)]
    facts = spark.createDataFrame(rows, "c long, g string, m int")
    numbers = keep(bitmaps.numbered(facts, "c"))
    assert sorted(r.nro for r in numbers.collect()) == list(range(len({r[0] for r in rows} - {None})))
    stored = keep(bitmaps.bitmaps(facts, "c", numbers, ["g", "m"]))
    for by, cut in ((["g"], lambda r: r[1]), (["m"], lambda r: r[2]), ([], lambda r: None)):
        told = {}
        for r in rows:
            told.setdefault(cut(r), set()).add(r[0])
        found = {(r[by[0]] if by else None): r.clientes for r in bitmaps.distinct_count(stored, by).collect()}
        assert found == {k: len(v - {None}) for k, v in told.items()}
    half = stored.filter("m BETWEEN 1 AND 3")
    assert bitmaps.distinct_count(half).first().clientes == len({r[0] for r in rows if 1 <= r[2] <= 3} - {None})
    assert bitmaps.distinct_count(stored.limit(0)).first().clientes == 0


def test_numbers_stay_when_customers_join(spark):
    first = keep(bitmaps.numbered(spark.range(0, 100, 2), "id"))
    more = bitmaps.numbered(spark.range(0, 100), "id", first)
    old, new = ({r.id: r.nro for r in df.collect()} for df in (first, more))
    assert all(new[k] == n for k, n in old.items()) and sorted(new.values()) == list(range(100))
    assert [r.nro for r in bitmaps.numbered(spark.range(3), "id", first.limit(0)).orderBy("nro").collect()] == [0, 1, 2]


@pytest.mark.parametrize("listed", [[], [None], [1, 2], [1, None], [9]])
def test_not_in_is_that_of_sql(spark, listed):
    rows = spark.createDataFrame([(1,), (2,), (3,), (None,), (3,)], "x long")
    long_list = spark.createDataFrame([(v,) for v in listed], "y long")
    rows.createOrReplaceTempView("filas")
    long_list.createOrReplaceTempView("lista")
    told = spark.sql("SELECT * FROM filas WHERE x NOT IN (SELECT y FROM lista)").collect()
    mine = joins.not_in(rows, "x", long_list, "y")
    assert sorted(map(str, mine.collect())) == sorted(map(str, told)) and mine.columns == ["x"]


def test_a_long_list_is_not_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(joins.not_in(spark.range(10), "id", spark.range(5).withColumnRenamed("id", "k"), "k"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def holiday_world(spark):
    days = ["2026-04-06", "2026-04-13", "2026-04-20", "2026-04-27", "2026-05-04", "2026-05-11"]
    orders = [order(100 * v + i, 1, d, v) for v in (1, 2, 155) for i, d in enumerate(days)]
    lines = [line(o["idPedido"], "E", 1 + o["idPedido"] % 7, 10) for o in orders]
    return tables(spark, Pedidos=orders, Pedidos_Productos=lines)


def test_slices_add_up_in_one_pass(spark):
    table = holiday_table(holiday_world(spark), [D(2026, 5, 11), D(2026, 5, 4)], min_days=2)
    cut = holiday_slices(table)
    # One Expand over the table's plan, which reads orders once and lines once.
    plan = plan_of(cut)
    assert plan.count("Expand [") == 1 and "Union" not in plan
    rows, parts = table.collect(), cut.collect()
    assert len({r.corte for r in parts}) == len(SLICES)
    total = sum(r.ARecuperar for r in rows)
    for corte in {r.corte for r in parts}:
        assert sum(r.ARecuperar for r in parts if r.corte == corte) == total
    [whole] = [r for r in parts if r.corte == 15]
    assert whole.Filas == len(rows) and whole.Supervisor is None
    north = [r for r in parts if r.Supervisor == "Norte" and r.Feriado == D(2026, 5, 4) and r.Ruta is None]
    assert len(north) == 1 and north[0].PromSem == sum(r.PromSem for r in rows if r.Supervisor == "Norte" and r.Feriado == D(2026, 5, 4))


def mix_world(spark):
    return tables(
        spark,
        Clientes=[customer(1), customer(2, "2026-03-01"), customer(3, "2026-03-05")],
        Pedidos=[order(1, 1, "2026-03-02"), order(2, 2, "2026-03-03"), order(3, 3, "2026-03-06"), order(4, 3, "2026-04-06")],
        Pedidos_Productos=[line(1, "E", 1, 0), line(2, "m", 2, 0), line(3, "E", 3, 0), line(4, "E", 9, 0)],
    )


def test_a_segment_without_by_limits_the_mix(spark):
    t = mix_world(spark)
    families = {"Agua": ["agua"]}
    mix = lambda accounts: {r.Mes: (r.Clientes, float(r.Litros)) for r in product_mix(t, families, D(2026, 4, 10), 1, accounts=accounts).collect()}
    assert mix(None) == {D(2026, 3, 1): (3, 83.0)}
    assert mix(t["Clientes"].filter("NroCta > 1")) == {D(2026, 3, 1): (2, 63.0)}


def test_promo_cost_of_a_day_and_of_new_customers(spark):
    t = mix_world(spark)
    prices = spark.createDataFrame([("E", 10), ("m", 1)], "idProducto string, PrecioLista int")
    units = lambda *a: {r.idProducto: int(r.Unidades) for r in promo_cost(t, prices, *a).collect()}
    assert units() == {"E": 4, "m": 2}
    assert units(None, D(2026, 3, 4)) == {"E": 1, "m": 2}
    new = t["Clientes"].filter("NroCta > 1")
    assert units(D(2026, 3, 1), D(2026, 4, 30), new) == {"E": 3, "m": 2}
