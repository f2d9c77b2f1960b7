import datetime as dt
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rivulet.functions import dates, exprs, rules, text
from rivulet.operators import aggregates, windows


def column(spark, expression, schema, *values):
    rows = spark.createDataFrame([(v,) if not isinstance(v, tuple) else v for v in values], schema)
    return [r[0] for r in rows.select(expression).collect()]


@pytest.mark.parametrize(
    ("day", "n", "expected"),
    [((2026, 3, 31), -1, (2026, 2, 28)), ((2024, 3, 31), -1, (2024, 2, 29)), ((2026, 1, 15), -13, (2024, 12, 15)),
     ((2026, 12, 1), 1, (2027, 1, 1))],
)
def test_shift_months(day, n, expected):
    assert dates.shift_months(dt.date(*day), n) == dt.date(*expected)


@settings(max_examples=60, deadline=None)
@given(st.dates(dt.date(1950, 1, 1), dt.date(2100, 1, 1)), st.integers(1, 40))
def test_closed_months_end_before_the_day(day, n):
    months = dates.closed_months(day, n)
    assert len(months) == n and months[-1] < day.replace(day=1)
    assert all(dates.shift_months(a, 1) == b for a, b in zip(months, months[1:]))
    assert dates.month_window(day)[1] == dates.shift_months(day.replace(day=1), 1)


def test_weekday_numbering_agrees(spark):
    days = [dt.date(2026, 5, d) for d in range(1, 9)]
    got = column(spark, dates.weekday("d"), "d date", *days)
    assert got == [dates.sunday_first_weekday(d) for d in days]


def test_trailing_digits(spark):
    samples = ["CIERRE DIARIO RUTA 0042  ", "RENDICION COBRANZA 157", "SIN RUTA", "12 X", "R-7", "", None, "A 123456789012"]
    assert column(spark, text.trailing_digits("s"), "s string", *samples) == ["0042", "157", "", "", "7", "", None, "123456789012"]
    parsed = column(spark, text.try_int(text.trailing_digits("s")), "s string", *samples)
    assert parsed == [42, 157, None, None, 7, None, None, None]


def test_first_match_and_case(spark):
    labels = rules.community_patterns()
    got = column(spark, text.classify_like("s", labels), "s string", "x Los Lagos y NORDELTA", "el trigal 3", "nada", None)
    assert got == ["NORDELTA", "EL TRIGAL", None, None]


def test_promo_class(spark):
    rows = spark.createDataFrame(
        [(None, None, None), (1, 0, 1), (1, 0, 0), (1, 5, 1), (1, 5, 0)], "id int, total int, zero int"
    )
    got = [r[0] for r in rows.select(rules.promo_class(F.col("id"), "total", "zero")).collect()]
    assert got == ["SIN COMPRA", "SIN CARGO", "SIN CARGO", "2x1/BONIF", "NORMAL"]


def test_channel_and_events(spark):
    assert column(spark, rules.channel("c"), "c string", "CAT-A", "CAT-D", "X", None) == ["RTO", "Digital", None, None]
    rows = spark.createDataFrame([(146, None), (147, None), (5, None), (None, None), (146, 1)], "r int, s int")
    assert [r[0] for r in rows.select(rules.retirement_event("r", "s")).collect()] == ["E3", "E4", "E1", "E1", "EC"]
    assert column(spark, rules.event_priority("c"), "c string", "E3", "E4", "E1", "EC", "E2", "ZZ") == [1, 2, 3, 4, 5, 99]


def test_guards(spark):
    rows = spark.createDataFrame([(1, 0), (6, 3), (None, 2), (-4, None)], "a int, b int")
    got = rows.select(exprs.safe_div("a", "b"), exprs.ratio("a", "b"), exprs.divide("a", "b", 9), exprs.clamp0("a")).collect()
    assert [tuple(r) for r in got] == [(None, None, 9, 1), (2, 2, 2, 6), (None, None, 9, 0), (None, None, 9, 0)]
    fits = column(spark, exprs.try_decimal(F.col("x"), 5, 1), "x double", 9999.94, 10000.0)
    assert fits == [Decimal("9999.9"), None]


def test_legacy_dates(spark):
    days = [dt.date(2026, 5, 1), None]
    assert column(spark, dates.legacy_text_date("d"), "d date", *days) == ["01/05/2026", "0"]
    assert column(spark, dates.legacy_day_number("d"), "d date", *days) == [46141, 0]
    assert column(spark, dates.month_name("d"), "d date", *days) == ["May", None]
    assert column(spark, dates.week_of_month("d"), "d date", dt.date(2026, 5, 7), dt.date(2026, 5, 8)) == [1, 2]


def test_audit_text_repeats_equal_events(spark):
    rows = spark.createDataFrame([(1, 2, "b"), (1, 1, "a"), (1, 2, "b"), (2, 1, "c")], "k int, o int, s string")
    got = {r.k: r.texto for r in aggregates.audit_text(rows, "k", ["o"], F.col("s"), " | ").collect()}
    assert got == {1: "a | b | b", 2: "c"}


def test_top1_tie_and_priority(spark):
    rows = spark.createDataFrame([("x", "B", 5), ("x", "A", 3), ("x", "A", 2), ("y", "C", -1)], "g string, m string, v int")
    assert {r.g: (r.m, r.v) for r in aggregates.top1(rows, ["g"], "m", "v").collect()} == {"x": ("A", 5), "y": ("C", -1)}
    ranked = windows.prioritise(rows, "g", F.when(F.col("m") == "B", 1).otherwise(2), "v")
    assert {r.g: r.m for r in ranked.collect()} == {"x": "B", "y": "C"}
