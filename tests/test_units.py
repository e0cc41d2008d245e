from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from marketloom.functions.units import currency_code, money, number, quantity, unit

MONEY = [
    ("US$ 1,234.50", "1234.5", "USD"), ("9,90 €", "9.9", "EUR"), ("5999 cents USD", "59.99", "USD"), ("¥7,638", "7638", "JPY"), ("R$ 1.234,5", "1234.5", "BRL"),
    ("$12", "12", "USD"), ("CA$28.90", "28.9", "CAD"), ("A$6", "6", "AUD"), ("GB£ 3.50", "3.5", "GBP"), ("12 pounds sterling", "12", "GBP"), ("JP¥ 1 299", "1299", "JPY"),
    ("1.5 thousand EUR", "1500", "EUR"), ("21 cm", None, None), ("12", None, None), ("free", None, None), ("", None, None), (None, None, None), ("x" * 100_000, None, None),
]


def test_money(spark):
    rows = spark.createDataFrame([(t,) for t, *_ in MONEY], "t string").select(money(F.col("t")).alias("m")).collect()
    assert [(r.m.amount if r.m.amount is None else r.m.amount.normalize(), r.m.currency) for r in rows] == [(a and Decimal(a).normalize(), c) for _, a, c in MONEY]


@pytest.mark.parametrize(
    "text, canonical, dims",
    [
        ("29.7 kg*m/s^2", 29.7, {"length": 1, "mass": 1, "time": -2}), ("68 °F", 293.15, {"temperature": 1}), ("-3.5 m²", -3.5, {"length": 2}), ("2.5 km per h", 2500 / 3600, {"length": 1, "time": -1}),
        ("8300 KB", 8.3e6, {"information": 1}), ("0.125 in", 0.003175, {"length": 1}), ("50 %", 0.5, {}), ("20 °C", 293.15, {"temperature": 1}), ("3 J/°C", 3.0, {"length": 2, "mass": 1, "time": -2, "temperature": -1}),
    ],
)
def test_quantity(spark, text, canonical, dims):
    from marketloom.functions.units import BASE_DIMENSIONS

    q = spark.createDataFrame([(text,)], "t string").select(quantity(F.col("t")).alias("q")).first().q
    assert q.canonical == pytest.approx(canonical)
    assert q.unit.dims == [dims.get(d, 0) for d in BASE_DIMENSIONS]


def test_unknown_units_and_bare_numbers(spark):
    rows = spark.createDataFrame([("7 foo",), ("7",), ("7 kg foo",)], "t string").select(quantity(F.col("t")).alias("q")).collect()
    assert [(float(r.q.number), r.q.unit, r.q.canonical) for r in rows] == [(7.0, None, None)] * 3


def test_numbers(spark):
    cases = {"1.299": 1299, "1,299.5": 1299.5, "1.299,5": 1299.5, "12,5": 12.5, "0.125": 0.125, "1'234": 1234, "1,234,567": 1234567, "no": None}
    rows = spark.createDataFrame([(k,) for k in cases], "t string").select(number(F.col("t")).alias("n")).collect()
    assert [r.n if r.n is None else float(r.n) for r in rows] == list(cases.values())


def test_currency_codes(spark):
    cases = {"usd": "USD", " € ": "EUR", "Brazilian reais": "BRL", "C$": "CAD", "XYZ": None, "": None, "yen": "JPY"}
    rows = spark.createDataFrame([(k,) for k in cases], "t string").select(currency_code(F.col("t")).alias("c")).collect()
    assert [r.c for r in rows] == list(cases.values())


def test_unit_expression_is_null_if_a_symbol_is_unknown(spark):
    rows = spark.createDataFrame([("kg*zz",), ("",), (None,)], "t string").select(unit(F.col("t")).alias("u")).collect()
    assert [r.u for r in rows] == [None, None, None]
