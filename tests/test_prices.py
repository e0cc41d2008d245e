import json
from datetime import datetime, timedelta, timezone
from decimal import Decimal

from marketloom.operators.prices import corrected_prices, resolved_prices

AT = datetime(2025, 3, 31, 23, 59, 59, tzinfo=timezone.utc)
P = "id bigint, raw_product_id bigint, price decimal(18,4), currency string, description string, collected_at timestamp, amount int, r int"
R = "id bigint, marketplace string, external_id string, raw_payload string, collected_at timestamp"
FX = "currency string, rate_month string, usd_per_unit decimal(18,6)"


def tables(spark):
    pound = json.dumps({"price_text": "£9.99", "available": True})
    older = json.dumps({"price_text": "£99.99", "available": True})
    raw = spark.createDataFrame([(1, "mock", "a", pound, AT), (2, "mock", "b", "{broken", AT), (3, "mock", "c", json.dumps({"price_text": "$" + "1," * 60_000, "available": True}), AT), (1, "mock", "a", pound, AT), (1, "mock", "a", older, AT - timedelta(days=1))], R)
    fx = spark.createDataFrame([("USD", "2025-03", Decimal(1)), ("GBP", "2025-03", Decimal("1.25")), ("JPY", "2025-03", Decimal("0.0067"))], FX)
    return raw, fx


CASES = [
    # raw id, price, currency, description -> amount, currency, cents, as stored
    (1, "9.99", "GBP", None, "9.99", "GBP", 1249, True),
    (1, "999", "GBP", "Price: $3", "9.99", "GBP", 1249, False),
    (1, "9.99", "gbp", None, "9.99", "GBP", 1249, False),
    (2, "5", "USD", None, "5", "USD", 500, True),
    (None, "5", "$", None, "5", "USD", 500, False),
    (None, "2.5", "USD", "Nice. (figure in thousands)", "2500", "USD", 250000, False),
    (None, "549", "GBP", "Amount is listed in cents.", "5.49", "GBP", 686, False),
    (None, "5", "USD", "Charged in yen.", "5", "JPY", 3, False),
    (1, "9.99", "GBP", "Try it with a €700 sample order.", "9.99", "GBP", 1249, True),  # teaches that such an amount isn't the price
    (1, "9.99", "GBP", "Shows totals in thousands for big jobs.", "9.99", "GBP", 1249, True),
    (None, None, None, "Try it with a €500 sample order. Yours for £ 2.00.", "2", "GBP", 250, False),
    (None, None, None, "Try it with a €500 sample order.", None, None, None, None),
    (None, None, None, "Once £2 and twice $3", None, None, None, None),  # either may be the price
    (None, "2", "USD", "Shows totals in thousands, the number stands for thousands.", "2000", "USD", 200000, False),
    (None, "3", "USD", "Includes a US dollars and a euros column", "3", "USD", 300, True),
    (None, None, "USD", "Shows totals in thousands for big jobs.", None, None, None, None),
    (None, "5", None, "Handles orders up to $39,000.", None, None, None, None),
    (None, "5", "EUR", None, "5", "EUR", None, True),
    (9, "5", "USD", "x" * 50_000, "5", "USD", 500, True),
    (None, "5", "USD", "$" + "1,1." * 30_000 + " $7 EUR9 " * 5_000 + "thousands " * 5_000, "5", "USD", 500, True),
    (None, None, None, None, None, None, None, None),
]


def test_cases(spark):
    raw, fx = tables(spark)
    rows = [(i, c[0], c[1] and Decimal(c[1]), c[2], c[3], AT, 1, 2) for i, c in enumerate(CASES)]
    products = spark.createDataFrame(rows, P)
    got = {r.product_id: r for r in resolved_prices(products, raw, fx).collect()}
    assert len(got) == len(CASES)
    for i, c in enumerate(CASES):
        g = got[i]
        assert (g.amount and g.amount.normalize(), g.currency, g.usd_cents, g.as_stored) == (c[4] and Decimal(c[4]).normalize(), c[5], c[6], c[7]), c
    assert {(r.product_id, r.usd_cents) for r in corrected_prices(products.union(products), raw, fx).collect()} == {(i, c[6]) for i, c in enumerate(CASES) if c[7] is False}


def test_empty_tables(spark):
    raw, fx = tables(spark)
    none = spark.createDataFrame([], P)
    assert resolved_prices(none, raw, fx).count() == 0
    one = spark.createDataFrame([(1, 1, Decimal(5), "USD", None, AT, 1, 1)], P)
    assert [r.usd_cents for r in resolved_prices(one, raw.limit(0), fx.limit(0)).collect()] == [None]


def test_reworded_statements_are_learnt(spark):
    raw = spark.createDataFrame([(i, "mock", "a", json.dumps({"price_text": f"£{i}.50", "available": True}), AT) for i in range(1, 9)], R)
    _, fx = tables(spark)
    known = [(i, i, None, None, f"Take home today at £{i}.50 flat. Ships with £{i}00 credit. Every sum in pounds here.", AT, 1, 2) for i in range(1, 9)]
    new = [(20, None, None, None, "Ships with £900 credit. Take home today at £7.25 flat.", AT, 1, 2), (21, None, Decimal(4), "USD", "Every sum in pounds here", AT, 1, 2)]
    got = {r.product_id: (r.amount, r.currency) for r in resolved_prices(spark.createDataFrame(known + new, P), raw, fx).collect()}
    assert got[20] == (Decimal("7.25"), "GBP") and got[21] == (Decimal(4), "GBP")
