import json
import random
from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from marketloom.operators.history import SLICE_ROWS, sliced, version_history
from marketloom.operators.listing_history import listing_history

RAW = "id bigint, marketplace string, external_id string, search_query string, raw_payload string, collected_at timestamp, created_at timestamp"
T0 = datetime(2024, 1, 1, tzinfo=timezone.utc)


def brute(rows):
    """rows: key, t, order, live, a, b -> set of (key, a, b, from, to)."""
    out = set()
    for key in {r[0] for r in rows if r[0] is not None}:
        seen = {}
        for r in rows:
            if r[0] == key and r[1] is not None and r[3] is not None and (r[1] not in seen or r[2] > seen[r[1]][2]):
                seen[r[1]] = r
        a = b = None
        open_from = None
        for t in sorted(seen):
            _, _, _, live, na, nb = seen[t]
            if not live:
                if open_from is not None:
                    out.add((key, a, b, open_from, t))
                open_from = None
                continue
            new = (na if na is not None else a, nb if nb is not None else b)
            if open_from is None:
                open_from = t
            elif new != (a, b):
                out.add((key, a, b, open_from, t))
                open_from = t
            a, b = new
        if open_from is not None:
            out.add((key, a, b, open_from, None))
    return out


def test_against_brute_force(spark):
    rng = random.Random(5)
    rows = []
    for i in range(3000):
        key = rng.choice(["hot", "hot", "hot", "x", "y", "z", None])
        rows.append((key, rng.choice([None] + list(range(400))) if i % 50 == 0 else rng.randrange(400), i, rng.choice([True] * 6 + [False, None]), rng.choice(["A", "B", None, "A"]), rng.choice([1, 2, None, 1])))
    df = spark.createDataFrame(rows, "k string, t bigint, o bigint, live boolean, a string, b int").selectExpr("*", "'clash' as e", "1 as slice", "2 as k0", "3 as a0")
    for units, slice_rows in (((1,), 1), ((1000, 50, 7), 20), ((1000,), 10), ((400, 100, 10, 1), 3)):
        got = {tuple(r) for r in version_history(df, ["k"], "t", "o", "live", ["a", "b"], units, slice_rows).collect()}
        assert got == brute(rows), units


def test_a_dense_entity_is_cut_into_bounded_slices(spark):
    n = 100_000
    second = 1_000_000
    t = F.when(F.col("id") < 90_000, F.col("id") * 500_000).otherwise(45_000 * second + (F.col("id") - 90_000) * 7)  # a day, its end a burst
    df = spark.range(n).select(F.lit("hot").alias("k"), t.alias("t"), F.col("id").alias("o"), F.lit(True).alias("live"), (F.col("id") / 3).cast("int").alias("a"))
    slices = sliced(df.select("k", "t"), ["k"]).groupBy("slice").count().collect()
    assert max(r["count"] for r in slices) <= SLICE_ROWS < n / len(slices) * 20
    got = version_history(df, ["k"], "t", "o", "live", ["a"])
    assert got.count() == (n + 2) // 3 and got.where("valid_to is null").count() == 1 and got.where("valid_to <= valid_from").count() == 0


def test_many_rows_at_one_instant(spark):
    df = spark.range(50_000).select(F.lit("k").alias("k"), F.lit(5).cast("bigint").alias("t"), F.col("id").alias("o"), F.lit(True).alias("live"), F.col("id").alias("a"))
    assert [tuple(r) for r in version_history(df, ["k"], "t", "o", "live", ["a"]).collect()] == [("k", 49_999, 5, None)]


def test_repeats_and_empty(spark):
    df = spark.createDataFrame([("k", 1, 1, True, "a")] * 5, "k string, t bigint, o bigint, live boolean, a string")
    assert [tuple(r) for r in version_history(df, ["k"], "t", "o", "live", ["a"]).collect()] == [("k", "a", 1, None)]
    assert version_history(df.limit(0), ["k"], "t", "o", "live", ["a"]).count() == 0


def raw(spark, payloads):
    rows = [(i, m, e, None, p if p is None or isinstance(p, str) else json.dumps(p), None if s is None else T0 + timedelta(seconds=s), None) for i, (m, e, s, p) in enumerate(payloads)]
    return spark.createDataFrame(rows, RAW)


def mock(title="T", price="$5", seller="S", on=True, **more):
    return {"id": "m1", "name": title, "price_text": price, "seller_name": seller, "available": on, **more}


def test_listing_rules(spark):
    base = int(T0.timestamp())
    df = raw(
        spark,
        [
            ("mock", "m1", 0, mock()),
            ("mock", None, 10, mock(title="  T ", price="5.00 USD")),  # the payload's own id, the same as meant
            ("mock", "m1", 20, mock(title=None, price=None)),  # unknown: as before
            ("mock", "m1", 30, mock(title="t")),  # letter case counts
            ("mock", "m1", 40, mock(on=False, title="ignored")),
            ("mock", "m1", 50, mock(title=None)),  # back on sale under the last title
            ("mock", "m1", 60, '{"error":"rate limited","code":429}'),
            ("mock", "m1", 60, "[]"),
            ("mock", "m1", 65, '{"id":"m1","name":"cut o'),
            ("mock", "m1", 66, None),
            ("mock", "m1", 70, mock(title="t", price="600 cents USD")),
            ("mock", "m1", 70, mock(title="t", price="7 USD")),  # several at one instant: the highest id
            ("mock", "m1", None, mock(title="never")),
            (None, "m1", 80, mock(title="nowhere")),
            ("etsy", "e1", 5, {"title": "E", "price": {"amount": 1490, "divisor": 100, "currency_code": "usd"}, "shop_name": "S", "state": "inactive", "listing_id": 1}),
        ],
    )
    got = sorted((r.title, float(r.amount), r.currency, r.seller, r.valid_from - base, r.valid_to if r.valid_to == -1 else r.valid_to - base) for r in listing_history(df).collect())
    assert got == sorted([("T", 5.0, "USD", "S", 0, 30), ("t", 5.0, "USD", "S", 30, 40), ("t", 5.0, "USD", "S", 50, 70), ("t", 7.0, "USD", "S", 70, -1)])


def test_payload_notations_agree(spark):
    pairs = [
        ("etsy", {"state": "active", "listing_id": 7, "price": {"amount": 14900, "divisor": 1000, "currency_code": "EUR"}}, {"state": "active", "price": "14,90 €"}),
        ("creative_market", {"status": "live", "list_price": "R$ 1.234,50"}, {"status": "live", "list_price": "1,234.50 BRL"}),
        ("gumroad", {"published": True, "price_cents": "300", "currency": "usd"}, {"published": True, "price_cents": 300, "currency": "USD"}),
    ]
    df = raw(spark, [(m, "x", s, p) for m, a, b in pairs for s, p in ((0, a), (1, b))])
    assert sorted((r.marketplace, float(r.amount), r.valid_to) for r in listing_history(df).collect()) == [("creative_market", 1234.5, -1), ("etsy", 14.9, -1), ("gumroad", 3.0, -1)]
