from datetime import date
from decimal import Decimal

from pyspark.sql import functions as F

from marketloom.functions import listing as L


def values(spark, function, inputs, kind="string"):
    df = spark.createDataFrame([(x,) for x in inputs], f"t {kind}")
    return [r[0] for r in df.select(function(F.col("t"))).collect()]


def test_prices(spark):
    cases = {"$12.99": "12.99", "US$ 8.50": "8.5", "€9,50": "9.5", "R$ 1.299,90": "1299.9", "1.299": "1299", "12.99.": "1299", "$5, then": "5", "1,234": "1234", "no": None, "": None}
    got = values(spark, L.price_amount, list(cases))
    assert [g if g is None else g.normalize() for g in got] == [c and Decimal(c).normalize() for c in cases.values()]
    assert values(spark, L.price_currency, ["$1", "us$ 1", "CA$1", "A$1", "R$1", "1 eur", "1", None]) == ["USD", "USD", "CAD", "AUD", "BRL", "EUR", None, None]


def test_reviews_and_ratings(spark):
    assert values(spark, L.review_count, ["532 reviews", "1,234 reviews", "2.1k", "10 k", "5 kits", "3 major", "none", None]) == [532, 1234, 2100, 10000, 5000, 3000000, None, None]
    assert values(spark, L.rating, ["4.9 / 5", "4,8 stars", "9 / 10", "6", "0", "", None]) == [4.9, 4.8, None, None, 0.0, None, None]


def test_urls(spark):
    cases = {
        " HTTPS://Shop.Example/A/b?utm_source=x&variation=42&REF=1#top ": "https://shop.example/A/b?variation=42",
        "https://a.b/c?x=&y=1": "https://a.b/c?x=&y=1",
        "https://a.b/c?q=a%20b": "https://a.b/c?q=a+b",
        "https://a.b": "https://a.b",
    }
    assert values(spark, L.canonical_url, list(cases)) == list(cases.values())


def test_keywords_slugs_and_types(spark):
    assert values(spark, L.normalize_keywords, [["  Bakery ", "bakery", "", None, "Cake  shop"], [], None], "array<string>") == [["Bakery", "Cake shop"], [], []]
    assert values(spark, L.slug, ["Bakery & Cake!", "---", ""]) == ["bakery-cake", "product-market", "product-market"]
    assert values(spark, L.controlled_product_type, [" Tracker ", "ebook", None]) == ["tracker", None, None]
    assert values(spark, L.normalize_text, [" a \n b\t", " ", None]) == ["a b", None, None]


def test_identity_age_and_display(spark):
    df = spark.createDataFrame([("etsy", "1", "u", date(2024, 1, 1), date(2024, 1, 11), 5.0, "BRL"), ("etsy", "", "u", date(2024, 2, 1), date(2024, 1, 1), None, "USD"), ("etsy", None, None, None, None, 1.0, "JPY")], "m string, e string, u string, l date, n date, a double, c string")
    got = df.select(L.identity_key(F.col("m"), F.col("e"), F.col("u")), L.listing_age_days(F.col("l"), F.col("n")), L.price_display(F.col("a"), F.col("c"))).collect()
    assert [tuple(r) for r in got] == [("etsy:id:1", 10, "R$ 5.00"), ("etsy:url:u", 0, None), (None, None, "JPY 1.00")]


def test_words(spark):
    assert values(spark, L.words, ["Bakeries & Classes, boxes: glass CANVAS", None]) == [["bakery", "class", "boxe", "glass", "canva"], []]


def test_combined_keywords_and_first_filled(spark):
    df = spark.createDataFrame([(["A b", " a  B "], None, " ", " x ", "1e400"), (None, ["c", None], None, None, " 2.5 ")], "k array<string>, l array<string>, s string, t string, n string")
    got = df.select(L.combined_keywords(F.col("k"), F.col("l")), L.first_filled(F.col("s"), F.col("t")), L.safe_number(F.col("n"))).collect()
    assert [tuple(r) for r in got] == [(["A b"], "x", None), (["c"], None, 2.5)]
