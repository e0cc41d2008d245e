import json
import os
from datetime import datetime, timezone
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from marketloom.operators import relational as R
from marketloom.operators.ingestion import ingest, normalize
from marketloom.sources import listings, sinks
from marketloom.streaming.ingest import compact_products, current_products, ingest_stream, raw_history

RAW = "id bigint, marketplace string, external_id string, search_query string, raw_payload string, collected_at timestamp"
AT = datetime(2024, 5, 1, tzinfo=timezone.utc)


def etsy(**more):
    base = {
        "listing_id": 770,
        "title": "\tReef   Tank\u00a0Dosing Planner ",
        "url": "HTTPS://Shop.Example/item/770?ref=front&size=xl&utm_term=reef#reviews",
        "price": {"amount": "4500", "divisor": 1000, "currency_code": " eur"},
        "review_count": "2.6k",
        "rating": "3,5 / 5",
        "shop_name": "Tide   Desk",
        "tags": ["Reef", " reef ", "salt", ""],
        "images": [{"url_570xN": "https://pics.example/a.png?click_key=9"}, {"other": 1}],
        "creation_timestamp": 1714003200,
        "product_type": "Tracker",
    }
    return json.dumps(base | more)


def test_normalize(spark):
    rows = [(1, "etsy", "770", "q", etsy(), AT), (2, "etsy", "6", "q", etsy(title=None), AT), (3, "gumroad", "7", "q", "{}", AT), (4, "etsy", "8", "q", "{broken", AT), (5, None, None, None, None, None)]
    got = {r.raw_product_id: r for r in normalize(spark.createDataFrame(rows, RAW)).collect()}
    r = got[1]
    assert (r.product_name, r.url, float(r.price), r.currency, r.review_count, r.rating, r.seller, r.keywords, r.image_urls, r.listing_age_days, r.identity_key, r.product_type, r.error) == (
        "Reef Tank Dosing Planner", "https://shop.example/item/770?size=xl", 4.5, "EUR", 2600, 3.5, "Tide Desk", ["Reef", "salt"], ["https://pics.example/a.png"], 6, "etsy:id:770", "tracker", None,
    )
    assert [got[i].error for i in (2, 3, 4, 5)] == ["no name or address", "unregistered marketplace", "unreadable payload", "unregistered marketplace"]


def test_ingest_counts(spark):
    rows = [(1, "etsy", "5", "q", etsy(), AT), (2, "etsy", "5", "q", etsy(title="New"), AT), (3, "etsy", "5", "q", "[]", AT)]
    products, report = ingest(spark.createDataFrame(rows, RAW))
    assert [(r.product_name, r.raw_product_id) for r in products.collect()] == [("New", 2)]
    assert [tuple(r) for r in report.collect()] == [("etsy", 3, 2, 1, 1, 1)]
    assert [c.count() for c in ingest(spark.createDataFrame([], RAW))] == [0, 0]
    assert ingest(listings.sample_listings(spark))[0].count() == 3


def test_relational(spark):
    old = spark.createDataFrame([("a", 1, 10, 10), ("b", 2, 10, 10)], "k string, v int, created_at int, updated_at int")
    new = spark.createDataFrame([("b", None, 20, 20), ("c", 3, 20, 20), ("c", 4, 30, 30)], "k string, v int, created_at int, updated_at int")
    assert sorted(tuple(r) for r in R.upsert(old, new, "k", ["updated_at"]).collect()) == [("a", 1, 10, 10, False), ("b", None, 10, 20, False), ("c", 4, 20, 30, True)]
    assert sorted(tuple(r) for r in R.latest_per_key(new, ["k"], ["updated_at"]).collect()) == [("b", None, 20, 20), ("c", 4, 30, 30)]
    assert [r.k for r in R.find(old, 5, [F.col("v").desc()], k=None).collect()] == ["b", "a"]
    edges = spark.createDataFrame([(1, 7), (2, 7)], "cluster_id bigint, product_id bigint")
    products = spark.createDataFrame([(7, AT)], "id bigint, collected_at timestamp")
    assert R.observation_metadata([1, 2], edges, products).first().observations == 2
    assert R.observation_metadata([], edges, products).first().observations == 0
    assert R.cluster_members(edges, products).count() == 1
    earlier = spark.createDataFrame([("b", 9, 5, 5)], "k string, v int, created_at int, updated_at int")
    assert [r.created_at for r in R.upsert(old, earlier, "k", ["updated_at"]).where("k = 'b'").collect()] == [10]
    assert [(r.k, r["rank"]) for r in R.ranked(new, [F.col("updated_at").desc(), F.col("v")], 2).collect()] == [("c", 1), ("b", 2)]
    got = R.latest_values(old.select("k"), "k", {"n": (new, ["updated_at"], ["v"])}).collect()
    assert {(r.k, r.n_v) for r in got} == {("a", None), ("b", None)}
    known = spark.createDataFrame([("x", 5)], "identity_key string, id bigint")
    made = spark.createDataFrame([(1, "x", 0.5), (1, "x", 0.5), (1, "y", 0.5)], "cluster_id bigint, identity_key string, membership_score double")
    saved, missing = R.save_memberships(made, known)
    assert [tuple(r) for r in saved.collect()] == [(1, 0.5, 5)] and [r.identity_key for r in missing.collect()] == ["y"]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, 2.5, None, ["a", "b"]), (2, 3.0, "x,y", [])], "id int, score double, note string, keywords array<string>")
    folder = str(tmp_path / "report")
    assert sinks.write_report({"top": df}, folder) == ["report.json", "top.csv"]
    text = open(os.path.join(folder, "report.json"), encoding="utf-8").read()
    assert json.loads(text)["top"][0]["keywords"] == ["a", "b"] and text.endswith("}\n")
    assert open(os.path.join(folder, "top.csv"), encoding="utf-8").read() == 'id,score,note,keywords\n1,2.5,,a | b\n2,3,"x,y",\n'
    sinks.write_csv(df.coalesce(1), str(tmp_path / "parts"))
    part = next(f for f in os.listdir(tmp_path / "parts") if f.endswith(".csv"))
    assert open(tmp_path / "parts" / part, encoding="utf-8").read() == 'id,score,note,keywords\n1,2.5,,a | b\n2,3,"x,y",\n'
    one = sinks.write_search_result(df, str(tmp_path / "found"), "etsy", "Reef  Tank!", AT)
    assert one.endswith("found/etsy/reef-tank/2024-05-01T00-00-00.json") and json.loads(open(one).read())["products"][1]["note"] == "x,y"
    with pytest.raises(FileExistsError):
        sinks.write_report({"top": df}, folder)
    with pytest.raises(ValueError):
        sinks.write_report({}, str(tmp_path / "other"), ("pdf",))
    assert sinks.search_result_path("out", "etsy", "a-b", AT).endswith("etsy/a-b/2024-05-01T00-00-00.json")
    (tmp_path / "terms.json").write_text('[" Bakery ", "", "cake"]')
    assert listings.taxonomy(spark, str(tmp_path / "terms.json")) == ["bakery", "cake"]
    (tmp_path / "broken.json").write_text("[")
    assert listings.taxonomy(spark, str(tmp_path / "missing.json")) == listings.taxonomy(spark, str(tmp_path / "broken.json")) == []
    (tmp_path / "terms").mkdir()
    for name, text in (("a.json", '["Cake"]'), ("b.json", '["ink", "cake"]')):
        (tmp_path / "terms" / name).write_text(text)
    assert listings.taxonomy(spark, str(tmp_path / "terms")) == ["cake", "ink"]
    (tmp_path / "l.json").write_text(etsy() + "\n[]\n")
    assert [r.external_id for r in listings.json_listings(spark, str(tmp_path / "l.json"), "etsy", " a  b ", "listing_id").collect()] == ["770"]


def test_recorded_pages(spark, tmp_path):
    page = lambda offset, ids, query="reef": json.dumps({"query": query, "offset": offset, "results": [i if i is None else {"listing_id": i} for i in ids]})
    (tmp_path / "p.json").write_text("\n".join([page(2, [3, None]), page(0, [1, 2]), page(4, [5]), page(6, [7, 8]), page(0, [99], "other"), "no page"]))
    source = listings.RecordedPages(str(tmp_path / "p.json"), page_size=2)
    assert sorted(r.external_id for r in source.search(spark, " reef ", 50).collect()) == ["1", "2", "3", "5"]
    assert sorted(r.external_id for r in source.search(spark, "reef", 3).collect()) == ["1", "2", "3"]
    assert source.search(spark, "none", 9).count() == 0


def test_stream(spark, tmp_path):
    source, target, state = (str(tmp_path / x) for x in ("source", "target", "state"))
    for i, title in enumerate(("First", "Second", "Third")):
        spark.createDataFrame([(i, "etsy", "5", "q", etsy(title=title), AT), (10 + i, "etsy", "9", "q", "{", AT)], RAW).write.mode("append").parquet(source)
        ingest_stream(spark, source, target, state).awaitTermination()
        assert [r.product_name for r in current_products(spark, target).collect()] == [title]
        if i:
            compact_products(spark, target)
            assert len([f for f in os.listdir(f"{target}/products") if f.startswith("batch=")]) == 1
    assert [r.product_name for r in current_products(spark, target).collect()] == ["Third"]
    assert raw_history(spark, target).count() == 6


def test_staged_tables_are_dropped_together(spark):
    from marketloom.session import drop_staged, shared_dir, staged

    df = staged(spark.range(5).toDF("id"), "x")
    assert df.count() == 5
    run = os.path.dirname(os.path.dirname(df.inputFiles()[0].removeprefix("file://")))
    assert run.startswith(shared_dir(spark).removeprefix("file://")) and os.path.isdir(run)
    drop_staged(spark)
    assert not os.path.exists(run)


def test_cluster_summaries(spark):
    from marketloom.operators import concentration as K

    schema = "id bigint, marketplace string, seller string, review_count int, price decimal(18,4), rating double, keywords array<string>, niche string, product_type string, description string, image_urls array<string>, n int, i int"
    rows = [(i, "etsy", "  " if i == 1 else "S", i * 10, None if i == 5 else Decimal(i), 4.0, ["A", "a ", None], "bakery", None, "one longer words", ["u"] if i % 2 else None, 1, 1) for i in range(1, 6)]
    products = spark.createDataFrame(rows, schema)
    edges = spark.createDataFrame([(1, i) for i in range(1, 6)] * 2 + [(None, 1), (2, 99)], "cluster_id bigint, product_id bigint")
    c = K.concentration(edges, products).collect()
    assert [(r.competitor_count, r.seller_count, r.top_seller_listing_share, r.top_3_review_share) for r in c] == [(5, 2, 0.8, 1.0)]
    d = K.dispersion(edges, products).first()
    assert (d.priced, d.price_min, d.price_median, d.price_max, d.price_mean) == (4, 1.0, 2.5, 4.0, 2.5)
    s = K.price_segments(edges, products).first()
    assert (s.entry_price, s.middle_price, s.leader_price, s.lower_third, s.upper_third) == (2.0, 3.0, 4.0, 2.0, 3.0)
    assert [(r.keyword, r.uses) for r in K.top_keywords(edges, products).collect()] == [("a", 10)]
    assert {r.signal for r in K.top_signals(edges, products).collect()} == {"a", "bakery", "longer", "words"}
    assert K.images(edges, products).where("url is null").count() == 2
    assert K.concentration(edges.limit(0), products).count() == 0
    five = products.withColumn("seller", F.col("id").cast("string"))  # five sellers with 10 to 50 reviews
    assert K.concentration(edges, five).first().top_3_review_share == 0.8
    q = K.quality_signals(edges, products).first()
    assert (q.rating_median, q.rated_share, round(q.quality, 6)) == (4.0, 1.0, 0.84) and q.differentiation == 0.0 and 0 < q.price_compression < 1
    assert round(q.depth, 6) == round(3 / 80 * 0.7 + 2 / 12 * 0.3, 6)
    v = K.review_coverage(edges, products).first()
    assert (v.reviews_available, v.reviews_analyzed, v.review_coverage) == (True, 150, 1.0)
    clusters = spark.createDataFrame([(1, ["Zed", "a"]), (7, None)], "id bigint, keywords array<string>")
    assert {r.cluster_id: r.keywords for r in K.cluster_keywords(clusters, edges, products).collect()} == {1: ["bakery", "longer", "words", "zed", "a"], 7: []}
    assert [tuple(r) for r in K.long_tail_keywords(edges, products).collect()] == [(1, "a a", 1)]
