import math
import random

import pyarrow as pa
from pyspark.sql import functions as F

from marketloom.operators import markets as markets_module
from marketloom.operators import components as components_module
from marketloom.operators.components import connected_components
from marketloom.functions.listing import NOISE, PROMOTIONAL, words
from marketloom.operators.markets import _alike, _met, _vectors, confidences, markets, memberships, similar_products, with_terms, with_tokens

SCHEMA = "id bigint, product_name string, niche string, category string, product_type string, keywords array<string>, description string, tokens int, df int"


def products(spark, rows):
    return spark.createDataFrame([(*r, 1, 1) for r in rows], SCHEMA)


def invented(n=150):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(40)] + ["bakery", "pricing", "calculators", "wedding", "budget"]
    rows = []
    for i in range(n):
        if rows and rng.random() < 0.5:
            base = list(rng.choice(rows))
            base[0], base[6] = i, (base[6] or "") + " " + rng.choice(words)
            rows.append(tuple(base))
        else:
            rows.append((i, " ".join(rng.sample(words, 5)), rng.choice(["Bakery", "bakery", None, ""]), None, rng.choice(["tracker", None]), rng.sample(words, 2), rng.choice([None, "", " ".join(rng.sample(words, 6))])))
    return rows + [(n, None, None, None, None, None, None)]


def test_similarity_against_brute_force(spark):
    df = products(spark, invented())
    docs = {r.id: r for r in with_tokens(df).collect()}
    n = len(docs)
    count = {}
    for d in docs.values():
        for t in d.tokens:
            count[t] = count.get(t, 0) + 1
    idf = {t: math.log((n + 1) / (c + 1)) + 1 for t, c in count.items()}
    want = {}
    for a in docs:
        for b in docs:
            x, y = docs[a], docs[b]
            s, t = set(x.tokens), set(y.tokens)
            if a < b and s and t:
                norm = lambda z: math.sqrt(sum(idf[w] ** 2 for w in z))
                shared = (x.niche_key and x.niche_key == y.niche_key) or (x.type_key and x.type_key == y.type_key)
                v = 0.55 * sum(idf[w] ** 2 for w in s & t) / norm(s) / norm(t) + 0.2 * len(s & t) / len(s | t) + (0.25 if shared else 0)
                if v >= 0.6:
                    want[a, b] = round(v, 6)
    got = {(r.a, r.b): round(r.similarity, 6) for r in similar_products(df, 0.6).collect()}
    assert got == want and len(want) > 50


def test_pairs_of_a_type_in_blocks(spark, monkeypatch):
    """Blocks of few products give the pairs of one block, and matrix products let few pass that don't reach the threshold."""
    rng = random.Random(5)
    rows = [(i, " ".join(f"w{w}" for w in rng.sample(range(60), 12)), None, None, "tracker", [f"n{rng.randrange(600)}x", f"m{rng.randrange(600)}x"], None) for i in range(600)]
    rows += [(1000 + r[0], r[1] + " more", *r[2:]) for r in rows[:50]]
    df = products(spark, rows)
    passed = []
    pairs = lambda: {(r.a, r.b, round(r.similarity, 6)) for r in similar_products(df).collect()}
    whole = pairs()
    assert {(r[0], 1000 + r[0]) for r in rows[:50]} <= {p[:2] for p in whole}
    monkeypatch.setattr(markets_module._alike, "__defaults__", (90,))
    assert pairs() == whole
    values = [[(1 << 20) * 512 + k] for k in (0, 0, 1, 1)]
    one = pa.table({"id": pa.array([4, 3, 2, 1], pa.int64()), "x": pa.array(values, pa.list_(pa.int32()))})
    for tile in (1, 3, 8):
        got = _met(one, one, True, 0.4, tile).to_pydict()
        passed.append(sorted(zip(got["a"], got["b"])))
    assert passed == [[(1, 2), (3, 4)]] * 3
    assert _met(one.slice(0, 2), one.slice(2, 2), False, 0.4).num_rows == 0 and _met(one.slice(0, 1), one.slice(1, 3), False, 0.4).num_rows == 1


def test_components(spark):
    chain = [(i, i + 1) for i in range(60)] + [(100, 90), (90, 80), (5, 5)]
    nodes = spark.range(0, 103).select(F.col("id").alias("node"))
    edges = spark.createDataFrame(chain, "a bigint, b bigint")
    got = {r.node: r.component for r in connected_components(nodes, edges).collect()}
    assert all(got[i] == 0 for i in range(61)) and got[100] == got[90] == got[80] == 80 and got[101] == 101 and len(got) == 103
    assert connected_components(nodes.limit(0), edges.limit(0)).count() == 0


def test_few_links_are_finished_at_once(spark, monkeypatch):
    """One table of links is written and no round follows; what rounds leave is the same as what one task finds."""
    rng = random.Random(9)
    links = [(rng.randrange(900), rng.randrange(900)) for _ in range(700)] + [(2000 - i, 1999 - i) for i in range(200)]
    low = {n: n for n in range(2001)}
    find = lambda n: n if low[n] == n else find(low[n])
    for a, b in links:
        a, b = find(a), find(b)
        low[max(a, b)] = min(a, b)
    written, write = [], components_module.staged
    monkeypatch.setattr(components_module, "staged", lambda df, name: written.append(name) or write(df, name))
    nodes, edges = spark.range(2001).withColumnRenamed("id", "node"), spark.createDataFrame(links, "a bigint, b bigint")
    found = lambda *most: {r.node: r.component for r in connected_components(nodes, edges, *most).collect()}
    assert found() == {n: find(n) for n in low} and written == ["components"]
    assert found(0) == found(600) == found() and len(written) > 5


def test_terms_and_markets(spark):
    rows = [
        (1, "Bakery Pricing Calculator", "bakery", None, "calculator", ["pricing"], "Price every cake"),
        (2, "Bakery pricing calculators", "bakery", None, "calculator", ["pricing"], "Price every cake"),
        (3, "Tattoo ROI tracker", None, None, "tracker", [], None),
        (4, None, None, None, None, None, None),
    ]
    df = products(spark, rows)
    terms = {r.id: r for r in with_terms(with_tokens(df)).collect()}
    assert terms[1].niche_terms == ["bakery", "cake"] and terms[1].problem_terms == ["pricing"] and terms[1].type_terms == ["calculator"]
    assert terms[3].niche_terms == ["tattoo artist"] and terms[3].keywords == ["tattoo", "roi", "tracker", "tattoo roi", "roi tracker"]
    clusters, members = markets(df)
    got = {r.component: r for r in clusters.collect()}
    assert got[1].product_count == 2 and got[1].cluster_name == "Bakery Pricing Calculators" and got[1].slug == "bakery-pricing-calculators"
    assert got[3].cluster_name == "Tattoo Artist ROI Trackers" and got[4].cluster_name == "Product Market"
    assert got[3].confidence == got[4].confidence == 1.0 and 0.9 < got[1].confidence <= 1
    assert {(r.component, r.product_id, r.membership_score) for r in members.collect()} == {(1, 1, got[1].confidence), (1, 2, got[1].confidence), (3, 3, 1.0), (4, 4, 1.0)}


def test_confidence_against_brute_force(spark):
    df = with_tokens(products(spark, invented(90)))
    members = df.withColumn("component", F.when(F.col("id") > 84, F.col("id")).otherwise(F.col("id") % 3))
    rows = members.collect()
    want = {}
    for c in {r.component for r in rows}:
        group = [r for r in rows if r.component == c]
        n = len(group)
        count = {}
        for r in group:
            for t in r.tokens:
                count[t] = count.get(t, 0) + 1
        idf = {t: math.log((n + 1) / (k + 1)) + 1 for t, k in count.items()}
        norm = lambda z: math.sqrt(sum(idf[w] ** 2 for w in z))
        total = 0.0
        for i, x in enumerate(group):
            for y in group[i + 1 :]:
                s, t = set(x.tokens), set(y.tokens)
                if s and t:
                    shared = (x.niche_key and x.niche_key == y.niche_key) or (x.type_key and x.type_key == y.type_key)
                    total += 0.55 * sum(idf[w] ** 2 for w in s & t) / norm(s) / norm(t) + 0.2 * len(s & t) / len(s | t) + (0.25 if shared else 0)
        want[c] = 1.0 if n == 1 else round(total / (n * (n - 1) / 2), 4)
    for block in (4, 512):
        got = {r.component: r.confidence for r in confidences(members, block).collect()}
        assert set(got) == set(want) and all(abs(got[c] - want[c]) < 2e-4 for c in want)
    assert confidences(members.limit(0)).count() == 0


def test_confidence_of_small_and_large_components(spark, monkeypatch):
    """A component that is one row gives what sums over tokens and blocks give, and leaves no sets to be met in blocks."""
    members = with_tokens(products(spark, invented(120))).withColumn("component", F.when(F.col("id") > 110, F.lit(9)).when(F.col("id") > 60, F.col("id") % 9 * 10).otherwise(F.lit(1)))
    told = lambda *a: {r.component: r.confidence for r in confidences(members, 16, *a).collect()}
    sums, blocks = told(0), []
    write = markets_module.staged
    monkeypatch.setattr(markets_module, "staged", lambda df, name: (out := write(df, name), name == "market-blocks" and blocks.append(out.count()))[0])
    for small in (30, 128):
        got = told(small)
        assert set(got) == set(sums) and all(abs(got[c] - sums[c]) < 2e-4 for c in sums) and len(got) > 9
    assert blocks[0] > 0 and blocks[1] == 0


def test_niches_come_from_the_taxonomy_given(spark):
    df = products(spark, [(1, "Reef tank dosing planner", None, None, None, ["coral"], None)])
    assert with_terms(with_tokens(df), ("coral", "reef")).first().niche_terms == ["coral", "reef"]
    assert with_terms(with_tokens(df)).first().niche_terms == []


def test_memberships_without_terms(spark, monkeypatch):
    """The memberships are those of the markets; no terms of members are found for them and products that stand alone are not compared."""
    df = products(spark, invented(200) + [(900 + i, None, "alone", None, None, None, None) for i in range(3)])
    for size in (2, 4):
        want = {tuple(r) for r in markets(df, minimum_size=size)[1].select("component", "product_id", "membership_score").collect()}
        written, write = {}, markets_module.staged
        with monkeypatch.context() as m:
            m.setattr(markets_module, "staged", lambda rows, name: written.setdefault(name, write(rows, name)))
            got = [tuple(r) for r in memberships(df, minimum_size=size).select("component", "product_id", "membership_score").collect()]
        assert set(got) == want and len(got) == len(want) and "market-terms" not in written
        parts = [r.component for r in written["market-parts"].collect()]
        assert written["market-told"].count() == sum(parts.count(c) > 1 for c in parts) < len(parts) == 204


def test_pairs_are_compared_where_they_are_found(spark, monkeypatch):
    """Only pairs that reach what is needed leave the blocks, and tokens that are joined get what tokens at hand get."""
    tokens = with_tokens(products(spark, invented())).select("id", "niche_key", "type_key", "tokens").cache()
    vectors, n = _vectors(tokens)
    found = [(r.a, r.b, round(r.part + 0.25, 9)) for r in _alike(vectors, n, 0.4).collect()]
    want = {(r.a, r.b): round(r.similarity, 9) for r in similar_products(products(spark, invented()), 0.65).collect()}
    assert {p[:2] for p in found} <= set(want) and all(want[a, b] == min(1, s) for a, b, s in found) and len(found) > 50
    monkeypatch.setattr(markets_module, "COMMON", 7)
    few = {r.id: (sorted(c >> 32 for c in r.t), round(r.norm2, 6)) for r in _vectors(tokens)[0].collect()}
    assert few == {r.id: (sorted(c >> 32 for c in r.t), round(r.norm2, 6)) for r in vectors.collect()} and len(few) == 150


def test_tokens_as_words(spark):
    rng = random.Random(2)
    texts = ["".join(rng.choice("aieses s1y-é\u0130b S") for _ in range(60)) for _ in range(300)] + ["the Classes for bakeries, PDF ties", "", None]
    df = products(spark, [(i, t, None, None, None, [t, "x"], t) for i, t in enumerate(texts)])
    want = F.array_distinct(F.filter(words(F.concat_ws(" ", "product_name", "keywords", "description")), lambda t: ~t.isin(*PROMOTIONAL, *NOISE)))
    assert {r.id: r.tokens for r in with_tokens(df).collect()} == {r.id: r.w for r in df.select("id", want.alias("w")).collect()}
