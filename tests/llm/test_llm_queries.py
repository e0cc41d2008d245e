import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from conftest import SMALL
from marketloom.llm.queries import QUERIES, SQL

FOUND = {"p4_found": ["product_id_a", "product_id_b"], "p6_found": ["doc_id", "item_id"]}
LARGER = SMALL.replace("0.001", "0.01")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_runs(spark, duck, name):
    df = entry.queries()[name](spark, SMALL)
    rows = df.collect()
    assert rows or name == "p6_near"
    if name in FOUND:
        assert df.columns == FOUND[name] and len(set(rows)) == len(rows)
    if name in SQL:
        want = duck.sql(SQL[name])
        at = [want.columns.index(c) for c in df.columns]
        assert sorted(tuple(r) for r in rows) == sorted(tuple(r[i] for i in at) for r in want.fetchall())


def test_subset_shows_every_value_it_can(spark):
    shown = {r.field: (r.distinct_chosen, r.distinct_values) for r in QUERIES["p1_coverage"](spark, LARGER).collect()}
    assert all(chosen == values for chosen, values in shown.values()) and shown["niche"][1] > 30


def test_clusters_follow_the_niches_of_listings(spark):
    products = spark.read.parquet(f"{LARGER}/products.parquet").select(F.col("id").alias("product_id"), F.lower(F.trim("niche")).alias("niche")).where("niche <> ''")
    rows = QUERIES["p3_members"](spark, LARGER).join(products, "product_id").groupBy("cluster", "niche").count().collect()
    best, everything, niches = {}, 0, {}
    for r in rows:
        best[r.cluster] = max(best.get(r.cluster, 0), r["count"])
        niches[r.niche] = niches.get(r.niche, 0) + r["count"]
        everything += r["count"]
    purity, chance = sum(best.values()) / everything, max(niches.values()) / everything
    print("purity", purity, "most frequent niche", chance)
    assert purity > 2 * chance


def test_shares_reach_their_targets(spark):
    rows = {r.source_name: r for r in QUERIES["p7_shares"](spark, SMALL.replace("0.001", "0.1")).collect()}
    assert abs(sum(r.reached_share for r in rows.values()) - 1) < 1e-9
    free = [r for r in rows.values() if r.available_tokens and r.rate < r.max_repeats]
    scale = sum(r.reached_tokens for r in free) / sum(r.target_share for r in free)
    assert all(abs(r.reached_tokens - r.target_share * scale) < 0.1 * r.target_share * scale for r in free)
    assert abs(sum(r.corpus_share for r in rows.values()) - 1) < 0.05
