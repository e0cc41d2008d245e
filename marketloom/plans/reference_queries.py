"""Queries of the relational core, normalisation, ingestion, market clustering and cluster summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.functions import listing as L
from marketloom.operators import concentration as K
from marketloom.operators import markets as M
from marketloom.operators import relational as R
from marketloom.operators.components import connected_components
from marketloom.operators.ingestion import ingest, normalize
from marketloom.plans.reference_sql import SQL as SQL
from marketloom.session import ship_package, staged, table


def _seconds(name: str) -> Column:
    return F.unix_seconds(name).alias(name)


def q_recent_products(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "products")
    return R.find(p, 50, [F.col("updated_at").desc(), F.col("id").desc()], marketplace="etsy").select("id", "identity_key", _seconds("updated_at"))


def q_recent_raw(spark: SparkSession, d: str) -> DataFrame:
    return R.find(table(spark, d, "raw_marketplace_products"), 50, [F.col("id").desc()]).select("id", "marketplace", "external_id")


def q_lookup(spark: SparkSession, d: str) -> DataFrame:
    """Products by identity: the rows of the marketplace and external id that the newest product with one has."""
    products = table(spark, d, "products")
    key = R.find(products.where("external_id is not null"), 1, [F.col("id").desc()]).select("marketplace", "external_id").first()
    found = products.limit(0) if key is None else R.lookup(products, **key.asDict())
    return found.select("id", "identity_key", "marketplace", "external_id")


def q_cluster(spark: SparkSession, d: str) -> DataFrame:
    """One cluster by id (the largest), with its members."""
    clusters, edges = table(spark, d, "product_clusters"), table(spark, d, "product_cluster_memberships")
    wanted = R.find(clusters, 1, [F.col("product_count").desc_nulls_last(), F.col("id")]).select("id").first()
    one = R.find(clusters, 1, [F.col("id")], id=wanted and wanted["id"]).select(F.col("id").alias("cluster_id"), "cluster_name", "slug")
    members = R.cluster_members(edges, table(spark, d, "products"), wanted and wanted["id"]).select(F.col("id").alias("product_id"), "product_name")
    return one.join(members, F.lit(True), "left")


def q_observed(spark: SparkSession, d: str) -> DataFrame:
    """Observation metadata of the ten newest clusters."""
    ids = [r["id"] for r in R.find(table(spark, d, "product_clusters"), 10, [F.col("id").desc()]).select("id").collect()]
    m = R.observation_metadata(ids, table(spark, d, "product_cluster_memberships"), table(spark, d, "products"))
    return m.select("observations", _seconds("first_collected_at"), _seconds("last_collected_at"))


def q_memberships(spark: SparkSession, d: str) -> DataFrame:
    """Memberships named by identity, as a clustering run hands them over, resolved to the ids of stored products."""
    products = table(spark, d, "products")
    named = table(spark, d, "product_cluster_memberships").join(products.select(F.col("id").alias("product_id"), "identity_key"), "product_id")
    return R.save_memberships(named.select("cluster_id", "membership_score", "identity_key"), products)[0]


def q_latest_scores(spark: SparkSession, d: str) -> DataFrame:
    """Every market (slug) with its latest cluster's size and confidence, and the latest run it was in."""
    clusters, runs = table(spark, d, "product_clusters"), table(spark, d, "cluster_runs")
    base = clusters.where("slug is not null").select("slug").distinct()
    seen = clusters.join(runs.select(F.col("id").alias("run_id"), "algorithm", "started_at"), "run_id").where("started_at is not null")
    return R.latest_values(base, "slug", {"cluster": (clusters, ["created_at", "id"], ["product_count", "confidence"]), "run": (seen, ["started_at", "id"], ["algorithm", "run_id"])})


def q_ranking(spark: SparkSession, d: str) -> DataFrame:
    """The 25 largest clusters in order of size, confidence and id, all descending, numbered."""
    order = [F.col("product_count").desc_nulls_last(), F.col("confidence").desc_nulls_last(), F.col("id").desc()]
    return R.ranked(table(spark, d, "product_clusters"), order, 25).select("rank", "id", "product_count", "confidence")


def q_histogram(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "cluster_runs").groupBy("algorithm", F.col("completed_at").isNotNull().alias("completed")).agg(F.count("*").alias("runs"))


def q_counts(spark: SparkSession, d: str) -> DataFrame:
    one = lambda name: table(spark, d, name).groupBy("marketplace").agg(F.count("*").alias("rows")).withColumn("source", F.lit(name))
    return one("products").unionByName(one("raw_marketplace_products"))


def q_top_clusters(spark: SparkSession, d: str) -> DataFrame:
    top = R.find(table(spark, d, "product_clusters"), 100, [F.col("product_count").desc(), F.col("created_at").desc(), F.col("id")])
    edges = table(spark, d, "product_cluster_memberships").select(F.col("cluster_id").alias("id"), "product_id").distinct()
    return top.join(edges, "id", "left").groupBy("id", "cluster_name", "product_count").agg(F.count("product_id").alias("members"))


def q_cluster_members(spark: SparkSession, d: str) -> DataFrame:
    return R.cluster_members(table(spark, d, "product_cluster_memberships"), table(spark, d, "products")).select("id", "product_name")


def q_latest_observation(spark: SparkSession, d: str) -> DataFrame:
    raw = table(spark, d, "raw_marketplace_products").where("external_id is not null").select("marketplace", "external_id", "collected_at", "id")
    return R.latest_per_key(raw, ["marketplace", "external_id"], ["collected_at", "id"]).select("marketplace", "external_id", _seconds("collected_at"), "id")


def q_latest_run(spark: SparkSession, d: str) -> DataFrame:
    return R.find(table(spark, d, "cluster_runs"), 1, [F.col("id").desc()]).select("id", "algorithm", "product_count", "cluster_count")


def q_observation_metadata(spark: SparkSession, d: str) -> DataFrame:
    m = R.observation_metadata(None, table(spark, d, "product_cluster_memberships"), table(spark, d, "products"))
    return m.select("observations", _seconds("first_collected_at"), _seconds("last_collected_at"))


def n_texts(spark: SparkSession, d: str) -> DataFrame:
    """Price, currency, review count and rating read from the texts of all payloads, whatever their fields are called."""
    raw = table(spark, d, "raw_marketplace_products")
    any_of = lambda *names: F.coalesce(*(F.get_json_object("raw_payload", f"$.{n}") for n in names))
    price = any_of("price_text", "list_price")
    return raw.select(
        "id",
        L.price_amount(price).alias("amount"),
        L.price_currency(price).alias("currency"),
        L.review_count(any_of("review_count", "reviews_text")).alias("reviews"),
        L.rating(any_of("rating", "rating_text")).alias("rating"),
    )


def n_urls(spark: SparkSession, d: str) -> DataFrame:
    """Addresses of all payloads, and of all products, in canonical form."""
    raw = table(spark, d, "raw_marketplace_products").select("id", F.lit("raw").alias("source"), F.coalesce(F.get_json_object("raw_payload", "$.url"), F.get_json_object("raw_payload", "$.listing_url")).alias("u"))
    both = raw.unionByName(table(spark, d, "products").select("id", F.lit("products").alias("source"), F.col("url").alias("u")))
    return both.select("id", "source", L.canonical_url(F.col("u")).alias("url")).where("url is not null")


def n_display(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "products").select("id", L.price_display(F.col("price"), F.col("currency")).alias("display"))


def n_keywords(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "products").select("id", F.array_join(L.normalize_keywords(F.col("keywords")), "|").alias("keywords"))


def n_combined(spark: SparkSession, d: str) -> DataFrame:
    """Keywords, niche, type and category of each product in one list, its best label, and its rating as text read back."""
    p = table(spark, d, "products")
    words = L.combined_keywords(F.col("keywords"), F.array("niche"), F.array("product_type"), F.array("category"))
    return p.select("id", F.array_join(words, "|").alias("keywords"), L.first_filled(F.col("niche"), F.col("category"), F.col("search_query")).alias("label"), L.safe_number(F.col("rating").cast("string")).alias("rating"))


def n_slugs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "product_clusters").select("id", L.slug(F.col("cluster_name")).alias("slug"))


def n_identities(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "products")
    age = L.listing_age_days(F.col("listing_date"), F.col("collected_at"))
    return p.select("id", L.identity_key(F.col("marketplace"), F.col("external_id"), F.col("url")).alias("identity"), L.controlled_product_type(F.col("product_type")).alias("type"), age.alias("age_days"))


def g_report(spark: SparkSession, d: str) -> DataFrame:
    return ingest(table(spark, d, "raw_marketplace_products"))[1]


def g_errors(spark: SparkSession, d: str) -> DataFrame:
    """How many raw rows of each marketplace give no product, and why (NULL: they do)."""
    return normalize(table(spark, d, "raw_marketplace_products")).groupBy("marketplace", "error").agg(F.count("*").alias("rows"))


_PRODUCT_COLUMNS = "raw_product_id marketplace external_id search_query product_name url product_type price currency review_count rating seller description category listing_age_days identity_key".split()


def g_products(spark: SparkSession, d: str) -> DataFrame:
    """The canonical products of all raw rows, every column."""
    products = ingest(table(spark, d, "raw_marketplace_products"))[0]
    return products.select(*_PRODUCT_COLUMNS, F.array_join("keywords", "|").alias("keywords"), F.array_join("image_urls", "|").alias("image_urls"), _seconds("listing_date"), _seconds("collected_at"))


def g_upsert(spark: SparkSession, d: str) -> DataFrame:
    """Ingestion in two steps: the products of the raw rows stored up to the middle id, overwritten by those of the later rows."""
    raw = table(spark, d, "raw_marketplace_products").withColumn("created_at", F.coalesce("created_at", "collected_at"))
    middle = raw.agg(F.floor((F.min("id") + F.max("id")) / 2).alias("m")).first()["m"] or 0
    stamped = lambda rows: ingest(rows)[0].withColumn("created_at", F.col("raw_product_id")).withColumn("updated_at", F.col("raw_product_id"))
    merged = R.upsert(stamped(raw.where(F.col("id") <= middle)), stamped(raw.where(F.col("id") > middle)), "identity_key", ["updated_at"])
    return merged.select("identity_key", "raw_product_id", "product_name", "price", "created_at", "updated_at", "inserted")


def c_tokens(spark: SparkSession, d: str) -> DataFrame:
    ship_package(spark)
    return M.with_tokens(table(spark, d, "products")).select("id", F.explode("tokens").alias("token"))


def c_idf(spark: SparkSession, d: str) -> DataFrame:
    ship_package(spark)
    return M.document_frequencies(M.with_tokens(table(spark, d, "products")))


def c_similar(spark: SparkSession, d: str) -> DataFrame:
    ship_package(spark)
    return M.similar_products(table(spark, d, "products")).select("a", "b", F.round("similarity", 6).alias("similarity"))


def c_components(spark: SparkSession, d: str) -> DataFrame:
    ship_package(spark)
    p = table(spark, d, "products")
    return connected_components(p.select(F.col("id").alias("node")), staged(M.similar_products(p), "edges"))


def c_markets(spark: SparkSession, d: str) -> DataFrame:
    ship_package(spark)
    listed = lambda n: F.array_join(n, "|").alias(n)
    return M.markets(table(spark, d, "products"))[0].select("component", "product_count", "cluster_name", "slug", "niche", "product_type", "primary_problem", listed("secondary_problems"), listed("keywords"), "confidence")


def c_memberships(spark: SparkSession, d: str) -> DataFrame:
    """Every product with its market and the score of its membership."""
    ship_package(spark)
    return M.memberships(table(spark, d, "products")).select("component", "product_id", "membership_score")


def k_concentration(spark: SparkSession, d: str) -> DataFrame:
    return K.concentration(table(spark, d, "product_cluster_memberships"), table(spark, d, "products"))


def k_dispersion(spark: SparkSession, d: str) -> DataFrame:
    rows = K.dispersion(table(spark, d, "product_cluster_memberships"), table(spark, d, "products"))
    return rows.select("cluster_id", "priced", "price_min", "price_median", "price_max", "price_mean", F.round("price_stddev", 3).alias("price_stddev"), "rating_mean")


def k_keywords(spark: SparkSession, d: str) -> DataFrame:
    return K.top_keywords(table(spark, d, "product_cluster_memberships"), table(spark, d, "products"))


def k_price_segments(spark: SparkSession, d: str) -> DataFrame:
    return K.price_segments(table(spark, d, "product_cluster_memberships"), table(spark, d, "products"))


def k_signals(spark: SparkSession, d: str) -> DataFrame:
    return K.top_signals(table(spark, d, "product_cluster_memberships"), table(spark, d, "products"))


def k_images(spark: SparkSession, d: str) -> DataFrame:
    return K.images(table(spark, d, "product_cluster_memberships"), table(spark, d, "products"))


def k_quality(spark: SparkSession, d: str) -> DataFrame:
    rows = K.quality_signals(table(spark, d, "product_cluster_memberships"), table(spark, d, "products"))
    return rows.select("cluster_id", "competitor_count", "rating_median", *(F.round(c, 6).alias(c) for c in ("price_compression", "rated_share", "quality", "depth", "differentiation")))


def k_reviews(spark: SparkSession, d: str) -> DataFrame:
    return K.review_coverage(table(spark, d, "product_cluster_memberships"), table(spark, d, "products"))


def k_cluster_keywords(spark: SparkSession, d: str) -> DataFrame:
    rows = K.cluster_keywords(*(table(spark, d, n) for n in ("product_clusters", "product_cluster_memberships", "products")))
    return rows.select("cluster_id", F.array_join("keywords", "|").alias("keywords"))


def k_long_tail(spark: SparkSession, d: str) -> DataFrame:
    return K.long_tail_keywords(table(spark, d, "product_cluster_memberships"), table(spark, d, "products"))


QUERIES = {
    f.__name__: f
    for f in (
        q_recent_products, q_recent_raw, q_lookup, q_cluster, q_observed, q_memberships, q_latest_scores, q_ranking, q_histogram, q_counts, q_top_clusters, q_cluster_members,
        q_latest_observation, q_latest_run, q_observation_metadata, n_texts, n_urls, n_display, n_keywords, n_combined, n_slugs, n_identities, g_report, g_errors, g_products, g_upsert,
        c_tokens, c_idf, c_similar, c_components, c_markets, c_memberships, k_concentration, k_dispersion, k_keywords, k_price_segments, k_signals, k_images,
        k_quality, k_reviews, k_cluster_keywords, k_long_tail,
    )
}
