"""Ingestion: raw observations normalised into canonical products, one plan for all marketplaces."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.functions import listing as L
from marketloom.functions.payload import squeeze
from marketloom.operators.relational import latest_per_key

_TEXT = ("title", "name", "url", "listing_url", "shop_name", "seller", "seller_name", "description", "category", "product_type", "price_text", "reviews_text", "rating_text", "review_count", "rating")
_NESTED = "price struct<amount:string,divisor:string,currency_code:string>, tags array<string>, keywords array<string>, images array<struct<url_fullxfull:string,url_570xN:string>>, image_urls array<string>, original_creation_timestamp bigint, creation_timestamp bigint"
SUPPORTED = ("etsy", "mock")


def normalize(raw: DataFrame) -> DataFrame:
    """Canonical product columns of every raw row, plus `error`: why a row gives no product (NULL: it does).

    Etsy and mock listings are understood; others, unreadable payloads and listings without a name or an address are
    errors of their row alone. Money of an Etsy listing is amount / divisor (100 if absent or 0).
    """
    schema = ", ".join(f"`{n}` string" for n in _TEXT) + ", " + _NESTED
    m = F.col("marketplace")
    r = raw.withColumn("j", F.from_json("raw_payload", schema))
    j = lambda n: F.col("j")[n]
    either = lambda etsy, mock: F.when(m == "etsy", etsy).when(m == "mock", mock)
    divisor = F.coalesce(F.nullif(j("price")["divisor"].try_cast("decimal(12,2)"), F.lit(0).cast("decimal(12,2)")), F.lit(100).cast("decimal(12,2)"))
    etsy_price = (j("price")["amount"].try_cast("decimal(18,4)") / divisor).cast("decimal(18,4)")
    listed = F.timestamp_seconds(F.coalesce(F.nullif(j("original_creation_timestamp"), F.lit(0)), j("creation_timestamp")))
    images = F.transform(F.filter(F.transform(j("images"), lambda i: F.coalesce(i["url_fullxfull"], i["url_570xN"])), lambda u: u.isNotNull()), L.canonical_url)
    name = squeeze(either(j("title"), j("name")))
    url = F.nullif(L.canonical_url(either(j("url"), j("listing_url"))), F.lit(""))
    error = (
        F.when(~m.isin(*SUPPORTED) | m.isNull(), "unregistered marketplace")
        .when(F.col("j").isNull() | ~F.col("raw_payload").rlike(r"^\s*\{.*\}\s*$"), "unreadable payload")
        .when(F.col("product_name").isNull() | F.col("url").isNull(), "no name or address")
    )
    rows = r.select(
        F.col("id").alias("raw_product_id"),
        "marketplace",
        "external_id",
        "search_query",
        "collected_at",
        "raw_payload",
        "j",
        name.alias("product_name"),
        url.alias("url"),
        L.controlled_product_type(j("product_type")).alias("product_type"),
        either(etsy_price, L.price_amount(j("price_text"))).alias("price"),
        either(F.upper(squeeze(j("price")["currency_code"])), L.price_currency(j("price_text"))).alias("currency"),
        L.review_count(either(j("review_count"), j("reviews_text"))).alias("review_count"),
        L.rating(either(j("rating"), j("rating_text"))).alias("rating"),
        squeeze(either(F.coalesce(j("shop_name"), j("seller")), j("seller_name"))).alias("seller"),
        L.normalize_keywords(either(j("tags"), j("keywords"))).alias("keywords"),
        squeeze(j("description")).alias("description"),
        F.coalesce(either(images, L.normalize_keywords(j("image_urls"))), F.array().cast("array<string>")).alias("image_urls"),
        squeeze(j("category")).alias("category"),
        F.when(m == "etsy", listed).alias("listing_date"),
    )
    return rows.withColumn("error", error).withColumn("identity_key", F.when(F.col("error").isNull(), L.identity_key(m, F.col("external_id"), F.col("url")))).withColumn(
        "listing_age_days", L.listing_age_days(F.col("listing_date"), F.col("collected_at"))
    ).drop("j", "raw_payload")


def ingest(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(products, report): the last observation of each identity, and counters per marketplace.

    Counters: raw_collected, normalized, inserted (first of its identity), updated (overwrites of one), failed.
    """
    rows = normalize(raw)
    good = rows.where("identity_key is not null")
    products = latest_per_key(good.drop("error"), ["identity_key"], ["raw_product_id"])
    counts = rows.groupBy("marketplace").agg(F.count("*").alias("raw_collected"), F.count("identity_key").alias("normalized"))
    inserted = good.groupBy("marketplace", "identity_key").agg(F.count("*").alias("n")).groupBy("marketplace").agg(F.count("*").alias("inserted"))
    report = counts.join(inserted, "marketplace", "left").select(
        "marketplace",
        "raw_collected",
        "normalized",
        F.coalesce("inserted", F.lit(0)).alias("inserted"),
        (F.col("normalized") - F.coalesce("inserted", F.lit(0))).alias("updated"),
        (F.col("raw_collected") - F.col("normalized")).alias("failed"),
    )
    return products, report
