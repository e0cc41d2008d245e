"""Concentration, dispersion and keyword summaries of the products of each cluster.

Rows of a rank up to k are kept by a window whose limit Spark applies before the shuffle already (WindowGroupLimit), so a task
sends at most k rows a cluster, however large that is. Medians and quantile prices work on one row per different value.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marketloom.functions.payload import squeeze


def _members(memberships: DataFrame, products: DataFrame) -> DataFrame:
    edges = memberships.select("cluster_id", F.col("product_id").alias("id")).where("cluster_id is not null").distinct()
    return edges.join(products, "id")


def concentration(memberships: DataFrame, products: DataFrame) -> DataFrame:
    """Per cluster: competitors, sellers, marketplaces and the shares of the largest seller and of the three with most reviews.

    A blank or NULL seller counts as `unknown`; review shares are NULL where there are no reviews. Sellers are summed
    before clusters are, so the second aggregation sees one row per cluster and seller. A product counts once in a cluster.
    """
    m = _members(memberships, products).select(
        "cluster_id", "marketplace", F.coalesce(squeeze(F.col("seller")), F.lit("unknown")).alias("seller"), F.coalesce("review_count", F.lit(0)).cast("bigint").alias("reviews"), "id"
    )
    by_seller = m.groupBy("cluster_id", "seller").agg(F.count("*").alias("n"), F.sum("reviews").alias("reviews"), F.collect_set("marketplace").alias("places"))
    total = by_seller.groupBy("cluster_id").agg(
        F.sum("n").alias("competitor_count"),
        F.count("*").alias("seller_count"),
        F.size(F.array_distinct(F.flatten(F.collect_list("places")))).alias("marketplace_count"),
        F.max("n").alias("most"),
        F.sum("reviews").alias("reviews"),
        F.max("reviews").alias("most_reviews"),
    )
    top = by_seller.withColumn("r", F.row_number().over(W.partitionBy("cluster_id").orderBy(F.col("reviews").desc()))).where("r <= 3").groupBy("cluster_id").agg(F.sum("reviews").alias("top3"))
    share = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b))
    return total.join(top, "cluster_id").select(
        "cluster_id",
        "competitor_count",
        "seller_count",
        "marketplace_count",
        share("most", "competitor_count").alias("top_seller_listing_share"),
        share("most_reviews", "reviews").alias("top_seller_review_share"),
        share("top3", "reviews").alias("top_3_review_share"),
    )


def dispersion(memberships: DataFrame, products: DataFrame) -> DataFrame:
    """Per cluster with a price: lowest, median, highest, mean, population deviation and variation of price; mean rating."""
    m = _members(memberships, products).select("cluster_id", F.col("price").cast("decimal(24,6)").alias("exact"), F.col("price").cast("double").alias("price"), F.col("rating").cast("decimal(12,4)").alias("rating"))
    out = m.groupBy("cluster_id").agg(
        F.count("price").alias("priced"),
        F.min("price").alias("price_min"),
        F.expr("percentile(price, 0.5)").alias("price_median"),
        F.max("price").alias("price_max"),
        (F.sum("exact").cast("double") / F.count("exact")).alias("price_mean"),
        F.stddev_pop("price").alias("price_stddev"),
        (F.sum("rating").cast("double") / F.count("rating")).alias("rating_mean"),
    )
    return out.where("priced > 0").withColumn("price_cv", F.when(F.col("price_mean") > 0, F.col("price_stddev") / F.col("price_mean")))


def top_keywords(memberships: DataFrame, products: DataFrame, top: int = 8) -> DataFrame:
    """cluster_id, keyword, uses, rank: the most used keywords of each cluster (lower case; ties in alphabetical order)."""
    m = _members(memberships, products).select("cluster_id", F.explode("keywords").alias("k"))
    uses = m.select("cluster_id", F.lower(squeeze(F.col("k"))).alias("keyword")).where("keyword is not null").groupBy("cluster_id", "keyword").agg(F.count("*").alias("uses"))
    return uses.withColumn("rank", F.row_number().over(W.partitionBy("cluster_id").orderBy(F.col("uses").desc(), "keyword"))).where(F.col("rank") <= top)


def price_segments(memberships: DataFrame, products: DataFrame) -> DataFrame:
    """Per cluster with a price: entry, middle and leader price and the two prices that part it into thirds.

    Of n prices in rising order these are the ones at n // 4, n // 2, the last, n // 3 and 2n // 3 (counted from 0). Prices
    are counted first, so what is ordered is one row per different price of a cluster.
    """
    m = _members(memberships, products).where("price is not null").select("cluster_id", F.col("price").cast("double").alias("price"))
    counted = m.groupBy("cluster_id", "price").agg(F.count("*").alias("c"))
    upto = counted.withColumn("upto", F.sum("c").over(W.partitionBy("cluster_id").orderBy("price"))).withColumn("n", F.sum("c").over(W.partitionBy("cluster_id")))
    at = lambda place, name: F.min(F.when(F.col("upto") > place, F.col("price"))).alias(name)
    n = F.col("n")
    return upto.groupBy("cluster_id").agg(
        F.sum("c").alias("priced"),
        at(F.floor(n / 4), "entry_price"),
        at(F.floor(n / 2), "middle_price"),
        F.max("price").alias("leader_price"),
        at(F.floor(n / 3), "lower_third"),
        at(F.floor(2 * n / 3), "upper_third"),
    )


def top_signals(memberships: DataFrame, products: DataFrame, top: int = 12) -> DataFrame:
    """cluster_id, signal, uses, rank: the most frequent signal words of each cluster (ties in alphabetical order).

    Signals are keywords, niche, product type and the words of more than three characters of descriptions, in lower case
    with `-` for spaces.
    """
    none = F.array().cast("array<string>")
    long_words = F.filter(F.split(F.trim(F.coalesce("description", F.lit(""))), r"\s+"), lambda w: F.length(w) > 3)
    parts = F.concat(F.coalesce("keywords", none), F.array("niche", "product_type"), long_words)
    words = _members(memberships, products).select("cluster_id", F.explode(parts).alias("w"))
    signal = F.nullif(F.regexp_replace(F.trim(F.lower("w")), " ", "-"), F.lit(""))
    uses = words.select("cluster_id", signal.alias("signal")).where("signal is not null").groupBy("cluster_id", "signal").agg(F.count("*").alias("uses"))
    return uses.withColumn("rank", F.row_number().over(W.partitionBy("cluster_id").orderBy(F.col("uses").desc(), "signal"))).where(F.col("rank") <= top)


def images(memberships: DataFrame, products: DataFrame) -> DataFrame:
    """cluster_id, product_id, position, url: every image of every member; a member without one gives a row without url."""
    m = _members(memberships, products)
    return m.select("cluster_id", F.col("id").alias("product_id"), F.posexplode_outer("image_urls").alias("position", "url"))


def quality_signals(memberships: DataFrame, products: DataFrame) -> DataFrame:
    """Per cluster: price compression, rating median and share of rated products, quality, depth and differentiation signals.

    price_compression is the variation of price cut off at 1; quality = 0.8 mean rating / 5 + 0.2 rated share; depth = 0.7
    words per description / 80 + 0.3 keywords per product / 12; differentiation = share of keyword uses whose keyword (in lower
    case) is used once in the cluster. All lie within 0 and 1; NULL where nothing is there to measure.
    """
    none = F.array().cast("array<string>")
    m = _members(memberships, products).select(
        "cluster_id",
        F.col("price").cast("double").alias("price"),
        F.col("price").cast("decimal(24,6)").alias("exact"),
        F.col("rating").cast("decimal(12,4)").alias("rating"),
        F.when(F.col("description") != "", F.size(F.filter(F.split(F.trim("description"), r"\s+"), lambda w: w != ""))).alias("words"),
        F.transform(F.filter(F.coalesce("keywords", none), lambda k: k.isNotNull()), lambda k: F.lower(k)).alias("keywords"),
    )
    sums = m.groupBy("cluster_id").agg(
        F.count("*").alias("competitor_count"),
        (F.sum("exact").cast("double") / F.count("exact")).alias("mean"),
        F.stddev_pop("price").alias("stddev"),
        (F.sum("rating").cast("double") / F.count("rating")).alias("rating_mean"),
        F.expr("percentile(cast(rating as double), 0.5)").alias("rating_median"),
        F.count("rating").alias("rated"),
        F.avg("words").alias("words"),
        F.sum(F.size("keywords")).alias("uses"),
    )
    uses = m.select("cluster_id", F.explode("keywords").alias("k")).groupBy("cluster_id", "k").agg(F.count("*").alias("c")).groupBy("cluster_id").agg(F.sum(F.when(F.col("c") > 1, F.col("c")).otherwise(0)).alias("repeated"))
    unit = lambda c: F.greatest(F.lit(0.0), F.least(F.lit(1.0), c))
    n = F.col("competitor_count")
    depth = F.coalesce("words", F.lit(0.0)) / 80 * 0.7 + F.col("uses") / n / 12 * 0.3
    return sums.join(uses, "cluster_id", "left").select(
        "cluster_id",
        "competitor_count",
        F.when(F.col("mean") > 0, unit(F.col("stddev") / F.col("mean"))).alias("price_compression"),
        "rating_median",
        (F.col("rated") / n).alias("rated_share"),
        F.when(F.col("rated") > 0, unit(F.col("rating_mean") / 5 * 0.8 + F.col("rated") / n * 0.2)).alias("quality"),
        F.when(F.col("words").isNotNull() | (F.col("uses") > 0), unit(depth)).alias("depth"),
        F.when(F.col("uses") > 0, unit(1 - F.col("repeated") / F.col("uses"))).alias("differentiation"),
    )


def review_coverage(memberships: DataFrame, products: DataFrame, sample: int = 30) -> DataFrame:
    """Per cluster: whether any product has a review count, the reviews counted, and how much of a `sample` that is (1 at most)."""
    m = _members(memberships, products).groupBy("cluster_id").agg(F.count("review_count").alias("n"), F.sum(F.coalesce("review_count", F.lit(0)).cast("bigint")).alias("reviews"))
    return m.select("cluster_id", (F.col("n") > 0).alias("reviews_available"), F.col("reviews").alias("reviews_analyzed"), F.when(F.col("n") > 0, F.least(F.lit(1.0), F.col("reviews") / sample)).otherwise(0.0).alias("review_coverage"))


def cluster_keywords(clusters: DataFrame, memberships: DataFrame, products: DataFrame, top: int = 10) -> DataFrame:
    """cluster_id, keywords: a cluster's own keywords in lower case with its most frequent signals, the longest first, at most `top`.

    A cluster without keywords takes those of its first member. Clusters without members or keywords have an empty list.
    """
    none = F.array().cast("array<string>")
    lower = lambda c: F.transform(F.filter(F.coalesce(c, none), lambda k: k.isNotNull()), lambda k: F.lower(k))
    first = _members(memberships, products).groupBy("cluster_id").agg(F.min_by("keywords", "id").alias("first"))
    signals = top_signals(memberships, products).groupBy("cluster_id").agg(F.collect_list("signal").alias("signals"))
    j = clusters.select(F.col("id").alias("cluster_id"), lower(F.col("keywords")).alias("own")).join(first, "cluster_id", "left").join(signals, "cluster_id", "left")
    words = F.array_union(F.when(F.size("own") > 0, F.col("own")).otherwise(lower(F.col("first"))), F.coalesce("signals", none))
    longest = F.array_sort(F.transform(words, lambda w: F.struct((-F.length(w)).alias("n"), w.alias("w"))))
    return j.select("cluster_id", F.slice(F.transform(longest, lambda x: x["w"]), 1, top).alias("keywords"))


def long_tail_keywords(memberships: DataFrame, products: DataFrame, top: int = 8) -> DataFrame:
    """cluster_id, phrase, rank: the first four keywords of products with two or more, joined, in lower case; the first `top` in alphabetical order."""
    kept = F.filter(F.slice(F.transform("keywords", lambda k: F.lower(F.trim(k))), 1, 4), lambda k: k != "")
    phrases = _members(memberships, products).where(F.size("keywords") >= 2).select("cluster_id", F.array_join(kept, " ").alias("phrase")).distinct()
    return phrases.withColumn("rank", F.row_number().over(W.partitionBy("cluster_id").orderBy("phrase"))).where(F.col("rank") <= top)
