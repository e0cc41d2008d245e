"""Queries of the operators for training data, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.llm import clusters, matching, mixing, readability, subset
from marketloom.llm.leakage import SHARE, leak_matches, leaks
from marketloom.llm.sql import SQL as SQL
from marketloom.session import ship_package, staged, table


MARKET_FIELDS = ["niche", "product_type", "primary_problem"]


def p1_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = subset.varied_subset(table(spark, sf_dir, "product_clusters"), "id", MARKET_FIELDS)
    return chosen.withColumnRenamed("chosen_id", "cluster_id")


def p1_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subset.subset_coverage(table(spark, sf_dir, "product_clusters"), p1_subset(spark, sf_dir), MARKET_FIELDS)


def p3_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.similarity_clusters(table(spark, sf_dir, "products"))


def p3_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.cluster_profiles(staged(p3_members(spark, sf_dir), "cluster-members"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.item_pairs(table(spark, sf_dir, "products"))


def p4_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = matching.item_groups(table(spark, sf_dir, "products"))
    return groups.join(groups.groupBy("item").agg(F.count("*").alias("listings")), "item").select("product_id", "item", "listings")


def p6_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"))
    return found.select("doc_id", "item_id", "matched_words", "item_words")


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p6_leaks(spark, sf_dir).select("doc_id", "item_id").distinct()


def p6_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with an item's passage in changed wording only: proximity matches that aren't leaks in exact wording."""
    found = leak_matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"))
    return found.where(F.col("matched_words") < F.lit(SHARE) * F.col("item_words"))


def p7_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"))[0]


def p7_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"))[1]


def p7_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mixture itself, a row for each copy."""
    documents = table(spark, sf_dir, "documents")
    return mixing.emitted(documents, staged(mixing.mixture(documents, table(spark, sf_dir, "mix_targets"))[1], "mix-shares"))


def p8_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readability.reading_levels(table(spark, sf_dir, "documents"), table(spark, sf_dir, "reading_labels"))


def p8_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readability.reading_profile(p8_levels(spark, sf_dir))


def _shipped(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """The query, run after the Python workers have been sent this package."""

    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return query(spark, sf_dir)

    return run


QUERIES = {
    f.__name__: _shipped(f)
    for f in (p1_subset, p1_coverage, p3_members, p3_clusters, p4_found, p4_groups, p6_found, p6_leaks, p6_near, p7_mixture, p7_shares, p7_documents, p8_levels, p8_profile)
}
