"""The relational core: lookups, top rows, latest row per key, upserts and observation metadata."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def find(df: DataFrame, limit: int, order: list[Column], **equal: object) -> DataFrame:
    """Rows whose columns equal the given values (None: any), the first `limit` by `order`."""
    for name, value in equal.items():
        if value is not None:
            df = df.where(F.col(name) == F.lit(value))
    return df.orderBy(*order).limit(limit)


def lookup(df: DataFrame, **equal: object) -> DataFrame:
    """All rows whose columns equal the given values, NULL being equal to NULL; the comparisons are pushed to the scan."""
    for name, value in equal.items():
        df = df.where(F.col(name).isNull() if value is None else F.col(name) == F.lit(value))
    return df


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row of each key that is last by `order` (NULLs first). Combined before the shuffle, so a hot key costs no more than another."""
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_last"))
    return picked.select(*keys, *(F.col("_last")[c].alias(c) for c in rest)).select(*df.columns)


def upsert(existing: DataFrame, incoming: DataFrame, key: str, order: list[str]) -> DataFrame:
    """`existing` overwritten by the last incoming row of each key, whole rows including NULLs.

    A stored row keeps its `created_at`, a new one gets its first; `updated_at` takes the incoming row's. Adds `inserted`: whether the key is new.
    """
    columns = [c for c in existing.columns if c != key]
    last = incoming.groupBy(key).agg(F.max_by(F.struct(*columns), F.struct(*order)).alias("_new"), F.min("created_at").alias("_first"))
    joined = existing.select(key, F.struct(*columns).alias("_old")).join(last, key, "full_outer")
    source = F.coalesce("_new", "_old")
    return joined.select(
        key,
        *(F.coalesce(F.col("_old.created_at"), F.col("_first")).alias(c) if c == "created_at" else source[c].alias(c) for c in columns),
        F.col("_old").isNull().alias("inserted"),
    )


def observation_metadata(clusters: list[int] | None, memberships: DataFrame, products: DataFrame) -> DataFrame:
    """One row: number, first and last collection time of the products of the clusters; a product in two counts twice."""
    edges = memberships if clusters is None else memberships.where(F.col("cluster_id").isin(clusters) if clusters else F.lit(False))
    return (
        edges.select(F.col("product_id").alias("id"))
        .join(products.select("id", "collected_at"), "id")
        .agg(F.count("*").alias("observations"), F.min("collected_at").alias("first_collected_at"), F.max("collected_at").alias("last_collected_at"))
    )


def cluster_members(memberships: DataFrame, products: DataFrame, cluster_id: int | None = None) -> DataFrame:
    """Products of one cluster or of any, each once."""
    edges = memberships if cluster_id is None else memberships.where(F.col("cluster_id") == cluster_id)
    return products.join(edges.select(F.col("product_id").alias("id")).distinct(), "id", "left_semi")


def ranked(df: DataFrame, order: list[Column], top: int, name: str = "rank") -> DataFrame:
    """The first `top` rows by `order`, numbered from 1. The cut comes first, so that only `top` rows are gathered to be numbered."""
    first = df.orderBy(*order).limit(max(1, top))
    return first.withColumn(name, F.row_number().over(W.orderBy(*order)))


def latest_values(base: DataFrame, key: str, tables: dict[str, tuple[DataFrame, list[str], list[str]]]) -> DataFrame:
    """`base` with the latest row of each table per key: name -> (table, order, columns), the columns prefixed by the name.

    A key without a row in a table keeps NULLs. Each table is reduced to one row a key before it is joined.
    """
    out = base
    for name, (df, order, columns) in tables.items():
        last = latest_per_key(df.where(F.col(key).isNotNull()).select(key, *dict.fromkeys((*order, *columns))), [key], order)
        out = out.join(last.select(key, *(F.col(c).alias(f"{name}_{c}") for c in columns)), key, "left")
    return out


def save_memberships(memberships: DataFrame, products: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(edges, missing): memberships given by `identity_key` resolved to product ids; the identities no product has yet."""
    ids = products.select("identity_key", F.col("id").alias("product_id"))
    joined = memberships.join(ids, "identity_key", "left")
    return joined.where("product_id is not null").drop("identity_key").distinct(), joined.where("product_id is null").select("identity_key").distinct()
