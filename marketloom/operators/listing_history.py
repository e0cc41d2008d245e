"""Full history of marketplace listings from their raw observations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.functions.payload import with_observation
from marketloom.operators.history import SLICE_ROWS, version_history
from marketloom.session import epoch_micros


def listing_history(raw: DataFrame, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """marketplace, external_id, title, amount, currency, seller, valid_from, valid_to (seconds; -1 while open).

    Observations of a listing (marketplace and external id, else the payload's own id) in order of `collected_at`; see
    `with_observation` for what is no observation and `version_history` for nulls, ties, repeats and empty tables.
    """
    obs = with_observation(raw.select("id", "marketplace", "external_id", "raw_payload", epoch_micros(raw, "collected_at").alias("at")))
    flat = obs.select(
        "marketplace",
        F.col("obs_listing_id").alias("external_id"),
        "at",
        "id",
        F.col("obs_on_sale").alias("on_sale"),
        F.col("obs_title").alias("title"),
        F.when(F.col("obs_amount").isNotNull(), F.struct(F.col("obs_amount").alias("amount"), F.col("obs_currency").alias("currency"))).alias("price"),
        F.col("obs_seller").alias("seller"),
    )
    v = version_history(flat, ["marketplace", "external_id"], "at", "id", "on_sale", ["title", "price", "seller"], slice_rows=slice_rows)
    second = F.lit(1_000_000)
    return v.select(
        "marketplace",
        "external_id",
        "title",
        F.col("price.amount").alias("amount"),
        F.col("price.currency").alias("currency"),
        "seller",
        F.floor(F.col("valid_from") / second).cast("bigint").alias("valid_from"),
        F.coalesce(F.floor(F.col("valid_to") / second).cast("bigint"), F.lit(-1).cast("bigint")).alias("valid_to"),
    )
