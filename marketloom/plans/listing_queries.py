"""Queries over the listing tables: history of listings and prices in one unit."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.functions.units import quantity
from marketloom.operators.listing_history import listing_history
from marketloom.operators.prices import corrected_prices, resolved_prices
from marketloom.plans import listing_sql
from marketloom.session import table


def p2_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return listing_history(table(spark, sf_dir, "raw_marketplace_products"))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p2_history(spark, sf_dir).select("marketplace", "external_id", "valid_from", "valid_to").distinct()


def p5_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = (table(spark, sf_dir, n) for n in ("products", "raw_marketplace_products", "fx_rates"))
    return resolved_prices(*tables).where("usd_cents is not null").select("product_id", "amount", "currency", "usd_cents", "as_stored")


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corrected_prices(*(table(spark, sf_dir, n) for n in ("products", "raw_marketplace_products", "fx_rates")))


def p5_page_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Width and height of the stated page format in whole millimetres, whatever unit the description uses."""
    text = F.regexp_extract("description", r"(\d+(?:\.\d+)?) x (\d+(?:\.\d+)?) (mm|cm|in)\b", 0)
    parts = table(spark, sf_dir, "products").select("id", text.alias("t")).where("t <> ''")
    unit_text = F.regexp_extract("t", "[a-z]+$", 0)
    side = lambda n: F.round(quantity(F.concat_ws(" ", F.regexp_extract("t", r"([\d.]+) x ([\d.]+)", n), unit_text))["canonical"] * 1000, 0).cast("int")
    return parts.select(F.col("id").alias("product_id"), side(1).alias("width_mm"), side(2).alias("height_mm"))


QUERIES = {"p2_found": p2_found, "p2_history": p2_history, "p5_found": p5_found, "p5_prices": p5_prices, "p5_page_sizes": p5_page_sizes}

SQL = {
    "p2_found": listing_sql.HISTORY_FOUND,
    "p2_history": listing_sql.HISTORY,
    "p5_found": listing_sql.PRICES_FOUND,
    "p5_prices": listing_sql.PRICES,
    "p5_page_sizes": """
select id as product_id,
  cast(round(cast(regexp_extract(t, '([0-9.]+) x ([0-9.]+) ([a-z]+)', 1) as double) * k) as int) as width_mm,
  cast(round(cast(regexp_extract(t, '([0-9.]+) x ([0-9.]+) ([a-z]+)', 2) as double) * k) as int) as height_mm
from (select id, t, case regexp_extract(t, '[a-z]+$') when 'mm' then 1 when 'cm' then 10 else 25.4 end as k
      from (select id, regexp_extract(description, '[0-9]+(?:\\.[0-9]+)? x [0-9]+(?:\\.[0-9]+)? (?:mm|cm|in)\\b') as t from products) where t <> '')""",
}
