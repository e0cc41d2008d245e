"""Sources of raw listings: recorded result pages, JSON files, a built-in sample; and taxonomies."""

from __future__ import annotations

from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

RAW_SCHEMA = "id bigint, marketplace string, external_id string, search_query string, raw_payload string, collected_at timestamp"


class ListingSource(Protocol):
    """Anything that answers a search with at most `limit` raw rows (RAW_SCHEMA)."""

    marketplace: str

    def search(self, spark: SparkSession, query: str, limit: int) -> DataFrame: ...


def _raw_rows(payloads: DataFrame, marketplace: str, query: str, id_field: str) -> DataFrame:
    """Raw rows of JSON texts (`value`). Ids follow the payload's hash, white space of the query is squeezed."""
    return payloads.select(
        F.xxhash64("value").alias("id"),
        F.lit(marketplace).alias("marketplace"),
        F.get_json_object("value", f"$.{id_field}").alias("external_id"),
        F.lit(" ".join(query.split())).alias("search_query"),
        F.col("value").alias("raw_payload"),
        F.current_timestamp().alias("collected_at"),
    )


class RecordedPages:
    """Result pages of a paged search, recorded one a line: `{"query":…, "offset":…, "results":[…]}`.

    Pages count by rising offset up to and including the first with fewer than `page_size` results (the last one a
    paging client would ask for) or until `limit` results are reached. Items that aren't objects are left out, but fill
    their page. Lines that are no pages are ignored.
    """

    def __init__(self, path: str, marketplace: str = "etsy", id_field: str = "listing_id", page_size: int = 100):
        self.path, self.marketplace, self.id_field, self.page_size = path, marketplace, id_field, page_size

    def search(self, spark: SparkSession, query: str, limit: int) -> DataFrame:
        asked = " ".join(query.split())
        page = F.from_json("value", "query string, offset bigint, results array<string>")
        pages = spark.read.text(self.path).select(page.alias("p")).select("p.*").where((F.col("query") == asked) & F.col("results").isNotNull() & F.col("offset").isNotNull())
        short = F.max(F.when(F.size("results") < self.page_size, 1).otherwise(0)).over(W.partitionBy("query").orderBy("offset").rowsBetween(W.unboundedPreceding, -1))
        asked_for = pages.withColumn("over", F.coalesce(short, F.lit(0))).where((F.col("over") == 0) & (F.col("offset") < limit))
        items = asked_for.select("offset", F.posexplode("results").alias("at", "value")).where((F.col("offset") + F.col("at") < limit) & F.col("value").rlike(r"^\s*\{"))
        return _raw_rows(items, self.marketplace, query, self.id_field)


def json_listings(spark: SparkSession, path: str, marketplace: str, query: str, id_field: str) -> DataFrame:
    """Raw rows of files with one JSON listing a line; lines that are no objects are left out."""
    lines = spark.read.text(path).where(F.col("value").rlike(r"^\s*\{"))
    return _raw_rows(lines, marketplace, query, id_field)


def sample_listings(spark: SparkSession, limit: int = 3) -> DataFrame:
    """A few invented listings of the mock marketplace, for trying things out without files."""
    payloads = [
        '{"id":"kiln-31","name":"Glaze Batch Log","price_text":"27.00 EUR","reviews_text":"64 reviews","rating_text":"4.2 / 5","seller_name":"North Clay","listing_url":"https://mock.example/items/31?lot=7&utm_medium=mail","keywords":["pottery","glaze"],"product_type":"tracker"}',
        '{"id":"hive-8","name":"Apiary Season Ledger","price_text":"R$ 1.140,00","seller_name":"Meadow Desk","listing_url":"https://mock.example/items/8","keywords":["bees"," Bees ","honey"],"product_type":"spreadsheet"}',
        '{"id":"quilt-5","name":"Fabric Yardage Estimator","price_text":"GBP 3","reviews_text":"1.5k","rating_text":"5","listing_url":"https://mock.example/items/5?campaign=x#top","keywords":[],"product_type":"calculator"}',
    ]
    rows = [(i + 1, "mock", p.split('"')[3], "sample", p) for i, p in enumerate(payloads[: max(0, limit)])]
    return spark.createDataFrame(rows, "id bigint, marketplace string, external_id string, search_query string, raw_payload string").withColumn("collected_at", F.current_timestamp())


def taxonomy(spark: SparkSession, path: str) -> list[str]:
    """Lower-case terms of the JSON lists in a file or in all files of a folder; missing or broken files give none."""
    try:
        texts = spark.read.text(path, wholetext=True)
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" not in str(missing.getCondition()):
            raise
        return []
    terms = texts.select(F.explode(F.from_json("value", "array<string>")).alias("t")).select(F.lower(F.trim("t")).alias("t")).where("t <> ''")
    return [r["t"] for r in terms.distinct().orderBy("t").collect()]
