"""Structured Streaming ingestion: raw observations appended, products kept by identity."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marketloom.operators.ingestion import normalize
from marketloom.operators.relational import latest_per_key
from marketloom.sources.listings import RAW_SCHEMA


def raw_stream(spark: SparkSession, path: str, files_per_trigger: int = 8) -> DataFrame:
    return spark.readStream.schema(RAW_SCHEMA).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def ingest_stream(spark: SparkSession, source: str, target: str, checkpoint: str):
    """Start a query that, per micro batch, appends the raw rows to `target`/raw and each identity's last product to `target`/products.

    Both are written to a folder of the batch, so a batch repeated after a failure overwrites only its own rows and the raw
    history holds every observation once. `current_products` reads the last version of each identity.
    """

    def write(batch: DataFrame, number: int) -> None:
        rows = batch.persist()
        rows.write.mode("overwrite").parquet(f"{target}/raw/batch={number}")
        good = normalize(rows).where("identity_key is not null").drop("error")
        latest_per_key(good, ["identity_key"], ["raw_product_id"]).write.mode("overwrite").parquet(f"{target}/products/batch={number}")
        rows.unpersist()

    return raw_stream(spark, source).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def raw_history(spark: SparkSession, target: str) -> DataFrame:
    """All raw rows ever ingested."""
    return spark.read.parquet(f"{target}/raw")


def current_products(spark: SparkSession, target: str) -> DataFrame:
    return latest_per_key(spark.read.parquet(f"{target}/products"), ["identity_key"], ["batch", "raw_product_id"])


def compact_products(spark: SparkSession, target: str) -> None:
    """Replace the batches of products by one that holds the last version of each identity, between two runs of the stream.

    The new batch is numbered half above the last, so later batches still win. It is written beside, put in place and only then
    are the others deleted: if the driver is lost in between, both are there and give the same products.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path
    root = path(f"{target}/products")
    file_system = root.getFileSystem(spark._jsc.hadoopConfiguration())
    number = lambda p: float(p.getName().split("=")[1])
    old = sorted((f.getPath() for f in file_system.listStatus(root) if f.getPath().getName().startswith("batch=")), key=number)
    if len(old) < 2:
        return
    fresh = f"{target}/products-compact"
    current_products(spark, target).drop("batch").write.mode("overwrite").parquet(fresh)
    file_system.rename(path(fresh), path(f"{target}/products/batch={int(number(old[-1]))}.5"))
    for p in old:
        file_system.delete(p, True)
