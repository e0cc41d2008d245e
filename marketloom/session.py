"""Session helpers: local sessions, table access and lineage cuts in the shared folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def local_session(cores: str = "8", shuffle_partitions: int = 8, app: str = "marketloom") -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", os.environ.get("MARKETLOOM_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it in spark.checkpoint.dir.

    Only where that setting is absent and the session runs on one machine a temporary folder of this machine is set; on a
    cluster its absence is an error, as workers would write where nobody else reads.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="marketloom-shared-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


_RUN = uuid.uuid4().hex


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write `df` once as a table in the shared folder and read it back: cuts the lineage, survives lost executors.

    The tables of one driver lie in one folder of their own, which goes when the driver ends; `drop_staged` removes it before,
    when the results are written.
    """
    spark = df.sparkSession
    file_system, folder = _staging(spark)
    if not file_system.exists(folder):
        file_system.mkdirs(folder)
        file_system.deleteOnExit(folder)
    path = f"{folder.toString()}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _staging(spark: SparkSession):
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark).rstrip('/')}/marketloom-{_RUN}")
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def drop_staged(spark: SparkSession) -> None:
    """Delete all tables this driver has staged. DataFrames that read them can't be used any more."""
    file_system, folder = _staging(spark)
    file_system.delete(folder, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """One file of text at any path Spark can reach, local or shared; an existing file is an error."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, False)
    try:
        out.write(bytearray(text, "utf-8"))
    finally:
        out.close()


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application, for where it isn't installed on their path."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        folder = tempfile.mkdtemp(prefix="marketloom-package-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        target = os.path.join(folder, "marketloom")
        spark.sparkContext.addPyFile(shutil.make_archive(target, "zip", root, "marketloom"))
        _shipped.add(app)


def epoch_micros(df: DataFrame, name: str) -> Column:
    """Microseconds since 1970 UTC of a timestamp column with or without zone, whatever the session's zone is."""
    if isinstance(df.schema[name].dataType, T.TimestampNTZType):
        return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{name}`)")
    return F.unix_micros(F.col(name).cast("timestamp"))


def utc_month(micros: Column) -> Column:
    """`YYYY-MM` of microseconds since 1970 UTC."""
    return F.date_format(F.date_from_unix_date(F.floor(micros / F.lit(86_400_000_000)).cast("int")), "yyyy-MM")
