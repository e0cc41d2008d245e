"""Writing results: append-only parquet, report files in canonical JSON and CSV, search results as JSON."""

from __future__ import annotations

import json
import posixpath
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketloom.session import write_text

REPORT_ROWS = 10_000  # a report is one file made by the driver; larger results are written as tables (`append`, `write_csv`)


def append(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    writer = df.write.mode("append")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def plain_number(value: Column) -> Column:
    """At most four decimals, no trailing zeros."""
    fixed = F.format_string("%.4f", value.cast("double"))
    return F.when(value.isNotNull(), F.regexp_replace(F.regexp_replace(fixed, r"0+$", ""), r"\.$", ""))


def csv_rows(df: DataFrame) -> DataFrame:
    """Every column as text: numbers plain, arrays joined by ` | `, NULL empty."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.ArrayType):
            c = F.array_join(c.cast("array<string>"), " | ")
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
            c = plain_number(c)
        out.append(F.coalesce(c.cast("string"), F.lit("")).alias(f.name))
    return df.select(*out)


def write_csv(df: DataFrame, path: str) -> None:
    """A folder of CSV files, written by as many tasks as `df` has partitions."""
    csv_rows(df).write.mode("errorifexists").csv(path, header=True, lineSep="\n", emptyValue="")


def _csv_text(df: DataFrame) -> str:
    """A bounded table as one CSV text; fields with a mark, a quote or a line end are quoted."""
    quoted = lambda v: '"' + v.replace('"', '""') + '"' if any(c in v for c in ',"\n\r') else v
    lines = [df.columns] + [[r[c] for c in df.columns] for r in _bounded(csv_rows(df))]
    return "".join(",".join(map(quoted, line)) + "\n" for line in lines)


def _bounded(df: DataFrame) -> list[dict]:
    rows = df.limit(REPORT_ROWS + 1).collect()
    if len(rows) > REPORT_ROWS:
        raise ValueError(f"a report holds at most {REPORT_ROWS} rows")
    return [r.asDict(recursive=True) for r in rows]


def canonical_json(payload: object) -> str:
    """Sorted keys, two spaces, no NaN, a line end."""
    return json.dumps(payload, sort_keys=True, indent=2, ensure_ascii=False, allow_nan=False, default=lambda x: x.isoformat() if hasattr(x, "isoformat") else float(x)) + "\n"


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def write_report(tables: dict[str, DataFrame], folder: str, formats: tuple[str, ...] = ("json", "csv")) -> list[str]:
    """One report folder, anywhere Spark can write, that is never overwritten: report.json of all tables, and a CSV of each."""
    unknown = set(formats) - {"json", "csv"}
    if unknown:
        raise ValueError(f"unknown formats: {', '.join(sorted(unknown))}")
    if not tables:
        return []
    spark = next(iter(tables.values())).sparkSession
    file_system, target = _file_system(spark, folder)
    if file_system.exists(target) and file_system.listStatus(target):
        raise FileExistsError(folder)
    texts = {"report.json": canonical_json({name: _bounded(df) for name, df in tables.items()})} if "json" in formats else {}
    if "csv" in formats:
        texts |= {f"{name}.csv": _csv_text(df) for name, df in tables.items()}
    for name, text in texts.items():
        write_text(spark, posixpath.join(folder, name), text)
    return list(texts)


def search_result_path(base: str, marketplace: str, query_slug: str, at: datetime) -> str:
    return base if base.endswith(".json") else posixpath.join(base, marketplace, query_slug, at.strftime("%Y-%m-%dT%H-%M-%S") + ".json")


def write_search_result(products: DataFrame, base: str, marketplace: str, query: str, at: datetime) -> str:
    """The products of one search as one JSON file; returns its path."""
    slug = "-".join(w for w in "".join(c if c.isascii() and c.isalnum() else " " for c in query.lower()).split()) or "search"
    path = search_result_path(base, marketplace, slug, at)
    write_text(products.sparkSession, path, canonical_json({"marketplace": marketplace, "query": query, "collected_at": at, "products": _bounded(products)}))
    return path
