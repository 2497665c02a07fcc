"""Sources (A1, B1) and sinks.

The corpus is already collected: pages, documents and events are tables.
Explicit schemas everywhere a reader would otherwise infer; streams need them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PAGES = T.StructType([
    T.StructField("page_id", T.LongType()),
    T.StructField("url", T.StringType()),
    T.StructField("html", T.StringType()),
])
DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
])
EVENTS = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])
SCANS = T.StructType([
    T.StructField("scan_id", T.LongType()),
    T.StructField("body", T.StringType()),
])
SCHEMAS = {"pages": PAGES, "documents": DOCUMENTS, "events": EVENTS, "scans": SCANS}


def table_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One table of a corpus folder (``<root>/<name>.parquet``), with its
    explicit schema when it is one of ours (no footer-based inference)."""
    r = spark.read
    if name in SCHEMAS:
        r = r.schema(SCHEMAS[name])
    return r.parquet(table_path(root, name))


def read_pages(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A1: a stored page corpus (parquet or JSON lines) with the pages schema."""
    return spark.read.schema(PAGES).format(fmt).load(path)


def read_html_files(spark: SparkSession, path: str, glob: str = "*.html") -> DataFrame:
    """A1 for a crawl stored as one HTML file per page: one row per file with
    the pages schema; ``url`` is the file path, ``page_id`` its 64-bit hash.
    Spark's whole-text reader gives no row for an empty file (such a page has
    no items either)."""
    raw = (spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", "true")
           .text(path, wholetext=True))
    file_path = F.col("_metadata.file_path")
    return raw.select(F.xxhash64(file_path).alias("page_id"), file_path.alias("url"), F.col("value").alias("html"))


def read_scans(spark: SparkSession, path: str) -> DataFrame:
    """B1: scan objects as JSON lines ``{"scan_id": .., "body": "<json text>"}``
    or parquet with the same columns."""
    if path.endswith(".parquet"):
        return spark.read.schema(SCANS).parquet(path)
    return spark.read.schema(SCANS).json(path)


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None,
                mode: str = "overwrite") -> None:
    """A10/B5 sink: parquet, optionally partitioned."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
