"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pageops.session import scratch_path

#: A word, for Java, Python and RE2 alike: a run without ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_S30, _S27, _S31 = np.uint64(30), np.uint64(27), np.uint64(31)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def only(df: DataFrame, *names: str) -> DataFrame:
    """The named columns and no other, so extra columns (also those that clash
    with a name used inside an operator) never meet the operator's own."""
    return df.select(*[F.col(n) for n in names])


def keep(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """Write ``df`` as a table in the cluster's shared folder and read it back:
    lineage ends there, and a lost executor loses nothing."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Have Spark remove the shuffle files of plans that nothing refers to any
    more.  It does when the driver's garbage is collected, which a driver with
    little to do may put off until the disks hold many such files."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def texts(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """The column's texts as UTF-8 bytes; null is empty."""
    raw = batch.column(batch.schema.get_field_index(column)).cast(pa.binary()).to_pylist()
    return [t or b"" for t in raw]


def words(text: bytes) -> list[bytes]:
    """The words of a text (``bytes.split`` cuts at exactly the six ASCII
    white-space characters that WORD excludes)."""
    return text.split()


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser."""
    x = (x ^ (x >> _S30)) * _M1
    x = (x ^ (x >> _S27)) * _M2
    return x ^ (x >> _S31)


def word_hashes(ws: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, ws), dtype=np.uint64, count=len(ws))


def batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 4096) -> Iterator[pa.RecordBatch]:
    """Rows as record batches of at most ``size`` rows."""
    block: list[tuple] = []
    for row in rows:
        block.append(row)
        if len(block) >= size:
            yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*block), schema)], schema=schema)
            block = []
    if block:
        yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*block), schema)], schema=schema)


#: Keys that spread_join broadcasts, at most.
HOT_KEYS = 10_000


def spread_join(left: DataFrame, right: DataFrame, on: list[str], rows: str, total: int) -> DataFrame:
    """Inner join with ``right``, whose rows are unique by ``on`` and say in
    ``rows`` how many rows of ``left`` (``total`` in all) have the key.  Keys with
    a share of 1 / HOT_KEYS or more, which cannot be more than HOT_KEYS, are
    joined by broadcast, so that no key fills a task.  ``left`` is read twice."""
    often = F.col(rows) * HOT_KEYS >= total
    hot = F.broadcast(right.filter(often).drop(rows))
    rest = left.join(F.broadcast(right.filter(often).select(*on)), on, "left_anti")
    return left.join(hot, on).unionByName(rest.join(right.filter(~often).drop(rows), on))
