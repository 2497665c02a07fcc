"""Tables that streams keep between epochs, under a folder of the shared storage.

Both kinds are changed by epoch and can be tried again: what an epoch writes is
replaced as a whole, and nothing counts until the epoch's pointer, an empty file
named by the epoch, is there.  Readers take the latest pointer, so a crash in
between changes no result.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _fs(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = _fs(spark, path)
    return fs.exists(at)


def _remove(spark: SparkSession, path: str) -> None:
    fs, at = _fs(spark, path)
    fs.delete(at, True)


def _point(spark: SparkSession, root: str, epoch: int) -> None:
    fs, at = _fs(spark, f"{root}/pointer/{epoch:012d}")
    fs.create(at, True).close()


def pointers(spark: SparkSession, root: str, before: int | None = None) -> list[int]:
    """The epochs that are complete, in order (before one, if given)."""
    fs, at = _fs(spark, f"{root}/pointer")
    done = sorted(int(f.getPath().getName()) for f in fs.listStatus(at)) if fs.exists(at) else []
    return done if before is None else [e for e in done if e < before]


def leave_garbage(spark: SparkSession, root: str, epoch: int, paths: Sequence[str]) -> None:
    """Note paths that nothing refers to as of an epoch."""
    spark.createDataFrame([(p,) for p in paths], "path string").coalesce(1).write.mode("overwrite").parquet(f"{root}/epoch={epoch}")


def earlier_garbage(spark: SparkSession, root: str, epoch: int) -> list[tuple[str, list[str]]]:
    """(note, paths) of what earlier epochs have left."""
    fs, at = _fs(spark, root)
    notes = [f.getPath().toString() for f in fs.listStatus(at)] if fs.exists(at) else []
    return [(n, [r[0] for r in spark.read.schema("path string").parquet(n).collect()]) for n in notes if int(n.rsplit("=", 1)[1]) < epoch]


def remove_garbage(spark: SparkSession, root: str, found: list[tuple[str, list[str]]]) -> None:
    for note, paths in found:
        for path in (*paths, note):
            _remove(spark, path)


@dataclass(frozen=True)
class Levels:
    """A table of partial rows: each epoch adds some, ``merge`` makes few of many.

    ``fan`` tables of a level are merged to one of the next, so after n epochs
    a read folds at most ``fan - 1`` tables of each of the log n levels.  Which
    tables count follows from the number of epochs alone.  Merged tables are
    removed when the next of their level are, so that a reader who looked at the
    pointer before still finds them."""

    spark: SparkSession
    root: str
    schema: T.StructType
    merge: Callable[[DataFrame], DataFrame]
    fan: int = 8

    def _path(self, level: int, index: int) -> str:
        return f"{self.root}/level={level}/index={index:012d}"

    def tables(self, epochs: int) -> list[str]:
        """The tables that hold the first ``epochs`` epochs."""
        out, level = [], 0
        while self.fan ** level <= epochs:
            size = self.fan ** level
            out += [self._path(level, i) for i in range(epochs // (size * self.fan) * self.fan, epochs // size)]
            level += 1
        return out

    def _union(self, paths: Sequence[str]) -> DataFrame:
        there = [p for p in paths if exists(self.spark, p)]
        return self.spark.read.schema(self.schema).parquet(*there) if there else self.spark.createDataFrame([], self.schema)

    def read(self, before: int | None = None) -> DataFrame:
        """What the complete epochs (before one, if given) have written, merged."""
        done = pointers(self.spark, self.root, before)
        return self.merge(self._union(self.tables(done[-1] + 1 if done else 0)))

    def commit(self, epoch: int, rows: DataFrame) -> None:
        """Write an epoch's rows and the merges that are due, then count them."""
        rows.select(*self.schema.names).write.mode("overwrite").parquet(self._path(0, epoch))
        superseded, level, index = [], 1, epoch + 1
        while index % self.fan == 0:
            index //= self.fan
            inputs = [self._path(level - 1, i) for i in range((index - 1) * self.fan, index * self.fan)]
            self.merge(self._union(inputs)).select(*self.schema.names).write.mode("overwrite").parquet(self._path(level, index - 1))
            superseded += [self._path(level - 1, i) for i in range(max(0, index - 2) * self.fan, (index - 1) * self.fan)]
            level += 1
        _point(self.spark, self.root, epoch)
        for path in superseded:
            _remove(self.spark, path)
        for old in pointers(self.spark, self.root, epoch)[:-1]:
            _remove(self.spark, f"{self.root}/pointer/{old:012d}")


_MANIFEST = "bucket int, buckets int, epoch long, source int, rows long"


@dataclass(frozen=True)
class KeyStore:
    """The distinct keys of a stream, dealt into buckets by hash.

    An epoch reads the buckets that its keys fall into and no other, and adds
    what is new as one more part of each; a bucket of ``fan`` parts becomes one.
    Buckets are doubled in number when they hold more than ``bucket_rows`` keys
    on average; no key is moved for it: two buckets then refer to one part, and
    a read takes each its own half.  The manifest (one row a bucket and part) is
    all that the driver sees."""

    spark: SparkSession
    root: str
    keys: tuple[str, ...]
    buckets: int = 64
    bucket_rows: int = 1_000_000
    fan: int = 8

    def manifest(self, before: int | None = None) -> list:
        done = pointers(self.spark, self.root, before)
        return self._manifest_of(done[-1]) if done else []

    def _manifest_of(self, epoch: int) -> list:
        return self.spark.read.schema(_MANIFEST).parquet(f"{self.root}/manifest/epoch={epoch}").collect()

    def _part(self, row) -> str:
        return f"{self.root}/keys/epoch={row['epoch']}/bucket={row['source']}"

    def parts_read(self, before: int, touched: set[int]) -> list[str]:
        """The files' folders that an epoch with keys of these buckets reads."""
        return sorted({self._part(r) for r in self.manifest(before) if r["bucket"] in touched})

    def add(self, epoch: int, batch: DataFrame, out: str) -> None:
        """Write the keys of the batch that no earlier epoch had to ``out``."""
        spark, keys = self.spark, list(self.keys)
        manifest = self.manifest(epoch)
        n = manifest[0]["buckets"] if manifest else self.buckets
        bucket = F.pmod("_hash", F.lit(n)).cast("int")
        incoming = f"{self.root}/incoming"
        batch.select(*keys).distinct().withColumn("_hash", F.xxhash64(*keys)).write.mode("overwrite").parquet(incoming)
        now = spark.read.schema(T.StructType([*batch.select(*keys).schema.fields, T.StructField("_hash", T.LongType())])).parquet(incoming)
        touched = {r[0] for r in now.select(bucket).distinct().collect()}
        paths = self.parts_read(epoch, touched)
        old = spark.read.schema(now.schema).parquet(*paths) if paths else spark.createDataFrame([], now.schema)
        old = old.filter(bucket.isin(touched)) if touched else old
        seen = old.select("_hash", *[F.col(k).alias(f"_{k}") for k in keys])
        same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys], now["_hash"] == seen["_hash"])
        now.join(seen, same, "left_anti").select(*keys).write.mode("overwrite").parquet(out)
        fresh = spark.read.schema(now.select(*keys).schema).parquet(out).withColumn("_hash", F.xxhash64(*keys))
        # Buckets with many parts are written whole, the others' new keys alone.
        parts: dict[int, int] = {}
        for r in manifest:
            parts[r["bucket"]] = parts.get(r["bucket"], 0) + 1
        whole = {b for b in touched if parts.get(b, 0) >= self.fan - 1}
        rows = fresh.unionByName(old.filter(bucket.isin(whole))) if whole else fresh
        here = f"{self.root}/keys/epoch={epoch}"
        rows.withColumn("bucket", bucket).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(here)
        written = spark.read.schema(T.StructType([*now.schema.fields, T.StructField("bucket", T.IntegerType())])).parquet(here)
        added = [(r[0], n, epoch, r[0], r[1]) for r in written.groupBy("bucket").count().collect()]
        after = [tuple(r) for r in manifest if r["bucket"] not in whole] + added
        while sum(r[4] for r in after) > n * self.bucket_rows:
            after = [(b + k * n, 2 * n, e, s, m // 2) for b, _, e, s, m in after for k in (0, 1)]
            n *= 2
        spark.createDataFrame(after, _MANIFEST).coalesce(1).write.mode("overwrite").parquet(f"{self.root}/manifest/epoch={epoch}")
        _point(spark, self.root, epoch)
        # What the epoch before did away with.
        done = pointers(spark, self.root, epoch)
        if len(done) > 1:
            for path in {self._part(r) for r in self._manifest_of(done[-2])} - {self._part(r) for r in manifest}:
                _remove(spark, path)
            for e in done[:-1]:
                _remove(spark, f"{self.root}/pointer/{e:012d}")
                _remove(spark, f"{self.root}/manifest/epoch={e}")
