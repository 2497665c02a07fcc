"""Stream forms of the operators (Structured Streaming).

- A13: page files in, newest-first links out.  Link extraction is per page
  row with no window, so it runs as a plain append-mode stream.
- C4: contact entities of arriving documents, append mode.
- B6: distinct keys; an epoch compares its keys with their buckets of a key store.
- D8: the bracket per key as one partial row per key and epoch, merged by levels.
- D4, D5: the bracket history per key and bucket of time; an epoch rewrites the
  groups it has attempts of, and what went before a group is added on read.

B6, D8 and D4/D5 write every epoch to its own folder, replaced as a whole if the
epoch is tried again, and keep no state but tables (``store``): results don't
depend on how the input is cut into batches, and no row is late.

Checkpoints and outputs live under the session's shared checkpoint folder.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.patterns import FORUM_EXCLUDED, HIGHEST, LOWEST
from ..operators import entities as E
from ..operators import links as L
from ..operators import numbers as N
from ..operators.scan import combine
from ..sources.tables import SCHEMAS, table_path
from .store import KeyStore, Levels, earlier_garbage, leave_garbage, remove_garbage


def read_stream(spark: SparkSession, root: str, table: str, max_files: int | None = None) -> DataFrame:
    """The parquet files of ``<root>/<table>.parquet``, one file or a folder of
    part files, as a stream.  A missing table is an error, not an empty stream."""
    path = table_path(root, table)
    spark.read.schema(SCHEMAS[table]).parquet(path)          # raises if there is nothing to read
    r = spark.readStream.schema(SCHEMAS[table]).format("parquet")
    if max_files:
        r = r.option("maxFilesPerTrigger", str(max_files))
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    if at.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(at).isDirectory():
        return r.load(path)
    # A stream's path must be a folder: the file is the one of its name there.
    return r.option("pathGlobFilter", f"{table}.parquet").load(root)


def _run(df: DataFrame, out: str, checkpoint: str, available_now: bool) -> StreamingQuery:
    w = (df.writeStream.format("parquet").outputMode("append")
         .option("path", out).option("checkpointLocation", checkpoint))
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")).start()


def stream_index_links(pages: DataFrame, out: str, checkpoint: str, item=("li", None), title=None,
                       keywords: Iterable[str] = FORUM_EXCLUDED, available_now: bool = True) -> StreamingQuery:
    """Every arriving page's kept links, newest first, appended to ``out``."""
    return _run(L.index_links(pages, item, title, keywords), out, checkpoint, available_now)


def stream_entities(docs: DataFrame, out: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """C4 on a stream: ``(doc_id, kind, pos, value)`` appended per document."""
    return _run(E.extract_entities(docs), out, checkpoint, available_now)


def distinct_within_watermark(events: DataFrame, keys: Sequence[str], ts_col: str = "ts",
                              delay: str = "1 day") -> DataFrame:
    """B6 in bounded memory, for feeds in time order: the first row of each key;
    a key's state is dropped once the watermark (max event time - ``delay``)
    passes it, so a key seen again after that is a new one, and rows older than
    the watermark are dropped.  ``stream_distinct`` has neither effect.
    ``timestamp_ntz`` is read in the session time zone (watermarks need
    ``timestamp``)."""
    ts = F.col(ts_col)
    if dict(events.dtypes)[ts_col] == "timestamp_ntz":
        ts = ts.cast("timestamp")
    return (events.withColumn("_wts", ts).withWatermark("_wts", delay)
            .dropDuplicatesWithinWatermark(list(keys)))


def _by_epoch(df: DataFrame, checkpoint: str, write, available_now: bool) -> StreamingQuery:
    w = df.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")).start()


def stream_distinct(events: DataFrame, keys: Sequence[str], out: str, checkpoint: str, available_now: bool = True,
                    buckets: int = 64, bucket_rows: int = 1_000_000) -> StreamingQuery:
    """Each key once, in the epoch that first has it.  An epoch reads only
    the buckets of the key store (beside the checkpoint) that its keys fall into."""
    def write(batch: DataFrame, epoch: int) -> None:
        store = KeyStore(batch.sparkSession, f"{checkpoint}-keys", tuple(keys), buckets, bucket_rows)
        store.add(epoch, batch, f"{out}/epoch={epoch}")

    return _by_epoch(events, checkpoint, write, available_now)


def _moves(attempts: DataFrame, raw_col: str, target_col: str, lo: int, hi: int, *carry: str) -> DataFrame:
    """The carried columns and what an attempt does to a bracket: ``low`` and
    ``high`` (the bound it moves, if any) and ``hit``.  Parsed once a row."""
    parsed = attempts.select(*carry, N.parse_int(F.col(raw_col)).alias("_v"), F.col(target_col).cast("decimal(38,0)").alias("_t"))
    v, t = F.col("_v"), F.col("_t")
    return parsed.select(*carry, F.when(v < t, v).alias("low"), F.when(v > t, v).alias("high"),
                         F.when((v == t) & (t > lo) & (t < hi), F.lit(1)).otherwise(F.lit(0)).alias("hit"))


def _brackets(spark: SparkSession, out: str, key: T.StructField) -> Levels:
    wide = T.DecimalType(38, 0)
    fields = [key, *(T.StructField(n, t) for n, t in (("attempts", T.LongType()), ("low", wide), ("high", wide), ("hit", T.IntegerType())))]

    def merge(rows: DataFrame) -> DataFrame:
        return rows.groupBy(key.name).agg(F.sum("attempts").alias("attempts"), F.max("low").alias("low"), F.min("high").alias("high"), F.max("hit").alias("hit"))

    return Levels(spark, out, T.StructType(fields), merge)


def stream_bracket_state(attempts: DataFrame, key: str, out: str, checkpoint: str, raw_col: str = "raw", target_col: str = "target",
                         lo: int = LOWEST, hi: int = HIGHEST, available_now: bool = True) -> StreamingQuery:
    """One partial row per key that an epoch has, merged level by level; see
    ``bracket_state``."""
    field = attempts.schema[key]

    def write(batch: DataFrame, epoch: int) -> None:
        levels = _brackets(batch.sparkSession, out, field)
        levels.commit(epoch, levels.merge(_moves(batch, raw_col, target_col, lo, hi, key).withColumn("attempts", F.lit(1).cast("long"))))

    return _by_epoch(attempts, checkpoint, write, available_now)


def bracket_state(spark: SparkSession, out: str, key: T.StructField, lo: int = LOWEST, hi: int = HIGHEST) -> DataFrame:
    """The current bracket of each key from every attempt seen so far (max
    of lows, min of highs, any hit); folds a logarithmic number of tables.
    ``key`` is the key's field in the attempts' schema."""
    wide = "decimal(38,0)"
    return _brackets(spark, out, key).read().select(
        key.name, "attempts", F.greatest(F.lit(lo).cast(wide), "low").cast("long").alias("lo"),
        F.least(F.lit(hi).cast(wide), "high").cast("long").alias("hi"), "hit")


#: Columns of a bracket history's running aggregates and their totals.
_RUNNING = (("below", "decimal(38,0)"), ("above", "decimal(38,0)"), ("hits", "bigint"), ("before", "bigint"))


@dataclass(frozen=True)
class History:
    """D4, D5 on a stream of attempts in any order: per key and bucket of time.

    ``rows`` holds the attempts of each group (key, bucket) with the running
    aggregates *inside* the group; ``totals`` one row a group, with the epoch
    that wrote the group last.  What went before a group is a prefix over the
    few totals of its key, taken on read.  So an epoch rewrites the groups that
    its attempts fall into, late or not, and what comes after a late attempt
    changes by its group's total alone.  ``bucket`` is an int that never falls
    along the order.  Folders whose groups have all been rewritten are removed an
    epoch later."""

    attempts: T.StructType       # key, order columns, raw and target, others are dropped
    key: str
    order: tuple[str, ...]
    out: str
    bucket: Column
    raw_col: str = "raw"
    target_col: str = "target"
    lo: int = LOWEST
    hi: int = HIGHEST

    @property
    def _columns(self) -> list[str]:
        return list(dict.fromkeys((self.key, *self.order, self.raw_col, self.target_col)))

    @property
    def _schema(self) -> T.StructType:
        more = [T.StructField("_ok", T.BooleanType()), T.StructField("value", T.DecimalType(38, 0))]
        more += [T.StructField(n, T._parse_datatype_string(t)) for n, t in _RUNNING]
        return T.StructType([*(self.attempts[c] for c in self._columns), *more, T.StructField("_bucket", T.IntegerType())])

    def _totals(self, spark: SparkSession) -> Levels:
        fields = [self.attempts[self.key], T.StructField("_bucket", T.IntegerType()), T.StructField("written", T.LongType())]
        fields += [T.StructField(f"_t_{n}", T._parse_datatype_string(t)) for n, t in _RUNNING]
        names = [f.name for f in fields[2:]]

        def merge(rows: DataFrame) -> DataFrame:
            last = rows.groupBy(self.key, "_bucket").agg(F.max_by(F.struct(*names), "written").alias("_last"))
            return last.select(self.key, "_bucket", "_last.*")

        return Levels(spark, f"{self.out}/totals", T.StructType(fields), merge)

    def _folder(self, epoch: int, bucket: int | None = None) -> str:
        return f"{self.out}/rows/epoch={epoch}" + ("" if bucket is None else f"/_bucket={bucket}")

    @staticmethod
    def _places(groups: DataFrame) -> set[tuple[int, int]]:
        """The (epoch, bucket) folders that hold groups (key, _bucket, written)."""
        return {(r["written"], r["_bucket"]) for r in groups.select("written", "_bucket").distinct().collect()}

    def _rows(self, spark: SparkSession, groups: DataFrame, where: set[tuple[int, int]]) -> DataFrame:
        """The stored rows of groups (key, _bucket, written), in these folders."""
        if not where:
            return spark.createDataFrame([], self._schema)
        read = [spark.read.schema(self._schema).option("basePath", self._folder(e)).parquet(*[self._folder(e, b) for w, b in sorted(where) if w == e])
                .withColumn("written", F.lit(e)) for e in sorted({w for w, _ in where})]
        every = reduce(DataFrame.unionByName, read)
        wanted = groups.select(F.col(self.key).alias("_k"), F.col("_bucket").alias("_b"), F.col("written").alias("_w"))
        same = F.col(self.key).eqNullSafe(F.col("_k")) & (F.col("_bucket") == F.col("_b")) & (F.col("written") == F.col("_w"))
        return every.join(wanted, same, "left_semi").drop("written")

    def write(self, batch: DataFrame, epoch: int) -> None:
        spark, key = batch.sparkSession, self.key
        # Nulls come first in the order.
        bucket = F.coalesce(self.bucket.cast("int"), F.lit(-2**31))
        new = N.parsed(batch.select(*self._columns, bucket.alias("_bucket")), self.raw_col)
        touched = new.select(F.col(key).alias("_k"), F.col("_bucket").alias("_b")).distinct()
        totals = self._totals(spark)
        before = totals.read(epoch).join(touched, F.col(key).eqNullSafe(F.col("_k")) & (F.col("_bucket") == F.col("_b")), "left_semi")
        replaced = self._places(before)
        rows = new.unionByName(self._rows(spark, before, replaced).select(new.columns))
        val, t = F.col("value"), F.col(self.target_col).cast("decimal(38,0)")
        moves = N.moves(val, t, self.lo, self.hi)
        group = Window.partitionBy(key, "_bucket").orderBy(*self.order).rowsBetween(Window.unboundedPreceding, -1)
        fold = {"max": F.max, "min": F.min, "sum": F.sum}
        here = self._folder(epoch)
        local = rows.select("*", *[fold[kind](expr).over(group).cast(dict(_RUNNING)[n]).alias(n) for n, (kind, expr) in moves.items()])
        local.select(*self._schema.names).write.mode("overwrite").partitionBy("_bucket").parquet(here)
        written = spark.read.schema(self._schema).parquet(here)
        # Folders whose groups have all been rewritten go when the next epoch is complete.
        gone = earlier_garbage(spark, f"{self.out}/garbage", epoch)
        totals.commit(epoch, written.groupBy(key, "_bucket").agg(
            F.lit(epoch).cast("long").alias("written"), *[fold[kind](expr).cast(dict(_RUNNING)[n]).alias(f"_t_{n}") for n, (kind, expr) in moves.items()]))
        remove_garbage(spark, f"{self.out}/garbage", gone)
        if replaced:
            touched_buckets = sorted({b for _, b in replaced})
            still = self._places(totals.read().filter(F.col("_bucket").isin(touched_buckets)))
            leave_garbage(spark, f"{self.out}/garbage", epoch, [self._folder(w, b) for w, b in sorted(replaced - still)])

    def read(self, spark: SparkSession) -> DataFrame:
        """The rows of ``numbers.bracket_history`` over every attempt so far."""
        totals = self._totals(spark).read()
        earlier = Window.partitionBy(self.key).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
        kinds = {n: kind for n, (kind, _) in N.moves(F.col("value"), F.col(self.target_col), self.lo, self.hi).items()}
        fold = {"max": F.max, "min": F.min, "sum": F.sum}
        carry = totals.select(F.col(self.key).alias("_k"), F.col("_bucket").alias("_b"), *[fold[kinds[n]](f"_t_{n}").over(earlier).alias(f"_c_{n}") for n, _ in _RUNNING])
        joined = self._rows(spark, totals, self._places(totals)).join(carry, F.col(self.key).eqNullSafe(F.col("_k")) & (F.col("_bucket") == F.col("_b")))
        run = joined.select(*self._columns, "_ok", "value", *[combine(kinds[n], F.col(f"_c_{n}"), F.col(n)).alias(n) for n, _ in _RUNNING])
        return N.told(run, self.target_col, self.lo, self.hi)


def stream_bracket_history(attempts: DataFrame, history: History, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """The history kept up to date by epoch; see ``History``."""
    return _by_epoch(attempts, checkpoint, history.write, available_now)
