"""Mixing sources to target weights by pivotal dependent rounding.

A source's target share of words makes the same fractional number of copies of
each of its documents: whole copies are taken, and the fraction is a
probability.  Two documents of one source meet: mass in words moves from one to
the other, either way at random so that expectations stay, until one of the two
probabilities is 0 or 1; the other goes on to the next meeting.  The words in
probability never change, so a source ends within one document of its target.
Large documents meet first, so that the one left in the end is likely small; it
goes to the nearer whole number.

Documents meet within buckets of a source (by hash of the id, so that a source
with a third of all documents is many buckets); what a bucket leaves open meets
the others' in a reduction tree, ``FAN`` buckets a node.  All random numbers
are hashes of ids, so reruns agree.

Null text has size 0; documents of size 0 take whole copies only.  A null
source is a source of its own, after all others.  Rows that repeat a
``doc_id`` are separate documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import WORD, batches, keep, mix, only

WEIGHTS = (3, 1, 2)
ROWS = 512           # documents in a bucket, about
FAN = 32


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """source, source_size, target: weights over the sources by code point (null
    last), repeating; a target stops at ``most`` times its source's size and the
    excess is shared again by weight.  Sources fill in the order of their cap by
    weight: while what remains a unit of weight exceeds it, the cap holds."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last()))
    per = per.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), ((rank - 1) % len(weights) + 1).cast("int")).cast("double"))
    per = per.withColumn("cap", F.col("source_size") * F.lit(float(most)))
    order = W.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    rest = order.rowsBetween(W.currentRow, W.unboundedFollowing)
    past = order.rowsBetween(W.unboundedPreceding, -1)
    everything = W.partitionBy()
    unit = (F.sum("source_size").over(everything) * F.lit(float(share)) - F.coalesce(F.sum("cap").over(past), F.lit(0.0))) / F.sum("weight").over(rest)
    per = per.withColumn("unit", unit).withColumn("capped", F.col("unit") > F.col("cap") / F.col("weight"))
    level = F.max(F.when(~F.col("capped"), F.struct(-F.col("cap") / F.col("weight"), "unit"))).over(everything)["unit"]
    return (per.withColumn("level", level)
            .select("source", "source_size", F.when(F.col("capped"), F.col("cap")).otherwise(F.least("cap", F.col("level") * F.col("weight"))).alias("target")))


def _uniform(*keys: int) -> float:
    x = np.uint64(0x243F6A8885A308D3)
    for k in keys:
        x = mix(np.array([int(x) ^ (k & (2**64 - 1))], dtype=np.uint64))[0]
    return float(x >> np.uint64(11)) / 2.0**53


def meet(p: float, s: int, q: float, t: int, u: float) -> tuple[float, float]:
    """Move mass between probabilities p (of size s) and q (of size t)."""
    up, down = min(1.0 - p, q * t / s), min(p, (1.0 - q) * t / s)
    if u * (up + down) < down:               # raise p, with probability down / (up + down)
        return (1.0, q - up * s / t) if up == 1.0 - p else (p + up, 0.0)
    return (0.0, q + down * s / t) if down == p else (p - down, 1.0)


def _round(level: int, last: bool):
    """Pivotal rounding of each run of one (sid, bucket); at most one row of a
    run stays open, and none in the last level."""
    schema = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("size", pa.int64()), ("source_size", pa.int64()), ("target", pa.float64()),
                        ("sid", pa.int64()), ("bucket", pa.int64()), ("order", pa.int64()), ("whole", pa.int64()), ("p", pa.float64())])
    names = schema.names
    at_p, at_size, at_order = names.index("p"), names.index("size"), names.index("order")

    def rows(it: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        held: tuple | None = None

        def settle(row: tuple) -> tuple:
            if last and 0.0 < row[at_p] < 1.0:
                return (*row[:at_p], 1.0 if row[at_p] >= 0.5 else 0.0)
            return row

        for batch in it:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if not row[at_size]:
                    yield (*row[:at_p], 0.0)
                    continue
                if not 0.0 < row[at_p] < 1.0:
                    yield row
                    continue
                if held is not None and held[5:7] == row[5:7]:
                    p, q = meet(held[at_p], held[at_size], row[at_p], row[at_size], _uniform(row[at_order], held[at_order], level))
                    held, row = (*held[:at_p], p), (*row[:at_p], q)
                    if 0.0 < p < 1.0:
                        yield row
                        continue
                    yield held
                    held = row if 0.0 < q < 1.0 else None
                    if held is None:
                        yield row
                    continue
                if held is not None:
                    yield settle(held)
                held = row
        if held is not None:
            yield settle(held)

    return lambda it: batches(rows(it), schema)


_ROW = "row long, doc_id long, size long, source_size long, target double, sid long, bucket long, `order` long, whole long, p double"


def copies(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0, seed: int = 0) -> DataFrame:
    """doc_id, t (hash of the text), source, size, source_size, target and
    ``copies`` of every row of ``docs``."""
    size = F.when(F.col("text").isNull(), 0).otherwise(F.regexp_count("text", F.lit(WORD))).cast("long")
    sized = keep(only(docs, "doc_id", "source", "text").select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), "source", size.alias("size"), F.xxhash64("text").alias("t")), "sizes")
    per = keep(targets(sized, weights, share, most).withColumn("sid", F.xxhash64(F.coalesce("source", F.lit("")), F.col("source").isNull())), "targets")
    buckets = max(1, -(-sized.count() // ROWS))
    order = F.xxhash64("doc_id", "size", F.lit(seed))
    x = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    open_ = (sized.withColumn("sid", F.xxhash64(F.coalesce("source", F.lit("")), F.col("source").isNull()))
             .join(per.drop("source"), "sid")
             .select("row", "doc_id", "size", "source_size", "target", "sid", F.pmod(order, F.lit(buckets)).alias("bucket"), order.alias("order"),
                     F.floor(x).alias("whole"), (x - F.floor(x)).alias("p")))
    done, level = [], 0
    while True:
        last = buckets == 1
        dealt = open_.repartition("sid", "bucket").sortWithinPartitions("sid", "bucket", F.desc("size"), "order", "doc_id", "row")
        out = keep(dealt.mapInArrow(_round(level, last), _ROW), f"rounded-{level}")
        if last:
            done.append(out)
            break
        between = (F.col("p") > 0) & (F.col("p") < 1)
        done.append(out.filter(~between))
        buckets = -(-buckets // FAN)
        open_ = out.filter(between).withColumn("bucket", F.floor(F.col("bucket") / FAN))
        level += 1
    rounded = done[0]
    for d in done[1:]:
        rounded = rounded.unionByName(d)
    return (rounded.join(sized.select("row", "source", "t"), "row")
            .select("doc_id", "t", "source", "size", "source_size", "target", (F.col("whole") + F.col("p").cast("long")).alias("copies")))


def mix_documents(docs: DataFrame, **how) -> DataFrame:
    """``docs`` with each row as often as its copies.  Rows alike in doc_id,
    source and text are pooled: the sum of their copies is made of one of them."""
    took = copies(docs, **how).groupBy("doc_id", "t", "source").agg(F.sum("copies").alias("copies")).filter("copies > 0")
    took = took.select(*[F.col(c).alias(f"__{c}") for c in ("doc_id", "t", "source", "copies")])
    have = docs.withColumn("__h", F.xxhash64("text")).dropDuplicates(["doc_id", "__h", "source"])
    on = F.col("doc_id").eqNullSafe(F.col("__doc_id")) & (F.col("__h") == F.col("__t")) & F.col("source").eqNullSafe(F.col("__source"))
    return have.join(took, on).withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies").cast("int")))).select(*docs.columns)


def digest(docs: DataFrame) -> DataFrame:
    return copies(docs).select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies")
