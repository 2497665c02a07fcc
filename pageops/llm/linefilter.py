"""Line dedup that can be taken back: sharded cuckoo filters over exact counts.

A line's key is the line without ASCII white space at its ends, A-Z lower-cased.
Keys that at least ``min_docs`` documents have lose all their lines.  The index
holds, in versions of a folder in the shared storage,

- ``counts``: of each key (128 bits of BLAKE2) the documents that have it, exact;
- ``filters``: per shard of the keys a cuckoo filter of those at or above
  ``min_docs``: buckets of four 16-bit tags, a tag in one of two buckets.

``insert`` and ``delete`` add a batch's documents to the counts or take them
off.  A key that crosses ``min_docs`` enters its shard's filter or leaves it (a
cuckoo filter, unlike a Bloom filter, forgets), so after a deletion the index is
as if the documents had never come.  A filter that gets too full is made anew,
twice as large, from the counts.  ``apply`` takes the keys of documents to the
shards; only what a filter lets through is compared with the counts.

A document is a row: rows that repeat count each.  Null texts have one empty
line.  Extra columns stay as they are, if carried.  Keys with a thousandth of all
(document, key) pairs - at most 1,000 - are joined by broadcast, so no shard and
no join holds more of one key; counts are aggregated before they are shuffled.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pageops.session import scratch_path

from .common import keep, mix, only, texts

MIN_DOCS = 10
MIN_CHARS = 1
SLOTS = 4
FULL = 0.8           # load from which a filter is made anew
KICKS = 200
SHARDS = 64          # at least
SHARD_KEYS = 500_000  # pairs of a document and a key that a shard is meant for, at the first insertion
HOT = 1000

_KEYS = "r long, k1 long, k2 long"
_COUNTS = "shard long, k1 long, k2 long, n long, was boolean"
_FILTERS = "shard long, tags binary"


def line_key(line: bytes) -> bytes:
    return line.strip().lower()      # bytes: the six ASCII white-space characters, A-Z only


def _counted(key: bytes, min_chars: int) -> bool:
    return len(key) >= min_chars and (min_chars <= 1 or len(key.decode()) >= min_chars)


def _digest(key: bytes) -> bytes:
    return hashlib.blake2b(key, digest_size=16).digest()


def keys(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(r, k1, k2): each document's distinct keys.  ``r`` is a hash of doc_id and
    text; whether a key is frequent doesn't depend on the document, so documents
    with equal ``r`` may well share a list of frequent keys."""
    frame = only(docs, "doc_id", "text").select(F.xxhash64("doc_id", "text").alias("r"), "text")

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for at in range(0, batch.num_rows, 1024):
                b = batch.slice(at, 1024)
                found, counts = [], []
                for t in texts(b):
                    mine = [_digest(k) for k in {line_key(x) for x in t.split(b"\n")} if _counted(k, min_chars)]
                    found += mine
                    counts.append(len(mine))
                k = np.frombuffer(b"".join(found), dtype="<i8").reshape(-1, 2)
                rows = pa.array(np.repeat(np.arange(b.num_rows), counts))
                yield pa.RecordBatch.from_arrays([b.column(0).take(rows), pa.array(np.ascontiguousarray(k[:, 0])), pa.array(np.ascontiguousarray(k[:, 1]))], names=["r", "k1", "k2"])

    return frame.mapInArrow(run, _KEYS)


class Cuckoo:
    """A multiset of keys as 16-bit tags.  ``rest`` takes what finds no place.
    As bytes: how many are in the rest, the rest (8 bytes each), the tags."""

    def __init__(self, state: bytes) -> None:
        n = int.from_bytes(state[:8], "little")
        self.rest = np.frombuffer(state, dtype="<i8", count=n, offset=8).tolist()
        self.tags = np.frombuffer(state, dtype="<u2", offset=8 + 8 * n).copy()
        self.mask = len(self.tags) // SLOTS - 1

    @classmethod
    def empty(cls, n: int) -> "Cuckoo":
        buckets = 2
        while buckets * SLOTS * FULL / 2 < n:
            buckets *= 2
        return cls(bytes(8 + 2 * SLOTS * buckets))

    def places(self, k1: np.ndarray, k2: np.ndarray) -> tuple[np.ndarray, ...]:
        tag = np.maximum(k1.view(np.uint64) >> np.uint64(48), np.uint64(1))
        one = k2.view(np.uint64) & np.uint64(self.mask)
        return tag.astype(np.int64), one.astype(np.int64), (one ^ (mix(tag) & np.uint64(self.mask))).astype(np.int64)

    def other(self, bucket: int, tag: int) -> int:
        return bucket ^ int(mix(np.array([tag], dtype=np.uint64))[0] & np.uint64(self.mask))

    def has(self, k1: np.ndarray, k2: np.ndarray) -> np.ndarray:
        tag, one, two = self.places(k1, k2)
        table = self.tags.reshape(-1, SLOTS)
        found = (table[one] == tag[:, None]).any(axis=1) | (table[two] == tag[:, None]).any(axis=1)
        if self.rest:
            found |= np.isin(np.minimum(one, two) << 16 | tag, self.rest)
        return found

    def _put(self, bucket: int, tag: int) -> bool:
        for s in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
            if not self.tags[s]:
                self.tags[s] = tag
                return True
        return False

    def add(self, tag: int, one: int, two: int) -> None:
        if self._put(one, tag) or self._put(two, tag):
            return
        bucket = two
        for kick in range(KICKS):
            s = bucket * SLOTS + (kick + tag) % SLOTS
            tag, self.tags[s] = int(self.tags[s]), tag
            bucket = self.other(bucket, tag)
            if self._put(bucket, tag):
                return
        self.rest.append(min(bucket, self.other(bucket, tag)) << 16 | tag)

    def remove(self, tag: int, one: int, two: int) -> None:
        for bucket in (one, two):
            for s in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
                if self.tags[s] == tag:
                    self.tags[s] = 0
                    return
        self.rest.remove(min(one, two) << 16 | tag)

    def change(self, k1: np.ndarray, k2: np.ndarray, sign: np.ndarray) -> None:
        for tag, one, two, up in zip(*(x.tolist() for x in (*self.places(k1, k2), sign))):
            (self.add if up > 0 else self.remove)(tag, one, two)

    def row(self, shard: int) -> pa.RecordBatch:
        state = len(self.rest).to_bytes(8, "little") + np.array(self.rest, dtype="<i8").tobytes() + self.tags.tobytes()
        return pa.RecordBatch.from_arrays([pa.array([shard], pa.int64()), pa.array([state], pa.binary())], names=["shard", "tags"])


@dataclass(frozen=True)
class Index:
    """One version of an index; ``insert`` and ``delete`` give the next, in a
    folder of its own, so a version that was read stays as it is."""

    spark: SparkSession
    folder: str
    version: str = ""        # the version's folder; none: an empty index
    shards: int = 0          # set by the first insertion
    min_docs: int = MIN_DOCS
    min_chars: int = MIN_CHARS

    def table(self, name: str) -> str:
        return f"{self.folder}/{self.version}/{name}"

    @property
    def counts(self) -> DataFrame:
        """(shard, k1, k2, n): the documents that have each key."""
        if not self.version:
            return self.spark.createDataFrame([], _COUNTS).drop("was")
        return self.spark.read.schema(_COUNTS).parquet(self.table("counts")).filter("n > 0").drop("was")

    @property
    def filters(self) -> DataFrame:
        """(shard, tags): the shards' filters, as ``Cuckoo`` writes them."""
        if not self.version:
            return self.spark.createDataFrame([], _FILTERS)
        return self.spark.read.schema(_FILTERS).parquet(self.table("filters"))

    def insert(self, docs: DataFrame, made: DataFrame | None = None) -> "Index":
        """With the documents' lines counted; ``made`` may hold their ``keys``."""
        return self._changed(keys(docs, self.min_chars) if made is None else made, 1)

    def delete(self, docs: DataFrame) -> "Index":
        """Without documents that were inserted.  Raises if one never was."""
        return self._changed(keys(docs, self.min_chars), -1)

    def _changed(self, pairs: DataFrame, sign: int) -> "Index":
        shards = self.shards
        if not shards:
            shards, n = SHARDS, pairs.count()
            while shards * SHARD_KEYS < n:
                shards *= 2
        new = replace(self, version=f"v-{int(self.version[2:8] or 0) + 1:06d}-{uuid.uuid4().hex[:8]}", shards=shards)
        batch = pairs.groupBy("k1", "k2").agg((F.count("*") * sign).alias("d")).select("k1", "k2", F.lit(0).cast("long").alias("old"), "d")
        before = self.counts.select("k1", "k2", F.col("n").alias("old"), F.lit(0).cast("long").alias("d"))
        both = before.unionByName(batch).groupBy("k1", "k2").agg(F.sum("old").alias("old"), F.sum("d").alias("d"))
        shard = F.pmod("k1", F.lit(shards)).cast("long")
        both.select(shard.alias("shard"), "k1", "k2", (F.col("old") + F.col("d")).alias("n"), (F.col("old") >= self.min_docs).alias("was")).write.parquet(new.table("counts"))
        merged = self.spark.read.schema(_COUNTS).parquet(new.table("counts"))
        if not merged.filter("n < 0").isEmpty():
            raise ValueError("documents that were never inserted can't be deleted")
        self._filters(merged).write.parquet(new.table("filters"))
        return new

    def _filters(self, merged: DataFrame) -> DataFrame:
        """The filters after a change: kept and changed where there is room, else made anew."""
        now = F.col("n") >= self.min_docs
        need = merged.groupBy("shard").agg(F.count_if(now).alias("need"), F.count_if(now != F.col("was")).alias("moves"))
        # One row a shard.
        plan = need.join(self.filters, "shard", "full").withColumn("anew", F.col("tags").isNull() | (F.col("need") * 2 > F.octet_length("tags") * F.lit(FULL)))
        anew = plan.select("shard", "anew").filter("anew is not null")
        rows = merged.join(F.broadcast(anew), "shard").filter((F.col("anew") & now) | (~F.col("anew") & (now != F.col("was"))))
        rows = rows.select("shard", F.lit(1).alias("kind"), F.lit(None).cast("binary").alias("tags"),
                           F.lit(0).cast("long").alias("need"), "k1", "k2", F.when(now, 1).otherwise(-1).alias("sign"))
        none = F.lit(None).cast("long")
        tables = plan.select("shard", F.lit(0).alias("kind"), F.when(~F.col("anew"), F.col("tags")).alias("tags"),
                             F.coalesce("need", F.lit(0).cast("long")).alias("need"), none.alias("k1"), none.alias("k2"), F.lit(0).alias("sign"))

        def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: tuple[int, Cuckoo] | None = None
            for shard, first, part in _by_shard(it):
                if first is not None:
                    if held is not None:
                        yield held[1].row(held[0])
                    held = shard, Cuckoo.empty(first["need"]) if first["tags"] is None else Cuckoo(first["tags"])
                if len(part):
                    held[1].change(*(part.column(part.schema.get_field_index(c)).to_numpy() for c in ("k1", "k2", "sign")))
            if held is not None:
                yield held[1].row(held[0])

        return rows.unionByName(tables).repartition("shard").sortWithinPartitions("shard", "kind").mapInArrow(run, _FILTERS)

    def frequent(self, pairs: DataFrame) -> DataFrame:
        """Those of the pairs (r, k1, k2) whose key is frequent."""
        many = self.counts.filter(F.col("n") >= self.min_docs).select("k1", "k2", "n")
        # The counts add up to all pairs, so at most HOT keys have a share of 1 in HOT.
        every = self.counts.agg(F.sum("n")).first()[0] or 0
        hot = many.filter(F.col("n") >= every / HOT).select("k1", "k2", F.lit(True).alias("hot"))
        told = pairs.join(F.broadcast(hot), ["k1", "k2"], "left")
        rest = told.filter("hot is null").select(F.pmod("k1", F.lit(max(1, self.shards))).cast("long").alias("shard"), F.lit(1).alias("kind"),
                                                 F.lit(None).cast("binary").alias("tags"), "r", "k1", "k2")
        none = F.lit(None).cast("long")
        tables = self.filters.select("shard", F.lit(0).alias("kind"), "tags", none.alias("r"), none.alias("k1"), none.alias("k2"))

        def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: Cuckoo | None = None
            of: int | None = None
            for shard, first, part in _by_shard(it):
                if first is not None:
                    of, held = shard, Cuckoo(first["tags"])
                if len(part) and of == shard:
                    r, k1, k2 = (part.column(part.schema.get_field_index(c)) for c in ("r", "k1", "k2"))
                    passed = pa.array(held.has(k1.to_numpy(), k2.to_numpy()))
                    yield pa.RecordBatch.from_arrays([c.filter(passed) for c in (r, k1, k2)], names=["r", "k1", "k2"])

        passed = rest.unionByName(tables).repartition("shard").sortWithinPartitions("shard", "kind").mapInArrow(run, _KEYS)
        return told.filter("hot").select("r", "k1", "k2").unionByName(passed.join(many, ["k1", "k2"], "left_semi"))

    def apply(self, docs: DataFrame, carry: tuple[str, ...] = (), made: DataFrame | None = None) -> DataFrame:
        """One row per row of ``docs``: doc_id, the carried columns, ``text``
        without the lines of frequent keys (joined by line feeds), ``n_lines``
        and ``n_dropped``."""
        pairs = keep(keys(docs, self.min_chars), "keys") if made is None else made
        lists = self.frequent(pairs).distinct().groupBy("r").agg(F.collect_list(F.struct("k1", "k2")).alias("gone"))
        frame = only(docs, "doc_id", *carry, "text").withColumn("doc_id", F.col("doc_id").cast("long")).withColumn("r", F.xxhash64(F.col("doc_id"), F.col("text")))
        joined = frame.join(lists, "r", "left").select("doc_id", *carry, "text", "gone")
        n_head, min_chars = 1 + len(carry), self.min_chars
        head = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in joined.schema[:n_head])

        def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in it:
                for at in range(0, batch.num_rows, 1024):
                    b = batch.slice(at, 1024)
                    kept, n, lost = [], [], []
                    for t, gone in zip(texts(b), b.column(n_head + 1)):
                        lines = stay = t.split(b"\n")
                        if gone.is_valid:
                            bad = {x["k1"].to_bytes(8, "little", signed=True) + x["k2"].to_bytes(8, "little", signed=True) for x in gone.as_py()}
                            stay = [x for x in lines if not (_counted(k := line_key(x), min_chars) and _digest(k) in bad)]
                        kept.append(b"\n".join(stay))
                        n.append(len(lines))
                        lost.append(len(lines) - len(stay))
                    yield pa.RecordBatch.from_arrays([*b.columns[:n_head], pa.array(kept, pa.binary()).cast(pa.string()), pa.array(n, pa.int64()), pa.array(lost, pa.int64())],
                                                     names=[*b.schema.names[:n_head], "text", "n_lines", "n_dropped"])

        return joined.mapInArrow(run, f"{head}, text string, n_lines long, n_dropped long")


def _by_shard(it: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(shard, its table's row or None, the key rows) of rows sorted by shard and kind."""
    for batch in it:
        shard = batch.column(batch.schema.get_field_index("shard")).to_numpy()
        kind = batch.column(batch.schema.get_field_index("kind")).to_numpy()
        cut = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1], [True]])) if len(shard) else []
        for a, z in zip(cut[:-1], cut[1:]):
            tables = int((kind[a:z] == 0).sum())
            first = batch.slice(a, 1).to_pylist()[0] if tables else None
            yield int(shard[a]), first, batch.slice(a + tables, z - a - tables)


def build(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS, made: DataFrame | None = None) -> Index:
    """A new index of the documents, in a folder of its own."""
    empty = Index(docs.sparkSession, scratch_path(docs.sparkSession, "lines"), min_docs=min_docs, min_chars=min_chars)
    return empty.insert(docs, made)


def digest(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> DataFrame:
    made = keep(keys(docs, min_chars), "keys")
    out = build(docs, min_docs, min_chars, made).apply(docs, made=made)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))
