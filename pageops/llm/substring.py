"""Substring dedup by seed and extend.

Seeds are winnowed anchors: in every window of ``length`` words the smallest of
its ``seed``-word hashes (leftmost on ties) is the window's anchor, so two equal
windows have equal anchors at the same place.  Consecutive windows with one
anchor form a run: the anchor extended to both sides as far as it is the
smallest.  Documents are joined on anchors.  Runs that agree as a whole match in
all their windows; where runs of one anchor differ, the extension is compared
word by word to either side through the hashes of the windows around the
anchor.  A window is a repeat if it also starts in a document with a smaller
id; touching repeats merge to maximal repeats, at least ``length`` words long.

Only the smallest document of each distinct run stands for it in the second
comparison, so a passage that a third of all documents share costs one row per
document and anchor, and no pairs; its anchors are joined by broadcast, not in
one task.

Null text has no words.  Rows with a null ``doc_id`` neither lose words nor take
any.  Rows that repeat a ``doc_id`` are judged each by its own text and never
against one another.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keep, mix, only, spread_join, texts, word_hashes, words

LENGTH = 50
SEED = 16
IDS_TO_BROADCAST = 1_000_000
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
_SALT = np.uint64(0xD6E8FEB86659FD93)
_POWERS: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base ** 0..n in 64 bits."""
    have = _POWERS.get(base)
    if have is None or len(have) <= n:
        steps = np.full(max(n, 4096) + 1, base, dtype=np.uint64)
        steps[0] = 1
        have = _POWERS[base] = np.cumprod(steps)
    return have[:n + 1]


class Rolling:
    """Hashes of any stretch of a word sequence."""

    def __init__(self, ws: list[bytes]) -> None:
        h = word_hashes(ws)
        self.n = len(h)
        self.sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(h * _power(_BASE, self.n)[:self.n])])

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return mix((self.sums[b] - self.sums[a]) * _power(_INVERSE, self.n)[a])


def _leftmost_min(g: np.ndarray, w: int) -> np.ndarray:
    """Position of the leftmost smallest value of every w consecutive values."""
    at, step = np.arange(len(g)), 1
    while step * 2 <= w:
        a, b = at[:-step], at[step:]
        at = np.where(g[b] < g[a], b, a)
        step *= 2
    rest = w - step
    if rest:
        a, b = at[:-rest], at[rest:]
        at = np.where(g[b] < g[a], b, a)
    return at


def runs(ws: list[bytes], length: int, seed: int) -> tuple[np.ndarray, ...]:
    """(anchor hash, run hash, first window, windows) of a document's runs."""
    r = Rolling(ws)
    starts = np.arange(r.n - seed + 1)
    g = r.of(starts, starts + seed)
    at = _leftmost_min(g, length - seed + 1)
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    count = np.diff(np.concatenate([first, [len(at)]]))
    whole = r.of(first, first + count + (length - 1))
    shape = ((at[first] - first) * 65536 + count).astype(np.uint64)
    return g[at[first]], mix(whole + shape * _SALT), first, count


def _signed(s: np.ndarray) -> pa.Array:
    return pa.array(s.view(np.int64))


def _runs(docs: DataFrame, length: int, seed: int) -> DataFrame:
    frame = docs.filter("doc_id is not null").select("doc_id", "t", "text")

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for at in range(0, batch.num_rows, 1024):
                b = batch.slice(at, 1024)
                took, found = [], []
                for k, t in enumerate(texts(b)):
                    ws = words(t)
                    if len(ws) >= length:
                        found.append(runs(ws, length, seed))
                        took.append((k, len(found[-1][0])))
                if not took:
                    continue
                rows = pa.array(np.repeat([k for k, _ in took], [c for _, c in took]))
                a, r, s, c = (np.concatenate(x) for x in zip(*found))
                yield pa.RecordBatch.from_arrays(
                    [_signed(a), _signed(r), b.column(0).take(rows), b.column(1).take(rows), pa.array(s.astype(np.int32)), pa.array(c.astype(np.int32))],
                    names=["anchor", "run", "doc_id", "t", "s", "c"])

    return frame.mapInArrow(run, "anchor long, run long, doc_id long, t int, s int, c int")


def _windows(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """(anchor, window, doc_id, t, s) of the windows of some runs, from the
    texts again.  Ids are broadcast if counted to be few, and joined otherwise."""
    per = wanted.groupBy("doc_id", "t").agg(F.collect_list(F.struct("anchor", "s", "c")).alias("runs"))
    ids = wanted.select("doc_id").distinct()
    few = F.broadcast(ids) if ids.count() <= IDS_TO_BROADCAST else ids
    frame = docs.select("doc_id", "t", "text").join(few, "doc_id", "left_semi").join(per, ["doc_id", "t"])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for at in range(0, batch.num_rows, 256):
                b = batch.slice(at, 256)
                counts, parts = [], []
                for t, mine in zip(texts(b), b.column(3)):
                    flat = mine.values
                    anchor, s, c = (flat.field(i).to_numpy() for i in range(3))
                    start = np.repeat(s.astype(np.int64), c) + np.arange(c.sum()) - np.repeat(np.cumsum(c) - c, c)
                    r = Rolling(words(t))
                    parts.append((np.repeat(anchor, c), r.of(start, start + length).view(np.int64), start))
                    counts.append(len(start))
                rows = pa.array(np.repeat(np.arange(b.num_rows), counts))
                a, w, s = (np.concatenate(x) for x in zip(*parts))
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(w), b.column(0).take(rows), b.column(1).take(rows), pa.array(s.astype(np.int32))],
                                                 names=["anchor", "w", "doc_id", "t", "s"])

    return frame.mapInArrow(run, "anchor long, w long, doc_id long, t int, s int").distinct()


def repeated_runs(docs: DataFrame, length: int = LENGTH, seed: int = SEED) -> DataFrame:
    """(doc_id, t, s, c): c consecutive windows from word s on, each of which
    also starts in a document with a smaller id.  ``docs`` has t, the text's hash."""
    all_runs = keep(_runs(docs, length, seed), "runs")
    per = all_runs.groupBy("anchor").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), F.count("*").alias("m"))
    shared = keep(per.filter("lo < hi").select("anchor", "m"), "shared")
    met = keep(spread_join(all_runs, shared, ["anchor"], "m", all_runs.count()), "met")
    classes = keep(met.groupBy("anchor", "run").agg(F.min("doc_id").alias("first"), F.count("*").alias("m")), "classes")
    whole = keep(spread_join(met, classes, ["anchor", "run"], "m", met.count()), "whole")
    later = whole.filter("doc_id > first").select("doc_id", "t", "s", "c")
    # Anchors with runs that differ: compare the windows of each run's first document one by one.
    firsts = keep(whole.filter("doc_id = first").select("anchor", "run", "doc_id", "t", "s", "c"), "firsts")
    differ = firsts.groupBy("anchor").agg(F.min("run").alias("r0"), F.max("run").alias("r1"), F.count("*").alias("m")).filter("r0 < r1").select("anchor", "m")
    wanted = keep(spread_join(firsts.drop("run"), keep(differ, "differ"), ["anchor"], "m", firsts.count()), "wanted")
    windows = keep(_windows(docs, wanted, length), "windows")
    lowest = windows.groupBy("anchor", "w").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).filter("lo < hi")
    single = windows.join(lowest, ["anchor", "w"]).filter("doc_id > lo").select("doc_id", "t", "s", F.lit(1).alias("c"))
    return later.unionByName(single)


def dedupe(docs: DataFrame, length: int = LENGTH, seed: int = SEED, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of ``docs``: doc_id, the carried columns, ``text`` (the
    kept words joined by one space), ``n_words``, ``n_removed`` and ``repeats``,
    the maximal repeats as (first word, words)."""
    frame = only(docs, "doc_id", *carry, "text").withColumn("doc_id", F.col("doc_id").cast("long")).withColumn("t", F.hash("text"))
    spans = repeated_runs(frame, length, seed).groupBy("doc_id", "t").agg(F.collect_list(F.struct("s", "c")).alias("spans"))
    joined = frame.join(spans, ["doc_id", "t"], "left").select("doc_id", *carry, "text", "spans")
    n_head = 1 + len(carry)
    head = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in joined.schema[:n_head])
    names = ["doc_id", *carry, "text", "n_words", "n_removed", "repeats"]
    repeat = pa.struct([("first", pa.int64()), ("words", pa.int64())])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for at in range(0, batch.num_rows, 1024):
                b = batch.slice(at, 1024)
                kept, n, gone, where = [], [], [], []
                for t, mine in zip(texts(b), b.column(n_head + 1)):
                    ws = words(t)
                    found: list[dict] = []
                    lost = 0
                    if mine.is_valid:
                        s, c = (mine.values.field(i).to_numpy().astype(np.int64) for i in range(2))
                        step = np.zeros(len(ws) + 1, dtype=np.int64)
                        np.add.at(step, s, 1)
                        np.add.at(step, s + c + (length - 1), -1)
                        stay = np.cumsum(step)[:len(ws)] == 0
                        edge = np.flatnonzero(np.diff(np.concatenate([[True], stay, [True]])))
                        found = [{"first": int(a), "words": int(z - a)} for a, z in zip(edge[::2], edge[1::2])]
                        lost = len(ws) - int(stay.sum())
                        kept.append(b" ".join(compress(ws, stay.tolist())))
                    else:
                        kept.append(b" ".join(ws))
                    n.append(len(ws))
                    gone.append(lost)
                    where.append(found)
                yield pa.RecordBatch.from_arrays(
                    [*b.columns[:n_head], pa.array(kept, pa.binary()).cast(pa.string()), pa.array(n, pa.int64()), pa.array(gone, pa.int64()),
                     pa.array(where, pa.list_(repeat))], names=names)

    return joined.mapInArrow(run, f"{head}, text string, n_words long, n_removed long, repeats array<struct<first: long, words: long>>")


def digest(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    return dedupe(docs, length).select("doc_id", "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))
