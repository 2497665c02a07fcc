"""Periodic runs of words by block convolution.

A run is a stretch of consecutive words with smallest period q, at least
``max(least, 2 * q)`` words long, that no neighbouring word extends.

Periods are searched at dyadic scales.  At block length B (2, 4, 8, ...) a text
is cut into aligned blocks of B words, and the periods in [2B, 4B) are wanted
(below 8 at B = 2).  The words of a run that have their equal q words later
number at least q, hence hold a whole block; so the block occurs again, without
a mismatch, q words later.  Words are numbers (place of their first
occurrence); the sum of squared differences between a block and each stretch of
the window after it is ``sum x^2 + sum y^2 - 2 sum x*y``, the last term by a
number-theoretic transform.  One transform a block serves for all: a window is
two neighbouring blocks, whose transforms add up (with alternating signs).
All arithmetic is exact: as many primes are used as make their product exceed
the largest possible sum, so that a distance is zero if and only if nothing
differs.

Blocks in a row with one distance are a seed.  It is extended to both sides, by
less than B words (the next blocks differ), with rolling hashes.  Of the
stretches with equal ends the smallest period counts: a period that is not the
smallest is a multiple of it and ends at the same words.  What is found is
compared word by word; if a hash was ever wrong, the chunk's seeds are extended
by plain comparison instead.

Null texts have no words.  A text is one row and is searched within it, in
memory proportional to its length; nothing is shuffled.  Rows that repeat are
searched each; extra columns don't matter.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix, only, texts, words

LEAST = 12
#: Primes with large powers of two in p - 1, and a primitive root of each.
PRIMES = ((2013265921, 31), (1811939329, 13), (998244353, 3), (469762049, 3))
CHUNK = 8192         # words whose transforms are made together, unless one text is longer
_BASE = np.uint64(0x9E3779B97F4A7C15)
_S63 = np.uint64(63)

Rewrite = Callable[[int | None, list[bytes]], list[bytes]]


@lru_cache(maxsize=None)
def _roots(size: int, prime: int, root: int, inverse: bool) -> dict[int, np.ndarray]:
    """Per half-length of a butterfly, its powers of the root of unity."""
    w = pow(root, (prime - 1) // size, prime)
    if inverse:
        w = pow(w, prime - 2, prime)
    powers = [1]
    for _ in range(size // 2 - 1):
        powers.append(powers[-1] * w % prime)
    full = np.array(powers, dtype=np.uint64)
    return {half: full[::size // 2 // half] for half in (1 << k for k in range(size.bit_length() - 1))}


@lru_cache(maxsize=None)
def _negated(size: int) -> np.ndarray:
    """Where the frequency -f is, for each frequency f, in bit-reversed order."""
    bits = size.bit_length() - 1
    at = np.arange(size)
    reversed_ = sum(((at >> k) & 1) << (bits - 1 - k) for k in range(bits))
    return reversed_[-reversed_ % size]


def _reduced(x: np.ndarray, p: np.uint64) -> np.ndarray:
    """x mod p of x < 2p, given as x - p in 64 bits."""
    x += (x >> _S63) * p
    return x


def forward(z: np.ndarray, prime: int, root: int) -> np.ndarray:
    """Transform of each column of ``z`` (size, columns), in place, to bit-reversed order."""
    size, columns = z.shape
    p, half, roots = np.uint64(prime), size // 2, _roots(size, prime, root, False)
    while half:
        v = z.reshape(-1, 2, half * columns)
        a, b = v[:, 0], v[:, 1]
        d = (a + p - b) * np.repeat(roots[half], columns)
        v[:, 0] = _reduced(a + b - p, p)
        v[:, 1] = d - d // p * p
        half //= 2
    return z


def backward(z: np.ndarray, prime: int, root: int) -> np.ndarray:
    """The inverse of ``forward`` times the size, in place."""
    size, columns = z.shape
    p, half, roots = np.uint64(prime), 1, _roots(size, prime, root, True)
    while half < size:
        v = z.reshape(-1, 2, half * columns)
        d = v[:, 1] * np.repeat(roots[half], columns)
        d -= d // p * p
        a = v[:, 0]
        v[:, 0], v[:, 1] = _reduced(a + d - p, p), _reduced(a - d, p)
        half *= 2
    return z


def _occurrences(ids: np.ndarray, first: np.ndarray, ends: np.ndarray, block: int) -> tuple[np.ndarray, ...]:
    """(row, block's place, distance) of every block that occurs again at a
    distance of this scale; ``first`` and ``ends`` bound each text."""
    count = -(-(ends - first) // block)
    rows = int(count.sum())
    at = np.repeat(first - (np.cumsum(count) - count) * block, count) + np.arange(rows) * block
    end = np.repeat(ends, count)
    cell = at + np.arange(block)[:, None]
    x = np.where(cell < end, ids[np.minimum(cell, len(ids) - 1)], 0).astype(np.uint64)
    need = int((ends - first).max()) ** 2 * block
    halves = (0, 1, 2, 3) if block == 2 else (2, 3)
    zero: dict[int, np.ndarray] = {}
    bound = 1
    for prime, root in PRIMES:
        p = np.uint64(prime)
        # Blocks past the end are empty; what a window has of the next text is masked below.
        z = np.zeros((2 * block, rows + 5), dtype=np.uint64)
        z[:block, :rows] = x if need < prime else x % p
        squares = z[:block].T.ravel() ** 2
        squares -= squares // p * p
        sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(squares)])
        stretch = sums[block:] - sums[:-block]               # squares of the block-long stretch at each place
        stretch -= stretch // p * p
        stretch *= np.uint64(block)
        stretch -= stretch // p * p
        f = forward(z, prime, root)
        mine = f[_negated(2 * block)][:, :rows]
        own = stretch[:rows * block:block]
        for a in halves:
            window = np.empty((2 * block, rows), dtype=np.uint64)
            one, two = f[:, a:a + rows], f[:, a + 1:a + 1 + rows]
            window[:block] = _reduced(one[:block] + two[:block] - p, p)
            window[block:] = _reduced(one[block:] - two[block:], p)
            window *= mine
            window -= window // p * p
            cross = backward(window, prime, root)[:block]
            there = stretch[a * block:(a + rows) * block].reshape(rows, block).T
            both = _reduced(own + there - p, p)
            zero[a] = (cross == both) & zero.get(a, True)
        bound *= prime
        if bound > need:
            break
    if bound <= need:
        raise ValueError("a text too long for the primes at hand")
    found = []
    for a in halves:
        shift, row = np.nonzero(zero[a])
        q = a * block + shift
        whole = (q > 0) & (at[row] + q + block <= end[row])
        found.append((row[whole], at[row[whole]], q[whole]))
    return tuple(np.concatenate(c) for c in zip(*found))


class _Hashes:
    """Equality of two stretches of numbers through sums in 64 bits."""

    def __init__(self, ids: np.ndarray) -> None:
        steps = np.full(len(ids) + 1, _BASE, dtype=np.uint64)
        steps[0] = 1
        self.powers = np.cumprod(steps)
        self.sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(mix(ids.astype(np.uint64) + np.uint64(1)) * self.powers[:-1])])

    def equal(self, a: np.ndarray, q: np.ndarray, n: np.ndarray) -> np.ndarray:
        s = self.sums
        return (s[a + n] - s[a]) * self.powers[q] == s[a + q + n] - s[a + q]

    def extend(self, at: np.ndarray, q: np.ndarray, limit: np.ndarray, side: int, block: int) -> np.ndarray:
        """How many words on from ``at`` (to the left: before it) equal those q later."""
        n, step = np.zeros(len(at), dtype=np.int64), block
        while step:
            more = np.minimum(n + step, limit)
            n = np.where(self.equal(at if side > 0 else at - more, q, more), more, n)
            step //= 2
        return n


class _Words:
    """The same by plain comparison."""

    def __init__(self, ids: np.ndarray) -> None:
        self.ids = ids

    def extend(self, at: np.ndarray, q: np.ndarray, limit: np.ndarray, side: int, block: int) -> np.ndarray:
        n, live = np.zeros(len(at), dtype=np.int64), np.arange(len(at))
        while len(live):
            live = live[n[live] < limit[live]]
            place = at[live] + n[live] if side > 0 else at[live] - n[live] - 1
            live = live[self.ids[place] == self.ids[place + q[live]]]
            n[live] += 1
        return n


def _search(ids: np.ndarray, bounds: np.ndarray, least: int, compare) -> tuple[np.ndarray, ...]:
    """(start, end, period) of every run, in order of start and period."""
    first, ends = bounds[:-1], bounds[1:]
    found = []
    block = 2
    while True:
        fit = ends - first >= (least if block == 2 else max(least, 4 * block))
        if not fit.any():
            break
        row, at, q = _occurrences(ids, first[fit], ends[fit], block)
        if len(row):
            order = np.argsort(q * (int(row.max()) + 2) + row)
            row, at, q = row[order], at[order], q[order]
            text = np.searchsorted(ends, at, side="right")
            new = np.concatenate([[True], (q[1:] != q[:-1]) | (row[1:] != row[:-1] + 1) | (text[1:] != text[:-1])])
            head = np.flatnonzero(new)
            tail = np.append(head[1:], len(row)) - 1
            a, z, q, text = at[head], at[tail] + block, q[head], text[head]
            z = z + compare.extend(z, q, ends[text] - z - q, 1, block)
            a = a - compare.extend(a, q, a - first[text], -1, block)
            long = z - a + q >= np.maximum(least, 2 * q)
            found.append((a[long], (z + q)[long], q[long]))
        block *= 2
    if not found:
        return tuple(np.zeros(0, dtype=np.int64) for _ in range(3))
    a, z, q = (np.concatenate(c) for c in zip(*found))
    order = np.lexsort((q, z, a))
    a, z, q = a[order], z[order], q[order]
    smallest = np.concatenate([[True], (a[1:] != a[:-1]) | (z[1:] != z[:-1])]) if len(a) else np.zeros(0, dtype=bool)
    a, z, q = a[smallest], z[smallest], q[smallest]
    order = np.lexsort((q, a))
    return a[order], z[order], q[order]


def _right(ids: np.ndarray, bounds: np.ndarray, a: np.ndarray, z: np.ndarray, q: np.ndarray) -> bool:
    """Whether each run holds word by word and no neighbour extends it."""
    for s, e, p in zip(a.tolist(), z.tolist(), q.tolist()):
        text = int(np.searchsorted(bounds, s, side="right")) - 1
        if not np.array_equal(ids[s:e - p], ids[s + p:e]):
            return False
        if (s > bounds[text] and ids[s - 1] == ids[s - 1 + p]) or (e < bounds[text + 1] and ids[e] == ids[e - p]):
            return False
    return True


def runs(texts_words: list[list[bytes]], least: int = LEAST) -> list[np.ndarray]:
    """Per text, its runs as rows (start, length, period) by start, then period."""
    numbers = []
    for ws in texts_words:
        place: dict[bytes, int] = {}
        numbers.append(np.fromiter(map(place.setdefault, ws, range(len(ws))), dtype=np.int64, count=len(ws)))
    out: list[np.ndarray] = []
    k = 0
    while k < len(numbers):
        n, size = k, 0
        while n < len(numbers) and (n == k or size + len(numbers[n]) <= CHUNK):
            size += len(numbers[n])
            n += 1
        ids = np.concatenate(numbers[k:n])
        bounds = np.concatenate([[0], np.cumsum([len(x) for x in numbers[k:n]])]).astype(np.int64)
        a, z, q = _search(ids, bounds, least, _Hashes(ids)) if size else (np.zeros(0, dtype=np.int64),) * 3
        if not _right(ids, bounds, a, z, q):
            a, z, q = _search(ids, bounds, least, _Words(ids))
        at = np.searchsorted(a, bounds)
        for i in range(n - k):
            mine = slice(at[i], at[i + 1])
            out.append(np.stack([a[mine] - bounds[i], z[mine] - a[mine], q[mine]], axis=1))
        k = n
    return out


def collapse(docs: DataFrame, least: int = LEAST, rewrite: Rewrite | None = None) -> DataFrame:
    """Per document: doc_id, ``n_words``, ``runs`` (start, length, period; by
    start, then period) and ``text``, the words left when every run keeps only
    its first period, joined by one space.  ``rewrite`` may replace a document's
    words first.  Null text has no words."""
    frame = only(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    one = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for at in range(0, batch.num_rows, 256):
                b = batch.slice(at, 256)
                ws = [words(t) for t in texts(b)]
                if rewrite is not None:
                    ws = [rewrite(i, w) for i, w in zip(b.column(0).to_pylist(), ws)]
                found = runs(ws, least)
                left = []
                for w, r in zip(ws, found):
                    if len(r):
                        step = np.zeros(len(w) + 1, dtype=np.int64)
                        np.add.at(step, r[:, 0] + r[:, 2], 1)
                        np.add.at(step, r[:, 0] + r[:, 1], -1)
                        w = compress(w, (np.cumsum(step)[:len(w)] == 0).tolist())
                    left.append(b" ".join(w))
                all_runs = np.concatenate(found)
                spans = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], np.cumsum([len(r) for r in found])]).astype(np.int32)),
                    pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(all_runs[:, c])) for c in range(3)], fields=list(one)))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array([len(w) for w in ws], pa.int64()), spans, pa.array(left, pa.binary()).cast(pa.string())],
                    names=["doc_id", "n_words", "runs", "text"])

    return frame.mapInArrow(run, "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, text string")


def digest(docs: DataFrame, least: int = LEAST, rewrite: Rewrite | None = None) -> DataFrame:
    """doc_id, ``n_runs``, the longest run (nulls if none) and two digests:
    ``runs_sha256`` of all runs and ``collapsed_sha256`` of the text left."""
    line = F.array_join(F.transform("runs", lambda r: F.concat(
        r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))), "")
    # The greatest of (length, -start, -period): ties go to the smallest start, then period.
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    out = collapse(docs, least, rewrite).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"),
        F.sha2(line.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("text").cast("binary"), 256).alias("collapsed_sha256"))
    length, period = F.col("best.length"), -F.col("best.period")
    return out.select("doc_id", "n_runs", (-F.col("best.start")).alias("start"), length.alias("length"), period.alias("period"),
                      F.floor(length * 1000 / period).cast("long").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")
