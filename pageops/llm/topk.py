"""Exact top-k inner products by multi-resolution segment statistics.

Vectors become whole numbers, floor(scale * x).  Cut into segments of length L
with means m and deviations s, two vectors' inner product is at most the sum of
L * (m m' + s s') over the segments; that is the lower bound on their distance,
seen from the other side.  Bounds go from one segment to a quarter of the
components; a pair stays only while its bound can still enter the query's k
best, and survivors are computed exactly.

The queries (every ``every``-th id) are a stated set against all rows, in
blocks: groups of ``GROUP`` queries meet slots of up to about ``ROWS``
candidates.  A task streams the candidates of a (group, slot) past its queries
in ascending id, holding one group and k results a query.  A slot's first
``SEED`` candidates are computed exactly, which gives each query a k-th best to
hold bounds against; all others are bounded first.  How many pairs go is up to
the vectors: hardly any of independent random ones, most of clustered ones.

Rows with a null id or vector, or null or non-finite components, take no part;
vectors only meet vectors of their own length.  Rows alike in id and vector
count once; rows with the query's id are never its candidates.  Ties go to the
smaller id.  Products too large for doubles are computed in whole numbers, and
a score beyond a long is cut to its range.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import keep, only

GROUP = 8192
ROWS = 65_536
TASKS = 8            # slots at least, if these have 1,024 candidates each
SEED = 64            # a slot's candidates that are computed without a bound
CHUNK = 1024         # candidates bounded at a time
FEW = 0.25           # share of the pairs up to which survivors are taken one by one
_EXACT = 2.0**53


def _levels(dim: int) -> list[int]:
    """Segment lengths, coarse to fine."""
    out, size = [], dim
    while size >= 4:
        out.append(size)
        size = -(-size // 4)
    return out


def _features(v: np.ndarray, size: int) -> np.ndarray:
    """sqrt(L) * mean and sqrt(L) * deviation of each segment (rows x 2 segments)."""
    cuts = np.arange(0, v.shape[1], size)
    length = np.diff(np.append(cuts, v.shape[1])).astype(np.float64)
    total, square = np.add.reduceat(v, cuts, 1), np.add.reduceat(v * v, cuts, 1)
    spread = np.sqrt(np.maximum(square - total * total / length, 0) * (1 + 1e-12))
    return np.concatenate([total / np.sqrt(length), spread], 1)


class Best:
    """The k best of each query of a group so far."""

    def __init__(self, ids: np.ndarray, v: np.ndarray, k: int) -> None:
        self.ids, self.v, self.k = ids, v, k
        self.score = np.full((len(ids), k), -np.inf)
        self.found = np.full((len(ids), k), -1, dtype=np.int64)
        self.levels = [(s, _features(v, s)) for s in _levels(v.shape[1])] if v.size else []
        self.top = float(np.abs(v).max()) if v.size else 0.0
        #: Pairs computed without a bound, bounded, and computed after that.
        self.seeded = self.bounded = self.survived = 0

    def offer(self, ids: np.ndarray, v: np.ndarray) -> None:
        """Candidates in ascending id, all larger than any offered before."""
        if v.size and self.top * float(np.abs(v).max()) * v.shape[1] >= _EXACT:
            big = np.array([[int(x) for x in row] for row in v.tolist()], dtype=object)
            mine = np.array([[int(x) for x in row] for row in self.v.tolist()], dtype=object)
            self._merge(None, None, None, ids, full=mine.dot(big.T))
            return
        if not self.levels or self.score.dtype == object:
            self.seeded += len(self.ids) * len(ids)
            self._merge(None, None, None, ids, full=self.v @ v.T)
            return
        if not self.seeded:
            self.seeded = len(self.ids) * min(SEED, len(ids))
            self._merge(None, None, None, ids[:SEED], full=self.v @ v[:SEED].T)
            ids, v = ids[SEED:], v[SEED:]
        if len(ids):
            self._bounded(ids, v)

    def _bounded(self, ids: np.ndarray, v: np.ndarray) -> None:
        last = self.score[:, -1]
        keep = np.ones((len(self.ids), len(ids)), dtype=bool)
        self.bounded += keep.size
        q = c = None
        for size, mine in self.levels:
            theirs = _features(v, size)
            if q is None:
                keep &= mine @ theirs.T + 0.01 > last[:, None]
                if np.count_nonzero(keep) <= FEW * keep.size:
                    q, c = np.nonzero(keep)
            else:
                some = self._products(mine, theirs, q, c) + 0.01 > last[q]
                q, c = q[some], c[some]
        if q is None:                    # many survive: one product is cheaper than pairs
            self.survived += int(np.count_nonzero(keep))
            full = np.where(keep, self.v @ v.T, -np.inf)
            q, c = np.nonzero(full > last[:, None])
            self._merge(q, c, full[q, c], ids)
            return
        self.survived += len(q)
        score = self._products(self.v, v, q, c)
        better = score > last[q]
        self._merge(q[better], c[better], score[better], ids)

    @staticmethod
    def _products(a: np.ndarray, b: np.ndarray, q: np.ndarray, c: np.ndarray) -> np.ndarray:
        out = np.empty(len(q))
        for at in range(0, len(q), 1 << 16):
            z = slice(at, at + (1 << 16))
            out[z] = np.einsum("ij,ij->i", a[q[z]], b[c[z]])
        return out

    def _merge(self, q, c, score, ids, full=None) -> None:
        if full is not None:
            full = np.where(self.ids[:, None] == ids[None, :], -np.inf, full)
            rows = range(len(self.ids))
            every = np.arange(len(ids))
        else:
            other = self.ids[q] != ids[c]
            q, c, score = q[other], c[other], score[other]
            rows, first = np.unique(q, return_index=True)
            ends = np.append(first[1:], len(q))
        for n, r in enumerate(rows):
            s, at = (full[r], every) if full is not None else (score[first[n]:ends[n]], c[first[n]:ends[n]])
            both = np.concatenate([self.score[r], s])
            who = np.concatenate([self.found[r], ids[at]])
            if len(both) > 4 * self.k and both.dtype != object:
                cut = np.partition(both, len(both) - self.k)[len(both) - self.k]
                near = both >= cut
                both, who = both[near], who[near]
            if both.dtype == object:
                order = np.array(sorted(range(len(both)), key=lambda i: (-both[i], who[i])))
            else:
                order = np.lexsort((who, -both))
            order = order[:self.k]
            if both.dtype == object and self.score.dtype != object:
                self.score = self.score.astype(object)
            self.score[r], self.found[r] = both[order], who[order]

    def rows(self) -> Iterator[tuple[int, int, int]]:
        low, high = -(2**63), 2**63 - 1
        for r, query in enumerate(self.ids.tolist()):
            for s, who in zip(self.score[r], self.found[r].tolist()):
                if s != -np.inf:
                    yield query, who, max(low, min(high, int(s)))


def _search(k: int):
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, queries, best = None, [], None

        def ended() -> Iterator[pa.RecordBatch]:
            if best is not None:
                rows = list(best.rows())
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows)], schema=schema)

        for batch in it:
            head = np.stack([batch.column(i).to_numpy() for i in range(4)], 1)       # g, slot, dim, kind
            cuts = np.flatnonzero(np.any(head[1:] != head[:-1], 1)) + 1
            ids = batch.column(4).to_numpy()
            for a, z in zip([0, *cuts], [*cuts, len(ids)]):
                now, kind = tuple(head[a, :3]), head[a, 3]
                if now != key:
                    yield from ended()
                    key, queries, best = now, [], None
                part = batch.column(5).slice(a, z - a)
                v = part.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(z - a, int(now[2]))
                if kind == 0:
                    queries.append((ids[a:z], v))
                    continue
                if best is None:
                    if not queries:
                        continue
                    best = Best(np.concatenate([i for i, _ in queries]), np.concatenate([x for _, x in queries]), k)
                for b in range(0, z - a, CHUNK):
                    best.offer(ids[a + b:min(a + b + CHUNK, z)], v[b:b + CHUNK])
        yield from ended()

    return run


def top_k(vectors: DataFrame, every: int = 50, k: int = 5, scale: float = 256.0) -> DataFrame:
    """query_id, rank, vec_id, score of each query's k best."""
    plain = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("double"))
    # floor() of a double beyond a long saturates, so such values are kept as they are.
    wide = F.transform("embedding", lambda x: F.when(F.abs(x.cast("double") * scale) < 2.0**53, F.floor(x.cast("double") * scale).cast("double")).otherwise(x.cast("double") * scale))
    fits = F.forall("embedding", lambda x: F.abs(x.cast("double") * scale) < 2.0**53)
    rows = (only(vectors, "vec_id", "embedding").filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & plain)
            .select(F.col("vec_id").cast("long"), F.when(fits, whole).otherwise(wide).alias("v"))
            .dropDuplicates(["vec_id", "v"]).withColumn("dim", F.size("v").cast("long")))
    rows = keep(rows, "vectors")
    is_query = F.pmod("vec_id", F.lit(every)) == 0
    total, asked = rows.select(F.count("*"), F.count(F.when(is_query, 1))).first()
    groups, slots = max(1, -(-asked // GROUP)), max(1, -(-total // ROWS), min(TASKS, total // 1024))
    queries = (rows.filter(is_query).withColumn("g", F.pmod(F.xxhash64("vec_id"), F.lit(groups)))
               .withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(slots - 1)))).withColumn("kind", F.lit(0)))
    others = (rows.withColumn("slot", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(slots)))
              .withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))).withColumn("kind", F.lit(1)))
    columns = [F.col(c).cast("long").alias(c) for c in ("g", "slot", "dim", "kind", "vec_id")]
    both = queries.select(*columns, "v").unionByName(others.select(*columns, "v"))
    dealt = both.repartition("g", "slot", "dim").sortWithinPartitions("g", "slot", "dim", "kind", "vec_id")
    found = dealt.mapInArrow(_search(k), "query_id long, vec_id long, score long")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.distinct().withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


SQL = """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) as v from embeddings
  where vec_id is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (
  select q.vec_id as query_id, c.vec_id, list_inner_product(q.v, c.v)::bigint as score
  from v q join v c on q.vec_id % 50 = 0 and c.vec_id <> q.vec_id and len(q.v) = len(c.v))
select query_id, rank, vec_id, score from (
  select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from s) where rank <= 5
"""
