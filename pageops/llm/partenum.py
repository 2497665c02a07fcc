"""N-gram Jaccard join of whole documents by PartEnum signatures.

A document's set holds the hashes of its distinct word ``n``-grams.  Two sets of
sizes a and b reach similarity ``percent`` exactly when their symmetric
difference is at most ``(100 - percent) * (a + b) / (100 + percent)``.  Sizes
fall into bands; in a band with bound k the hash domain is cut into
``ceil((k + 1) / 2)`` parts of ``PIECES`` pieces each.  Some part of a linked
pair then has at most one difference, so all its pieces but one agree: every
subset of all pieces but one of every part is a signature, and a linked pair
shares one.  A set near the upper end of a band is also signed for the next one.

Equal sets are one node.  Every node meets the smallest node of each of its
signatures; nodes of a signature that are in several components then, those
outside the largest, meet all of the other components.  In a signature of more
than ``LARGE`` nodes, nodes meet one typical node, and of other pairs only those
that its distances leave possible and whose nodes are not in one component yet
are made, once each (see ``_large``).  Candidates pass a
parity sketch of a bit per element (its distance never exceeds the difference of the sets, so
no link is lost) and then the exact count: the texts of a pair meet, which are
smaller than the sets, and these are made there.

Null or wordless texts have the empty set: n_shingles 0, linked with nothing.
Rows are judged one by one; rows that repeat a ``doc_id`` are separate rows with
that id.  A component of rows without any ``doc_id`` has a null id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keep, mix, only, release, texts, word_hashes, words
from .components import components

PIECES = 3
LARGE = 16           # nodes of a signature beyond which its group is pruned by distance
IDS_TO_BROADCAST = 1_000_000
CHUNK = 64           # pairs of a node that meet its text in one group
SAMPLE = 1024        # one node of as many is asked for hot signatures
SHARE = 1e-5         # of a sample's signatures, from which one is hot
SALT = 64
_C = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def shingles(text: bytes, n: int) -> np.ndarray:
    """The sorted distinct hashes of the text's word n-grams (A-Z lower-cased);
    the whole sequence is one n-gram if it has fewer than n words."""
    ws = words(text.lower())
    if not ws:
        return np.zeros(0, dtype=np.uint64)
    h = word_hashes(ws)
    m = min(n, len(h))
    total = np.full(len(h) - m + 1, int(_C[3]) * m % 2**64, dtype=np.uint64)
    for k in range(m):
        total = mix(total + h[k:len(h) - m + 1 + k]) * _C[0]
    return np.unique(mix(total))


def bands(size: int, percent: int) -> list[tuple[int, int, int]]:
    """(band, lower bound, k) of the bands that a set of this size is signed in."""
    low, nxt, band = 1, 2, 0
    while nxt <= size:
        low, nxt, band = nxt, max(nxt + 1, -(-3 * nxt // 2)), band + 1
    found = []
    reach = 100 * size // percent          # the largest size that can link
    while low <= reach:
        found.append((band, low, (100 - percent) * 2 * (nxt - 1) // (100 + percent)))
        low, nxt, band = nxt, max(nxt + 1, -(-3 * nxt // 2)), band + 1
    return found


def signatures(x: np.ndarray, percent: int) -> np.ndarray:
    """PartEnum signatures of a sorted set of uniform 64-bit hashes.  Pieces are
    equal ranges of the hash domain, so each is a slice of the sorted set.

    Some more parts than the bound asks for are cut, so that a linked pair
    agrees in more parts than that.  A set with at most as many parts in which a
    signature is of empty pieces leaves these signatures out: it still shares
    one of other pieces with any partner."""
    out = []
    sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(mix(x ^ _C[1]))])
    for band, _, k in bands(len(x), percent):
        if not k:
            continue                       # only equal sets can link
        need = (k + 2) // 2
        spare = -(-need // 12)
        parts = need + spare
        n = parts * PIECES
        cuts = (np.arange(1, n, dtype=np.float64) * (2.0**64 / n)).astype(np.uint64)
        at = np.concatenate([[0], np.searchsorted(x, cuts), [len(x)]])
        size = np.diff(at).reshape(parts, PIECES)
        piece = mix(sums[at[1:]] - sums[at[:-1]] + np.diff(at).astype(np.uint64) * _C[2]).reshape(parts, PIECES)
        tag = (np.arange(parts, dtype=np.uint64) + np.uint64(band << 32)) * _C[0]
        empty = size.sum(1, keepdims=True) == size                 # by the piece left out
        leave_out = int(empty.any(1).sum()) <= spare
        for leave in range(PIECES):
            sig = tag + np.uint64((leave + 1) * int(_C[1]) % 2**64)
            for p in range(PIECES):
                if p != leave:
                    sig = mix(sig + piece[:, p]) * _C[2]
            sig = mix(sig)
            out.append(sig[~empty[:, leave]] if leave_out else sig)
    return np.concatenate(out) if out else np.zeros(0, dtype=np.uint64)


def sketch(x: np.ndarray) -> bytes:
    """One parity bit for each of as many classes (a power of two) as elements."""
    bits = max(64, 1 << (len(x) - 1).bit_length()) if len(x) else 64
    odd = np.bincount((x & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def apart(a: bytes, b: bytes) -> int:
    """A lower bound of the difference of two sets, off their sketches; the
    longer one is folded to the length of the other."""
    short, long = sorted((a, b), key=len)
    v, size = int.from_bytes(long, "little"), 8 * len(long)
    while size > 8 * len(short):
        size //= 2
        v = (v ^ (v >> size)) & ((1 << size) - 1)
    return (v ^ int.from_bytes(short, "little")).bit_count()


def _frame(docs: DataFrame) -> DataFrame:
    return only(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))


def _ids_are_keys(frame: DataFrame) -> bool:
    rows, ids = frame.select(F.count("*"), F.countDistinct("doc_id")).first()
    return rows == ids


def _keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, text, node): doc_id itself where it is a key.  Where it is null
    or repeats, a written copy with row numbers takes the table's place."""
    frame = _frame(docs)
    if _ids_are_keys(frame):
        return frame.withColumn("node", F.col("doc_id"))
    return keep(frame.withColumn("node", F.monotonically_increasing_id()), "keyed")


def _without(frame: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    """``frame`` less (left_anti) or only with (left_semi) the nodes in ``keys``,
    which are broadcast if counted to be few, and joined otherwise."""
    return frame.join(F.broadcast(keys) if keys.count() <= IDS_TO_BROADCAST else keys, "node", how)


def _heads(docs: DataFrame, n: int) -> DataFrame:
    """Per row: node, doc_id, n, two set hashes and the sketch."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for at in range(0, batch.num_rows, 1024):
                b = batch.slice(at, 1024)
                size, head, drawn = [], [], []
                for t in texts(b):
                    x = shingles(t, n)
                    size.append(len(x))
                    head.append((mix(x).sum(dtype=np.uint64), mix(x ^ _C[2]).sum(dtype=np.uint64)))
                    drawn.append(sketch(x))
                heads = np.array(head, dtype=np.uint64).reshape(-1, 2).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [*b.columns[:2], pa.array(size, pa.int64()), pa.array(heads[:, 0]), pa.array(heads[:, 1]), pa.array(drawn, pa.binary())],
                    names=["node", "doc_id", "n", "h1", "h2", "sketch"])

    return docs.select("node", "doc_id", "text").mapInArrow(run, "node long, doc_id long, n long, h1 long, h2 long, sketch binary")


def _signatures(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """(node, sig) of every row.  48 bits of a signature are told: unrelated sets
    that agree in them by chance are candidates more, no links."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for at in range(0, batch.num_rows, 256):
                b = batch.slice(at, 256)
                sigs = [(signatures(shingles(t, n), percent) >> np.uint64(16)).view(np.int64) for t in texts(b)]
                nodes = b.column(0).take(pa.array(np.repeat(np.arange(len(sigs)), [len(s) for s in sigs])))
                yield pa.RecordBatch.from_arrays([nodes, pa.array(np.concatenate(sigs))], names=["node", "sig"])

    return docs.select("node", "text").mapInArrow(run, "node long, sig long")


def _verify(docs: DataFrame, nodes: DataFrame, pairs: DataFrame, n: int, percent: int) -> DataFrame:
    """Those of ``pairs`` (a < b: nodes) that link."""
    def side(s: str) -> DataFrame:
        return nodes.select(*[F.col(c).alias(f"{c}_{s}") for c in ("node", "n", "sketch")])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            both, a, b = (batch.column(i).to_pylist() for i in (2, 3, 4))
            fits = [apart(x, y) * (100 + percent) <= m * (100 - percent) for m, x, y in zip(both, a, b)]
            yield batch.select(["a", "b"]).filter(pa.array(fits, pa.bool_()))

    sized = (pairs.join(side("a"), F.col("a") == F.col("node_a")).join(side("b"), F.col("b") == F.col("node_b"))
             .filter(F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent)
             .select("a", "b", (F.col("n_a") + F.col("n_b")).alias("m"), "sketch_a", "sketch_b"))
    near = keep(sized.mapInArrow(run, "a long, b long"), "near")
    if near.isEmpty():
        return near
    return keep(_count(docs, near, n).filter(F.col("same") * 100 >= (F.col("both") - F.col("same")) * percent).select("a", "b"), "links")


def _count(docs: DataFrame, near: DataFrame, n: int) -> DataFrame:
    """(a, b, both, same) of the pairs ``near``: the sum of the sizes of their
    sets, read again from their texts, and how many elements they share.
    Texts go where a is; its own goes to each chunk of its pairs, first."""
    many = near.groupBy("a").agg(F.ceil(F.count("*") / CHUNK).cast("long").alias("chunks"))
    dealt = near.join(many, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("chunks")).alias("chunk"))
    asked = keep(dealt.select("a", "chunk", F.col("b").alias("node")).unionByName(dealt.select("a", "chunk", F.col("a").alias("node")).distinct()), "asked")
    few = F.broadcast(asked) if 3 * asked.count() <= IDS_TO_BROADCAST else asked
    met = docs.select("node", "text").join(few, "node").select("a", "chunk", (F.col("a") != F.col("node")).alias("other"), "node", "text")

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x = np.zeros(0, dtype=np.uint64)
        for batch in it:
            for at in range(0, batch.num_rows, 256):
                rows, met, both, same = batch.slice(at, 256), [], [], []
                for other, t in zip(rows.column(2).to_pylist(), texts(rows)):
                    y = shingles(t, n)
                    if not other:
                        x = y
                    met.append(other)
                    both.append(len(x) + len(y))
                    same.append(len(np.intersect1d(x, y, assume_unique=True)) if other else 0)
                out = [rows.column(0), rows.column(3), pa.array(both, pa.int64()), pa.array(same, pa.int64())]
                yield pa.RecordBatch.from_arrays(out, names=["a", "b", "both", "same"]).filter(pa.array(met, pa.bool_()))

    return met.repartition("a", "chunk").sortWithinPartitions("a", "chunk", "other").mapInArrow(run, "a long, b long, both long, same long")


def _lone(docs: DataFrame, nodes: DataFrame, n: int, half: int) -> DataFrame:
    """(node, more): how many n-grams of one half of the hash domain a node of
    ``nodes`` has that no other has; less those that agree in 40 bits by chance."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for at in range(0, batch.num_rows, 256):
                b = batch.slice(at, 256)
                sets = [shingles(t, n) for t in texts(b)]
                sets = [(x[(x & np.uint64(1)) == half] >> np.uint64(24)).view(np.int64) for x in sets]
                of = b.column(0).take(pa.array(np.repeat(np.arange(len(sets)), [len(x) for x in sets])))
                yield pa.RecordBatch.from_arrays([of, pa.array(np.concatenate(sets))], names=["node", "x"])

    every = _without(docs.select("node", "text"), nodes.select("node"), "left_semi").mapInArrow(run, "node long, x long")
    own = every.groupBy("x").agg(F.min("node").alias("node"), F.count("*").alias("m")).filter("m = 1")
    return own.groupBy("node").agg(F.count("*").alias("more"))


def _large(docs: DataFrame, nodes: DataFrame, large: DataFrame, n: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """(links, candidate pairs) of the large groups (sig, node): the pairs are
    all that can link besides the links.

    u counts the n-grams of a node that no other node of these groups has.  A
    node with more of them than a link lets it lack is left out, where half of
    them show it before the others are counted.  The rest meet
    their group's most typical node c (fewest u), at distance d.  The
    differences of x and y to c share at most d - u of either, so x and y are at
    least max(d_x - e_y, d_y - e_x) apart, with e = d - 2u: pairs for which that
    is beyond the bound are never made."""
    plus, minus = 100 + percent, 100 - percent
    may_lack = F.col("n") - F.floor((F.col("n") * percent + 99) / 100)
    live = keep(nodes.select("node", "n").join(large.select("node").distinct(), "node").withColumn("u", F.lit(0).cast("long")), "live")
    for half in (0, 1):
        more = live.join(_lone(docs, live, n, half), "node", "left")
        live = keep(more.select("node", "n", (F.col("u") + F.coalesce("more", F.lit(0))).alias("u")).filter(F.col("u") <= may_lack), "live")
        release(docs.sparkSession)
    large = keep(large.join(live, "node"), "large")
    best = large.groupBy("sig").agg(F.min(F.struct("u", "node")).alias("best"))
    placed = keep(large.join(best.select("sig", F.col("best.node").alias("c")), "sig"), "placed")
    held = placed.select("c", "node", "n", "u").distinct()
    top = held.groupBy("c").agg(F.max("n").alias("top"))
    around = keep(held.filter("c <> node").select(F.col("c").alias("a"), F.col("node").alias("b")), "around")
    met = keep(_count(docs, around, n).select(F.col("a").alias("c"), F.col("b").alias("node"), (F.col("both") - 2 * F.col("same")).alias("d"), "both")
               .join(live, "node"), "met")
    linked = F.col("d") * plus <= F.col("both") * minus
    links = keep(met.filter(linked).select(F.least("c", "node").alias("a"), F.greatest("c", "node").alias("b")), "known")
    # Of a node: its component so far, its signatures and its centres.
    known = placed.groupBy("node").agg(F.collect_set("sig").alias("sigs"), F.collect_set("c").alias("centres"))
    known = known.join(components(links), "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    far = met.join(top, "c").select("c", "node", linked.alias("linked"), ((F.col("d") - 2 * F.col("u")) * plus).alias("e"),
                                    (F.col("d") * plus - (F.col("n") + F.col("top")) * minus).alias("r"))
    # Less the nodes that not even the nearest node outside can link with.
    least = far.filter("not linked").groupBy("c").agg(F.min("r").alias("r_least"))
    far = keep(far.join(least, "c").filter("not linked or e >= r_least").drop("r_least").join(known, "node"), "far")
    outside = far.filter("not linked").select("c", *[F.col(x).alias(f"{x}_p") for x in ("node", "e", "r", "comp", "sigs", "centres")])
    # A pair is made once: at the smallest centre that both have.
    fits = (F.expr("(linked or node < node_p) and node <> node_p and comp <> comp_p and e >= r_p and e_p >= r")
            & F.arrays_overlap("sigs", "sigs_p") & (F.col("c") == F.array_min(F.array_intersect("centres", "centres_p"))))
    pairs = far.join(outside, "c").filter(fits)
    return links, pairs.select(F.least("node", "node_p").alias("a"), F.greatest("node", "node_p").alias("b")).distinct()


def _hot(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """Signatures that a share of a sample of the nodes has, at most 1 / SHARE of
    them: their groups are too large for one task."""
    sample = docs.filter(F.pmod(F.xxhash64("node"), F.lit(SAMPLE)) == 0)
    found = keep(_signatures(sample, n, percent).groupBy("sig").agg(F.count("*").alias("m")), "sampled")
    every = found.agg(F.sum("m")).first()[0] or 0
    return found.filter(F.col("m") >= max(LARGE, every * SHARE)).select("sig", F.lit(True).alias("hot"))


def _groups(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """(sig, node, m, c) of the signatures that m > 1 nodes have, c the smallest of
    them (of up to LARGE; else any).  Signatures are
    more than the text, so they are made and shuffled once: rows of a signature
    meet sorted, and those that are alone go no further.  Hot signatures are
    dealt over several tasks; they are large in any case (m is LARGE + 1)."""
    hot = F.broadcast(_hot(docs, n, percent))
    own = _signatures(docs, n, percent).join(hot, "sig", "left")
    dealt = own.select("sig", "node", F.when(F.col("hot"), F.pmod(F.xxhash64("node"), F.lit(SALT)) + 1).otherwise(0).cast("int").alias("salt"))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["sig", "node", "m", "c"]

        def told(sig: np.ndarray, node: np.ndarray, salt: np.ndarray) -> pa.RecordBatch:
            first = np.flatnonzero(np.concatenate([[True], (sig[1:] != sig[:-1]) | (salt[1:] != salt[:-1])]))
            m = np.diff(np.concatenate([first, [len(sig)]]))
            each = np.where(salt > 0, LARGE + 1, np.repeat(m, m))
            least = np.repeat(np.minimum.reduceat(node, first), m)
            some = each > 1
            return pa.RecordBatch.from_arrays([pa.array(v[some]) for v in (sig, node, each, least)], names=names)

        held = [np.zeros(0, dtype=t) for t in (np.int64, np.int64, np.int32)]
        for batch in it:
            rows = [np.concatenate([h, batch.column(i).to_numpy()]) for i, h in enumerate(held)]
            sig, _, salt = rows
            if not len(sig):
                continue
            # The last group may go on in the next batch; a hot one needn't wait.
            last = len(sig) if salt[-1] else int(np.searchsorted(sig, sig[-1]))
            held = [r[last:] for r in rows]
            if last:
                yield told(*(r[:last] for r in rows))
        if len(held[0]):
            yield told(*held)

    return dealt.repartition("sig", "salt").sortWithinPartitions("sig", "salt").mapInArrow(run, "sig long, node long, m long, c long")


def _components(docs: DataFrame, n: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Of a keyed table: the head of every row, and of every distinct set that
    isn't empty (h1, h2, n) its smallest doc_id ``low`` and component ``comp``."""
    heads = keep(_heads(docs, n), "heads")
    classes = keep(heads.filter("n > 0").groupBy("h1", "h2", "n").agg(F.min("node").alias("node"), F.min("doc_id").alias("low")), "classes")
    copies = keep(heads.join(classes.select("node"), "node", "left_anti").select("node"), "copies")     # and empty sets
    slim = heads.join(classes.select("node"), "node", "left_semi")
    groups = keep(_groups(_without(docs, copies, "left_anti"), n, percent), "groups")
    release(docs.sparkSession)

    small = groups.filter(F.col("m") <= LARGE)
    met = keep(small.filter("c <> node").select("c", "node").distinct(), "met")
    first = met.select(F.col("c").alias("a"), F.col("node").alias("b"))
    large = groups.filter(F.col("m") > LARGE).select("sig", "node")
    known = first.limit(0)
    if not large.isEmpty():
        known, more = _large(docs, slim, large, n, percent)
        first = first.unionByName(more)
    links = keep(_verify(docs, slim, first.distinct(), n, percent).unionByName(known).distinct(), "links")
    release(docs.sparkSession)
    comps = keep(components(links), "components")
    # Small groups in several components, which some pair of theirs shows: the
    # nodes outside the largest one meet all nodes of other components.
    of_c = comps.select(F.col("node").alias("c"), F.col("comp").alias("comp_c"))
    parted = keep(met.join(comps, "node", "left").join(of_c, "c", "left")
                  .filter(F.coalesce("comp", "node") != F.coalesce("comp_c", "c")).select("c", "node"), "parted")
    few = F.broadcast(parted) if 2 * parted.count() <= IDS_TO_BROADCAST else parted
    sigs = keep(small.join(few, ["c", "node"], "left_semi").select("sig").distinct(), "several")
    few = F.broadcast(sigs) if sigs.count() <= IDS_TO_BROADCAST else sigs
    left = small.select("sig", "node").join(few, "sig", "left_semi").join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    by_comp = left.groupBy("sig", "comp").agg(F.count("*").alias("m"))
    per = (by_comp.groupBy("sig").agg(F.max(F.struct("m", "comp")).alias("top"), F.sum("m").alias("all"))
           .filter(F.col("all") > F.col("top.m")).select("sig", F.col("top.comp").alias("main")))
    left = keep(left.join(per, "sig"), "left")
    outside = left.filter("comp <> main").select("sig", F.col("node").alias("p"), F.col("comp").alias("q"))
    second = left.join(outside, "sig").filter("comp <> q").select(F.least("node", "p").alias("a"), F.greatest("node", "p").alias("b")).distinct()
    more = _verify(docs, slim, second, n, percent)
    if not more.isEmpty():
        comps = keep(components(links.unionByName(more)), "components")
    return heads, classes.join(comps, "node", "left").select("h1", "h2", "n", "low", F.coalesce("comp", "node").alias("comp"))


def _named(heads: DataFrame, ends: DataFrame) -> DataFrame:
    """(doc_id, n, component) of the rows with sets that aren't empty."""
    lows = ends.groupBy("comp").agg(F.min("low").alias("component"))
    found = ends.join(lows, "comp").select("h1", "h2", "n", "component")
    return heads.select("doc_id", "n", "h1", "h2").filter("n > 0").join(found, ["h1", "h2", "n"]).select("doc_id", "n", "component")


def jaccard_components(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles and component_id of every row of ``docs``."""
    heads, ends = _components(_keyed(docs), n, percent)
    alone = heads.filter("n = 0").select("doc_id", "n", F.col("doc_id").alias("component"))
    return (_named(heads, ends).unionByName(alone)
            .select("doc_id", F.col("n").alias("n_shingles"), F.col("component").alias("component_id")))


def drop_near_copies(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with exactly one row of each component: that with the smallest
    doc_id (null comes last), of several such the one with the smallest hash.
    Rows with the empty set all stay."""
    if _ids_are_keys(_frame(docs)):
        table, key = docs, "doc_id"
        heads, ends = _components(_frame(docs).withColumn("node", F.col("doc_id")), n, percent)
        gone = _named(heads, ends).filter("doc_id <> component").select("doc_id")
    else:                                          # a written copy with row numbers takes the table's place
        key = "__row"
        table = keep(docs.withColumns({key: F.monotonically_increasing_id(), "__tie": F.xxhash64(*docs.columns)}), "keyed")
        heads, ends = _components(table.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col(key).alias("node")), n, percent)
        of = (heads.filter("n > 0").select(F.col("node").alias(key), "n", "h1", "h2")
              .join(ends.select("h1", "h2", "n", "comp"), ["h1", "h2", "n"]).select(key, F.col("comp").alias("__comp")))
        place = F.struct(F.col("doc_id").isNull(), "doc_id", "__tie", key).alias("__place")
        of = keep(table.select(key, place).join(of, key), "members")
        first = of.groupBy("__comp").agg(F.min("__place").alias("__first"))
        gone = of.join(first, "__comp").filter(F.col(key) != F.col(f"__first.{key}")).select(key)
    gone = keep(gone, "duplicates")
    few = F.broadcast(gone) if gone.count() <= IDS_TO_BROADCAST else gone
    return table.join(few, key, "left_anti").select(*docs.columns)
