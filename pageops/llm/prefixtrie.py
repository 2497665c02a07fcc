"""Prefix trie of conversations that are rebuilt from a base's head and their
own suffix, by composable fingerprints.

A sequence of turns has the fingerprint (length, value) of a monoid: a turn is
(1, t), and ``(m, x) * (n, y) = (m + n, x * R**n + y)`` modulo a prime.  Values
of a conversation's own prefixes are made once, where its turns lie; the value
of a rebuilt prefix is the product of the head's value and the suffix's, and
the suffix's follows from two own prefixes, so no rebuilt text is ever made.
A conversation that several tasks hold parts of is put together by the same
product of its parts.

Turns are told apart by 128 hashed bits; that turns with equal bits have equal
role and text is verified on the stored turns, and of each node (equal depth
and value) that all members refer to equal last turns, which by induction over
the depth makes their whole prefixes equal.  If either is violated, all is done
again with other constants.

Subtree sums need no walk over the trie.  A node belongs to its smallest member;
along a conversation's path the nodes that belong to it are the deepest ones.
So the sum over the subtree of a node is the sum of its owner's nodes from there
down, plus, for each other member, the sum of all nodes which belong to that one.

Turns are ordered by turn (null first), then role, then the text's md5.  Null
roles and texts are empty; rows without a ``conv_id`` are left out; repeated
rows are turns of their own.  An empty table has no nodes.  A conversation or a
prefix may hold any share of the rows: turns are dealt out by range, members are
aggregated before they are shuffled, and running sums go by stretches of depth.
The identifiers of the conversations that end in one node make one digest, which
can only be computed in order: pieces are joined in parallel, one task a node
reads the pieces as a stream.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from itertools import accumulate, count

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageops.operators.scan import running

from .common import WORD, batches, keep, only

PRIME = 2**127 - 1
STRETCH = 4096       # rows of one conversation that a join or a window holds together
HOT = 1000           # parents with a thousandth of all nodes as children, at most as many, are broadcast
PIECE = 512          # identifiers in a piece
MASK = 2**64 - 1
MAX_HEAD = 3


def base_of(conv_id: Column) -> Column:
    return conv_id - conv_id % 20


def head_of(conv_id: Column) -> Column:
    return F.crc32(conv_id.cast("string")) % 4


class Monoid:
    """Values of sequences; ``seed`` chooses the base."""

    def __init__(self, seed: int) -> None:
        self.base = int.from_bytes(hashlib.blake2b(f"turns {seed}".encode(), digest_size=16).digest(), "big") % PRIME
        self.back = pow(self.base, PRIME - 2, PRIME)
        self.powers = list(accumulate(range(1023), lambda x, _: x * self.base % PRIME, initial=1))

    def power(self, n: int) -> int:
        return self.powers[n] if n < len(self.powers) else pow(self.base, n, PRIME)

    def times(self, x: int, n: int, y: int) -> int:
        """(any, x) * (n, y)"""
        return (x * self.power(n) + y) % PRIME

    def of(self, turns: list[int]) -> int:
        x = 0
        for t in turns:
            x = (x * self.base + t) % PRIME
        return x

    def without_last(self, x: int, t: int) -> int:
        return (x - t) * self.back % PRIME


def _turn(t1: int, t2: int) -> int:
    return ((t1 & MASK) << 64 | t2 & MASK) % PRIME


def _pack(x: int) -> bytes:
    return x.to_bytes(16, "big")


def _unpack(b: bytes) -> int:
    return int.from_bytes(b, "big")


def _rows(it: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in it:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def _hashes(seed: int) -> list[Column]:
    return [F.xxhash64(F.lit(2 * seed + k), "role", "text").alias(f"t{k + 1}") for k in range(2)]


def _same_turns(source: DataFrame, seed: int) -> bool:
    """Whether turns with equal hashes are equal."""
    per = source.select(*_hashes(seed), F.struct("role", "text").alias("turn")).groupBy("t1", "t2").agg(F.min("turn").alias("a"), F.max("turn").alias("b"))
    return per.filter("a <> b").isEmpty()


_LOCAL = pa.schema([("conv_id", pa.int64()), ("part", pa.int32()), ("at", pa.int64()), ("value", pa.binary()), ("t1", pa.int64()), ("t2", pa.int64()), ("words", pa.int64())])
_PARTS = pa.schema([("conv_id", pa.int64()), ("part", pa.int32()), ("n", pa.int64()), ("first", pa.int64()), ("before", pa.binary())])
_JOINED = pa.schema([("conv_id", pa.int64()), ("part", pa.int32()), ("first", pa.int64()), ("before", pa.binary()), ("head", pa.int64()), ("shift", pa.int64()), ("size", pa.int64()), ("change", pa.binary())])
_MEMBERS = pa.schema([("conv", pa.int64()), ("depth", pa.int64()), ("value", pa.binary()), ("parent", pa.binary()), ("t1", pa.int64()), ("t2", pa.int64()), ("words", pa.int64()), ("ends", pa.bool_())])
_PIECES = pa.schema([("depth", pa.int64()), ("value", pa.binary()), ("first", pa.int64()), ("ids", pa.string())])
_DIGESTS = pa.schema([("depth", pa.int64()), ("value", pa.binary()), ("ends_sha256", pa.string())])


def _ddl(schema: pa.Schema) -> str:
    names = {"int64": "long", "int32": "int", "bool": "boolean"}
    return ", ".join(f"{f.name} {names.get(str(f.type), f.type)}" for f in schema)


def _through(df: DataFrame, rows: Callable[[Iterator[tuple]], Iterator[tuple]], schema: pa.Schema) -> DataFrame:
    return df.mapInArrow(lambda it: batches(rows(_rows(it)), schema), _ddl(schema))


def own_prefixes(source: DataFrame, seed: int) -> DataFrame:
    """conv_id, part (of the table, in order), at (place of the turn in that part
    of its conversation), value (of the part's turns up to it), t1, t2, words."""
    m = Monoid(seed)
    narrow = source.select("conv_id", "turn", "role", F.md5("text").alias("md5"), *_hashes(seed), F.regexp_count("text", F.lit(WORD)).cast("long").alias("words"))
    order = ["conv_id", "turn", "role", "md5"]
    dealt = narrow.repartitionByRange(*order).sortWithinPartitions(*order, "t1", "t2")

    def rows(it: Iterator[tuple]) -> Iterator[tuple]:
        held = None
        at = x = 0
        for c, part, t1, t2, words in it:
            at, x = (at + 1, x) if c == held else (0, 0)
            held, x = c, m.times(x, 1, _turn(t1, t2))
            yield c, part, at, _pack(x), t1, t2, words

    return _through(dealt.select("conv_id", F.spark_partition_id().alias("part"), "t1", "t2", "words"), rows, _LOCAL)


def _parts(turns: DataFrame, seed: int) -> DataFrame:
    """Per part of a conversation its turns ``n``, the place of its first one and
    the value of what goes before.  Only conversations at the ends of a range
    have several parts."""
    m = Monoid(seed)
    per = turns.groupBy("conv_id", "part").agg(F.count("*").alias("n"), F.max_by("value", "at").alias("value"))

    def rows(it: Iterator[tuple]) -> Iterator[tuple]:
        held = None
        first = x = 0
        for c, part, n, value in it:
            if c != held:
                held, first, x = c, 0, 0
            yield c, part, n, first, _pack(x)
            first, x = first + n, m.times(x, n, _unpack(value))

    return _through(per.repartition("conv_id").sortWithinPartitions("conv_id", "part"), rows, _PARTS)


def members(source: DataFrame, seed: int, base: Callable[[Column], Column], head: Callable[[Column], Column], max_head: int) -> DataFrame:
    """One row per rebuilt conversation and depth: the value of the prefix and of
    its parent, the last turn's hashes and words, and whether the conversation
    ends there."""
    m = Monoid(seed)
    turns = keep(own_prefixes(source, seed), "turns")
    parts = keep(_parts(turns, seed), "parts")
    early = turns.filter(F.col("at") < max_head).join(parts.filter(F.col("first") < max_head).select("conv_id", "part", "first"), ["conv_id", "part"])
    heads = (early.withColumn("place", F.col("first") + F.col("at")).filter(F.col("place") < max_head)
             .groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("place", "t1", "t2", "words"))).alias("turns")))
    convs = parts.groupBy("conv_id").agg(F.sum("n").alias("n")).select("conv_id", "n", head(F.col("conv_id")).cast("long").alias("head"), base(F.col("conv_id")).cast("long").alias("base"))
    convs = keep(convs.join(heads.withColumnRenamed("turns", "own"), "conv_id")
                 .join(heads.select(F.col("conv_id").alias("base"), F.col("turns").alias("theirs")), "base", "left")
                 .select("conv_id", "n", "head", "own", F.coalesce("theirs", F.array().cast(heads.schema["turns"].dataType)).alias("theirs")), "conversations")

    def joined(it: Iterator[tuple]) -> Iterator[tuple]:
        for c, part, first, before, n, h, own, theirs in it:
            taken = [_turn(t["t1"], t["t2"]) for t in theirs[:h]]
            left = [_turn(t["t1"], t["t2"]) for t in own[:h]]
            yield c, part, first, before, h, len(taken), len(taken) + max(0, n - h), _pack((m.of(taken) - m.of(left)) % PRIME)

    def suffixes(it: Iterator[tuple]) -> Iterator[tuple]:
        for c, at, value, t1, t2, words, first, before, h, shift, size, change in it:
            place = first + at
            if place < h:
                continue
            own = m.times(_unpack(before), at + 1, _unpack(value))
            x = (own + _unpack(change) * m.power(place - h + 1)) % PRIME
            depth = shift + place - h + 1
            yield c, depth, _pack(x), _pack(m.without_last(x, _turn(t1, t2))), t1, t2, words, depth == size

    def starts(it: Iterator[tuple]) -> Iterator[tuple]:
        for c, n, h, theirs in it:
            size = min(h, len(theirs)) + max(0, n - h)
            x = 0
            yield c, 0, _pack(x), None, 0, 0, 0, size == 0
            for depth, t in enumerate(theirs[:h], 1):
                y = m.times(x, 1, _turn(t["t1"], t["t2"]))
                yield c, depth, _pack(y), _pack(x), t["t1"], t["t2"], t["words"], depth == size
                x = y

    constants = _through(parts.drop("n").join(convs, "conv_id").select("conv_id", "part", "first", "before", "n", "head", "own", "theirs"), joined, _JOINED)
    rest = turns.join(constants, ["conv_id", "part"]).select("conv_id", "at", "value", "t1", "t2", "words", "first", "before", "head", "shift", "size", "change")
    return _through(rest, suffixes, _MEMBERS).unionByName(_through(convs.select("conv_id", "n", "head", "theirs"), starts, _MEMBERS))


def _digests(ends: DataFrame) -> DataFrame:
    """SHA-256 of each node's ascending, comma-joined conversations."""
    def pieces(it: Iterator[tuple]) -> Iterator[tuple]:
        held, ids = None, []
        for depth, value, c in it:
            if ids and (held != (depth, value) or len(ids) == PIECE):
                yield *held, ids[0], ",".join(map(str, ids))
                ids = []
            held = depth, value
            ids.append(c)
        if ids:
            yield *held, ids[0], ",".join(map(str, ids))

    def digests(it: Iterator[tuple]) -> Iterator[tuple]:
        held, sha = None, None
        for depth, value, _, ids in it:
            if held != (depth, value):
                if held is not None:
                    yield *held, sha.hexdigest()
                held, sha = (depth, value), hashlib.sha256(ids.encode())
            else:
                sha.update(b"," + ids.encode())
        if held is not None:
            yield *held, sha.hexdigest()

    dealt = ends.select("depth", "value", "conv").repartitionByRange("depth", "value", "conv").sortWithinPartitions("depth", "value", "conv")
    joined = _through(dealt, pieces, _PIECES)
    return _through(joined.repartition("depth", "value").sortWithinPartitions("depth", "value", "first"), digests, _DIGESTS)


def _parents(nodes: DataFrame) -> DataFrame:
    """conv_id, depth, parent_conv_id of the first node that belongs to each
    conversation (the parents of its others belong to itself)."""
    first = nodes.groupBy("conv_id").agg(F.min("depth").alias("depth"), F.min_by("parent", "depth").alias("parent")).filter("depth > 0")
    first = first.select("conv_id", "depth", (F.col("depth") - 1).alias("up"), F.col("parent").alias("up_value"))
    owner = nodes.select(F.col("depth").alias("up"), F.col("value").alias("up_value"), F.col("conv_id").alias("parent_conv_id"), "n_children")
    # The children number one less than the nodes, so at most HOT parents have a share of 1 in HOT.
    hot = owner.filter(F.col("n_children") >= max(1.0, nodes.count() / HOT)).select("up", "up_value", "parent_conv_id")
    met = first.join(F.broadcast(hot), ["up", "up_value"], "left")
    rest = met.filter("parent_conv_id is null").drop("parent_conv_id").join(owner.drop("n_children"), ["up", "up_value"])
    return met.filter("parent_conv_id is not null").select("conv_id", "depth", "parent_conv_id").unionByName(rest.select("conv_id", "depth", "parent_conv_id"))


def trie(conversations: DataFrame, base: Callable[[Column], Column] = base_of, head: Callable[[Column], Column] = head_of, max_head: int = MAX_HEAD) -> DataFrame:
    """One row per node: conv_id (smallest member), depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens, ends_sha256 and the prefix's
    ``value``.  ``head`` is at most ``max_head``."""
    source = only(conversations, "conv_id", "turn", "role", "text").filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    for seed in count():
        if not _same_turns(source, seed):
            continue
        rows = keep(members(source, seed, base, head, max_head), "members")
        found = keep(rows.groupBy("depth", "value").agg(
            F.min("conv").alias("conv_id"), F.count("*").alias("n_convs"), F.min("parent").alias("parent"), F.max("words").alias("words"),
            F.min(F.struct("t1", "t2", "parent")).alias("one"), F.max(F.struct("t1", "t2", "parent")).alias("other")), "nodes")
        if found.filter("one <> other").isEmpty():
            break
    children = found.filter("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("parent").alias("value")).agg(F.count("*").alias("n_children"))
    nodes = keep(found.join(children, ["depth", "value"], "left").select(
        "depth", "value", "parent", "conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("saved"), F.col("n_children").isNull().cast("long").alias("leaf"), (-F.col("depth")).alias("height")), "trie")
    own = running(nodes, "conv_id", ["height"], {"own_saved": ("sum", F.col("saved")), "own_leaves": ("sum", F.col("leaf"))},
                  inclusive=True, bucket=F.floor(F.col("height") / STRETCH))
    # What belongs to a conversation counts for the nodes above that it is a member of.
    stretch = F.floor(F.col("depth") / STRETCH).cast("long")
    total = (nodes.groupBy("conv_id").agg(F.min("depth").alias("from"), F.sum("saved").alias("saved"), F.sum("leaf").alias("leaves")).filter("`from` > 0")
             .select(F.col("conv_id").alias("conv"), "from", "saved", "leaves", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("from") - 1) / STRETCH).cast("long"))).alias("stretch")))
    others = (rows.select("conv", "depth", "value", stretch.alias("stretch")).join(total, ["conv", "stretch"]).filter("depth < `from`")
              .groupBy("depth", "value").agg(F.sum("saved").alias("others_saved"), F.sum("leaves").alias("others_leaves")))
    zero = F.lit(0).cast("long")
    return (own.join(others, ["depth", "value"], "left").join(_digests(rows.filter("ends")), ["depth", "value"], "left").join(_parents(nodes), ["conv_id", "depth"], "left")
            .select("conv_id", "depth", F.when(F.col("depth") > 0, F.coalesce("parent_conv_id", "conv_id")).alias("parent_conv_id"), "n_convs", "n_children",
                    (F.col("own_leaves") + F.coalesce("others_leaves", zero)).alias("n_leaves"), (F.col("own_saved") + F.coalesce("others_saved", zero)).alias("saved_tokens"),
                    F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"), "value"))


def digest(conversations: DataFrame) -> DataFrame:
    return trie(conversations).drop("value")
