"""Token ids in a word-aligned binary format (Simple-8b), written and read back.

A 64-bit word holds a 4-bit selector and 60 bits of payload; the selector says
how many ids the word packs and in how many bits each.  Ids are packed in
blocks of ``BLOCK`` ids of one document; the word offset at which each block
ends is stored, so every block of a batch is packed and unpacked at the same
time by numpy.  An id of more than 60 bits takes an escape word, whose payload
is its index in the escape area behind the document's last block.

A file set is a Parquet folder, one row per document in ascending ``doc_id``
(then text) over its parts: ``part`` and ``first`` (ids before the document in
its part), ``n_tokens``, ``block_ends`` and ``payload`` (words, then escapes,
little-endian).  Spark's committer puts each part in place whole, so a retried
task leaves no half-written part.

Null text is empty and holds the end id only.  Rows with a null ``doc_id`` come
first; repeated rows each get their own record.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from operator import itemgetter
from struct import pack as pack_ids

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pageops.session import scratch_path

from .common import only

BLOCK = 1024
MEMO = 700_000       # pieces that a task's memo takes before it starts again, and keeps aside then
# Fixed values of Simple-8b: ids in a word and bits of each, by selector 1..14.
COUNTS = np.array([0, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1, 1], dtype=np.int64)
BITS = np.array([0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60, 60], dtype=np.int64)
ESCAPE = 15


def pack(ids: np.ndarray, sizes: np.ndarray) -> list[tuple[list[int], bytes]]:
    """``ids`` (uint64) of consecutive documents of ``sizes`` ids each, as
    (block_ends, payload) of each document."""
    n = len(ids)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    n_blocks = -(-sizes // BLOCK)
    doc_of = np.repeat(np.arange(len(sizes)), n_blocks)
    within = np.arange(len(doc_of)) - np.repeat(np.cumsum(n_blocks) - n_blocks, n_blocks)
    block_start = starts[doc_of] + within * BLOCK
    block_end = np.minimum(block_start + BLOCK, ends[doc_of])
    length = block_end - block_start
    room = (np.repeat(block_end, length) - np.arange(n)).astype(np.int32)     # ids left in the block

    # The largest count that fits at every position, from fewest to most ids.
    # Blocks stand apart by the largest count, so that no window meets the next.
    gap = int(COUNTS.max())
    place = np.arange(n) + np.repeat(np.arange(len(length)) * gap, length)
    apart = np.zeros(n + gap * len(length), dtype=np.uint64)
    apart[place] = ids
    top = int(ids.max()) if n else 0
    chosen = np.full(len(apart), ESCAPE, dtype=np.int8)
    for s in range(14, 0, -1):
        if top < 1 << int(BITS[s]):
            chosen[:] = s
            continue
        wide, have = apart >= np.uint64(1 << int(BITS[s])), 1              # any of ``have`` ids from here on is too wide
        while have < COUNTS[s]:
            step = min(have, int(COUNTS[s]) - have)
            wide = wide[:-step] | wide[step:]
            have += step
        np.copyto(chosen[:len(wide)], np.int8(s), where=~wide)
    choice = chosen[place]
    take = np.minimum(COUNTS[choice], room)

    # Walk all blocks at once, one word of each per step.
    opens = np.zeros(n, dtype=bool)
    pos, stop = block_start.copy(), block_end
    while len(pos):
        opens[pos] = True
        pos = pos + take[pos]
        going = pos < stop
        pos, stop = pos[going], stop[going]
    first = np.flatnonzero(opens)
    sel = choice[first].astype(np.int64)
    out = sel.astype(np.uint64) << np.uint64(60)
    for s in range(1, 15):
        k = np.flatnonzero(sel == s)
        if not len(k):
            continue
        whole = take[first[k]] == COUNTS[s]
        slot = np.arange(COUNTS[s])
        shift = (slot * BITS[s]).astype(np.uint64)
        f = k[whole]
        out[f] |= np.bitwise_or.reduce(ids[first[f][:, None] + slot] << shift, axis=1)
        for w in k[~whole]:                        # the last words of blocks
            t = take[first[w]]
            out[w] |= np.bitwise_or.reduce(ids[first[w]:first[w] + t] << shift[:t])
    word_end = np.searchsorted(first, block_end)                           # words up to each block's end
    word_start = np.searchsorted(first, starts)
    result = []
    last_block = np.cumsum(n_blocks)
    for d in range(len(sizes)):
        a = int(word_start[d])
        mine = word_end[last_block[d] - n_blocks[d]:last_block[d]]
        b = int(mine[-1]) if len(mine) else a
        part = out[a:b]
        out_of = np.flatnonzero(sel[a:b] == ESCAPE)
        if len(out_of):
            part = np.concatenate([part, ids[first[a:b][out_of]]])
            part[out_of] |= np.arange(len(out_of), dtype=np.uint64)
        result.append(((mine - a).tolist(), part.astype("<u8").tobytes()))
    return result


def unpack(sizes: np.ndarray, block_ends: list[list[int]], payloads: list[bytes]) -> list[np.ndarray]:
    """The ids (uint64) of each document."""
    raw = [np.frombuffer(p, dtype="<u8") for p in payloads]
    n_words = np.array([e[-1] if len(e) else 0 for e in block_ends], dtype=np.int64)
    w = np.concatenate([r[:k] for r, k in zip(raw, n_words)]) if raw else np.zeros(0, dtype=np.uint64)
    sel = (w >> np.uint64(60)).astype(np.int64)
    take = COUNTS[sel]
    # The last word of a block may hold fewer ids than its selector says.
    if len(w):
        base = np.repeat(np.cumsum(n_words) - n_words, [len(e) for e in block_ends])
        last = base + np.concatenate([np.asarray(e, dtype=np.int64) for e in block_ends]) - 1
        before = np.cumsum(take)
        block_total = np.concatenate([np.full(len(e), BLOCK) for e in block_ends]).astype(np.int64)
        tail = np.cumsum([len(e) for e in block_ends]) - 1
        full = np.array([len(e) for e in block_ends])
        has = full > 0
        block_total[tail[has]] = (sizes - (full - 1) * BLOCK)[has]
        said = before[last] - np.concatenate([[0], before[last][:-1]])
        take[last] -= said - block_total
    off = np.cumsum(take) - take
    out = np.zeros(int(take.sum()), dtype=np.uint64)
    payload = w & np.uint64((1 << 60) - 1)
    for s in range(1, 15):
        k = np.flatnonzero(sel == s)
        if not len(k):
            continue
        mask = np.uint64((1 << int(BITS[s])) - 1)
        whole = take[k] == COUNTS[s]
        slot = np.arange(COUNTS[s])
        shift = (slot * BITS[s]).astype(np.uint64)
        f = k[whole]
        out[off[f][:, None] + slot] = (payload[f][:, None] >> shift) & mask
        for w in k[~whole]:                        # the last words of blocks
            out[off[w]:off[w] + take[w]] = (payload[w] >> shift[:take[w]]) & mask
    result = []
    at = word = 0
    for d, size in enumerate(sizes):
        ids = out[at:at + size]
        mine = sel[word:word + n_words[d]] == ESCAPE
        if mine.any():
            ids[off[word:word + n_words[d]][mine] - at] = raw[d][n_words[d]:]
        result.append(ids)
        at += size
        word += n_words[d]
    return result


# -- encoding ---------------------------------------------------------------
# Letters and numbers among the characters below U+0100 (fixed values of the
# Unicode standard).
_LETTER = r"A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff"
_NUMBER = r"0-9\xb2\xb3\xb9\xbc-\xbe"
_PLAIN = re.compile(r"[\t\n\r\x20-\x7e\xa0-\xff]*")
_PIECES = re.compile(rf"'(?:[stmd]|re|ve|ll)| ?[{_LETTER}]+| ?[{_NUMBER}]+| ?[^\s{_LETTER}{_NUMBER}]+|\s+(?!\S)|\s+")


class Encoder(dict):
    """The tokenizers library's encoding with a byte-level vocabulary file.
    Plain Latin-1 texts are cut into the file's pieces here and each distinct
    piece goes to the library's model once; any other text goes to the library
    whole.  The mapping itself is the memo, from pieces to their ids' bytes; when
    it is full it starts again, and takes what it still needs from the last one."""

    def __init__(self, path: str) -> None:
        super().__init__()
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        from .treebpe import byte_alphabet

        self.lib = Tokenizer.from_file(path)
        self.special = [t.content for t in self.lib.get_added_tokens_decoder().values()]
        self.alphabet = byte_alphabet()
        self.space = self.alphabet[32]
        self.tokenize = self.lib.model.tokenize
        self.last: dict[str, bytes] = {}

    def __missing__(self, p: str) -> bytes:
        got = self.last.get(p)
        if got is None:
            if p.isascii() and p.isprintable():            # these bytes stand for themselves, but for the space
                spelt = p.replace(" ", self.space)
            else:
                spelt = "".join([self.alphabet[b] for b in p.encode("utf-8")])
            ids = [t.id for t in self.tokenize(spelt)]
            got = pack_ids(f"<{len(ids)}I", *ids)
        if len(p) <= 64:
            if len(self) >= MEMO:
                self.last = dict(self)
                self.clear()
            self[p] = got
        return got

    def encode(self, text: str) -> bytes:
        if _PLAIN.fullmatch(text) and not any(s in text for s in self.special):
            pieces = _PIECES.findall(text)
            return b"".join(itemgetter(*pieces)(self)) if len(pieces) > 1 else b"".join(map(self.__getitem__, pieces))
        return np.array(self.lib.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()


_ENCODERS: dict[str, Encoder] = {}


def _encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


FILE_SCHEMA = "doc_id long, part int, first long, n_tokens long, block_ends array<int>, payload binary"


def write_ids(docs: DataFrame, out: str, vocabulary: str, end_id: int = 2, rows: int = 512) -> None:
    """Encode each text, append ``end_id`` and write the file set at ``out``."""
    tie = F.xxhash64("text")
    frame = only(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text", tie.alias("tie"), F.monotonically_increasing_id().alias("row"))
    frame = frame.repartitionByRange("doc_id", "tie", "row").sortWithinPartitions("doc_id", "tie", "row").select("doc_id", "text")
    end = end_id.to_bytes(4, "little")

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part, first = _encoder(vocabulary), TaskContext.get().partitionId(), 0
        for batch in it:
            for at in range(0, batch.num_rows, rows):
                b = batch.slice(at, rows)
                got = [np.frombuffer(enc.encode(t or "") + end, dtype="<u4") for t in b.column(1).to_pylist()]
                sizes = np.array([len(g) for g in got], dtype=np.int64)
                packed = pack(np.concatenate(got).astype(np.uint64), sizes)
                firsts = first + np.cumsum(sizes) - sizes
                first += int(sizes.sum())
                yield pa.RecordBatch.from_arrays([
                    b.column(0), pa.array([part] * len(sizes), pa.int32()), pa.array(firsts, pa.int64()), pa.array(sizes, pa.int64()),
                    pa.array([e for e, _ in packed], pa.list_(pa.int32())), pa.array([p for _, p in packed], pa.binary()),
                ], names=["doc_id", "part", "first", "n_tokens", "block_ends", "payload"])

    frame.mapInArrow(run, FILE_SCHEMA).write.option("compression", "none").parquet(out)


def map_ids(spark: SparkSession, path: str, per_document, schema: str, names: list[str], types: list[pa.DataType], rows: int = 512) -> DataFrame:
    """Read a file set back: ``per_document(ids)`` gives the values of the
    columns ``names`` for each document's ids (uint64)."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for at in range(0, batch.num_rows, rows):
                b = batch.slice(at, rows)
                sizes = np.array(b.column(3).to_pylist(), dtype=np.int64)
                ids = unpack(sizes, b.column(4).to_pylist(), b.column(5).to_pylist())
                made = list(zip(*map(per_document, ids)))
                yield pa.RecordBatch.from_arrays([*b.columns[:4], *(pa.array(c, t) for c, t in zip(made, types))],
                                                 names=["doc_id", "part", "first", "n_tokens", *names])

    files = spark.read.schema(FILE_SCHEMA).parquet(path)
    return files.mapInArrow(run, f"doc_id long, part int, first long, n_tokens long, {schema}")


def with_starts(spark: SparkSession, path: str, df: DataFrame) -> DataFrame:
    """Adds ``start``: ids of all documents before, over all parts.  The part
    totals, one row per part, are few whatever the corpus size and broadcast."""
    parts = spark.read.schema(FILE_SCHEMA).parquet(path).groupBy("part").agg(F.sum("n_tokens").alias("total"))
    before = F.sum("total").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    parts = parts.select("part", F.coalesce(before, F.lit(0)).alias("before"))
    return df.join(F.broadcast(parts), "part").withColumn("start", F.col("before") + F.col("first")).drop("before")


def digest(docs: DataFrame, vocabulary: str, end_id: int = 2) -> DataFrame:
    """Write ``docs`` as a file set in the shared folder, read it back and
    return doc_id, start, n_tokens and ids_crc32 of each document."""
    spark = docs.sparkSession
    path = scratch_path(spark, "token-ids")
    write_ids(docs, path, vocabulary, end_id)
    back = map_ids(spark, path, lambda ids: (zlib.crc32(ids.astype("<u4").tobytes()),), "ids_crc32 long", ["ids_crc32"], [pa.int64()])
    return with_starts(spark, path, back).select("doc_id", "start", "n_tokens", "ids_crc32")
