"""BPE encoding and decoding by tree concatenation.

Text is normalised and cut into pieces as the vocabulary file says.  A piece up
to ``leaf`` characters goes to the BPE model whole.  A longer unsplit piece is
cut in halves down to leaves; all leaves are encoded on their own, then the
halves are joined pairwise, level by level.  At a join a window of tokens
around the seam is encoded again, and grows on either side until its first and
last tokens equal the tokens that were there: every neighbouring pair of tokens
is then one that BPE itself makes, so the joined list is the encoding of the
joined text.  (Each token of such a vocabulary has one merge that makes it.)

Spark deals the documents out; each task keeps a bounded memo of short pieces,
because a corpus repeats them.

Null text is empty; an empty text has no ids and decodes to ''.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import only

LEAF = 12           # characters of the largest piece that is encoded in one go
MEMO = 300_000      # pieces in a task's memo before it starts again

_SPACE = r"\t\n\v\f\r \x85\xa0"
# Letters and numbers among the characters below U+0100, lower case only
# (fixed values of the Unicode standard).
_LETTER = r"a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff"
_NUMBER = r"0-9\xb2\xb3\xb9\xbc-\xbe"
_PLAIN = re.compile(r"[\t\n\r\x20-\x7e\xa0-\xff]*")
_PIECES = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_NUMBER}]|[^{_SPACE}{_LETTER}{_NUMBER}]+")


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte: printable Latin-1
    characters for themselves, the others from U+0100 on in order."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


class TreeEncoder:
    """The encoder of one vocabulary file, with its memo."""

    def __init__(self, path: str, leaf: int = LEAF) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        from tokenizers.models import BPE

        self.leaf = max(2, leaf)
        self.lib = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.end = model["end_of_word_suffix"] or ""
        # Leaves that do not end a piece carry no end-of-word mark.
        self.last = self.lib.model
        self.inner = BPE(model["vocab"], merges) if self.end else self.last
        self.token = {i: t for t, i in model["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token.update({i: t for t, i in self.special.items()})
        self.cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.alphabet = byte_alphabet()
        self.byte = str.maketrans({chr(b): c for b, c in enumerate(self.alphabet)})
        self.memo: dict[str, bytes] = {}
        self.joins = 0               # halves that were joined

    # -- one piece ---------------------------------------------------------
    def text_of(self, ids: list[int]) -> str:
        return "".join(self.token[i] for i in ids)

    def base(self, text: str, ends: bool) -> list[int]:
        return [t.id for t in (self.last if ends else self.inner).tokenize(text)]

    def join(self, left: list[int], right: list[int], ends: bool) -> list[int]:
        """The encoding of the two texts together."""
        if not left or not right:
            return left or right
        self.joins += 1
        a = b = 1
        while True:
            a, b = min(a, len(left)), min(b, len(right))
            whole_left, whole_right = a == len(left), b == len(right)
            closing = ends and whole_right
            window = self.text_of(left[-a:] + right[:b])
            if closing and self.end:
                window = window.removesuffix(self.end)
            again = self.base(window, closing)
            left_agrees = whole_left or again[0] == left[-a]
            right_agrees = whole_right or again[-1] == right[b - 1]
            if left_agrees and right_agrees:
                return left[:-a] + again + right[b:]
            if not left_agrees:
                a *= 2
            if not right_agrees:
                b *= 2

    def piece(self, text: str) -> list[int]:
        """The ids of one piece, written in the byte alphabet."""
        if len(text) <= self.leaf:
            return self.base(text, True)
        ends = [0, len(text)]
        while max(b - a for a, b in zip(ends, ends[1:])) > self.leaf:
            ends = sorted({*ends, *((a + b) // 2 for a, b in zip(ends, ends[1:]))})
        parts = [self.base(text[a:b], b == len(text)) for a, b in zip(ends, ends[1:])]
        while len(parts) > 1:
            at_end = (len(parts) + 1) // 2 - 1
            parts = [self.join(parts[i], parts[i + 1], i // 2 == at_end) if i + 1 < len(parts) else parts[i]
                     for i in range(0, len(parts), 2)]
        return parts[0]

    def known(self, piece: str) -> bytes:
        """The piece's ids as bytes, from the memo if short."""
        got = self.memo.get(piece)
        if got is None:
            ids = self.piece("".join(self.alphabet[b] for b in piece.encode("utf-8")))
            got = np.array(ids, dtype="<u4").tobytes()
            if len(piece) <= 64:
                if len(self.memo) >= MEMO:
                    self.memo.clear()
                self.memo[piece] = got
        return got

    # -- whole texts -------------------------------------------------------
    def pieces(self, text: str) -> list[str]:
        """Normalised pieces of a text without special tokens.  Texts of plain
        Latin-1 characters take a short way; others the file's own rules."""
        if _PLAIN.fullmatch(text):
            return _PIECES.findall(text.lower())
        whole = self.lib.normalizer.normalize_str(text)
        back = {c: b for b, c in enumerate(self.alphabet)}
        return [bytes(back[c] for c in p).decode("utf-8") for p, _ in self.lib.pre_tokenizer.pre_tokenize_str(whole)]

    def encode(self, text: str) -> bytes:
        """The ids of a text (little-endian 32-bit)."""
        parts = self.cut.split(text) if self.cut and any(s in text for s in self.special) else [text]
        ids: list[bytes] = []
        memo = self.memo.get
        for k, part in enumerate(parts):
            if k % 2:
                ids.append(self.special[part].to_bytes(4, "little"))
            else:
                ids += [memo(p) or self.known(p) for p in self.pieces(part)]
        return b"".join(ids)

    def decode(self, ids: bytes) -> str:
        """The text of ids: the file has no decoder, so tokens are joined by one space."""
        return " ".join(map(self.token.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


_ENCODERS: dict[tuple[str, int], TreeEncoder] = {}


def encoder(path: str, leaf: int = LEAF) -> TreeEncoder:
    """This process's encoder: made once per worker, not once per task."""
    if (path, leaf) not in _ENCODERS:
        _ENCODERS[path, leaf] = TreeEncoder(path, leaf)
    return _ENCODERS[path, leaf]


def encode_documents(docs: DataFrame, path: str, with_ids: bool = False, carry: tuple[str, ...] = (), leaf: int = LEAF) -> DataFrame:
    """One row per row of ``docs``: the carried columns, ``n_tokens``,
    ``ids_sha256``, ``decoded_sha256`` and, ``with_ids``, the ids as bytes."""
    frame = only(docs, *carry, "text")
    ours = "n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids binary" * with_ids
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema if f.name != "text"] + [ours])
    n_carry = len(carry)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, leaf)
        for batch in it:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                ids: list[bytes] = []
                said: list[str] = []
                for t in part.column(n_carry).to_pylist():
                    ids.append(enc.encode(t or ""))
                    said.append(hashlib.sha256(enc.decode(ids[-1]).encode("utf-8")).hexdigest())
                cols = [part.column(k) for k in range(n_carry)]
                cols += [pa.array([len(x) // 4 for x in ids], pa.int64()),
                         pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string()), pa.array(said, pa.string())]
                names = [*carry, "n_tokens", "ids_sha256", "decoded_sha256"]
                if with_ids:
                    cols.append(pa.array(ids, pa.binary()))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names=names)

    return frame.mapInArrow(run, schema)


def decode_ids(df: DataFrame, path: str, column: str = "ids") -> DataFrame:
    """Adds ``decoded``, the text of the ids in ``column``."""
    from pyspark.sql.functions import pandas_udf

    @pandas_udf("string")
    def back(s):  # noqa: ANN001, ANN202
        enc = encoder(path)
        return s.map(lambda b: enc.decode(b or b""))

    return df.withColumn("decoded", back(F.col(column)))
