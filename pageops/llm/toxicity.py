"""Toxicity by subword bags: character n-gram embeddings, averaged over a word
and over the text, into a linear softmax; both trained together in numpy.

A text's average weighs a word by the logarithm of its count, next to some empty
words, so one odd word, or one said over and over, doesn't decide a text.

A word is lower-cased and cut at its edges' punctuation; its bag is the n-grams
of 3 to 5 characters of ``<word>`` and the word itself, hashed to ``BUCKETS``
rows.  Words never seen, misspelt ones too, share rows with those seen.  Words of
any length are read whole, in training and scoring (a text without ASCII white
space is one word); memory is bounded by cutting them into overlapping spans.

The logits' slope and shift are set on a fifth of the sample that isn't trained
on.  Training takes at most ``MAX_ROWS`` labelled rows, those with the smallest hash
of their id, so reruns agree.  Scoring takes every whole text: the softmax of an
average is linear up to its last step, so each n-gram is one number and a text
costs one memo look-up a word.

Null or empty text scores as the model's bias says.  Labels that are null are
not learnt from.  Repeated rows score alike; a repeated label row counts again.
With no label of either class all scores are 0.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import mix, only, texts

BUCKETS = 1 << 18
DIM = 8
MAX_ROWS = 6000
MAX_BYTES = 64 << 20  # of training text on the driver
EPOCHS = 8
MIN_STEPS = 150      # batches at least: a small sample is gone through more often
BATCH = 64
RATE = 3.0
MEMO = 400_000
MEMO_BYTES = 64      # longer words, seldom met again, stay out of the memo
CHARS = 1 << 18      # characters that n-grams are made from at a time
START = 1e-5          # squared gradient that every row starts with: rare rows move little
PRIOR = 10.0         # weight of the empty words that every text is averaged with
MIN_DOCUMENTS = 4    # a row found in fewer training texts stays 0
GRAMS = (3, 4, 5)
_PRIME = np.uint64(0x100000001B3)
_EDGE = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def _codes(s: str) -> np.ndarray:
    return np.frombuffer(s.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)


def _mark(w: bytes) -> str:
    return "<" + w.decode("utf-8", "replace").lower().strip(_EDGE) + ">"


def _bags(ws: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(word index, row) of the n-grams of all words, in one go."""
    marked = [_mark(w) for w in ws]
    size = np.fromiter(map(len, marked), dtype=np.int64, count=len(ws))
    chars = _codes("".join(marked))
    n = len(chars)
    word = np.repeat(np.arange(len(ws)), size)
    first = np.cumsum(size) - size
    left = np.repeat(first + size, size) - np.arange(n)                 # characters up to the word's end
    place = (np.arange(n) - np.repeat(first, size)).astype(np.uint64)
    whole = mix(np.add.reduceat(mix(chars * _PRIME + place), first))
    of, rows = [np.arange(len(ws))], [whole]
    for k in GRAMS:
        at = np.flatnonzero(left >= k)
        h = np.full(len(at), k, dtype=np.uint64)
        for j in range(k):
            h = h * _PRIME + chars[at + j]
        of.append(word[at])
        rows.append(mix(h))
    return np.concatenate(of), (np.concatenate(rows) % np.uint64(BUCKETS)).astype(np.int64)


def _spans(w: bytes) -> Iterator[np.ndarray]:
    """The rows that ``_bags`` gives one word, from ``CHARS`` characters at a time."""
    s = _mark(w)
    whole = np.zeros(1, dtype=np.uint64)
    for a in range(0, len(s), CHARS):
        chars = _codes(s[a:a + CHARS + GRAMS[-1] - 1])                  # n-grams reach into the next span
        own = min(CHARS, len(s) - a)
        whole += mix(chars[:own] * _PRIME + np.arange(a, a + own, dtype=np.uint64)).sum(dtype=np.uint64)
        for k in GRAMS:
            n = max(0, min(own, len(chars) - k + 1))
            h = np.full(n, k, dtype=np.uint64)
            for j in range(k):
                h = h * _PRIME + chars[j:j + n]
            yield (mix(h) % np.uint64(BUCKETS)).astype(np.int64)
    yield (mix(whole) % np.uint64(BUCKETS)).astype(np.int64)


def bags(ws: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(word index, row) of the n-grams of all words, in parts made from about
    ``CHARS`` characters each, however many or long the words are."""
    a = held = 0
    for b, w in enumerate(ws):
        if b > a and held + len(w) > CHARS:
            of, rows = _bags(ws[a:b])
            yield of + a, rows
            a, held = b, 0
        held += len(w)
        if held > CHARS:                                                # a single word
            for rows in _spans(w):
                yield np.full(len(rows), b), rows
            a, held = b + 1, 0
    if a < len(ws):
        of, rows = _bags(ws[a:])
        yield of + a, rows


class _Corpus:
    """Texts as counts of distinct words, words as bags."""

    def __init__(self, docs: list[bytes]) -> None:
        number: dict[bytes, int] = {}
        self.docs = []
        for t in docs:
            at = np.fromiter((number.setdefault(w, len(number)) for w in t.split()), dtype=np.int64)
            ids, count = np.unique(at, return_counts=True)
            weight = np.log1p(count)
            self.docs.append((ids, (weight / (weight.sum() + PRIOR)).astype(np.float32)))
        words, rows = list(number), []
        self.size = np.zeros(len(words), dtype=np.int64)
        for of, found in bags(words):                                   # words come in order, a long one in several parts
            low = int(of.min(initial=len(words)))
            size = np.bincount(of - low)
            self.size[low:low + len(size)] += size
            rows.append(found[np.argsort(of, kind="stable")].astype(np.int32))
        self.start = np.cumsum(self.size) - self.size
        self.rows = np.concatenate(rows) if rows else np.zeros(0, dtype=np.int32)
        self.found_in = np.zeros(BUCKETS, dtype=np.int64)               # documents that have the row
        for ids, _ in self.docs:
            size = self.size[ids]
            at = np.repeat(self.start[ids] - (np.cumsum(size) - size), size) + np.arange(size.sum())
            self.found_in[np.unique(self.rows[at])] += 1


def train(docs: list[bytes], labels: np.ndarray, epochs: int = EPOCHS, rate: float = RATE) -> tuple[np.ndarray, float]:
    """(score of each n-gram row, bias) of the trained model."""
    score = np.zeros(BUCKETS, dtype=np.float32)
    positive = float(labels.sum())
    if not 0 < positive < len(labels):
        return score, -30.0
    rng = np.random.default_rng(7)
    c = _Corpus(docs)
    epochs = max(epochs, -(-MIN_STEPS * BATCH // len(docs)))
    emb = rng.normal(0, 0.1, (BUCKETS, DIM)).astype(np.float32)
    common = c.found_in >= MIN_DOCUMENTS
    emb[~common] = 0
    out = rng.normal(0, 0.5, (DIM, 2)).astype(np.float32)        # softmax weights
    bias = np.array([0.0, np.log(positive / (len(labels) - positive))], dtype=np.float32)
    sq_emb, sq_out, sq_bias = np.full(BUCKETS, START, dtype=np.float32), np.full(out.shape, 1e-8, dtype=np.float32), np.full(2, 1e-2, dtype=np.float32)
    for _ in range(epochs):
        order = rng.permutation(len(docs))
        for a in range(0, len(order), BATCH):
            part = [d for d in order[a:a + BATCH] if len(c.docs[d][0])]
            if not part:
                continue
            ids = np.concatenate([c.docs[d][0] for d in part])
            share = np.concatenate([c.docs[d][1] for d in part])
            first = np.cumsum([len(c.docs[d][0]) for d in part]) - [len(c.docs[d][0]) for d in part]
            words, back = np.unique(ids, return_inverse=True)
            size = c.size[words]
            at = np.cumsum(size) - size
            flat = c.rows[np.repeat(c.start[words] - at, size) + np.arange(size.sum())]
            vec = np.add.reduceat(emb[flat], at) / size[:, None]                     # words
            text = np.add.reduceat(vec[back] * share[:, None], first)                # documents
            logit = text @ out + bias
            prob = np.exp(logit - logit.max(1, keepdims=True))
            prob /= prob.sum(1, keepdims=True)
            prob[np.arange(len(part)), labels[part].astype(int)] -= 1                # gradient at the logits
            g_text = prob @ out.T
            doc_of = np.repeat(np.arange(len(part)), np.diff(np.append(first, len(ids))))
            g_word = np.zeros((len(words), DIM), dtype=np.float32)
            by_word = np.argsort(back, kind="stable")
            grad = g_text[doc_of[by_word]] * share[by_word, None]
            g_word = np.add.reduceat(grad, np.searchsorted(back[by_word], np.arange(len(words)))) / size[:, None]
            rows, inverse = np.unique(flat, return_inverse=True)
            g_rows = np.stack([np.bincount(inverse, np.repeat(g_word[:, k], size), len(rows)) for k in range(DIM)], 1).astype(np.float32)
            g_out, g_bias = text.T @ prob, prob.sum(0)
            g_rows *= common[rows, None]
            sq_emb[rows] += (g_rows**2).mean(1)
            emb[rows] -= rate * g_rows / np.sqrt(sq_emb[rows])[:, None]
            sq_out += g_out**2
            out -= rate * 0.5 * g_out / np.sqrt(sq_out)
            sq_bias += g_bias**2
            bias -= rate * 0.1 * g_bias / np.sqrt(sq_bias)
    return emb @ (out[:, 1] - out[:, 0]), float(bias[1] - bias[0])


def calibrate(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """(slope, shift) of the logistic fit of labels on logits, by Newton steps;
    drawn towards (0.5, 0) by as much as a few examples weigh."""
    scale = float(np.abs(x).max()) or 1.0
    a = np.stack([x / scale, np.ones(len(x))], 1)
    start, pull = np.array([0.5 * scale, 0.0]), np.diag([4.0 / scale**2, 0.05])
    w = start.copy()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        grad = a.T @ (p - y) + pull @ (w - start)
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + pull + 1e-9 * np.eye(2), grad)
        size = np.abs(step / np.array([scale, 10.0])).max()
        w -= step / max(1.0, size)
    return max(float(w[0]) / scale, 1e-3), float(w[1])


def fit(docs: list[bytes], labels: np.ndarray) -> tuple[np.ndarray, float]:
    """Train on four fifths of the sample; the last fifth sets slope and shift
    of the logits, so that scores of unseen texts are probabilities."""
    cut = len(docs) - len(docs) // 5
    score, bias = train(docs[:cut], labels[:cut])
    if not 0 < labels[cut:].sum() < len(labels) - cut:
        return score, bias
    slope, shift = calibrate(np.array(Scorer(score, bias).logits(docs[cut:])), labels[cut:])
    return score * np.float32(slope), bias * slope + shift


class Scorer:
    """Scores texts under a trained model, with a bounded memo of words."""

    def __init__(self, score: np.ndarray, bias: float) -> None:
        self.score, self.bias = score.astype(np.float64), bias
        self.memo: dict[bytes, float] = {}

    def means(self, ws: list[bytes]) -> list[float]:
        total, size = np.zeros(len(ws)), np.zeros(len(ws))
        for of, rows in bags(ws):
            low = int(of.min(initial=len(ws)))
            n = np.bincount(of - low)
            total[low:low + len(n)] += np.bincount(of - low, self.score[rows])
            size[low:low + len(n)] += n
        return (total / size).tolist()

    def logits(self, ts: list[bytes]) -> list[float]:
        if len(self.memo) >= MEMO:
            self.memo.clear()
        counts = [Counter(t.split()) for t in ts]
        new = list({w for c in counts for w in c if w not in self.memo})
        mean = dict(zip(new, self.means(new)))
        self.memo.update((w, x) for w, x in mean.items() if len(w) <= MEMO_BYTES)
        long = {w: x for w, x in mean.items() if len(w) > MEMO_BYTES}
        out = []
        for c in counts:
            weight = np.log1p(np.fromiter(c.values(), dtype=np.float64, count=len(c)))
            each = np.fromiter((self.memo[w] if len(w) <= MEMO_BYTES else long[w] for w in c), dtype=np.float64, count=len(c))
            out.append(self.bias + float(each @ weight) / (float(weight.sum()) + PRIOR))
        return out

    def texts(self, ts: list[bytes]) -> list[float]:
        return (1.0 / (1.0 + np.exp(-np.clip(self.logits(ts), -60, 60)))).tolist()


_SCORERS: dict[int, Scorer] = {}


def fold(column: str, folds: int):
    return F.crc32(F.col(column).cast("string").cast("binary")) % folds


def sample(docs: DataFrame, labels: DataFrame, label: str, learn, max_rows: int, max_bytes: int = MAX_BYTES) -> tuple[list[bytes], np.ndarray]:
    """The bounded training sample: texts and labels of the ``max_rows`` labelled
    rows with the smallest id hash, as many as ``max_bytes`` hold; texts of more
    than a hundredth of that are not learnt from.  Only their ids, then their
    texts, move."""
    keys = (labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).filter(learn)
            .select(F.col("doc_id").alias("_d"), F.col(label).cast("int").alias("_y"), F.xxhash64("doc_id").alias("_h"))
            .orderBy("_h", "_d", "_y").limit(max_rows))
    size = F.coalesce(F.octet_length("text"), F.lit(0))
    picked = (only(docs, "doc_id", "text").join(F.broadcast(keys), F.col("doc_id") == F.col("_d")).filter(size <= max_bytes // 100)
              .select("_h", "_d", "text", "_y").orderBy("_h", "_d", "text", "_y").limit(max_rows))
    so_far = F.sum(size).over(W.orderBy("_h", "_d", "text", "_y").rowsBetween(W.unboundedPreceding, W.currentRow))
    rows = picked.withColumn("_size", so_far).filter(F.col("_size") <= max_bytes).orderBy("_h", "_d", "text", "_y").select("text", "_y").toArrow()
    return [(t or "").encode("utf-8") for t in rows.column(0).to_pylist()], np.array(rows.column(1).to_pylist(), dtype=np.int64)


def score_documents(docs: DataFrame, scorer_of, key: int, folds: int, held: int, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted.  ``scorer_of()`` makes the scorer once
    in each worker, kept under ``key``."""
    frame = only(docs, "doc_id", "text").withColumn("held_out", fold("doc_id", folds) == held).select("doc_id", "held_out", "text")

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _SCORERS:
            _SCORERS.clear()
            _SCORERS[key] = scorer_of()
        s = _SCORERS[key]
        for batch in it:
            for at in range(0, batch.num_rows, 1024):
                b = batch.slice(at, 1024)
                x = np.array(s.texts(texts(b)))
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(x), pa.array((x >= threshold).astype(np.int32))],
                                                 names=["doc_id", "held_out", "score", "predicted"])

    return frame.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, held_out boolean, score double, predicted int")


def toxicity(docs: DataFrame, labels: DataFrame, folds: int = 4, held: int = 2, max_rows: int = MAX_ROWS) -> DataFrame:
    score, bias = fit(*sample(docs, labels, "toxic", fold("doc_id", folds) != held, max_rows))
    key = zlib.crc32(score.tobytes(), zlib.crc32(repr(bias).encode()))
    return score_documents(docs, lambda: Scorer(score, bias), key, folds, held)
