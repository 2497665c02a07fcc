"""Quality classifier: a byte-level convolutional network in numpy.

Bytes are embedded; filters of ``WIDTH`` bytes slide over the whole text in
steps of ``STRIDE``.  Chunks of ``CHUNK`` positions, each overlapping the next
by half, pool every filter by its maximum; a hidden layer reads a chunk's
maxima, the document pools the hidden units by their maximum and their mean over
chunks, and a logistic output combines these into one probability.

Training takes at most ``MAX_ROWS`` labelled rows, those with the smallest hash
of their id, each as a whole text.  For scoring, embedding and filters fold into
one table of byte pairs per offset, so a position costs ``WIDTH / 2`` look-ups.
Texts are scored in blocks of bounded size, whatever their length.

Null or empty text is one chunk of padding.  Labels that are null are not learnt
from.  Repeated rows score alike.  With labels of one class only, all scores are
that class.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame

from .toxicity import fold, sample, score_documents

EMBED = 8
WIDTH = 8            # bytes, even
STRIDE = 2           # bytes
FILTERS = 24
CHUNK = 128          # positions
HIDDEN = 12
MAX_ROWS = 2500
EPOCHS = 6
MIN_STEPS = 120      # batches at least: a small sample is gone through more often
BATCH = 32
BLOCK = 1 << 20      # bytes of text convolved at a time
HALF = CHUNK // 2


def padded(text: bytes) -> np.ndarray:
    """The text's bytes, followed by zeros up to whole half-chunks (two at
    least) and the filters' overhang."""
    halves = max(2, -(-len(text) // (HALF * STRIDE)))
    out = np.zeros(halves * HALF * STRIDE + WIDTH - STRIDE, dtype=np.uint8)
    out[:len(text)] = np.frombuffer(text, dtype=np.uint8)
    return out


class Net:
    """The parameters, and passes over single documents."""

    def __init__(self, seed: int = 3) -> None:
        rng = np.random.default_rng(seed)
        f = np.float32
        self.p = {
            "emb": rng.normal(0, 0.5, (256, EMBED)).astype(f),
            "flt": rng.normal(0, (WIDTH * EMBED) ** -0.5, (WIDTH * EMBED, FILTERS)).astype(f),
            "fb": np.zeros(FILTERS, dtype=f),
            "hid": rng.normal(0, FILTERS**-0.5, (FILTERS, HIDDEN)).astype(f),
            "hb": np.full(HIDDEN, 0.1, dtype=f),
            "out": rng.normal(0, 0.2, 2 * HIDDEN).astype(f),
            "ob": np.zeros(1, dtype=f),
        }

    def train_one(self, b: np.ndarray, y: float, grads: dict[str, np.ndarray], weight: float) -> None:
        """Adds a document's gradients."""
        p = self.p
        halves = (len(b) - WIDTH + STRIDE) // STRIDE // HALF
        at = np.arange(halves * HALF) * STRIDE
        window = b[at[:, None] + np.arange(WIDTH)]                         # positions x bytes
        x = p["emb"][window].reshape(len(at), -1)
        conv = (x @ p["flt"]).reshape(halves, HALF, FILTERS)
        best = conv.argmax(1)                                              # halves x filters
        top = np.take_along_axis(conv, best[:, None], 1)[:, 0]
        second = top[1:] > top[:-1]
        raw = np.where(second, top[1:], top[:-1]) + p["fb"]                # chunks x filters
        chunk = np.maximum(raw, 0)
        h_raw = chunk @ p["hid"] + p["hb"]
        h = np.maximum(h_raw, 0)
        arg = h.argmax(0)
        n = len(h)
        z = np.concatenate([h[arg, np.arange(HIDDEN)], h.mean(0)])
        prob = 1 / (1 + np.exp(-np.clip(float(z @ p["out"] + p["ob"][0]), -30, 30)))
        d = np.float32((prob - y) * weight)
        grads["out"] += d * z
        grads["ob"] += d
        dh = np.tile(d * p["out"][HIDDEN:] / n, (n, 1))
        dh[arg, np.arange(HIDDEN)] += d * p["out"][:HIDDEN]
        dh *= h_raw > 0
        grads["hid"] += chunk.T @ dh
        grads["hb"] += dh.sum(0)
        dc = (dh @ p["hid"].T) * (raw > 0)
        grads["fb"] += dc.sum(0)
        c, f = np.nonzero(dc)
        half = c + second[c, f]
        pos = half * HALF + best[half, f]
        g = dc[c, f]
        order = np.argsort(f, kind="stable")
        c, f, pos, g = c[order], f[order], pos[order], g[order]
        starts = np.flatnonzero(np.diff(f, prepend=-1))
        if len(f):
            grads["flt"][:, f[starts]] += np.add.reduceat(x[pos] * g[:, None], starts).T
            dx = (p["flt"].T[f] * g[:, None]).reshape(-1, EMBED)
            seen = window[pos].ravel()
            for e in range(EMBED):
                grads["emb"][:, e] += np.bincount(seen, dx[:, e], 256).astype(np.float32)

    def tables(self) -> np.ndarray:
        """WIDTH / 2 tables (65536 x filters) of what a byte pair adds."""
        flt = self.p["flt"].reshape(WIDTH, EMBED, FILTERS)
        one = np.einsum("be,wef->wbf", self.p["emb"], flt)                 # offset x byte x filter
        low, high = np.arange(65536) & 255, np.arange(65536) >> 8
        return np.stack([one[k][low] + one[k + 1][high] for k in range(0, WIDTH, 2)]).astype(np.float32)


def train(docs: list[bytes], labels: np.ndarray, epochs: int = EPOCHS, rate: float = 0.01) -> Net:
    """Adam over batches of whole documents."""
    net = Net()
    epochs = max(epochs, -(-MIN_STEPS * BATCH // max(1, len(docs))))
    if not 0 < labels.sum() < len(labels):
        net.p["out"][:] = 0
        net.p["ob"][:] = 30 if labels.sum() else -30
        return net
    low = float((labels == 0).mean())
    rng = np.random.default_rng(11)
    bytes_ = [padded(t) for t in docs]
    m = {k: np.zeros_like(v) for k, v in net.p.items()}
    v = {k: np.zeros_like(v) for k, v in net.p.items()}
    step = 0
    for epoch in range(epochs):
        order = rng.permutation(len(docs))
        for a in range(0, len(order), BATCH):
            grads = {k: np.zeros_like(x) for k, x in net.p.items()}
            for d in order[a:a + BATCH]:
                net.train_one(bytes_[d], float(labels[d]), grads, 1.0 if labels[d] else max(1.0, 0.4 / low))
            step += 1
            lr = rate * (1 - (step - 1) / (epochs * -(-len(order) // BATCH)))
            for k, g in grads.items():
                g /= BATCH
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.99 * v[k] + 0.01 * g * g
                net.p[k] -= lr * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-7)
    return net


class Scorer:
    def __init__(self, net: Net) -> None:
        self.p = net.p
        self.tables = net.tables()

    def halves(self, b: np.ndarray) -> np.ndarray:
        """Each half-chunk's filter maxima."""
        out = []
        span = HALF * STRIDE
        n = (len(b) - WIDTH + STRIDE) // span
        for a in range(0, n, BLOCK // span):
            k = min(BLOCK // span, n - a)
            part = b[a * span:(a + k) * span + WIDTH - STRIDE]
            pair = part[::2].astype(np.int32) + (part[1::2].astype(np.int32) << 8)
            size = k * HALF
            conv = self.tables[0][pair[:size]]
            for j in range(1, WIDTH // 2):
                conv += self.tables[j][pair[j:j + size]]
            out.append(conv.reshape(k, HALF, FILTERS).max(1))
        return np.concatenate(out)

    def text(self, t: bytes) -> float:
        p = self.p
        top = self.halves(padded(t))
        h = np.maximum(np.maximum(np.maximum(top[1:], top[:-1]) + p["fb"], 0) @ p["hid"] + p["hb"], 0)
        z = float(np.concatenate([h.max(0), h.mean(0)]) @ p["out"] + p["ob"][0])
        return float(1 / (1 + np.exp(-np.clip(z, -60, 60))))

    def texts(self, ts: list[bytes]) -> list[float]:
        return [self.text(t) for t in ts]


def quality(docs: DataFrame, labels: DataFrame, folds: int = 5, held: int = 0, max_rows: int = MAX_ROWS) -> DataFrame:
    net = train(*sample(docs, labels, "quality", fold("doc_id", folds) != held, max_rows))
    key = zlib.crc32(b"".join(x.tobytes() for x in net.p.values()))
    return score_documents(docs, lambda: Scorer(net), key, folds, held)
