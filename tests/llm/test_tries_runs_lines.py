"""The prefix trie, the periodic runs and the line index against brute force,
with nulls, empty texts, ties, repeated rows, empty tables and clashing columns."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from pageops.llm import linefilter, periodic, prefixtrie
from pageops.llm.queries import planted_period

SPACE = " \t\n\x0b\x0c\r"


def text_hash():
    return F.sha2(F.col("text").cast("binary"), 256)


# --- prefix trie ------------------------------------------------------------

def turns(seed=5):
    rnd = random.Random(seed)
    rows = []
    for c in [*range(-45, 160), *range(10**12, 10**12 + 25)]:
        if rnd.random() < 0.85:
            for t in range(rnd.choice([1, 1, 2, 3, 4, 5, 6])):
                rows.append((c, rnd.choice([t, t, t, None]), rnd.choice(["u", "a", None]), rnd.choice(["hi", "hi there", "x y z", "", None])))
    rows += [(41, t, "u", f"hi {t % 3}") for t in range(700)] + [(None, 1, "u", "z")]
    return rows + rows[:9]


def conversations(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, 3) for r in rows], "conv_id long, turn long, role string, text string, value int, depth int, part int").repartition(5)


def trie_brute(rows):
    by = {}
    for c, t, r, x in rows:
        if c is not None:
            by.setdefault(c, []).append((t is not None, t or 0, r or "", hashlib.md5((x or "").encode()).hexdigest(), x or ""))
    own = {c: [(r, x) for _, _, r, _, x in sorted(v)] for c, v in by.items()}
    nodes, kids, leaves, saved, built = {}, {}, {}, {}, {}
    for c, s in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = own.get(c - int(math.fmod(c, 20)), [])[:h] + s[h:]
        for d in range(len(built[c]) + 1):
            nodes.setdefault(tuple(built[c][:d]), []).append(c)
    for p in nodes:
        if p:
            kids.setdefault(p[:-1], []).append(p)
    for p in sorted(nodes, key=len, reverse=True):
        below = kids.get(p, [])
        leaves[p] = sum(leaves[k] for k in below) if below else 1
        saved[p] = (len(nodes[p]) - 1) * (len(p[-1][1].split()) if p else 0) + sum(saved[k] for k in below)
    return sorted(((min(m), len(p), min(nodes[p[:-1]]) if p else None, len(m), len(kids.get(p, [])), leaves[p], saved[p],
                    hashlib.sha256(",".join(str(c) for c in sorted(m) if len(built[c]) == len(p)).encode()).hexdigest()) for p, m in nodes.items()), key=str)


def trie_rows(df):
    out = prefixtrie.digest(df).select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    return sorted((tuple(r) for r in out.collect()), key=str)


def test_trie_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(prefixtrie, "STRETCH", 64)
    monkeypatch.setattr(prefixtrie, "PIECE", 3)
    monkeypatch.setattr(prefixtrie, "HOT", 4)
    rows = turns()
    assert trie_rows(conversations(spark, rows)) == trie_brute(rows)


def test_trie_notices_equal_hashes_and_starts_again(spark, monkeypatch):
    rows = turns()[:200]
    sound = prefixtrie._hashes
    tried = []

    def weak(seed):
        tried.append(seed)
        if seed == 0:                # turns whose texts are as long collide
            return [F.length("text").cast("long").alias(f"t{k}") for k in (1, 2)]
        return sound(seed)

    monkeypatch.setattr(prefixtrie, "_hashes", weak)
    assert trie_rows(conversations(spark, rows)) == trie_brute(rows)
    assert 0 in tried and 1 in tried


def test_trie_of_values_that_collide_starts_again(spark, monkeypatch):
    rows = turns()[:200]
    sound = prefixtrie.Monoid

    class Weak(sound):
        def __init__(self, seed):
            super().__init__(seed)
            if seed == 0:            # the order of turns is lost
                self.base = self.back = 1
                self.powers = [1]

    monkeypatch.setattr(prefixtrie, "Monoid", Weak)
    assert trie_rows(conversations(spark, rows)) == trie_brute(rows)


def test_trie_of_nothing(spark):
    assert trie_rows(conversations(spark, turns()).limit(0)) == []
    assert trie_rows(conversations(spark, [(None, 0, "u", "x")])) == []


def test_monoid_is_associative():
    m = prefixtrie.Monoid(1)
    rnd = random.Random(1)
    a, b, c = ([rnd.randrange(prefixtrie.PRIME) for _ in range(n)] for n in (3, 0, 2000))
    assert m.times(m.times(m.of(a), len(b), m.of(b)), len(c), m.of(c)) == m.of(a + b + c)
    assert m.without_last(m.of(a), a[-1]) == m.of(a[:-1])


# --- periodic runs ----------------------------------------------------------

def runs_brute(w, least=12):
    n, best = len(w), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            a = i
            while i + q < n and w[i] == w[i + q]:
                i += 1
            if i - a + q >= max(least, 2 * q):
                best.setdefault((a, i + q), q)
    return sorted((a, e - a, q) for (a, e), q in best.items())


def periodic_words(rnd):
    k, n = rnd.choice([1, 2, 3, 5, 30, 500]), rnd.choice([0, 1, 5, 11, 12, 13, 40, 100, 300, 700])
    w = [b"w%d" % rnd.randrange(k) for _ in range(n)]
    while rnd.random() < 0.7 and n > 3:
        p, a = rnd.randrange(1, n // 2 + 1), rnd.randrange(n)
        for i in range(a + p, min(n, a + p * rnd.randrange(2, 9) + rnd.randrange(3))):
            w[i] = w[i - p]
    return w


@pytest.mark.parametrize("chunk,plain", [(50, False), (1000, True), (8192, False)])
def test_runs_against_brute_force(monkeypatch, chunk, plain):
    monkeypatch.setattr(periodic, "CHUNK", chunk)
    if plain:                        # as if a hash had been wrong
        monkeypatch.setattr(periodic, "_right", lambda *a: False)
    rnd = random.Random(chunk)
    for _ in range(15):
        docs = [periodic_words(rnd) for _ in range(rnd.randrange(1, 8))]
        for w, found in zip(docs, periodic.runs(docs)):
            assert [tuple(r) for r in found.tolist()] == runs_brute(w)


def test_runs_of_long_texts():
    """Sums beyond one prime, all words equal, and no run at all."""
    third = [b"%d" % i for i in range(20_000)]
    assert periodic.runs([third * 3])[0].tolist() == [[0, 60_000, 20_000]]
    assert periodic.runs([[b"x"] * 60_000])[0].tolist() == [[0, 60_000, 1]]
    assert periodic.runs([third])[0].tolist() == []


@pytest.mark.parametrize("prime,root", periodic.PRIMES)
def test_transform_gives_exact_correlations(prime, root):
    rnd = np.random.default_rng(1)
    for block in (2, 16, 256):
        x, y = rnd.integers(0, 1000, block), rnd.integers(0, 1000, 2 * block)
        z = np.zeros((2 * block, 2), dtype=np.uint64)
        z[:block, 0], z[:, 1] = x, y
        f = periodic.forward(z, prime, root)
        product = np.ascontiguousarray((f[periodic._negated(2 * block), 0] * f[:, 1] % np.uint64(prime))[:, None])
        got = [int(v) * pow(2 * block, -1, prime) % prime for v in periodic.backward(product, prime, root)[:block, 0]]
        assert got == [int((x * y[s:s + block]).sum()) % prime for s in range(block)]


def test_collapse_and_digest(spark):
    rnd = random.Random(7)
    rows = [(i, " ".join(w.decode() for w in periodic_words(rnd))) for i in range(150)]
    rows += [(150, None), (151, ""), (152, " \t\n"), (None, "a b " * 9), (5, "z " * 30), (5, "z " * 30), (153, "É é x " * 8)]
    df = spark.createDataFrame([(*r, 1, "q", 3) for r in rows], "doc_id long, text string, start int, runs string, period int").repartition(3)

    def expected(i, t):
        w = planted_period(i, (t or "").encode().split())
        found = runs_brute(w)
        gone = {k for s, n, q in found for k in range(s + q, s + n)}
        best = min(((-n, s, q) for s, n, q in found), default=None)
        sha = lambda b: hashlib.sha256(b).hexdigest()
        return (i, len(found), *((best[1], -best[0], best[2], -1000 * best[0] // best[2]) if best else (None,) * 4),
                sha("".join(f"{s},{n},{q}\n" for s, n, q in found).encode()), sha(b" ".join(x for k, x in enumerate(w) if k not in gone)))

    got = sorted((tuple(r) for r in periodic.digest(df, rewrite=planted_period).collect()), key=str)
    assert got == sorted((expected(*r) for r in rows), key=str)
    assert periodic.digest(df.limit(0)).count() == 0


# --- line index -------------------------------------------------------------

def line_key(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(SPACE))


def lines_brute(rows, least, chars):
    found = Counter()
    for _, t in rows:
        found.update({k for k in map(line_key, (t or "").split("\n")) if len(k) >= chars})
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        stay = [x for x in lines if len(line_key(x)) < chars or found[line_key(x)] < least]
        out.append((i, len(lines), len(lines) - len(stay), hashlib.sha256("\n".join(stay).encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def line_rows():
    rnd = random.Random(5)
    pool = [f"line {i}" for i in range(60)] + ["É x", " A b ", "a B", "", "\t", "z\x1f", "　q", "\x1fz"]
    rows = [(i if i % 17 else None, "\n".join(rnd.choice(pool) if rnd.random() < 0.7 else f"u{rnd.randrange(10**6)}" for _ in range(rnd.choice([0, 1, 3, 9])))) for i in range(300)]
    return rows + [(7, None), (7, None), (8, ""), (8, "")]


def line_docs(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "q") for r in rows], "doc_id long, text string, r long, k1 long, shard string").repartition(4)


def applied(index, df):
    return sorted((tuple(r) for r in index.apply(df).select("doc_id", "n_lines", "n_dropped", text_hash()).collect()), key=str)


def state(index):
    filters = [(r.shard, linefilter.Cuckoo(bytes(r.tags))) for r in index.filters.collect()]
    tags = sorted((shard, int((f.tags > 0).sum()) + len(f.rest)) for shard, f in filters)
    return sorted(tuple(r) for r in index.counts.collect()), [t for t in tags if t[1]]


@pytest.mark.parametrize("least,chars", [(10, 1), (30, 3), (3, 0)])
def test_lines_against_brute_force(spark, line_rows, least, chars):
    got = sorted((tuple(r) for r in linefilter.digest(line_docs(spark, line_rows), least, chars).collect()), key=str)
    assert got == lines_brute(line_rows, least, chars)


def test_lines_come_back_when_documents_go(spark, line_rows):
    first, second = line_rows[:200], line_rows[200:]
    one = linefilter.build(line_docs(spark, first))
    before = state(one)
    two = one.insert(line_docs(spark, second))
    assert applied(two, line_docs(spark, line_rows)) == lines_brute(line_rows, 10, 1)
    back = two.delete(line_docs(spark, second))
    assert state(back) == before and before[1]
    assert applied(back, line_docs(spark, first)) == lines_brute(first, 10, 1)
    with pytest.raises(ValueError):
        one.delete(line_docs(spark, [(1, "never inserted")]))
    assert applied(two, line_docs(spark, line_rows)) == lines_brute(line_rows, 10, 1)


def test_only_the_filter_decides_what_is_compared(spark, line_rows, monkeypatch):
    """Without hot keys by broadcast, every frequent key comes through its shard's filter."""
    monkeypatch.setattr(linefilter, "HOT", 0.5)
    got = sorted((tuple(r) for r in linefilter.digest(line_docs(spark, line_rows)).collect()), key=str)
    assert got == lines_brute(line_rows, 10, 1)


def test_lines_of_nothing(spark, line_rows):
    assert linefilter.digest(line_docs(spark, line_rows).limit(0)).count() == 0


def test_cuckoo_filter_forgets():
    k1, k2 = (np.ascontiguousarray(c) for c in np.random.default_rng(1).integers(-2**63, 2**63 - 1, (2, 5000)))
    one = np.ones(5000, dtype=np.int64)
    for size in (10, 5000):          # far too small, so that the rest is used, and as sized
        f = linefilter.Cuckoo.empty(size)
        f.change(k1[:3000], k2[:3000], one[:3000])
        assert f.has(k1[:3000], k2[:3000]).all()
        if size == 5000:
            assert not f.rest and f.has(k1[3000:], k2[3000:]).mean() < 0.01
        f.change(k1[:3000], k2[:3000], -one[:3000])
        assert not f.tags.any() and not f.rest
