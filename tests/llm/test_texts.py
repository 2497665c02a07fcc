"""The operators on small planted documents against brute force, with nulls,
empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from pageops.llm import bytecnn, idpack, mixing, outliers, partenum, substring, toxicity, treebpe
from pageops.llm.queries import vocabulary

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, a long, b long, node long, t int, row long, n long, x string, copies long"


def documents(spark, rows):
    """Rows (doc_id, text[, lang, source]) with extra columns whose names the
    operators use themselves."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", len(r[1] or ""), 1, 2, 3, 4, 5, 6, "x", 7) for r in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(3)


def near_copies(seed=5):
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(2000)]
    rows = []
    for length, size in ((60, 70), (150, 60), (30, 40), (12, 30)):
        base = [rnd.choice(vocab) for _ in range(length)]
        pool = [base]
        for _ in range(size):
            w = list(rnd.choice(pool)) if rnd.random() < 0.3 else list(base)
            for _ in range(rnd.choice([0, 0, 1, 1, 2, 3, 4, 6])):
                r, j = rnd.random(), rnd.randrange(len(w))
                if r < 0.5:
                    w[j] = rnd.choice(vocab[:40] if rnd.random() < 0.5 else vocab)
                elif r < 0.75 and len(w) > 3:
                    del w[j]
                else:
                    w.insert(j, rnd.choice(vocab))
            pool.append(w)
            rows.append((len(rows), " ".join(w)))
    return rows + [(len(rows) + k, t) for k, t in enumerate(["", None, "a", "a", "A", "a b", "a b c d e", " \t\n", "É é", "é é"])]


def jaccard_brute(rows, n, percent):
    sets = {}
    for i, t in rows:
        w = [x.decode() for x in (t or "").encode().lower().split()]
        sets[i] = {tuple(w)} if 0 < len(w) < n else {tuple(w[k:k + n]) for k in range(len(w) - n + 1)}
    root = {i: i for i in sets}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


@pytest.mark.parametrize("n,percent,large,sample", [(3, 90, 16, 1024), (5, 80, 4, 1024), (5, 80, 4, 1), (3, 90, 2, 2)])
def test_jaccard_components(spark, monkeypatch, n, percent, large, sample):
    """Also with large groups pruned by distance and hot ones dealt over tasks."""
    monkeypatch.setattr(partenum, "LARGE", large)
    monkeypatch.setattr(partenum, "SAMPLE", sample)
    rows = near_copies()
    out = {r.doc_id: (r.n_shingles, r.component_id) for r in partenum.jaccard_components(documents(spark, rows), n, percent).collect()}
    assert out == jaccard_brute(rows, n, percent)


def test_jaccard_repeated_and_null_ids(spark):
    long = " ".join(f"w{i}" for i in range(40))
    rows = [(3, long), (3, long), (7, long + " end"), (None, long), (9, "other words here")]
    out = sorted(partenum.jaccard_components(documents(spark, rows), 3, 90).collect(), key=repr)
    assert [(r.doc_id, r.component_id) for r in out if r.doc_id] == [(3, 3), (3, 3), (7, 3), (9, 9)]
    assert [r.component_id for r in out if r.doc_id is None] == [3]


def test_pairs_meet_as_texts(spark, monkeypatch):
    """No sets are written, and a node of many pairs meets them in chunks."""
    monkeypatch.setattr(partenum, "CHUNK", 3)
    written = []
    write = partenum.keep
    monkeypatch.setattr(partenum, "keep", lambda df, name, *by: written.append(name) or write(df, name, *by))
    base = [f"word{k}" for k in range(60)]
    rows = [(k, " ".join([*base, *(["new"] * (k % 2)), f"end{k}"])) for k in range(12)]
    out = partenum.jaccard_components(documents(spark, rows), 3, 80)
    assert {(r.doc_id, r.component_id) for r in out.collect()} == {(k, 0) for k in range(12)}
    assert "near" in written and "sets" not in written
    docs = documents(spark, rows).withColumn("node", F.col("doc_id"))
    pairs = spark.createDataFrame([(0, k) for k in range(1, 12)], "a long, b long")
    assert sorted(map(tuple, partenum._count(docs, pairs, 3).collect())) == [(0, k, 118 + k % 2, 58) for k in range(1, 12)]


def test_one_row_of_each_near_copy_stays(spark):
    import corpus_pipeline

    a, b, c, d = (" ".join(f"{x}{i}" for i in range(60)) for x in "abcd")
    rows = [(3, a), (5, a + " end"), (5, b), (9, b + " end"), (9, "quite another text that no other row has"),
            (2, c), (2, c), (2, c + " end"), (None, c), (None, d), (None, d + " end"), (4, None), (4, ""), (None, None)]
    want = [(3, a), (5, b), (9, rows[4][1]), (4, None), (4, ""), (None, None)]
    got = []
    for order in (rows, rows[::-1]):
        docs = documents(spark, order)
        out = corpus_pipeline.near_duplicates(spark, docs, "")
        assert out.columns == docs.columns
        got.append(sorted(((r.doc_id, r.text) for r in out.collect()), key=repr))
    assert got[0] == got[1]
    of_c, of_d = ([r for r in got[0] if (r[1] or "").startswith(x)] for x in ("c0", "d0"))
    assert len(of_c) == 1 and of_c[0][0] == 2 and len(of_d) == 1 and of_d[0][0] is None
    assert sorted([r for r in got[0] if r not in of_c + of_d], key=repr) == sorted(want, key=repr)
    unique = [(k, t) for k, (_, t) in enumerate(rows)]
    out = corpus_pipeline.near_duplicates(spark, documents(spark, unique), "")
    assert sorted(r.doc_id for r in out.collect()) == [0, 2, 4, 5, 9, 11, 12, 13]


def test_parity_sketch_never_exceeds_the_difference():
    rnd = np.random.default_rng(0)
    for _ in range(50):
        x = np.unique(rnd.integers(0, 2**63, int(rnd.integers(1, 400))).astype(np.uint64))
        y = np.unique(np.concatenate([x[rnd.random(len(x)) < 0.9], rnd.integers(0, 2**63, 20).astype(np.uint64)]))
        assert partenum.apart(partenum.sketch(x), partenum.sketch(y)) <= len(np.setxor1d(x, y))


def repeats_brute(rows, length):
    words = {k: WORD.findall(t or "") for k, (_, t) in enumerate(rows)}
    first = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            for s in range(len(words[k]) - length + 1):
                w = tuple(words[k][s:s + length])
                first[w] = min(first.get(w, i), i)
    out = []
    for k, (i, _) in enumerate(rows):
        gone = [False] * len(words[k])
        for s in range(len(words[k]) - length + 1):
            if i is not None and first[tuple(words[k][s:s + length])] < i:
                gone[s:s + length] = [True] * length
        kept = " ".join(w for w, g in zip(words[k], gone) if not g)
        out.append((i, len(gone), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def test_substring_dedup(spark):
    rnd = random.Random(3)
    vocab = [f"v{i}" for i in range(60)]
    passages = [[rnd.choice(vocab) for _ in range(n)] for n in (50, 51, 49, 70, 120)] + [["the"] * 80, ["a", "b"] * 40]
    rows = []
    for i in range(60):
        w = []
        for _ in range(rnd.randrange(4)):
            w += [rnd.choice(vocab) for _ in range(rnd.randrange(60))] + rnd.choice(passages)
        rows.append((i, rnd.choice([" ", "\n", " \t "]).join(w)))
    rows += [(60, None), (61, ""), (62, rows[5][1]), (62, rows[5][1]), (62, rows[7][1]), (None, rows[5][1])]
    out = substring.digest(documents(spark, rows))
    assert sorted([tuple(r) for r in out.collect()], key=repr) == repeats_brute(rows, 50)
    spans = substring.dedupe(documents(spark, rows)).select("n_removed", F.explode("repeats").alias("r")).collect()
    assert spans and all(r.r.words >= 50 for r in spans)


def test_bpe_equals_the_library(spark):
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    rnd = random.Random(1)
    texts = ["", None, "<|endoftext|>a<|startoftext|> b", "ΑΣ ΣΑΣ İı Ⅷ", "a" * 30000, "abcdefghij" * 3000, "☃日本" * 50, "it's we'll 12 ½ naïve"]
    texts += ["".join(rnd.choice(a) for _ in range(rnd.randrange(80))) for a in ("ab", "etaoin", "aé☃ ", "'strevlmd 1.") for _ in range(40)]
    rows = list(enumerate(texts))
    want = {}
    for i, t in rows:
        ids = lib.encode(t or "", add_special_tokens=False).ids
        want[i] = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                   hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest())
    for leaf in (3, treebpe.LEAF):
        out = treebpe.encode_documents(documents(spark, rows), vocabulary("word_bpe_49k.json"), carry=("doc_id",), leaf=leaf)
        assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in out.collect()} == want


def test_every_plain_character_is_cut_as_the_library_does():
    word, byte = treebpe.TreeEncoder(vocabulary("word_bpe_49k.json")), idpack.Encoder(vocabulary("byte_bpe_50k.json"))
    for c in range(0x300):
        text = f"ab{chr(c)}c'd {chr(c)}{chr(c)} {chr(c)}  {chr(c)}"
        assert word.encode(text) == np.array(word.lib.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), c
        assert byte.encode(text) == np.array(byte.lib.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), c


def test_simple8b_round_trip():
    rnd = np.random.default_rng(0)
    for k in range(200):
        sizes = rnd.integers(0, 4000 if k % 2 else 40, rnd.integers(1, 6))
        top = int(rnd.choice([1, 2, 15, 300, 50257, 2**31, 2**60]))
        ids = (rnd.random(sizes.sum()) ** rnd.integers(1, 9) * top).astype(np.uint64)
        if k % 5 == 0:
            ids = rnd.integers(0, 2**64 - 1, sizes.sum(), dtype=np.uint64) >> rnd.integers(0, 64, sizes.sum()).astype(np.uint64)
        packed = idpack.pack(ids, sizes)
        back = idpack.unpack(sizes, [e for e, _ in packed], [p for _, p in packed])
        assert (np.concatenate(back) == ids).all()


def test_token_files(spark):
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    rows = [(9, "nine words or so"), (-4, "first"), (2, None), (3, ""), (5, "x" * 50000), (7, "☃ <|endoftext|> é"), (7, "a tie"), (7, "a tie")]
    out = idpack.digest(documents(spark, rows), vocabulary("byte_bpe_50k.json")).orderBy("start").collect()
    start = 0
    assert [r.doc_id for r in out] == sorted(i for i, _ in rows)
    codes = Counter()
    for i, t in rows:
        ids = np.array([*lib.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        codes[i, len(ids), zlib.crc32(ids.tobytes())] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in out) == codes
    for r in out:
        assert r.start == start
        start += r.n_tokens


def test_mix(spark):
    rnd = random.Random(2)
    rows = [(i, " ".join(["w"] * rnd.randrange(1, 200)), "en", rnd.choice(["b", "a", "é", None, "Z"])) for i in range(1500)]
    rows += [(2000, None, "en", "a"), (2001, "", "en", "a"), (2002, "one two", "en", "tiny"), (2002, "one two", "en", "tiny")]
    docs = documents(spark, rows)
    out = mixing.copies(docs).collect()
    assert sorted((r.doc_id, r.size) for r in out) == sorted((i, len((t or "").split())) for i, t, *_ in rows)
    total, by = sum(r.size for r in out), {}
    for r in out:
        assert 0 <= r.copies <= 2
        s = by.setdefault(r.source, [r.target, r.source_size, 0, 0, 0])
        s[2] += r.copies * r.size
        s[3] += r.size
        s[4] = max(s[4], r.size)
    order = sorted((s for s in by if s is not None), key=lambda s: [ord(c) for c in s]) + [None]
    weight, cap, target = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}, {s: 2 * by[s][3] for s in order}, {}
    left, free = 1.5 * total, set(order)
    while True:
        unit = left / sum(weight[s] for s in free)
        over = {s for s in free if unit * weight[s] > cap[s]}
        if not over:
            break
        for s in over:
            target[s] = float(cap[s])
            left -= cap[s]
        free -= over
    target |= {s: unit * weight[s] for s in free}
    for s, (t, size, taken, seen, largest) in by.items():
        assert size == seen and t == pytest.approx(target[s]) and abs(taken - t) <= largest
    again = mixing.copies(docs.repartition(7)).collect()
    assert sorted((r.doc_id, r.copies) for r in out) == sorted((r.doc_id, r.copies) for r in again)
    mixed = mixing.mix_documents(docs)
    assert mixed.columns == docs.columns and mixed.count() == sum(r.copies for r in out)


def test_outliers(spark):
    rnd = random.Random(4)
    vocab = [f"w{chr(97 + i % 26)}{i}" for i in range(400)]
    rows = [(i, " ".join(rnd.choice(vocab) for _ in range(rnd.randrange(40, 300))), rnd.choice(["en", "de", None]), rnd.choice(["s", None])) for i in range(600)]
    odd = [(1000, " ".join(rnd.choice(vocab) + "###" for _ in range(200)), "en", "s"), (1001, "\n".join([" ".join(vocab[:5])] * 2 + [v for v in vocab]), "en", "s")]
    edge = [(2000, None, "en", "s"), (2001, "", None, None), (2002, "a b c", "en", "s"), (2003, "x y " * 50, "en", "s"), (2004, "q " * 20000, "zz", "zz")]
    out = {r.doc_id: r for r in outliers.judge(documents(spark, rows + odd + edge)).collect()}
    for i, t, *_ in rows + odd + edge:
        w = WORD.findall(t or "")
        wins = [tuple(w[k:k + 8]) for k in range(len(w) - 7)]
        seen, hit = Counter(wins), [0] * len(w)
        for k, x in enumerate(wins):
            if seen[x] > 1:
                hit[k:k + 8] = [1] * 8
        lines = [x for x in (t or "").split("\n") if WORD.search(x)]
        r = out[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == \
            (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), sum(hit)), i
        assert r.base_failed == (len(w) < 20 or 100 * sum(hit) > 30 * len(w))
        assert not (r.base_failed and r.kept)
    assert not out[1000].kept and not out[1000].base_failed
    assert all(out[i].kept for i, *_ in rows)
    docs = documents(spark, rows + odd + edge)
    kept = outliers.filter_documents(docs)
    assert kept.columns == docs.columns and kept.count() == sum(r.kept for r in out.values())


def test_classifiers_on_edge_cases(spark):
    rnd = random.Random(6)
    vocab = [f"plain{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(400):
        bad = i % 4 == 0
        w = [rnd.choice(vocab) for _ in range(60)]
        if bad:
            for _ in range(4):
                w[rnd.randrange(60)] = rnd.choice(["nastyword", "uglyness", "vileness"]) + rnd.choice(["", "es", "ing"])
        rows.append((i, " ".join(w)))
        labels.append((i, 0 if bad else 1, 1 if bad else 0))
    rows += [(900, None), (901, ""), (902, "word " * 40000), (903, rows[0][1]), (903, rows[0][1])]
    labels += [(901, None, None), (7, 1, 0), (950, 1, 0)]
    docs, lab = documents(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    for out in (toxicity.toxicity(docs, lab), bytecnn.quality(docs, lab)):
        got = out.collect()
        assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
        assert len({r.score for r in got if r.doc_id == 903}) == 1
    tox = {r.doc_id: r for r in toxicity.toxicity(docs, lab).collect()}
    right = [tox[i].predicted == (i % 4 == 0) for i in range(400) if tox[i].held_out]
    assert sum(right) / len(right) > 0.9
    assert [tox[i].held_out for i in range(20)] == [zlib.crc32(str(i).encode()) % 4 == 2 for i in range(20)]
    none = lab.filter("false")
    assert all(r.score < 0.01 for r in toxicity.toxicity(docs, none).collect())


def test_toxicity_reads_long_words_whole(monkeypatch):
    rnd = random.Random(8)
    plain, bad = ["meadow", "window", "candle", "garden", "pebble"], ["nastyword", "uglyness"]
    docs = []
    for i in range(400):
        w = [rnd.choice(plain) for _ in range(30)]
        if i % 2:
            w[5:25] = [rnd.choice(bad) for _ in range(20)]
        docs.append((" ", "/", "\u3000")[i % 3].join(w).encode())
    model = toxicity.Scorer(*toxicity.fit(docs, np.array([i % 2 for i in range(400)])))
    for glue in ("/", "_", "\u00a0", "\u3000"):
        head = glue.join(plain * 4)
        worse, better = model.logits([(head + glue + glue.join(x * 10)).encode() for x in (bad, plain[:2])])
        assert worse > better + 0.1, glue
    assert all(len(w) <= toxicity.MEMO_BYTES for w in model.memo)
    ws = [b"a", b"word" * 50, "\u4e2d\u6587\u0130".encode() * 300, b"-", b"x" * 31, b"\xff" * 70, b"end"]
    of, rows = toxicity._bags(ws)
    for chars in (1, 30, 64, 10**6):
        monkeypatch.setattr(toxicity, "CHARS", chars)
        parts = list(toxicity.bags(ws))
        assert sorted(zip(of.tolist(), rows.tolist())) == sorted(x for a, b in parts for x in zip(a.tolist(), b.tolist()))
        assert max(len(a) for a, _ in parts) <= 4 * 3 * max(chars, 40) or chars == 10**6


def test_empty_tables(spark):
    docs = documents(spark, [(1, "x")]).filter("false")
    lab = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    vocab = vocabulary("word_bpe_49k.json")
    for out in (partenum.jaccard_components(docs), substring.digest(docs), treebpe.encode_documents(docs, vocab), mixing.digest(docs), outliers.judge(docs),
                idpack.digest(docs, vocabulary("byte_bpe_50k.json")), toxicity.toxicity(docs, lab), bytecnn.quality(docs, lab)):
        assert out.count() == 0


def test_longer_pieces_go_through_the_tree(spark, sf_small):
    """With the given leaf, the corpus' own words are joined from halves; long
    unsplit texts take several levels; all equal the library."""
    rnd = random.Random(4)
    enc = treebpe.TreeEncoder(vocabulary("word_bpe_49k.json"))
    given = [r.text for r in spark.read.parquet(f"{sf_small}/documents.parquet").select("text").collect()]
    for text in given:
        ids = enc.lib.encode(text or "", add_special_tokens=False).ids
        assert enc.encode(text or "") == np.array(ids, "<u4").tobytes()
        assert enc.decode(enc.encode(text or "")) == enc.lib.decode(ids, skip_special_tokens=False)
    assert enc.joins > 100
    for alphabet in ("ab", "aehinorst", "aaaab"):
        text = "".join(rnd.choice(alphabet) for _ in range(20_000))
        before = enc.joins
        assert enc.encode(text) == np.array(enc.lib.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        assert enc.joins - before > 1000


def test_a_hot_key_is_joined_by_broadcast(spark, monkeypatch):
    from pageops.llm import common

    monkeypatch.setattr(common, "HOT_KEYS", 4)
    left = spark.createDataFrame([(k % 7 if k % 2 else 0, k) for k in range(200)], "a int, b int")
    right = left.groupBy("a").agg(F.count("*").alias("m"), F.max("b").alias("top")).filter("a <> 5")
    got = sorted(map(tuple, common.spread_join(left, right, ["a"], "m", 200).collect()))
    assert got == sorted(map(tuple, left.join(right.drop("m"), "a").collect())) and got


def test_toxicity_scorer_is_the_plain_average():
    """Folded tables and memo against words, n-grams and averages one by one."""
    rnd = np.random.default_rng(2)
    score = rnd.normal(0, 1, toxicity.BUCKETS).astype(np.float32)
    ts = [b"", b"one", b"one two one", "\u00c9t\u00e9 bad,word BAD,WORD x".encode(), b" ".join(b"w%d" % (i % 9) for i in range(300)), b"y" * 90 + b" y"]

    def plain(t):
        total = weights = 0.0
        for w, n in Counter(t.split()).items():
            rows = [int(r) for _, part in toxicity.bags([w]) for r in part]
            weight = math.log(1 + n)
            total += weight * sum(float(score[r]) for r in rows) / len(rows)
            weights += weight
        return 0.25 + total / (weights + toxicity.PRIOR)

    scorer = toxicity.Scorer(score, 0.25)
    for _ in range(2):                                   # the second time from the memo
        assert np.allclose(scorer.logits(ts), [plain(t) for t in ts], atol=1e-6)


def _plain_net(p, text):
    """The byte network's logit, position by position."""
    b = bytecnn.padded(text)
    n = (len(b) - bytecnn.WIDTH + bytecnn.STRIDE) // bytecnn.STRIDE
    conv = np.array([p["emb"][b[i * bytecnn.STRIDE:i * bytecnn.STRIDE + bytecnn.WIDTH]].ravel() @ p["flt"] for i in range(n)])
    chunks = [conv[a:a + bytecnn.CHUNK].max(0) for a in range(0, n - bytecnn.HALF, bytecnn.HALF)]
    h = np.maximum(np.maximum(np.array(chunks) + p["fb"], 0) @ p["hid"] + p["hb"], 0)
    return float(np.concatenate([h.max(0), h.mean(0)]) @ p["out"] + p["ob"][0])


def test_byte_network_against_a_plain_pass_and_finite_differences():
    rnd = np.random.default_rng(5)
    net = bytecnn.Net()
    for k in net.p:
        net.p[k] = net.p[k].astype(np.float64) + (rnd.normal(0, 0.3, net.p[k].shape) if k in ("fb", "hb", "ob") else 0)
    texts_ = [b"", b"ab", bytes(rnd.integers(32, 127, 300).tolist()), bytes(rnd.integers(0, 256, 1500).tolist())]
    scorer = bytecnn.Scorer(net)
    for t in texts_:
        assert abs(scorer.text(t) - 1 / (1 + math.exp(-_plain_net(net.p, t)))) < 1e-4

    def loss(t, y):
        return math.log(1 + math.exp(-(1 if y else -1) * _plain_net(net.p, t))) * 0.7

    for t, y in zip(texts_[1:], (1.0, 0.0, 1.0)):
        grads = {k: np.zeros_like(v) for k, v in net.p.items()}
        net.train_one(bytecnn.padded(t), y, grads, 0.7)
        for k, v in net.p.items():
            strong = np.argsort(-np.abs(grads[k]).ravel())[:4]
            for at in [*strong.tolist(), *rnd.integers(0, v.size, 2).tolist()]:
                flat, eps = v.reshape(-1), 1e-6
                was = flat[at]
                flat[at] = was + eps
                up = loss(t, y)
                flat[at] = was - eps
                down = loss(t, y)
                flat[at] = was
                assert abs((up - down) / (2 * eps) - grads[k].reshape(-1)[at]) < 1e-4 * max(1, abs(grads[k]).max()), (k, at)


def test_training_sample_is_bounded_in_bytes(spark):
    docs = spark.createDataFrame([(i, "x" * (10 if i % 3 else 40)) for i in range(60)], "doc_id long, text string")
    labels = docs.select("doc_id", F.lit(1).alias("toxic"))
    got, y = toxicity.sample(docs, labels, "toxic", F.lit(True), 50, max_bytes=2000)
    assert len(got) == len(y) and {len(t) for t in got} == {10} and sum(map(len, got)) <= 2000 and len(got) >= 30
    got, _ = toxicity.sample(docs, labels, "toxic", F.lit(True), 50, max_bytes=1000)
    assert {len(t) for t in got} == {10}
    assert len(toxicity.sample(docs, labels, "toxic", F.lit(True), 50)[0]) == 50


def test_null_ids_in_the_mix_and_the_token_files(spark):
    rows = [(None, "a b c", "en", "x"), (None, "a b c", "en", "x"), (None, None, "en", None), (3, "d e", "en", "x"), (1, "f", "en", "y")]
    out = mixing.digest(documents(spark, rows)).collect()
    assert sorted(r.size for r in out) == [0, 1, 2, 3, 3] and sum(r.doc_id is None for r in out) == 3
    assert all(0 <= r.taken <= 2 * r.size for r in out)
    got = idpack.digest(documents(spark, rows), vocabulary("byte_bpe_50k.json")).orderBy("start").collect()
    assert [r.doc_id for r in got] == [None, None, None, 1, 3]                  # null ids come first
    assert [r.start for r in got] == [sum(x.n_tokens for x in got[:k]) for k in range(5)]


def test_labels_with_clashing_columns(spark):
    docs = documents(spark, [(i, ("bad awful nasty " if i % 2 else "fine good nice ") * (3 + i % 5)) for i in range(60)])
    labels = spark.createDataFrame([(i, i % 2, 1 - i % 2, "bad", "en", 1, 2, 3) for i in range(60)] + [(None, 1, 1, "t", "l", 1, 2, 3), (61, None, None, "t", "l", 1, 2, 3)],
                                   "doc_id long, toxic int, quality int, text string, lang string, _d int, _h int, score int")
    for out, name in ((toxicity.toxicity(docs, labels), "toxic"), (bytecnn.quality(docs, labels), "quality")):
        got = out.collect()
        assert out.columns[:4] == ["doc_id", "held_out", "score", "predicted"] and len(got) == 60, name
        right = sum(r.predicted == (r.doc_id % 2 if name == "toxic" else 1 - r.doc_id % 2) for r in got)
        assert right >= 55, (name, right)
