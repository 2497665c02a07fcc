"""Column helpers against their Python counterparts."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pageops.functions.text import contains_any, py_strip, unescape_entities


def test_py_strip_property(spark):
    pieces = st.sampled_from([" ", "\t", "\n", "\r", "\x0b", "\x0c", "\x1c", "\x1f", "\x85", "\xa0",
                              " ", "　", "​", "a", "中", "é", "x y"])
    texts = st.lists(pieces, max_size=8).map("".join)

    @settings(max_examples=3, deadline=None)
    @given(st.lists(texts, min_size=40, max_size=80))
    def check(batch):
        df = spark.createDataFrame([(i, s) for i, s in enumerate(batch)], "i int, s string")
        got = {r["i"]: r["t"] for r in df.select("i", py_strip(F.col("s")).alias("t")).collect()}
        for i, s in enumerate(batch):
            assert got[i] == s.strip(), repr(s)

    check()


def test_unescape_matches_python(spark):
    """All names with and without ';', all special numbers, random texts."""
    import html
    import random
    from html.entities import html5
    rng = random.Random(4)
    names = list(html5)
    cases = ["&lt;b&gt;", "&amp;lt;", "&amp;#65;", "&#x1F600; smile", "no refs", "", "&bogus; stays", "&amp", "&#65", "&", "&;", "&#;", "&#x;", "&#" + "0" * 50 + "65;",
             "&#x" + "0" * 50 + "41;", "&#" + "9" * 60 + ";", "&notit; &notin; &notin", "&" + "a" * 5000, *(f"&{n}{x}" for n in names for x in ("", "x", " z"))]
    cases += [f"&#{i};" for i in (*range(300), 0xD7FF, 0xD800, 0xDFFF, 0xE000, 0xFDD0, 0xFDEF, 0xFFFE, 0xFFFF, 0x10000, 0x1FFFE, 0x10FFFF, 0x110000)]
    letters = "&#xX0123456789abcdefglt;amp copy notin =é<"
    cases += ["".join(rng.choice(letters) if rng.random() < 0.6 else rng.choice(["&", "&#", "&#x", "&" + rng.choice(names), ";"]) for _ in range(rng.randrange(1, 25)))
              for _ in range(2000)]
    df = spark.createDataFrame(list(enumerate(cases)), "i int, s string")
    got = {r["i"]: r["t"] for r in df.select("i", unescape_entities(F.col("s")).alias("t")).collect()}
    assert [(c, got[i]) for i, c in enumerate(cases) if got[i] != html.unescape(c)] == []
    assert spark.range(1).select(unescape_entities(F.lit(None).cast("string"))).first()[0] is None


def test_contains_any(spark):
    df = spark.createDataFrame([("[公告] x",), ("Re: [協尋] y",), ("plain",), (None,)], "t string")
    got = [r[0] for r in df.select(contains_any(F.col("t"), ["[公告]", "[協尋]"])).collect()]
    assert got == [True, True, False, None]
