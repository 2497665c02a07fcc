"""Link extraction: the numbered rules on a forum-shaped fixture, the stated
limits, and a cross-check against a stdlib html.parser oracle."""

import random
import time
from html import escape
from html.parser import HTMLParser

from pyspark.sql import functions as F

from pageops.functions import html as H
from pageops.functions import patterns as P
from pageops.functions.patterns import FORUM_EXCLUDED, FORUM_ITEM, FORUM_TITLE
from pageops.operators import links as L

from .fixtures import AUDIT_EXPECTED, INDEX_LINKS_EXPECTED, index_pages


def _links(spark, **kw):
    df = L.index_links(index_pages(spark), FORUM_ITEM, FORUM_TITLE, FORUM_EXCLUDED, **kw)
    return sorted(tuple(r) for r in df.collect())


def test_index_links_rules(spark):
    assert _links(spark) == sorted(INDEX_LINKS_EXPECTED)


def test_audit_counts(spark):
    df = L.link_audit(index_pages(spark), FORUM_ITEM, FORUM_TITLE, FORUM_EXCLUDED)
    got = {r["page_id"]: tuple(r)[1:] for r in df.collect()}
    assert got == AUDIT_EXPECTED


def test_extract_links_keeps_null_and_empty_href(spark):
    df = L.extract_links(index_pages(spark), FORUM_ITEM, FORUM_TITLE, FORUM_EXCLUDED)
    rows = {(r["page_id"], r["title"]): (r["link"], r["reason"]) for r in df.collect()}
    assert rows[(2, "(本文已被刪除) [someone]")] == (None, "no_link")
    assert rows[(2, "no href later")] == (None, "no_link")       # first anchor has no href
    assert rows[(2, "empty href")] == ("", "kept")
    assert rows[(4, "[公告] board rules")][1] == "excluded"
    assert rows[(4, "Re: [協尋] lost cat")][1] == "excluded"


def test_select_elements_class_tokens_and_nesting(spark):
    df = L.select_elements(index_pages(spark), FORUM_ITEM)
    per_page = {}
    for r in df.collect():
        per_page.setdefault(r["page_id"], []).append(r["item_pos"])
    # near-miss class, comment and script items are not selected; nested ones are
    assert per_page == {1: [1, 2, 3], 2: [1, 2, 3, 4], 3: [1, 2, 3], 4: [1, 2, 3, 4], 5: [1, 2, 3]}


def test_item_is_its_own_title(spark):
    pages = spark.createDataFrame(
        [(1, "u", "<ul><li><a href='/a'>A</a></li><li>B <a href=/b>b</a></li><li>none</li></ul>")],
        "page_id long, url string, html string")
    got = sorted(tuple(r) for r in L.index_links(pages, ("li", None), None, ()).collect())
    assert got == [(1, 1, "B b", "/b"), (1, 2, "A", "/a")]


def test_absolute_links(spark):
    html = ("<li><a href='/root'>r</a></li><li><a href='rel/x'>x</a></li><li><a href='//cdn.example.net/y'>y</a></li>"
            "<li><a href='https://other.example.com/z'>z</a></li><li><a href='?q=1'>q</a></li><li><a href='#f'>f</a></li>")
    pages = spark.createDataFrame([(1, "https://s.example.org/dir/page.html?x=1#top", html)],
                                  "page_id long, url string, html string")
    got = {r["link"]: r["abs_url"] for r in L.absolute_links(pages, ("li", None), None, ()).collect()}
    assert got == {
        "/root": "https://s.example.org/root",
        "rel/x": "https://s.example.org/dir/rel/x",
        "//cdn.example.net/y": "https://cdn.example.net/y",
        "https://other.example.com/z": "https://other.example.com/z",
        "?q=1": "https://s.example.org/dir/page.html?q=1",
        "#f": "https://s.example.org/dir/page.html?x=1#f",
    }


def test_reference_resolution_examples(spark):
    """RFC 3986, 5.4.1 and 5.4.2, and paths without dot segments."""
    base = "http://a/b/c/d;p?q"
    want = {"g:h": "g:h", "g": "http://a/b/c/g", "./g": "http://a/b/c/g", "g/": "http://a/b/c/g/", "/g": "http://a/g", "//g": "http://g", "?y": "http://a/b/c/d;p?y",
            "g?y": "http://a/b/c/g?y", "#s": "http://a/b/c/d;p?q#s", "g#s": "http://a/b/c/g#s", "g?y#s": "http://a/b/c/g?y#s", ";x": "http://a/b/c/;x",
            "g;x": "http://a/b/c/g;x", "g;x?y#s": "http://a/b/c/g;x?y#s", "": "http://a/b/c/d;p?q", ".": "http://a/b/c/", "./": "http://a/b/c/", "..": "http://a/b/",
            "../": "http://a/b/", "../g": "http://a/b/g", "../..": "http://a/", "../../": "http://a/", "../../g": "http://a/g",
            "../../../g": "http://a/g", "../../../../g": "http://a/g", "/./g": "http://a/g", "/../g": "http://a/g", "g.": "http://a/b/c/g.", ".g": "http://a/b/c/.g",
            "g..": "http://a/b/c/g..", "..g": "http://a/b/c/..g", "./../g": "http://a/b/g", "./g/.": "http://a/b/c/g/", "g/./h": "http://a/b/c/g/h",
            "g/../h": "http://a/b/c/h", "g;x=1/./y": "http://a/b/c/g;x=1/y", "g;x=1/../y": "http://a/b/c/y", "g?y/./x": "http://a/b/c/g?y/./x",
            "g?y/../x": "http://a/b/c/g?y/../x", "g#s/./x": "http://a/b/c/g#s/./x", "g#s/../x": "http://a/b/c/g#s/../x", "http:g": "http:g",
            "http://x/y/../z/./?q/../r": "http://x/z/?q/../r", "//h/a//../b": "http://h/a/b", "/a//b/../c": "http://a/a//c", "/.x/..y": "http://a/.x/..y"}
    df = spark.createDataFrame([(k, base) for k in want] + [(None, base), ("x", None), ("../x", "http://h")], "link string, url string")
    got = {(r[0], r[1]): r[2] for r in df.select("link", "url", L.absolutize(F.col("link"), F.col("url"))).collect()}
    assert {k: got[(k, base)] for k in want} == want
    assert got[(None, base)] is None and got[("x", None)] is None and got[("../x", "http://h")] == "http://h/x"


def test_distinct_links_counts_pages_once(spark):
    pages = spark.createDataFrame(
        [(1, "u", "<li><a href='/a'>a</a></li><li><a href='/a'>a2</a></li>"),
         (2, "u", "<li><a href='/a'>a</a></li><li><a href='/b'>b</a></li>")],
        "page_id long, url string, html string")
    got = sorted(tuple(r) for r in L.distinct_links(pages, ("li", None), None, ()).collect())
    assert got == [("/a", 2, 1), ("/b", 1, 2)]


def test_missing_end_tags_are_implied(spark):
    html = ("<ul><li><a href='/1'>one</a><li><a href='/2'>two</a><ul><li><a href='/3'>three</a></ul> more<li><a href='/4'>four</a></ul> after"
            "<li><div><a href='/5'>five</a><li><a href='/6'>six</a></div> late")
    pages = spark.createDataFrame([(1, "u", html)], "page_id long, url string, html string")
    got = [(r["title"], r["link"]) for r in L.extract_links(pages, ("li", None), None, ()).orderBy("item_pos").collect()]
    assert got == [("one", "/1"), ("twothree more", "/2"), ("three", "/3"), ("four", "/4"), ("five", "/5"), ("six late", "/6")]


def test_a_title_ends_with_its_item(spark):
    pages = spark.createDataFrame([(1, "u", "<div><p><b>one<p>two<p><b>three</div>four")], "page_id long, url string, html string")
    got = [(r["item_pos"], r["title"]) for r in L.extract_links(pages, ("p", None), ("b", None), ()).orderBy("item_pos").collect()]
    assert got == [(1, "one"), (3, "three")]


class _Stack(HTMLParser):
    """Texts of one kind of element by a plain element stack."""

    def __init__(self, wanted):
        super().__init__(convert_charrefs=True)
        self.wanted, self.stack, self.found = wanted, [], []

    def pop(self, names, scope, farthest):
        """Close up to the nearest (or farthest) of the names within scope."""
        hit = None
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] in names:
                hit = i
                if not farthest:
                    break
            elif self.stack[i][0] in scope:
                break
        if hit is not None:
            del self.stack[hit:]

    def handle_starttag(self, tag, attrs):
        if tag in P.START_ENDS[self.wanted]:
            names, scope = P.START_ENDS[self.wanted][tag]
            self.pop(names, scope, len(names) > 1)
        if tag in P.STRUCTURE:
            text = []
            self.stack.append((tag, text))
            if tag == self.wanted:
                self.found.append(text)

    def handle_endtag(self, tag):
        if tag in P.STRUCTURE:
            self.pop((tag,), P.END_SCOPES.get(tag, P.SCOPE), False)

    def handle_data(self, data):
        for _, text in self.stack:
            text.append(data)


def _soup(rng):
    names = ["ul", "ol", "li", "li", "p", "p", "div", "dl", "dt", "dd", "table", "tbody", "tr", "td", "td", "th", "select", "option", "optgroup",
             "span", "b", "h2", "hr", "section", "button"]
    parts = []
    for k in range(rng.randint(0, 60)):
        n = rng.choice(names)
        parts.append(f"</{n}>" if rng.random() < 0.35 and n != "hr" else f"<{n}>")
        if rng.random() < 0.7:
            parts.append(f"w{k} ")
    return "".join(parts)


def test_implied_ends_match_an_element_stack(spark):
    rng = random.Random(3)
    pages = [(i, "u", _soup(rng)) for i in range(150)]
    pages.append((150, "u", "<ul>" + "".join(f"<li>w{k} <p>x" for k in range(700)) + "</ul>end"))     # several blocks of tags
    df = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(4).cache()
    for tag in H.IMPLIED:
        got = {}
        for r in L.extract_links(df, (tag, None), None, ()).orderBy("page_id", "item_pos").collect():
            got.setdefault(r["page_id"], []).append(r["title"])
        for pid, _, html in pages:
            stack = _Stack(tag)
            stack.feed(html)
            stack.close()
            assert got.get(pid, []) == ["".join(t).strip() for t in stack.found], (tag, html)


def test_text_only_elements_hold_no_markup(spark):
    html = ("<title>a <li>no</li> &amp; <b>bold</b></title><li>one <textarea rows=2>x</li><li>&lt;y</textarea> two</li>"
            "<li>three <iframe src='/f'>p &amp; <li>q</iframe><noframes></noframes><noscript>n<a href='/s'>s</a></noscript></li><xmp><li></xmp>"
            "<li>four <TextArea>open <li>to the end")
    pages = spark.createDataFrame([(1, "u", html)], "page_id long, url string, html string")

    def titles(tag):
        return [(r["title"], r["link"]) for r in L.extract_links(pages, (tag, None), None, ()).orderBy("item_pos").collect()]

    assert titles("li") == [("one x</li><li><y two", None), ("three p &amp; <li>qns", "/s"), ("four open <li>to the end", None)]
    assert titles("title") == [("a <li>no</li> & <b>bold</b>", None)]
    assert titles("textarea") == [("x</li><li><y", None), ("open <li>to the end", None)]


def test_references_in_links_keep_query_parameters(spark):
    html = "<li><a href='/q?a=1&copy=2&amp=3&lt;x&copy&not'>&copy 1 &copy=2 &notit; &CounterClockwiseContourIntegral;</a></li>"
    pages = spark.createDataFrame([(1, "u", html)], "page_id long, url string, html string")
    r = L.extract_links(pages, ("li", None), None, ()).first()
    assert r["link"] == "/q?a=1&copy=2&amp=3<x©¬"
    assert r["title"] == "© 1 ©=2 ¬it; ∳"


def test_many_unclosed_titles_cost_no_more_than_the_page(spark):
    """Pages with 200 unclosed titles and a reference in each paragraph, against
    pages ten times as long: time grows with length, not with its square."""
    def seconds(paragraphs, pages):
        html = "<p><b>t &copy; x<p>" + "text &copy; more " * 20
        df = spark.createDataFrame([(i, "u", html * paragraphs) for i in range(pages)], "page_id long, url string, html string").coalesce(1).cache()
        df.count()
        best = 1e9
        for _ in range(3):
            t = time.perf_counter()
            out = L.link_audit(df, ("p", None), ("b", None), ()).agg(F.sum("dropped_no_link")).first()[0]
            best = min(best, time.perf_counter() - t)
        assert out == paragraphs * pages
        return best

    seconds(20, 20)
    assert seconds(2000, 4) < 4 * seconds(200, 40) + 1


# --- independent oracle: stdlib html.parser on well-formed pages ------------

class _Tree(HTMLParser):
    VOID = {"br", "img", "meta", "hr", "input", "link"}

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = {"tag": None, "attrs": {}, "children": []}
        self.stack = [self.root]

    def handle_starttag(self, tag, attrs):
        node = {"tag": tag, "attrs": dict(attrs), "children": []}
        self.stack[-1]["children"].append(node)
        if tag not in self.VOID:
            self.stack.append(node)

    def handle_endtag(self, tag):
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i]["tag"] == tag:
                del self.stack[i:]
                return

    def handle_data(self, data):
        self.stack[-1]["children"].append(data)


def _find_all(node, tag, cls):
    out = []
    for ch in node["children"]:
        if isinstance(ch, dict):
            classes = (ch["attrs"].get("class") or "").split()
            if ch["tag"] == tag and (cls is None or cls in classes):
                out.append(ch)
            out.extend(_find_all(ch, tag, cls))
    return out


def _text(node):
    return "".join(_text(c) if isinstance(c, dict) else c for c in node["children"])


def _oracle_links(html, item, title, words):
    tree = _Tree()
    tree.feed(html)
    tree.close()
    links = []
    for it in _find_all(tree.root, *item):
        holder = {"children": [it]}
        titles = _find_all(holder, *title)
        if not titles:
            continue
        t = titles[0]
        anchors = _find_all(t, "a", None)
        if not anchors or anchors[0]["attrs"].get("href") is None:
            continue
        text = _text(t).strip()
        if any(w in text for w in words):
            continue
        links.append((text, anchors[0]["attrs"]["href"].strip()))
    return list(reversed(links))


def _random_page(rng):
    words = ["alpha", "beta", "gamma", "[公告]", "delta", "東西", "x&y", "a<b"]
    parts = ["<html><body><div class='list'>"]
    for _ in range(rng.randint(0, 8)):
        cls = rng.choice(["r-ent", "r-ent hot", "r-entry", "other"])
        title = " ".join(escape(rng.choice(words), quote=False) for _ in range(rng.randint(1, 3)))
        anchor = rng.choice([
            f"<a href='/p/{rng.randint(1, 99)}.html'>{title}</a>",
            f"<a>{title}</a>",
            title,
            f"<b>{title}</b> <a href=\"/q?x=1&amp;y={rng.randint(1, 9)}\">more</a>",
        ])
        inner = f"<div class='title'>\n  {anchor}  \n</div>" if rng.random() > 0.1 else "<div class='meta'>m</div>"
        parts.append(f"<div class='{cls}'>{inner}<div class='meta'><span>date</span></div></div>")
    parts.append("</div></body></html>")
    return "".join(parts)


def test_matches_html_parser_oracle(spark):
    rng = random.Random(11)
    pages = [(i, "u", _random_page(rng)) for i in range(200)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {}
    for r in L.index_links(df, FORUM_ITEM, FORUM_TITLE, FORUM_EXCLUDED).collect():
        got.setdefault(r["page_id"], []).append((r["rank"], r["title"], r["link"]))
    for pid, _, html in pages:
        want = _oracle_links(html, FORUM_ITEM, FORUM_TITLE, FORUM_EXCLUDED)
        have = [(t, lk) for _, t, lk in sorted(got.get(pid, []))]
        assert have == want, (pid, html)


def test_link_plan_is_narrow_and_python_free(spark):
    df = L.index_links(index_pages(spark), FORUM_ITEM, FORUM_TITLE, FORUM_EXCLUDED)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    # the items expression is evaluated once: no inferred filter repeats it
    assert "Filter (size(" not in plan and "Filter size(" not in plan


def test_filter_on_output_reaches_scan(spark, sf_small):
    from __spark_entry__ import queries
    df = queries()["index_links"](spark, sf_small).where(F.col("page_id") < 10)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(page_id,10)" in plan


def test_many_excluded_words(spark):
    words = [f"w{i}x" for i in range(40)] + ["[公告]"]
    df = L.index_links(index_pages(spark), FORUM_ITEM, FORUM_TITLE, words)
    titles = {r["title"] for r in df.collect()}
    assert "[公告] board rules" not in titles and "[問卦] plain item" in titles


def _nested_loops(df):
    return df._jdf.queryExecution().executedPlan().toString().count("NestedLoop")


def test_word_table_matches_contains(spark, monkeypatch):
    rng = random.Random(8)
    letters = "abcé中😀 "
    titles = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 12))) for _ in range(400)] + [None, "", "a"]
    words = ["".join(rng.choice(letters) for _ in range(rng.choice([1, 2, 3, 4, 4, 5, 5, 6, 9]))) for _ in range(60)][4:] + [None, "", "zzzz"]
    links = spark.createDataFrame([(i, t, "x") for i, t in enumerate(titles)], "item_pos int, title string, word string").repartition(3)
    for size in (0, 3, 20, len(words)):
        table = spark.createDataFrame([(w,) for w in words[-size:] if size], "word string")
        want = {i for i, t in enumerate(titles) if not any(w and t and w in t for w in words[-size:] if size)}
        for bound in (0, 1000):
            monkeypatch.setattr(L, "ROWS_TO_BROADCAST", bound)
            out = L.without_words(links, table)
            assert out.columns == links.columns and _nested_loops(out) == 0
            assert {r["item_pos"] for r in out.collect()} == want, (size, bound)


def test_word_table_of_100000_words(spark):
    """As many words as a nested loop would compare each title with."""
    words = spark.range(100_000).select(F.format_string("w%05dq", "id").alias("word"))
    titles = spark.range(20_000).select(F.format_string("title %d of w%05dq and more", "id", (F.col("id") * 7) % 200_000).alias("title"), F.col("id").alias("item_pos"))
    out = L.without_words(titles, words)
    assert _nested_loops(out) == 0
    assert {r["item_pos"] for r in out.select("item_pos").collect()} == {i for i in range(20_000) if (i * 7) % 200_000 >= 100_000}


def test_multi_class_selector_matches_exact_attribute(spark):
    pages = spark.createDataFrame(
        [(1, "u", "<div class='r-ent hot'><a href='/1'>one</a></div><div class='hot r-ent'><a href='/2'>two</a></div>"
                  "<div class='r-ent'><a href='/3'>three</a></div>")],
        "page_id long, url string, html string")
    got = [r["open_tag"] for r in L.select_elements(pages, ("div", "r-ent hot")).collect()]
    assert got == ["<div class='r-ent hot'>"]
    assert L.select_elements(pages, ("div", "r-ent")).count() == 3


def _random_tree(rng, depth):
    """A well-formed random tree of divs/spans/anchors; classes drawn so that
    items, titles and near misses nest in each other."""
    if depth == 0 or rng.random() < 0.25:
        word = rng.choice(["alpha", "beta", "[公告] x", "gamma", "δ", "a&amp;b"])
        if rng.random() < 0.3:
            href = rng.choice(["/p/1", "/p/2", "", None])
            attr = "" if href is None else f" href='{href}'"
            return f"<a{attr}>{word}</a>"
        return word
    tag = rng.choice(["div", "div", "span"])
    cls = rng.choice(["r-ent", "title", "r-ent title", "r-entry", "other", None])
    open_ = f"<{tag}>" if cls is None else f"<{tag} class='{cls}'>"
    kids = "".join(_random_tree(rng, depth - 1) for _ in range(rng.randint(0, 4)))
    return f"{open_}{kids}</{tag}>"


def test_deep_nesting_matches_html_parser_oracle(spark):
    rng = random.Random(23)
    pages = [(i, "u", "<html><body>" + _random_tree(rng, 6) + "</body></html>") for i in range(300)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {}
    for r in L.index_links(df, FORUM_ITEM, FORUM_TITLE, FORUM_EXCLUDED).collect():
        got.setdefault(r["page_id"], []).append((r["rank"], r["title"], r["link"]))
    checked = 0
    for pid, _, html in pages:
        want = _oracle_links(html, FORUM_ITEM, FORUM_TITLE, FORUM_EXCLUDED)
        have = [(t, lk) for _, t, lk in sorted(got.get(pid, []))]
        assert have == want, (pid, html)
        checked += len(want)
    assert checked > 50


def test_limit_stray_less_than_in_text(spark):
    # '<' not followed by a letter, '/', '!' or '?' is text (as in HTML);
    # '<b' in running text starts a tag (a tree builder would do the same).
    pages = spark.createDataFrame(
        [(1, "u", "<ul><li><a href='/1'>1 < 2 and 3 <= 4</a></li><li><a href='/2'>x<y</a></li></ul>")],
        "page_id long, url string, html string")
    got = sorted(tuple(r) for r in L.index_links(pages, ("li", None), None, ()).collect())
    assert got == [(1, 1, "x", "/2"), (1, 2, "1 < 2 and 3 <= 4", "/1")]


def test_limit_self_closing_selected_tag_opens(spark):
    # '<li/>' counts as an open tag; the next item ends it.  A <span/> nests
    # what follows.
    pages = spark.createDataFrame(
        [(1, "u", "<ul><li/><li><a href='/1'>one</a></li></ul><span/><span>x</span> y")], "page_id long, url string, html string")
    rows = L.select_elements(pages, ("li", None)).collect()
    assert [r["open_tag"] for r in rows] == ["<li/>", "<li>"]
    assert [r["title"] for r in L.extract_links(pages, ("li", None), None, ()).orderBy("item_pos").collect()] == ["", "one"]
    assert [r["title"] for r in L.extract_links(pages, ("span", None), None, ()).orderBy("item_pos").collect()] == ["x y", "x"]


def test_void_elements_are_complete(spark):
    pages = spark.createDataFrame(
        [(1, "u", "<p><img src='/a.png' class='x'><img src='/b.png'/><br>text<img src=/c.png></p>")],
        "page_id long, url string, html string")
    tags = [r["open_tag"] for r in L.select_elements(pages, ("img", None)).collect()]
    assert tags == ["<img src='/a.png' class='x'>", "<img src='/b.png'/>", "<img src=/c.png>"]
    assert [r["open_tag"] for r in L.select_elements(pages, ("img", "x")).collect()] == ["<img src='/a.png' class='x'>"]


def test_numeric_references_decoded_before_keyword_filter(spark):
    html = ("<div class='r-ent'><div class='title'><a href='/1'>&#x5B;&#x516C;&#x544A;&#x5D; rules</a></div></div>"
            "<div class='r-ent'><div class='title'><a href='/2?a=1&#38;b=2'>caf&#233; &#x1F600;</a></div></div>")
    pages = spark.createDataFrame([(1, "u", html)], "page_id long, url string, html string")
    rows = {r["item_pos"]: (r["title"], r["link"], r["reason"])
            for r in L.extract_links(pages, FORUM_ITEM, FORUM_TITLE, FORUM_EXCLUDED).collect()}
    assert rows[1] == ("[公告] rules", "/1", "excluded")
    assert rows[2] == ("café 😀", "/2?a=1&b=2", "kept")
