"""Link extraction from a page corpus (items, titles, links, filters, order).

All per-page work is done inside the page row (see ``functions.html``), so the
page-to-links query is one narrow stage: scan, project, explode.  No exchange,
no Python.  Only ``distinct_links`` groups across pages, with a partial
aggregate before its single shuffle.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import html as H
from ..functions.patterns import FORUM_EXCLUDED
from ..functions.text import contains_any, py_strip, reference_names, unescape_bound
from ..session import scratch_path

Selector = tuple[str, str | None]

REASONS = ("kept", "no_title", "no_link", "excluded")


def _with_page(html, body, references=None):
    """Bind the page's tokens, their tag names, their count and, given the table
    of references, each token's decoded text once and pass them to ``body`` as
    fields of two structs."""
    def bind(v):
        more = {}
        if references is not None:
            more["texts"] = F.transform(v["tokens"], lambda t: H.token_text(t, lambda x: unescape_bound(x, names=references)))
        return H.let(lambda w: body(v, w), names=H.token_names(v["tokens"]), n=F.size(v["tokens"]), **more)

    return H.let(bind, tokens=H.page_tokens(html))


def element_open_tags(html, item: Selector = ("li", None)):
    """Column: the open tag of every element matching ``item``, in document order."""
    def body(v, w):
        els = H.select(w["names"], v["tokens"], w["n"], item[0], item[1])
        return F.transform(els, lambda e: H.open_tag(F.get(v["tokens"], e["open"]), item[0].lower()))
    return _with_page(html, body)


def select_elements(pages: DataFrame, item: Selector = ("li", None), *,
                    id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """A2: every element matching ``item`` (tag, class token), in document
    order.  Rows ``(page_id, item_pos, open_tag)``; ``item_pos`` counts from 1
    per page.  Nested matches are items of their own."""
    per_page = pages.select(id_col, _built(("open_tags", html_col, tuple(item)),
                                           lambda: element_open_tags(F.col(html_col), item)).alias("_t"))
    return (per_page.select(id_col, F.posexplode_outer("_t").alias("_p", "open_tag"))
            .where(F.col("_p").isNotNull())
            .select(id_col, (F.col("_p") + 1).cast("int").alias("item_pos"), "open_tag"))


def items_column(html, item: Selector = ("li", None), title: Selector | None = None,
                 keywords: Iterable[str] = FORUM_EXCLUDED):
    """Column ``array<struct<item_pos, title, link, reason>>`` for one page.

    Per item: the first title element at or inside the item (A3), its text
    with entities decoded and Unicode whitespace stripped; the ``href`` of the
    first anchor inside that title (A4), NULL when the anchor or the attribute
    is missing.  ``reason`` is ``no_title`` (no title element), ``no_link``
    (A5), ``excluded`` (A6: title contains a keyword) or ``kept``."""
    keywords = list(keywords)
    same = title is None or tuple(title) == tuple(item)

    def body(v, w):
        items = H.select(w["names"], v["tokens"], w["n"], item[0], item[1])
        anchors = H.positions_of(w["names"], "a")

        def with_titles(x):
            def extract(z):
                def one(it, j):
                    tl = F.get(x["titles"], j)
                    # What is inside an item ends with it.
                    text = H.inner_text(w["texts"], tl["open"], F.least(tl["close"], it["close"]))
                    a_pos = F.get(x["anchors"], F.get(z["aidx"], j))
                    href = H.attr(F.get(v["tokens"], a_pos), "href")
                    return F.struct(
                        (j + 1).alias("item_pos"),
                        F.when(tl.isNotNull(), text).alias("title"),
                        href.alias("raw_link"),
                    )
                return F.transform(x["items"], one)
            return H.let(extract, aidx=H.first_within(x["titles"], x["anchors"], strict=True))

        if same:   # bind the elements once; titles are the same lambda variable
            return H.let(lambda y: with_titles({"items": y["items"], "titles": y["items"], "anchors": y["anchors"]}),
                         items=items, anchors=anchors)

        def pick_titles(y):
            idx = H.first_within(y["items"], F.transform(y["tels"], lambda e: e["open"]), strict=False)
            return H.let(lambda t: with_titles({"items": y["items"], "titles": t["titles"], "anchors": y["anchors"]}),
                         titles=F.transform(idx, lambda i: F.get(y["tels"], i)))

        tels = H.select(w["names"], v["tokens"], w["n"], title[0], title[1])
        return H.let(pick_titles, items=items, anchors=anchors, tels=tels)

    # Raw links are fields of an array of structs here, so the decoder may
    # read them more than once without recomputing them.
    def decoded(n):
        def decode(r):
            return F.struct(r["item_pos"],
                            py_strip(r["title"]).alias("title"),
                            py_strip(unescape_bound(r["raw_link"], attribute=True, names=n["names"])).alias("link"))
        return F.transform(_with_page(html, body, n["names"]), decode)

    def classify(x):
        reason = (F.when(x["title"].isNull(), F.lit("no_title"))
                  .when(x["link"].isNull(), F.lit("no_link"))
                  .when(contains_any(x["title"], keywords), F.lit("excluded"))
                  .otherwise(F.lit("kept")))
        return F.struct(x["item_pos"], x["title"], x["link"], reason.alias("reason"))

    return F.transform(H.let(decoded, names=reference_names()), classify)


_BUILT: dict = {}


def _built(key: tuple, build):
    """A large column expression, built once per process and key: every node
    is a py4j call to build, while the built (unresolved) expression can be
    reused by any number of DataFrames."""
    from pyspark import SparkContext
    key = (id(SparkContext._gateway), *key)
    if key not in _BUILT:
        if len(_BUILT) >= 256:       # bounded: drop the oldest entry
            _BUILT.pop(next(iter(_BUILT)))
        _BUILT[key] = build()
    return _BUILT[key]


def _items_for(html_col: str, item: Selector, title: Selector | None, keywords: Iterable[str]):
    keywords = tuple(keywords)
    key = ("items", html_col, tuple(item), None if title is None else tuple(title), keywords)
    return _built(key, lambda: items_column(F.col(html_col), item, title, keywords))


def page_items(pages: DataFrame, item: Selector = ("li", None), title: Selector | None = None,
               keywords: Iterable[str] = FORUM_EXCLUDED, *,
               id_col: str = "page_id", html_col: str = "html",
               keep: Sequence[str] = ()) -> DataFrame:
    """Per page ``(page_id, *keep, items)``; see ``items_column``.  ``title=None``
    means the item is its own title element."""
    return pages.select(id_col, *keep, _items_for(html_col, item, title, keywords).alias("items"))


def extract_links(pages: DataFrame, item: Selector = ("li", None), title: Selector | None = None,
                  keywords: Iterable[str] = FORUM_EXCLUDED, *, id_col: str = "page_id",
                  html_col: str = "html") -> DataFrame:
    """One row per selected item with a title element:
    ``(page_id, item_pos, title, link, reason)``; ``link`` may be NULL."""
    items = page_items(pages, item, title, keywords, id_col=id_col, html_col=html_col)
    return (items.select(id_col, F.inline_outer("items"))
            .where(F.col("reason") != "no_title")
            .select(id_col, F.col("item_pos").cast("int").alias("item_pos"), "title", "link", "reason"))


def filter_links(links: DataFrame) -> DataFrame:
    """Keep items with a link whose title holds no excluded word."""
    return links.where(F.col("reason") == "kept").drop("reason")


#: Side of a join up to this many (counted) rows is broadcast.
ROWS_TO_BROADCAST = 1_000_000
_GRAM = 3


def _kept(df: DataFrame, name: str) -> DataFrame:
    """Written to the shared folder and read back: counted and used from there."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= ROWS_TO_BROADCAST else df


def _grams(text, sizes: Sequence[int]):
    """The distinct stretches of the given lengths in a text."""
    return F.array_distinct(F.concat(*[F.when(F.char_length(text) >= n, F.transform(
        F.sequence(F.lit(1), F.char_length(text) - (n - 1)), lambda i: F.substring(text, i, F.lit(n)))).otherwise(F.array().cast("array<string>")) for n in sizes]))


def texts_with_words(texts: DataFrame, words: DataFrame, text_col: str = "title", word_col: str = "word") -> DataFrame:
    """The distinct texts that contain at least one of the words (unanchored and
    case-sensitive), without comparing each with each.

    A word is indexed by the rarest of its trigrams (rare in the texts; shorter
    words by themselves).  Texts meet words on trigrams, by an equi-join; only
    these pairs are compared.  Words with a trigram that is in no text drop out.
    Null or empty texts and words match nothing."""
    spark = texts.sparkSession
    some = _kept(texts.select(F.col(text_col).alias("text")).where(F.length(text_col) > 0).distinct(), "texts")
    every = _kept(words.select(F.col(word_col).alias("word")).where(F.length(word_col) > 0).distinct(), "words")
    length = F.least(F.char_length("word"), F.lit(_GRAM))
    sizes = sorted(r[0] for r in every.select(length.alias("n")).distinct().collect())        # 1 to 3
    if not sizes:
        return spark.createDataFrame([], f"`{text_col}` string")
    of_words = _kept(every.select("word", F.explode(F.when(length < _GRAM, F.array("word")).otherwise(_grams(F.col("word"), [_GRAM]))).alias("gram")), "word-grams")
    wanted = _small(_kept(of_words.select("gram").distinct(), "grams"))
    of_texts = some.select("text", F.explode(_grams(F.col("text"), sizes)).alias("gram")).join(wanted, "gram", "left_semi")
    found = of_texts.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    rarest = of_words.join(found, "gram", "left").groupBy("word").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram")).alias("key"))
    index = _small(_kept(rarest.where("key.n > 0").select("word", "key.gram"), "word-index"))
    met = of_texts.join(index, "gram").where(F.contains("text", F.col("word")))
    return met.select(F.col("text").alias(text_col)).distinct()


def without_words(links: DataFrame, words: DataFrame, title_col: str = "title", word_col: str = "word") -> DataFrame:
    """A6 for a table of words of any size: rows whose title holds none of them."""
    hit = _kept(texts_with_words(links, words, title_col, word_col), "excluded")
    return links.join(_small(hit), title_col, "left_anti").select(*links.columns)


def index_links(pages: DataFrame, item: Selector = ("li", None), title: Selector | None = None,
                keywords: Iterable[str] = FORUM_EXCLUDED, *, id_col: str = "page_id",
                html_col: str = "html") -> DataFrame:
    """A9 (with A8): the kept ``(title, link)`` pairs of each page, newest
    first: the last item on the page gets ``rank`` 1.  Ranks restart per page.

    The reversal is done on the page's own item array, so no window and no
    shuffle is needed."""
    items = page_items(pages, item, title, keywords, id_col=id_col, html_col=html_col)
    kept = items.select(id_col, F.reverse(F.filter("items", lambda x: x["reason"] == "kept")).alias("_k"))
    return kept.select(id_col, F.posexplode_outer("_k").alias("_p", "_x")).where(F.col("_p").isNotNull()).select(
        id_col,
        (F.col("_p") + 1).cast("int").alias("rank"),
        F.col("_x")["title"].alias("title"),
        F.col("_x")["link"].alias("link"),
    )


def link_audit(pages: DataFrame, item: Selector = ("li", None), title: Selector | None = None,
               keywords: Iterable[str] = FORUM_EXCLUDED, *, id_col: str = "page_id",
               html_col: str = "html") -> DataFrame:
    """Per page, how many items were selected, kept, and dropped for
    each reason.  Counted inside the page row: no shuffle."""
    items = page_items(pages, item, title, keywords, id_col=id_col, html_col=html_col)

    # size() of NULL is -1 under the legacy setting; test for NULL explicitly
    def count(arr):
        return F.when(F.col("items").isNull(), F.lit(0)).otherwise(F.size(arr)).cast("long")

    def n(reason):
        return count(F.filter("items", lambda x: x["reason"] == reason))

    return items.select(
        id_col,
        count(F.col("items")).alias("total"),
        n("kept").alias("kept"),
        n("no_title").alias("dropped_no_title"),
        n("no_link").alias("dropped_no_link"),
        n("excluded").alias("dropped_excluded"),
    )


def base_of(url):
    """``scheme://authority`` of an absolute URL column, NULL otherwise."""
    b = F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    return F.when(b != "", b)


def url_parts(page_url):
    """Per page, once: ``struct<base, scheme, no_frag, no_query, directory>``
    of an absolute URL (``base`` NULL when the URL is not absolute)."""
    no_frag = F.regexp_replace(page_url, r"#.*$", "")
    no_query = F.regexp_replace(no_frag, r"\?.*$", "")
    path = F.regexp_extract(no_query, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/.*)?$", 1)
    directory = F.regexp_replace(path, r"[^/]*$", "")
    return F.struct(
        base_of(page_url).alias("base"),
        F.regexp_extract(page_url, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1).alias("scheme"),
        no_frag.alias("no_frag"),
        no_query.alias("no_query"),
        F.when(directory == "", F.lit("/")).otherwise(directory).alias("directory"),
    )


def remove_dot_segments(url):
    """``.`` and ``..`` segments taken out of the path of an absolute URL (RFC
    3986, 5.2.4): a stack of segments, folded in the row.  URLs without such
    segments, or without an authority, stay as they are."""
    def body(v):
        segments = F.split(F.regexp_extract(v["url"], _URL_PATH_RE, 2), "/")

        def step(acc, s):
            return (F.when(s == ".", acc)
                    .when(s == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0))))
                    .otherwise(F.concat(acc, F.array(s))))

        def path(w):
            last = F.element_at(w["segments"], -1)
            # After a dot segment at the end the path is a folder.
            end = F.when(last.isin(".", "..") & (F.size(w["kept"]) > 0), F.lit("/")).otherwise(F.lit(""))
            return F.concat(F.regexp_extract(v["url"], _URL_PATH_RE, 1), F.lit("/"), F.array_join(w["kept"], "/"), end, F.regexp_extract(v["url"], _URL_PATH_RE, 3))

        kept = F.aggregate(segments, F.array().cast("array<string>"), step)
        return F.when(F.contains(v["url"], F.lit("/.")), H.let(path, segments=segments, kept=kept)).otherwise(v["url"])

    # A match needs a path, so a URL without one is left alone.
    dotted = F.when(url.rlike(_DOT_SEGMENT_RE), H.let(body, url=url))
    return F.coalesce(dotted, url)


_URL_PATH_RE = r"(?s)^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)/([^?#]*)(.*)$"
_DOT_SEGMENT_RE = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(?:/[^/?#]*)*?/\.\.?(?:[/?#]|$)"


def absolutize_parts(link, u):
    """A11 with the page URL already split (``url_parts``); ``link`` and ``u``
    must be cheap to reference (columns)."""
    return H.let(lambda v: remove_dot_segments(v["url"]), url=_joined_url(link, u))


def _joined_url(link, u):
    return (
        F.when(link.isNull() | u["base"].isNull(), F.lit(None).cast("string"))
        .when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), link)
        .when(link.startswith("//"), F.concat(u["scheme"], F.lit(":"), link))
        .when(link.startswith("/"), F.concat(u["base"], link))
        .when(link == "", u["no_frag"])
        .when(link.startswith("?"), F.concat(u["no_query"], link))
        .when(link.startswith("#"), F.concat(u["no_frag"], link))
        .otherwise(F.concat(u["base"], u["directory"], link))
    )


def absolutize(link, page_url):
    """Resolve a link against the page URL.

    Absolute links stay; ``//host/x`` takes the page's scheme; ``/x`` the
    page's scheme and authority; ``?q`` the page path; ``#f`` the page URL
    without its fragment; anything else is relative to the page's directory.
    Dot segments are resolved, also those of absolute links."""
    return absolutize_parts(link, url_parts(page_url))


def absolute_links(pages: DataFrame, item: Selector = ("li", None), title: Selector | None = None,
                   keywords: Iterable[str] = FORUM_EXCLUDED, *, id_col: str = "page_id",
                   html_col: str = "html", url_col: str = "url") -> DataFrame:
    """A11 over every item with a link: ``(page_id, item_pos, link, abs_url)``.
    The page URL rides along in the page row, so no join back to pages."""
    items = page_items(pages, item, title, keywords, id_col=id_col, html_col=html_col, keep=[url_col])
    # URL parts are computed once per page row, before the explode
    links = (items.select(id_col, url_parts(F.col(url_col)).alias("_u"), F.inline_outer("items"))
             .where((F.col("reason") != "no_title") & F.col("link").isNotNull()))
    return links.select(id_col, F.col("item_pos").cast("int").alias("item_pos"), "link",
                        absolutize_parts(F.col("link"), F.col("_u")).alias("abs_url"))


def distinct_links(pages: DataFrame, item: Selector = ("li", None), title: Selector | None = None,
                   keywords: Iterable[str] = FORUM_EXCLUDED, *, id_col: str = "page_id",
                   html_col: str = "html", kept_only: bool = True) -> DataFrame:
    """B4 over links: each distinct link, on how many pages it occurs and the
    first such page.  Duplicates within a page collapse inside the page row
    (``array_distinct``), and count/min are partial aggregates, so there is one
    shuffle and a link found on a third of all pages still ships at most one
    row per map partition."""
    items = page_items(pages, item, title, keywords, id_col=id_col, html_col=html_col)
    wanted = (lambda x: x["reason"] == "kept") if kept_only else (
        lambda x: (x["reason"] != "no_title") & x["link"].isNotNull())
    per_page = items.select(id_col, F.explode_outer(F.array_distinct(
        F.transform(F.filter("items", wanted), lambda x: x["link"]))).alias("link")).where(F.col("link").isNotNull())
    return per_page.groupBy("link").agg(
        F.count(F.lit(1)).alias("n_pages"), F.min(id_col).alias("first_page"))
