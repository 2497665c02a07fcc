"""Synthetic fixtures (invented names, numbers and markup only)."""

from __future__ import annotations

from pyspark.sql import types as T

E3000 = "　"


def _item(title_html: str, cls: str = "r-ent", q: str = '"') -> str:
    return f'<div class={q}{cls}{q}><div class={q}title{q}>{title_html}</div></div>'


# page_id -> html.  Each page is a small forum index; comments name the case.
INDEX_PAGES = {
    1: (
        "<html><body>"
        + _item('<a href="/bbs/T/M.1.html">[問卦] plain item</a>')          # normal
        + _item('<a href="/bbs/T/M.2.html">two classes</a>', cls="r-ent hot")  # multi-class
        + _item('<a href="/bbs/T/M.3.html">near miss</a>', cls="r-entry")   # not selected
        + _item("<a href='/bbs/T/M.4.html'>single quotes</a>", q="'")      # single quotes
        + "<!-- " + _item('<a href="/bbs/T/M.5.html">commented</a>') + " -->"
        + "<script>var s='" + _item('<a href="/bbs/T/M.6.html">in script</a>') + "';</script>"
        + "</body></html>"
    ),
    2: (
        "<html><body>"
        + _item("(本文已被刪除) [someone]")                                   # deleted post: no anchor
        + _item('<a name="x">no href</a> <a href="/bbs/T/M.7.html">later</a>')  # first anchor lacks href
        + _item('<a href="">empty href</a>')                                # kept with ''
        + '<div class="r-ent"><div class="meta">no title here</div></div>'  # missing title
        + "</body></html>"
    ),
    3: (
        "<html><body>"
        + '<div class="r-ent title"><a href="/bbs/T/M.8.html">self titled</a> tail</div>'  # item is the title
        + '<div class="r-ent"><div class="title"><a href="/bbs/T/M.9.html">outer</a></div>'
        + _item('<a href="/bbs/T/M.10.html">inner</a>')                     # nested item
        + "</div>"
        + "</body></html>"
    ),
    4: (
        "<html><body>"
        + _item('<a href="/bbs/T/M.11.html">[公告] board rules</a>')         # excluded, at start
        + _item('<a href="/bbs/T/M.12.html">Re: [協尋] lost cat</a>')        # excluded, in the middle
        + _item(f'<a href="/bbs/T/M.13.html">\n{E3000} padded {E3000}\n</a>')  # Unicode padding
        + _item('<a href=" /bbs/T/M.14.html?a=1&amp;b=2 ">A &amp; B &lt;x&gt; &quot;q&quot; &#39;s&#39;</a>')
        + "</body></html>"
    ),
    5: (
        "<html><body>"
        + '<div class="r-ent" data-x="a>b"><div class="title"><a href="/bbs/T/M.15.html">gt in attr</a></div></div>'
        + '<DIV CLASS="r-ent"><DIV class="title"><A HREF="/bbs/T/M.16.html">upper case</A></DIV></DIV>'
        + '<div class="r-ent"><div class="title"><a href="/bbs/T/M.17.html">left open</a></div>'  # never closed
        + "</body></html>"
    ),
    6: "",     # empty page
    7: None,   # NULL html
}

# Expected (page_id, rank, title, link): newest first, ranks restart per page.
INDEX_LINKS_EXPECTED = [
    (1, 1, "single quotes", "/bbs/T/M.4.html"),
    (1, 2, "two classes", "/bbs/T/M.2.html"),
    (1, 3, "[問卦] plain item", "/bbs/T/M.1.html"),
    (2, 1, "empty href", ""),
    (3, 1, "inner", "/bbs/T/M.10.html"),
    (3, 2, "outer", "/bbs/T/M.9.html"),
    (3, 3, "self titled tail", "/bbs/T/M.8.html"),
    (4, 1, "A & B <x> \"q\" 's'", "/bbs/T/M.14.html?a=1&b=2"),
    (4, 2, "padded", "/bbs/T/M.13.html"),
    (5, 1, "left open", "/bbs/T/M.17.html"),
    (5, 2, "upper case", "/bbs/T/M.16.html"),
    (5, 3, "gt in attr", "/bbs/T/M.15.html"),
]

# Expected audit: page_id -> (total, kept, no_title, no_link, excluded)
AUDIT_EXPECTED = {
    1: (3, 3, 0, 0, 0),
    2: (4, 1, 1, 2, 0),
    3: (3, 3, 0, 0, 0),
    4: (4, 2, 0, 0, 2),
    5: (3, 3, 0, 0, 0),
    6: (0, 0, 0, 0, 0),
    7: (0, 0, 0, 0, 0),
}


PAGES_SCHEMA = T.StructType([
    T.StructField("page_id", T.LongType()),
    T.StructField("url", T.StringType()),
    T.StructField("html", T.StringType()),
])


def index_pages(spark):
    rows = [(pid, f"https://forum.example.org/bbs/T/index{pid}.html", html) for pid, html in INDEX_PAGES.items()]
    return spark.createDataFrame(rows, PAGES_SCHEMA)


# --- scan objects ----------------------------------------------------------
SCAN_JSON = {
    1: ('{"80": {"state": "open", "reason": "syn-ack", "name": "http", "product": "Example httpd",'
        ' "version": "", "extrainfo": "", "conf": "10", "cpe": "",'
        ' "script": {"http-title": "Welcome\\nhome", "http-server-header": "Example"}},'
        ' "22": {"state": "open", "reason": "syn-ack", "name": "ssh", "product": "Example sshd",'
        ' "version": "9.1", "extrainfo": "protocol 2.0", "conf": "10", "cpe": "cpe:/a:example:sshd:9.1",'
        ' "port": "9999", "script": {"ssh-hostkey": "\\n  256 aa:bb (ED25519)"}}}'),
    2: ('{"443": {"state": "open", "name": "https", "script": {}},'
        ' "25": {"state": "filtered", "name": "smtp", "product": "Pöstfach ✉"},'
        ' "443": {"state": "closed", "name": "https-alt", "script": {"x": "y"}}}'),
    3: '{"8080": {"state": "open"',                # malformed
    4: '{"21": "not an object"}',                   # wrong value type
    5: "{}",                                        # empty object
    6: None,                                        # NULL
    7: '[1, 2, 3]',                                 # not an object
}
SCAN_SCHEMA = T.StructType([T.StructField("scan_id", T.LongType()), T.StructField("body", T.StringType())])

# (scan_id, pos, port, state, name, product)
RECORDS_EXPECTED = [
    (1, 0, "80", "open", "http", "Example httpd"),
    (1, 1, "22", "open", "ssh", "Example sshd"),
    (2, 0, "443", "closed", "https-alt", None),
    (2, 1, "25", "filtered", "smtp", "Pöstfach ✉"),
]


def scans(spark):
    return spark.createDataFrame(list(SCAN_JSON.items()), SCAN_SCHEMA)


# --- contact text ----------------------------------------------------------
CONTACT_TEXT = {
    1: "Night shiftjdoe7702-23456789#3910Glass and clay",           # login digits glued to phone
    2: "Workshopmlee02-23456789\n#3911Old maps",                  # newline before extension
    3: "Librarykwan02-2345678 kwan@lab.example.edu.tw#3912Bridges",  # seven digits; email then ext
    4: "Harbourpchen0223456789 nothing here",                         # dashless: no phone
    5: "two a.b@x.example.org and c_d@y.example.com on a line",
    6: "North gaterwu02-23456789 rwu@lab.example.org\n#3913Tides",  # email and newline before ext
    7: "call +1 (555) 010-2030 or +1 (555) 010-4050",
    8: "no entity at all",
    9: "",
    10: None,
}
EMAILS_EXPECTED = [
    (3, 0, "kwan@lab.example.edu.tw"),
    (5, 0, "a.b@x.example.org"),
    (5, 1, "c_d@y.example.com"),
    (6, 0, "rwu@lab.example.org"),
]
PHONES_EXPECTED = [
    (1, 0, "02-23456789"),
    (2, 0, "02-23456789"),
    (3, 0, "02-2345678"),
    (6, 0, "02-23456789"),
    (7, 0, "+1 (555) 010-2030"),
    (7, 1, "+1 (555) 010-4050"),
]
EXTENSIONS_EXPECTED = [(1, 0, "3910"), (2, 0, "3911"), (3, 0, "3912"), (6, 0, "3913")]
DOC_SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])


def contact_docs(spark):
    return spark.createDataFrame(list(CONTACT_TEXT.items()), DOC_SCHEMA)


# --- attempts --------------------------------------------------------------
ATTEMPT_STRINGS = [
    "50", "abc", "4.2", "4e1", "1_000", "１２", "٣٤", " 42\n", "　42　", "+7", "-3", "", None,
    "1" * 40, "0000000000000000000000000000000000000000000042", "1__0", "_1", "0x1f", " 12", "1 2",
]
