"""Element selection over HTML held in one column, without a parser.

One regex pass splits a page into tokens that tile it exactly: a tag, a run of
text, a lone ``<`` (text), or a whole comment / script / style element (not
text, not selectable).  Elements of one tag name are found by bracket matching
over the positions of its open and close tags.  The depth of each tag is a
prefix count; instead of a running window over exploded tokens (a shuffle of
every token by page), the prefix count is read off one native sort of the
merged open/close positions: for the i-th tag of the merged order that is the
k-th open, ``k + 1`` opens and ``i - k`` closes are at or before it.  Sorting
again by (level, position) puts each open right before its close.  Everything
is O(n log n) per page, stays in the row, and needs no exchange.

Elements whose end tag may be missing (``li``, ``p``, ``td`` ...) are found with
an element stack instead, folded over the page's structural tags
(``implied_elements``): a start tag ends what it must, up to a boundary, and an
end tag ends all that was opened inside.

Every array that a lambda body reads by index is bound with ``let`` first, so
it is computed once per row (Catalyst would otherwise inline a column that is
referenced once into the lambda body and recompute it per element).

Limits (pinned by tests): an unclosed element whose end tag is required nests
whatever follows; ``<x/>`` counts as an open tag; ``script`` and ``style``
elements cannot be selected.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .patterns import (ATTRIBUTE_RE, ATTRIBUTE_VALUE_RE, END_SCOPES, RAWTEXT, RAWTEXT_RE, RCDATA, RCDATA_RE, SCOPE,
                       START_ENDS, STRUCTURE, TOKEN_RE, VOID_ELEMENTS)

_NAME_RE = r"^<(/?[A-Za-z][^\s/>]*)"
# Same, but '' for script/style (those tokens are whole elements, never selected).
_ELEMENT_NAME_RE = r"^<(/?(?!(?i:script|style)(?:[\s/>]|$))[A-Za-z][^\s/>]*+)"
_CLASS_SPLIT_RE = r"[ \t\n\f\r]+"
#: Elements whose results are kept together while a fold runs.
_BLOCK = 256


def let(body: Callable[[Column], Column], **bound: Column) -> Column:
    """Evaluate each bound expression once per row and hand them to ``body``
    as fields of one struct (a lambda variable)."""
    packed = F.array(F.struct(*[c.alias(k) for k, c in bound.items()]))
    return F.get(F.transform(packed, body), 0)


def prefix_sums(numbers: Column) -> Column:
    """For each element of an array of ints the sum of those before it, folded
    by blocks (a fold copies its state at every step)."""
    def step(acc, x):
        return F.struct((acc["sum"] + x).alias("sum"), F.concat(acc["out"], F.array(acc["sum"])).alias("out"))

    def block(acc, b):
        inner = F.aggregate(b, F.struct(acc["sum"].alias("sum"), F.array().cast("array<bigint>").alias("out")), step)
        return let(lambda v: F.struct(v["s"]["sum"].alias("sum"), F.concat(acc["out"], F.array(v["s"]["out"])).alias("out")), s=inner)

    def body(v):
        n = F.size(v["x"])
        cut = F.transform(F.sequence(F.lit(0), F.floor((n - 1) / _BLOCK).cast("int")), lambda b: F.slice(v["x"], b * _BLOCK + 1, F.lit(_BLOCK)))
        start = F.struct(F.lit(0).cast("bigint").alias("sum"), F.array().cast("array<array<bigint>>").alias("out"))
        return F.when(n == 0, F.array().cast("array<bigint>")).otherwise(F.flatten(F.aggregate(cut, start, block)["out"]))

    return let(body, x=numbers.cast("array<bigint>"))


def page_tokens(html: Column) -> Column:
    """The page as tokens (tags, text runs, whole comment/script/style).  The open
    tag of an element that holds text only (``title``, ``textarea``, ``iframe``
    ...) and its content are one token; see ``open_tag`` and ``token_text``."""
    return F.regexp_extract_all(html, F.lit(TOKEN_RE), F.lit(0))


def open_tag(token: Column, tag: str) -> Column:
    """A token of the given name without the content that comes with it."""
    if tag in RCDATA:
        return F.regexp_extract(token, RCDATA_RE, 1)
    return F.regexp_extract(token, RAWTEXT_RE, 1) if tag in RAWTEXT else token


def token_text(token: Column, unescape: Callable[[Column], Column]) -> Column:
    """The text of a token, decoded: a run of text, or the content of an element
    that holds text only; '' for anything else."""
    start = F.lower(F.substring(token, 1, 3))
    rcdata, raw = ([f"<{n[:2]}" for n in names] for names in (RCDATA, RAWTEXT))
    return (F.when(is_text(token), unescape(token))
            .when(start.isin(rcdata), let(lambda v: unescape(v["t"]), t=F.regexp_extract(token, RCDATA_RE, 2)))
            .when(start.isin(raw), F.regexp_extract(token, RAWTEXT_RE, 2))
            .otherwise(F.lit("")))


def token_names(tokens: Column) -> Column:
    """Lower-cased tag name per token, '/'-prefixed for a close tag; '' for
    text, comments, declarations and whole script/style elements.  One regex
    call per tag token, none per text token."""
    return F.transform(tokens, lambda t: F.when(
        F.startswith(t, F.lit("<")), F.lower(F.regexp_extract(t, _ELEMENT_NAME_RE, 1))).otherwise(F.lit("")))


def is_text(token: Column) -> Column:
    return ~F.startswith(token, F.lit("<")) | (token == F.lit("<"))


def positions_of(names: Column, name: str) -> Column:
    """Indexes (ascending) of the tags whose name equals ``name``."""
    return F.array_compact(F.transform(names, lambda x, i: F.when(x == F.lit(name), i)))


def attr(tag: Column, name: str) -> Column:
    """Value of attribute ``name`` of one tag token; NULL when absent, '' when
    empty or valueless.  The first occurrence wins; names are case-insensitive.
    The tag's attributes are listed one match each, so their number is no limit;
    tags without the name in them skip that.  ``tag`` must be cheap to reference."""
    n = re.escape(name)
    rest = F.regexp_replace(tag, F.lit(r"^</?[A-Za-z][^\s/>]*+"), F.lit(""))
    mine = F.filter(F.regexp_extract_all(rest, F.lit(ATTRIBUTE_RE), F.lit(0)), lambda a: a.rlike(rf"(?is)^{n}(?:\s*+=.*)?$"))
    return F.when(tag.rlike(f"(?i){n}"), F.regexp_replace(F.get(mine, 0), F.lit(ATTRIBUTE_VALUE_RE), F.lit("$1$2$3")))


def has_class(tag: Column, cls: str) -> Column:
    """Class match as the HTML library does it: ``cls`` is one of the
    whitespace-separated classes, or equals the whole attribute value (so a
    multi-class selector matches that exact string)."""
    def body(v):
        tokens = F.split(F.btrim(v["value"], F.lit(" \t\n\f\r")), _CLASS_SPLIT_RE)
        return F.array_contains(tokens, F.lit(cls)) | (v["value"] == F.lit(cls))
    return let(body, value=F.coalesce(attr(tag, "class"), F.lit("")))


def elements(names: Column, n_tokens: Column, tag: str) -> Column:
    """All ``tag`` elements as ``array<struct<open:int, close:int, closed:boolean>>``
    sorted by ``open``; ``open``/``close`` index the tokens.  An element with
    no matching close runs to the end (``close = n_tokens``).
    ``names`` must be cheap to reference (an attribute or a bound variable)."""
    tag = tag.lower()
    opens = positions_of(names, tag)
    if tag in VOID_ELEMENTS:   # no content, no close tag
        return F.transform(opens, lambda p: F.struct(p.alias("open"), (p + 1).alias("close"),
                                                     F.lit(True).alias("closed")))
    closes = positions_of(names, "/" + tag)
    merged = F.sort_array(F.concat(
        F.transform(opens, lambda p, k: F.struct(p.alias("pos"), F.lit(1).alias("kind"), k.alias("k"))),
        F.transform(closes, lambda p, k: F.struct(p.alias("pos"), F.lit(-1).alias("kind"), k.alias("k"))),
    ))
    # Level of an open = depth after it; of a close = depth before it.
    by_level = F.sort_array(F.transform(merged, lambda m, i: F.struct(
        F.when(m["kind"] == 1, m["k"] * 2 + 1 - i).otherwise(i - m["k"] * 2).alias("lvl"),
        m["pos"].alias("pos"),
        m["kind"].alias("kind"),
    )))

    def body(v):
        lv = v["lv"]

        def pair(x, i):
            nxt = F.get(lv, i + 1)
            close = F.when(nxt["lvl"] == x["lvl"], nxt["pos"])
            return F.struct(
                x["pos"].alias("open"),
                F.coalesce(close, v["n"]).alias("close"),
                close.isNotNull().alias("closed"),
                x["kind"].alias("kind"),
            )

        paired = F.filter(F.transform(lv, pair), lambda e: e["kind"] == 1)
        return F.sort_array(F.transform(paired, lambda e: F.struct(e["open"], e["close"], e["closed"])))

    return let(body, lv=by_level, n=n_tokens)


#: Elements with an optional end tag.
IMPLIED = tuple(START_ENDS)
_SPAN = "struct<open:int,close:int>"


def _code(name: str) -> str:
    """The element's letter in the text that stands for the stack."""
    return chr(0x100 + STRUCTURE.index(name))


def _class(names) -> str:
    return "[^" + "".join(_code(n) for n in names) + "]*?" if names else ".*?"


def _program(tag: str) -> tuple[list[str], list[dict[str, str]]]:
    """Tags that act on the stack, and for each: the letter to ``push``; the
    pattern of what it ``pops`` (the top is first); a letter that this ``needs``
    in the stack; and the letter that, on ``top``, is popped alone ('': none)."""
    names, rules = [], []
    for n in dict.fromkeys((*STRUCTURE, *START_ENDS[tag])):
        ends = START_ENDS[tag].get(n)
        pops = needs = ""
        if ends is not None:
            pops = f"^{_class(set(ends[1]) - set(ends[0]))}[{''.join(map(_code, ends[0]))}]"
            if len(ends[0]) > 1:      # the farthest of them within reach
                pops = pops.replace("*?", "*")
            else:
                needs = _code(ends[0][0])
        names.append(n)
        rules.append({"push": _code(n) if n in STRUCTURE else "", "pops": pops, "needs": needs, "top": ""})
        if n in STRUCTURE:
            names.append("/" + n)
            rules.append({"push": "", "pops": f"^{_class(set(END_SCOPES.get(n, SCOPE)) - {n})}{_code(n)}", "needs": _code(n), "top": _code(n)})
    return names, rules


def implied_elements(names: Column, n_tokens: Column, tag: str) -> Column:
    """``elements`` for a tag whose end tag may be missing.

    A stack of the structural elements that are open, as a text of one letter
    each (top first) and their places, is folded over the structural tags.  What
    a tag ends is a prefix of that text, given by a pattern: up to the element it
    ends, unless a boundary comes before.  ``closed``: something ended it before
    the page's end.

    A fold copies its state at every step: ends are kept by blocks of tags, and a
    stack is as long as the page nests."""
    acting, rules = _program(tag)
    mine = _code(tag)
    # Constants as one literal each: hundreds of small ones take long to plan.
    program = F.from_json(F.lit(json.dumps(rules)), "array<struct<push:string,pops:string,needs:string,top:string>>")
    names_of = F.from_json(F.lit(json.dumps(acting)), "array<string>")
    empty = F.array().cast(f"array<{_SPAN}>")

    def spans(letters, places, close):
        return F.filter(F.transform(places, lambda p, i: F.when(
            F.substring(letters, i + 1, F.lit(1)) == mine, F.struct(p.alias("open"), close.alias("close")))), lambda x: x.isNotNull())

    def step(acc, t):
        def body(v):
            k = F.length(v["popped"])
            ended = F.when(F.contains(v["popped"], F.lit(mine)), F.concat(acc["ended"], spans(v["popped"], F.slice(acc["places"], F.lit(1), k), t["pos"]))).otherwise(acc["ended"])
            stays = F.when(k > 0, F.slice(acc["places"], k + 1, F.greatest(F.size(acc["places"]) - k, F.lit(0)))).otherwise(acc["places"])
            places = F.when(t["push"] != "", F.concat(F.array(t["pos"]), stays)).otherwise(stays)
            return F.struct(F.concat(t["push"], F.substr(acc["stack"], k + 1)).alias("stack"), places.alias("places"), ended.alias("ended"))

        # Well-formed markup never gets to the pattern.
        popped = (F.when((t["top"] != "") & F.startswith(acc["stack"], t["top"]), t["top"])
                  .when((t["pops"] == "") | ~F.contains(acc["stack"], t["needs"]), F.lit(""))
                  .otherwise(F.call_function("regexp_extract", acc["stack"], t["pops"], F.lit(0))))
        return let(body, popped=popped)

    def block(acc, b):
        start = F.struct(acc["stack"].alias("stack"), acc["places"].alias("places"), empty.alias("ended"))
        return let(lambda v: F.struct(v["s"]["stack"].alias("stack"), v["s"]["places"].alias("places"),
                                      F.concat(acc["ended"], F.array(v["s"]["ended"])).alias("ended")),
                   s=F.aggregate(b, start, step))

    def all_spans(v):
        left = spans(v["s"]["stack"], v["s"]["places"], v["n"])
        found = F.concat(F.transform(F.flatten(v["s"]["ended"]), lambda e: F.struct(e["open"], e["close"], F.lit(True).alias("closed"))),
                         F.transform(left, lambda e: F.struct(e["open"], e["close"], F.lit(False).alias("closed"))))
        return F.sort_array(found)

    def run(v):
        def blocks(w):
            cut = F.transform(F.sequence(F.lit(0), F.floor((F.size(w["tags"]) - 1) / _BLOCK).cast("int")), lambda b: F.slice(w["tags"], b * _BLOCK + 1, F.lit(_BLOCK)))
            start = F.struct(F.lit("").alias("stack"), F.array().cast("array<int>").alias("places"), F.array().cast(f"array<array<{_SPAN}>>").alias("ended"))
            return let(all_spans, s=F.aggregate(cut, start, block), n=v["n"])

        def tags(x, i):
            return let(lambda p: F.when(p["at"] > 0, let(lambda w: F.struct(i.alias("pos"), *[w["r"][c].alias(c) for c in ("push", "pops", "needs", "top")]),
                                                         r=F.element_at(v["program"], p["at"]))),
                       at=F.when(x.isin(acting), F.array_position(v["names"], x)).otherwise(0).cast("int"))

        found = F.filter(F.transform(names, tags), lambda t: t.isNotNull())
        none = F.array().cast("array<struct<open:int,close:int,closed:boolean>>")
        return F.when(F.array_contains(names, F.lit(tag)), let(blocks, tags=found)).otherwise(none)

    return let(run, n=n_tokens, program=program, names=names_of)


def select(names: Column, tokens: Column, n_tokens: Column, tag: str, cls: str | None) -> Column:
    """Elements matching ``tag`` and, when given, class token ``cls``.
    ``names`` and ``tokens`` must be cheap to reference."""
    els = (implied_elements if tag.lower() in IMPLIED else elements)(names, n_tokens, tag.lower())
    if cls is None:
        return els
    return F.filter(els, lambda e: has_class(open_tag(F.get(tokens, e["open"]), tag.lower()), cls))


def first_within(items: Column, cand_pos: Column, strict: bool) -> Column:
    """For each item (struct with ``open``/``close``; may be NULL), the index
    into ``cand_pos`` (ascending ints) of the first candidate with
    ``open <= pos < close`` (``open < pos`` when ``strict``), else NULL.

    One merged sort: the number of candidates sorted before an item is the
    index of its first candidate at or after it.  Ties put the item first
    (inclusive) or last (strict)."""
    item_rank = 1 if strict else 0
    cand_rank = 0 if strict else 1

    def body(v):
        # Items need not be in position order (missing ones are NULL): rank them first.
        ranked = F.sort_array(F.transform(v["items"], lambda x, k: F.struct(
            F.coalesce(x["open"], F.lit(-1)).alias("pos"), k.alias("k"))))
        merged = F.sort_array(F.concat(
            F.transform(ranked, lambda x, r: F.struct(
                x["pos"].alias("pos"), F.lit(item_rank).alias("tie"), r.alias("r"),
                x["k"].alias("k"), F.lit(True).alias("is_item"))),
            F.transform(v["cands"], lambda p, j: F.struct(
                p.alias("pos"), F.lit(cand_rank).alias("tie"), j.alias("r"),
                j.alias("k"), F.lit(False).alias("is_item"))),
        ))
        firsts = F.sort_array(F.transform(
            F.filter(F.transform(merged, lambda m, i: F.struct(
                m["k"].alias("k"), (i - m["r"]).alias("c"), m["is_item"].alias("is_item"))),
                lambda r: r["is_item"]),
            lambda r: F.struct(r["k"], r["c"]),
        ))

        def pick(r):
            it = F.get(v["items"], r["k"])
            pos = F.get(v["cands"], r["c"])
            return F.when(it.isNotNull() & (pos < it["close"]), r["c"])

        return F.transform(firsts, pick)

    return let(body, items=items, cands=cand_pos)


def inner_text(texts: Column, open_: Column, close: Column) -> Column:
    """The texts from token ``open`` (content that comes with a tag is its own
    token's) up to ``close``, as one; ``texts`` has each token's ``token_text``."""
    return F.array_join(F.slice(texts, open_ + 1, F.greatest(close - open_, F.lit(0))), "")
