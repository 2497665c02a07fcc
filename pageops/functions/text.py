"""Column expressions for text: Python-compatible strip, entity decoding,
markup cleaning and pattern extraction.  All JVM built-ins."""

from __future__ import annotations

import json
import zlib
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from .html import let, prefix_sums
from .patterns import STRIP_RE


def py_strip(col: Column) -> Column:
    """``str.strip()``: removes Unicode whitespace (U+3000, U+00A0, tabs,
    newlines ...) at both ends, not only U+0020 as ``trim`` does."""
    return F.regexp_replace(col, F.lit(STRIP_RE), F.lit(""))


# What may be a reference: a number, or the longest run that a name can be.
_REF_RE = r"&(?:#[0-9]++;?|#[xX][0-9a-fA-F]++;?|[A-Za-z][A-Za-z0-9]*+;?)"
_BUCKETS = 512


def _utf16(units: list[Column]) -> Column:
    return F.decode(F.unhex(F.concat(*[F.lpad(F.hex(u), 4, "0") for u in units])), "UTF-16BE")


@lru_cache(maxsize=None)
def _names_json() -> str:
    """The named references of HTML (the standard library's table), as a list
    of small maps: a name is in the one that its CRC-32 says."""
    from html.entities import html5
    table: list[dict[str, str]] = [{} for _ in range(_BUCKETS)]
    for name, text in html5.items():
        table[zlib.crc32(name.encode()) % _BUCKETS][name] = text
    return json.dumps(table)


@lru_cache(maxsize=None)
def _short_names_re() -> str:
    """The names that need no ``;``, longest first, at the start of a text."""
    from html.entities import html5
    short = sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n))
    return "^(" + "|".join(short) + ")"


@lru_cache(maxsize=None)
def _numbers_json() -> str:
    """Character numbers that stand for another text (as Python's ``html``):
    controls as in Windows-1252, and those that stand for nothing."""
    table = {0: "\ufffd", 13: "\r"}
    for cp in range(0x80, 0xA0):
        table[cp] = bytes([cp]).decode("cp1252", "ignore") or chr(cp)
    none = [*range(1, 9), 11, *range(14, 32), 127, *range(0xFDD0, 0xFDF0), *(p * 0x10000 + k for p in range(17) for k in (0xFFFE, 0xFFFF))]
    return json.dumps({str(k): v for k, v in {**dict.fromkeys(none, ""), **table}.items()})


def reference_names() -> Column:
    """The table of named references, a constant; bind it once and hand it to
    ``unescape_bound`` where that is called in several places."""
    return F.from_json(F.lit(_names_json()), "array<map<string,string>>")


def _ref_text(ref: Column, attribute: bool, names: Column) -> Column:
    """The text of one reference without its ``&``; what is none stays as found.
    ``ref`` must be cheap to reference."""
    def look_up(name: Column) -> Column:
        return F.element_at(F.get(names, (F.crc32(name.cast("binary")) % _BUCKETS).cast("int")), name)

    def by_prefix(v):
        # The longest name that needs no ';'; in an attribute, not before more of a word or '='.
        short = F.regexp_extract(v["ref"], _short_names_re(), 1)
        rest = F.substr(v["ref"], F.length(short) + 1)
        open_end = (short == "") | F.lit(attribute) & (rest != "")
        return F.when(open_end, F.concat(F.lit("&"), v["ref"])).otherwise(F.concat(look_up(short), rest))

    def by_number(v):
        cp = v["cp"]
        w = cp - 0x10000
        char = F.when(cp <= 0xFFFF, _utf16([cp])).otherwise(_utf16([F.floor(w / 1024) + 0xD800, F.pmod(w, F.lit(1024)) + 0xDC00]))
        other = F.element_at(F.from_json(F.lit(_numbers_json()), "map<string,string>"), cp.cast("string"))
        outside = (cp > 0x10FFFF) | cp.between(0xD800, 0xDFFF)
        special = (cp < 0xA0) & ((cp < 32) | (cp >= 127)) | (cp >= 0xFDD0)
        return F.when(outside, F.lit("\ufffd")).otherwise(F.coalesce(F.when(special, other), char))

    # Leading zeros say nothing; more than seven digits are beyond any code point.
    digits = F.regexp_extract(ref, r"^#[xX]?0*([0-9a-fA-F]*);?$", 1)
    cut = F.when(F.length(digits) > 7, F.lit("1114112")).otherwise(F.when(digits == "", F.lit("0")).otherwise(digits))
    hexed = F.substring(ref, 2, 1).isin("x", "X") & (F.length(digits) <= 7)
    cp = F.when(hexed, F.conv(cut, 16, 10)).otherwise(cut).cast("long")
    return (F.when(F.startswith(ref, F.lit("#")), let(by_number, cp=cp))
            .otherwise(F.coalesce(F.when(F.endswith(ref, F.lit(";")), look_up(ref)), let(by_prefix, ref=ref))))


def unescape_bound(s: Column, attribute: bool = False, names: Column | None = None) -> Column:
    """``unescape_entities`` for a cheap-to-reference ``s`` (a column or a
    lambda variable): it is read more than once."""
    if names is None:
        return let(lambda v: unescape_bound(s, attribute, v["names"]), names=reference_names())
    pattern = _REF_RE + ("=?" if attribute else "")

    def decoded(m):
        if not attribute:
            return _ref_text(m, False, names)
        # A name without ';' before '=' is no reference in an attribute.
        plain = F.endswith(m, F.lit("=")) & ~F.startswith(m, F.lit("#")) & ~F.endswith(m, F.lit(";="))
        tail = F.when(F.endswith(m, F.lit("=")), F.lit("=")).otherwise(F.lit(""))
        return F.when(plain, F.concat(F.lit("&"), m)).otherwise(
            let(lambda v: F.concat(_ref_text(v["ref"], True, names), v["tail"]), ref=F.rtrim(m, F.lit("=")), tail=tail))

    def join(v):
        return F.array_join(F.transform(v["pieces"], lambda p, i: F.concat(p, F.coalesce(F.get(v["texts"], i), F.lit("")))), "")

    refs = F.transform(F.regexp_extract_all(s, F.lit(pattern), F.lit(0)), lambda m: F.substr(m, F.lit(2)))
    joined = let(join, pieces=F.split(s, pattern, -1), texts=F.transform(refs, decoded))
    return F.when(F.contains(s, F.lit("&")), joined).otherwise(s)


def unescape_entities(col: Column) -> Column:
    """Decode the references of HTML in one pass (so ``&amp;#65;`` gives
    ``&#65;``, not ``A``), as Python's ``html.unescape``: all names, with the
    longest of those that need no ``;`` where it is missing, and numbers.  Work
    happens only when the text holds an ``&``."""
    return let(lambda v: unescape_bound(v["s"]), s=col)


def extract_all(text: Column, pattern: str, group: int = 0, needs: str | None = None,
                guard: str | None = None) -> Column:
    """All non-overlapping matches, left to right; NULL text gives NULL.

    ``needs`` is a literal every match contains (checked on the UTF-8 bytes,
    nearly free); ``guard`` a short regex every match contains, for when no
    selective literal exists (a regex test decodes the whole text first).
    Texts failing either skip the full pattern: same result, less work."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    cond = None
    if needs is not None:
        cond = F.contains(text, F.lit(needs))
    if guard is not None:
        g = text.rlike(guard)
        cond = g if cond is None else (cond & g)
    if cond is None:
        return found
    return F.when(cond, found).otherwise(F.when(text.isNotNull(), F.array().cast("array<string>")))


def match_spans(text: Column, pattern: str, group: int = 0, needs: str | None = None) -> Column:
    """All matches with their places: ``array<struct<start, end, value>>`` in
    characters from 0, of the whole match; ``value`` is the group's text.  Places
    are sums of the lengths of what lies between the matches (a split) and of
    the matches.  NULL text gives NULL."""
    def body(v):
        lengths = F.transform(v["found"], lambda m, i: F.char_length(m) + F.char_length(F.get(v["pieces"], i)))

        def spans(w):
            def one(m, i):
                start = F.get(w["before"], i) + F.char_length(F.get(v["pieces"], i))
                value = m if group == 0 else F.regexp_extract(m, pattern, group)
                return F.struct(start.cast("int").alias("start"), (start + F.char_length(m)).cast("int").alias("end"), value.alias("value"))
            return F.transform(v["found"], one)

        return let(spans, before=prefix_sums(lengths))

    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    spans = let(body, found=found, pieces=F.split(text, pattern, -1))
    if needs is None:
        return spans
    none = F.array().cast("array<struct<start:int,end:int,value:string>>")
    return F.when(F.contains(text, F.lit(needs)), spans).otherwise(F.when(text.isNotNull(), none))


def contains_any(col: Column, words) -> Column:
    """Unanchored, case-sensitive substring test against a fixed word list.
    A short list is an OR of ``contains``; a long one is one ``exists`` over a
    literal array (the plan stays small)."""
    words = list(words)
    if not words:
        return F.lit(False)
    if len(words) > 8:
        return F.exists(F.array(*[F.lit(w) for w in words]), lambda w: F.contains(col, w))
    cond = None
    for w in words:
        c = F.contains(col, F.lit(w))
        cond = c if cond is None else (cond | c)
    return cond
