"""Fixed values.

Everything in this module is a constant that results depend on.  Regexes are
Java's; the oracles have their own.
"""

# --- fixed values: forum index defaults -----------------------------------
# Item, title and anchor selectors of the forum index page.
FORUM_ITEM = ("div", "r-ent")
FORUM_TITLE = ("div", "title")
# Titles holding either tag are dropped (announcements, search requests).
FORUM_EXCLUDED = ("[公告]", "[協尋]")

# --- fixed values: markup -------------------------------------------------
# One pass over a page: a whole comment / script / style element, a tag, a run
# of text, or a lone '<' (text).  The tokens tile the page exactly.  In a tag, a
# quote counts only after '=' (so a stray one is harmless) and hides '>' there;
# an unclosed tag takes the rest of the page once.  Repeats are possessive: Java
# runs them in a loop, not by recursion, so no tag is too long.
_IN_TAG = r"""(?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+'|))*+"""
TOKEN_RE = (
    r"(?is)<(?:!--.*?(?:-->|\z)"
    r"|(title|textarea|xmp|iframe|noembed|noframes)(?=[\s/>])" + _IN_TAG + r">.*?(?=</\1(?=[\s/>])|\z)"
    r"|script(?=[\s/>])" + _IN_TAG + r">.*?(?:</script(?=[\s/>])[^>]*+>|\z)"
    r"|style(?=[\s/>])" + _IN_TAG + r">.*?(?:</style(?=[\s/>])[^>]*+>|\z)"
    r"|/?[a-z]" + _IN_TAG + r"(?:>|\z)|[!?][^>]*+(?:>|\z))"
    r"|[^<]++|<"
)
# Elements whose content is text (HTML standard): references count in the first
# kind, nothing does in the second.  Their open tag and content are one match;
# groups: the open tag, the content.
RCDATA = ("title", "textarea")
RAWTEXT = ("xmp", "iframe", "noembed", "noframes")
RCDATA_RE = rf"(?is)^(<(?:{'|'.join(RCDATA)})(?=[\s/>])" + _IN_TAG + r">)(.*)$"
RAWTEXT_RE = rf"(?is)^(<(?:{'|'.join(RAWTEXT)})(?=[\s/>])" + _IN_TAG + r">)(.*)$"
# One attribute of a tag, after the tag's name; and a pattern that keeps its value.
ATTRIBUTE_RE = r"""(?s)[^\s/>=]++(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+))?+"""
ATTRIBUTE_VALUE_RE = r"""(?s)^[^=]*+(?:=\s*+(?:"(.*)"|'(.*)'|(.*)))?$"""
# HTML void elements (HTML standard): an open tag is the whole element.
VOID_ELEMENTS = ("area", "base", "br", "col", "embed", "hr", "img", "input",
                 "link", "meta", "source", "track", "wbr")
# Elements that structure a page (HTML standard, the "special" ones that have
# content, and those that hold options).
STRUCTURE = (
    "address", "applet", "article", "aside", "blockquote", "body", "button", "caption", "center", "datalist", "dd",
    "details", "dir", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4",
    "h5", "h6", "header", "hgroup", "html", "li", "listing", "main", "marquee", "menu", "nav", "object", "ol",
    "optgroup", "option", "p", "pre", "search", "section", "select", "summary", "table", "tbody", "td", "template",
    "tfoot", "th", "thead", "tr", "ul",
)
# Scopes (HTML standard): an end tag doesn't reach beyond these elements.
SCOPE = ("applet", "caption", "html", "table", "td", "th", "marquee", "object", "template")
LIST_SCOPE = (*SCOPE, "ol", "ul", "menu", "dir")
BUTTON_SCOPE = (*SCOPE, "button")
TABLE_SCOPE = ("html", "table", "template")
SELECT_SCOPE = ("select", "datalist")
# Elements whose end tag may be missing (HTML standard, optional tags): the
# start tags that end each, which elements these end, and how far they reach.
_CELLS, _GROUPS = ("td", "th"), ("tbody", "thead", "tfoot")
_P_ENDS = ("address", "article", "aside", "blockquote", "center", "details", "dialog", "dir", "div", "dl", "fieldset",
           "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "main",
           "menu", "nav", "ol", "p", "pre", "search", "section", "summary", "table", "ul", "li", "dd", "dt")
_ITEM_STOPS = tuple(n for n in STRUCTURE if n not in ("address", "div", "p"))
START_ENDS = {
    "li": {"li": (("li",), _ITEM_STOPS)},
    "dt": {n: (("dt", "dd"), _ITEM_STOPS) for n in ("dt", "dd")},
    "p": {n: (("p",), BUTTON_SCOPE) for n in _P_ENDS},
    "option": {**{n: (("option",), SELECT_SCOPE) for n in ("option", "hr")}, "optgroup": (("option", "optgroup"), SELECT_SCOPE)},
    "tr": {**{n: (_CELLS, (*TABLE_SCOPE, "tr")) for n in _CELLS}, "tr": ((*_CELLS, "tr"), TABLE_SCOPE),
           **{n: ((*_CELLS, "tr", *_GROUPS), TABLE_SCOPE) for n in _GROUPS}},
}
START_ENDS |= {"dd": START_ENDS["dt"], "optgroup": START_ENDS["option"], **{n: START_ENDS["tr"] for n in (*_CELLS, *_GROUPS)}}
# The scope of an end tag, where it isn't SCOPE.
END_SCOPES = {"li": LIST_SCOPE, "p": BUTTON_SCOPE, "option": SELECT_SCOPE, "optgroup": SELECT_SCOPE, "select": (), "datalist": (),
              **{n: TABLE_SCOPE for n in ("table", "tr", *_CELLS, *_GROUPS, "caption")}, "html": (), "body": ("html",)}
# Characters Python's str.strip() removes: Unicode White_Space plus U+001C..U+001F.
STRIP_RE = r"(?U)^[\s\x1c-\x1f]++|(?<![\s\x1c-\x1f])[\s\x1c-\x1f]++$"

# --- fixed values: contact entities ---------------------------------------
EMAIL_RE = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
# Either '+1 (ddd) ddd-dddd' or an area code of two digits, a dash and seven or
# eight digits; glued to a login ending in digits, the last two digits before
# the dash start the match.
PHONE_RE = r"\+\d{1,3} \(\d{3}\) \d{3}-\d{4}|\d{2}-\d{7,8}"
# Office extension: '#' and four digits; the value is the digits (group 1).
EXTENSION_RE = r"#(\d{4})"
# Neighbours are given as ASCII: what \\b takes for a letter depends on the Java version.
IPV4_RE = r"(?<![0-9A-Za-z_])(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)(?:\.(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)){3}(?![0-9A-Za-z_])"
# Pre-checks.  A literal every match contains (a byte search), and for IPv4,
# where the only literal ('.') is in nearly every text, a short regex instead.
EMAIL_NEEDS = "@"
PHONE_NEEDS = "-"
EXTENSION_NEEDS = "#"
IPV4_GUARD = r"\d\.\d"
# kind -> (pattern, group, literal every match contains)
ENTITY_PATTERNS = {
    "email": (EMAIL_RE, 0, EMAIL_NEEDS),
    "phone": (PHONE_RE, 0, PHONE_NEEDS),
    "extension": (EXTENSION_RE, 1, EXTENSION_NEEDS),
}

# --- fixed values: validated numbers --------------------------------------
# What Python int() accepts: optional Unicode space, a sign, decimal digits of
# any script with single underscores between them, optional Unicode space.
# int() spaces are Unicode White_Space, which is Java's (?U)\s; unlike
# str.strip() it does not take U+001C..U+001F.
INT_GUARD_RE = r"(?U)^\s*+[+-]?\p{Nd}++(?:_\p{Nd}++)*+\s*+$"
INT_NOISE_RE = r"(?U)[_\s]"
# The game's closed range; a guess must lie strictly inside the live bracket.
LOWEST = 1
HIGHEST = 100
