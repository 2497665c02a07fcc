"""Registered queries over the corpus tables, and their DuckDB oracles.

Each query is ``(spark, root) -> DataFrame`` over whole tables.  Each oracle is
an independent SQL formulation (regexes instead of element matching, a
recursive fold instead of the prefix scan) with the same column names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.patterns import HIGHEST, LOWEST
from ..operators import entities as E
from ..operators import links as L
from ..operators import numbers as N
from ..operators import records as R
from ..session import scratch_path
from ..sources.tables import read_table, write_table

# Selectors and words used on the corpus pages: items are list entries, each
# is its own title element; titles holding either word are dropped.
ITEM = ("li", None)
WORDS = ("the", "ou")
TARGET_SEED = 7

Query = Callable[[SparkSession, str], DataFrame]


def _pages(spark, root):
    return read_table(spark, root, "pages")


def _documents(spark, root):
    return read_table(spark, root, "documents")


def _events(spark, root):
    return read_table(spark, root, "events")


def attempts_from_events(events: DataFrame) -> DataFrame:
    """Attempts per user: an error event's value as text (never an integer),
    otherwise ``props.k``; the user's target is drawn per user (D6)."""
    raw = (F.when(F.col("event_type") == "error", F.col("value").cast("string"))
           .otherwise(F.get_json_object("props", "$.k")))
    return events.select("user_id", "ts", "event_id", raw.alias("raw"),
                         N.draw_in_range(F.col("user_id"), LOWEST, HIGHEST, TARGET_SEED).alias("target"))


def q_page_items(spark, root):
    return L.select_elements(_pages(spark, root), ITEM)


def q_page_links(spark, root):
    return L.extract_links(_pages(spark, root), ITEM, None, WORDS).drop("reason")


def q_links_filtered(spark, root):
    return L.filter_links(L.extract_links(_pages(spark, root), ITEM, None, WORDS))


def q_index_links(spark, root):
    return L.index_links(_pages(spark, root), ITEM, None, WORDS)


def q_links_absolute(spark, root):
    return L.absolute_links(_pages(spark, root), ITEM, None, WORDS)


def q_link_audit(spark, root):
    return L.link_audit(_pages(spark, root), ITEM, None, WORDS)


def q_distinct_links(spark, root):
    return L.distinct_links(_pages(spark, root), ITEM, None, WORDS, kept_only=False)


def q_class_items(spark, root):
    """Class-token selection on the corpus: each ``div.ad`` is its own title."""
    return L.extract_links(_pages(spark, root), ("div", "ad"), None, ())


def q_nav_first_links(spark, root):
    """Distinct item and title selectors: per list, its first entry's text and link."""
    return L.extract_links(_pages(spark, root), ("ul", None), ("li", None), ())


def q_keyed_flatten(spark, root):
    ev = _events(spark, root)
    parsed = ev.select("event_id", R.parse_keyed(F.col("props"), "string").alias("m"))
    return R.flatten_keyed(parsed, "event_id", "m", key_name="key")


def q_props_routing(spark, root):
    ev = _events(spark, root)
    return ev.select("event_id", R.routing_status(F.col("props"), "bigint").alias("status"))


def q_records_json(spark, root):
    ev = _events(spark, root)
    rec = F.struct("event_id", "user_id", "event_type",
                   R.parse_keyed(F.col("props"), "bigint").alias("props"))
    return ev.select("event_id", R.to_json_text(rec).alias("json"))


def q_distinct_addresses(spark, root):
    return E.distinct_addresses(_documents(spark, root))


def q_extract_emails(spark, root):
    return E.extract_emails(_documents(spark, root))


def q_extract_phones(spark, root):
    return E.extract_phones(_documents(spark, root))


def q_extract_extensions(spark, root):
    return E.extract_extensions(_documents(spark, root))


def q_contact_entities(spark, root):
    return E.extract_entities(_documents(spark, root))


def q_entity_index(spark, root):
    return E.entity_index(_documents(spark, root))


def q_validated_numbers(spark, root):
    att = attempts_from_events(_events(spark, root))
    v = N.validate(att, "raw")
    return v.select("event_id", "raw", F.col("value").cast("string").alias("value"), "reason")


def q_rejected_attempts(spark, root):
    att = attempts_from_events(_events(spark, root))
    _, rejected = N.quarantine(att, "raw")
    return rejected.select("event_id", "user_id", "raw", "reason")


def q_user_targets(spark, root):
    ev = _events(spark, root).select("user_id").distinct()
    return ev.select("user_id", N.draw_in_range(F.col("user_id"), LOWEST, HIGHEST, TARGET_SEED).alias("target"))


def _user_history(spark, root):
    """By user and day, so that a task holds one day of one user."""
    att = attempts_from_events(_events(spark, root))
    return N.bracket_history(att, "user_id", ["ts", "event_id"], bucket=F.date_trunc("day", "ts"))


def q_bracket_history(spark, root):
    h = _user_history(spark, root)
    return h.select("user_id", "event_id", "seq", "lo", "hi", "outcome")


def q_bracket_summary(spark, root):
    return N.bracket_summary(_user_history(spark, root), "user_id")


QUERIES: dict[str, Query] = {
    "page_items": q_page_items,
    "page_links": q_page_links,
    "links_filtered": q_links_filtered,
    "index_links": q_index_links,
    "links_absolute": q_links_absolute,
    "link_audit": q_link_audit,
    "distinct_links": q_distinct_links,
    "class_items": q_class_items,
    "nav_first_links": q_nav_first_links,
    "keyed_flatten": q_keyed_flatten,
    "records_json": q_records_json,
    "props_routing": q_props_routing,
    "distinct_addresses": q_distinct_addresses,
    "extract_emails": q_extract_emails,
    "extract_phones": q_extract_phones,
    "extract_extensions": q_extract_extensions,
    "contact_entities": q_contact_entities,
    "entity_index": q_entity_index,
    "validated_numbers": q_validated_numbers,
    "rejected_attempts": q_rejected_attempts,
    "user_targets": q_user_targets,
    "bracket_history": q_bracket_history,
    "bracket_summary": q_bracket_summary,
}


# ---------------------------------------------------------------------------
# DuckDB oracles.  Pages there hold list entries that never nest, so an entry
# is a regex match from '<li ...>' to the next '</li>'.

def _sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


_CLEAN = r"(?s)<!--.*?(-->|$)|<script[^>]*>.*?(</script\s*>|$)|<style[^>]*>.*?(</style\s*>|$)"
_LI = r"(?s)<li(\s[^>]*)?>.*?</li\s*>"

_ITEMS_CTE = f"""
li_pages AS (
  SELECT page_id, url, regexp_extract_all(regexp_replace(html, {_sql_str(_CLEAN)}, '', 'g'), {_sql_str(_LI)}) AS lis
  FROM pages
),
li_items AS (
  SELECT page_id, url, CAST(i AS INTEGER) AS item_pos, lis[i] AS li
  FROM (SELECT page_id, url, lis, unnest(range(1, len(lis) + 1)) AS i FROM li_pages)
),
li_parsed AS (
  SELECT page_id, url, item_pos, li,
    regexp_replace(
      replace(replace(replace(replace(replace(replace(
        regexp_replace(li, '<[^>]*>', '', 'g'),
        '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&nbsp;', chr(160)), '&amp;', '&'),
      '^\\s+|\\s+$', '', 'g') AS title,
    CASE WHEN regexp_matches(li, '<a\\s[^>]*href\\s*=\\s*"')
      THEN regexp_replace(
        replace(replace(replace(replace(replace(replace(
          regexp_extract(li, '<a\\s[^>]*?href\\s*=\\s*"([^"]*)"', 1),
          '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&nbsp;', chr(160)), '&amp;', '&'),
        '^\\s+|\\s+$', '', 'g') END AS link
  FROM li_items
),
li_classified AS (
  SELECT *, CASE WHEN link IS NULL THEN 'no_link'
                 WHEN contains(title, 'the') OR contains(title, 'ou') THEN 'excluded'
                 ELSE 'kept' END AS reason
  FROM li_parsed
)"""

_ATTEMPTS_CTE = f"""
attempts AS (
  SELECT user_id, ts, event_id,
    CASE WHEN event_type = 'error' THEN CAST(value AS VARCHAR) ELSE json_extract_string(props, '$.k') END AS raw,
    CAST({LOWEST} + (
      (((user_id % 4294967296) + 4294967296) % 4294967296 * CAST(2654435761 AS HUGEINT) + {TARGET_SEED})
      % 4294967296 * {HIGHEST - LOWEST + 1} // 4294967296) AS BIGINT) AS target
  FROM events
),
checked AS (
  SELECT *, coalesce(regexp_full_match(raw, '\\s*[+-]?[0-9]+(_[0-9]+)*\\s*'), false) AS fmt_ok,
    CASE WHEN regexp_full_match(raw, '\\s*[+-]?[0-9]+(_[0-9]+)*\\s*')
      THEN TRY_CAST(replace(trim(raw), '_', '') AS DECIMAL(38,0)) END AS val,
    row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS seq
  FROM attempts
)"""

_FOLD_CTE = f"""
fold(user_id, seq, event_id, val, target, lo, hi, outcome) AS (
  SELECT user_id, seq, event_id, val, target, CAST({LOWEST} AS BIGINT), CAST({HIGHEST} AS BIGINT),
    CASE WHEN NOT fmt_ok THEN 'format'
         WHEN val IS NULL OR val <= {LOWEST} OR val >= {HIGHEST} THEN 'range'
         WHEN val = target THEN 'hit' WHEN val < target THEN 'low' ELSE 'high' END
  FROM checked WHERE seq = 1
  UNION ALL
  SELECT c.user_id, c.seq, c.event_id, c.val, c.target, n.lo, n.hi,
    CASE WHEN NOT c.fmt_ok THEN 'format'
         WHEN c.val IS NULL OR c.val <= n.lo OR c.val >= n.hi THEN 'range'
         WHEN c.val = c.target THEN 'hit' WHEN c.val < c.target THEN 'low' ELSE 'high' END
  FROM fold f
  JOIN checked c ON c.user_id = f.user_id AND c.seq = f.seq + 1
  CROSS JOIN LATERAL (SELECT
      CASE WHEN f.outcome = 'low' THEN CAST(f.val AS BIGINT) ELSE f.lo END AS lo,
      CASE WHEN f.outcome = 'high' THEN CAST(f.val AS BIGINT) ELSE f.hi END AS hi) n
  WHERE f.outcome <> 'hit'
)"""


# The oracles' own statement of the entity patterns, for RE2.
EMAIL_RE = r"[[:alnum:]._%+-]+@[[:alnum:].-]+[.][[:alpha:]]{2,}"
PHONE_RE = r"[+][0-9]{1,3} [(][0-9]{3}[)] [0-9]{3}-[0-9]{4}|[0-9]{2}-[0-9]{7,8}"
_OCTET = "(?:[0-9]|[1-9][0-9]|1[0-9][0-9]|2[0-4][0-9]|25[0-5])"
IPV4_RE = rf"\b{_OCTET}[.]{_OCTET}[.]{_OCTET}[.]{_OCTET}\b"


def _entities_sql(pattern: str, col: str, group: int = 0) -> str:
    return f"""
SELECT doc_id, CAST(i - 1 AS INTEGER) AS pos, m[i] AS {col}
FROM (SELECT doc_id, m, unnest(range(1, len(m) + 1)) AS i
      FROM (SELECT doc_id, regexp_extract_all(text, {_sql_str(pattern)}, {group}) AS m FROM documents))"""


ORACLES: dict[str, str] = {
    "page_items": f"""WITH {_ITEMS_CTE}
SELECT page_id, item_pos, regexp_extract(li, '^<li[^>]*>', 0) AS open_tag FROM li_items""",
    "page_links": f"""WITH {_ITEMS_CTE}
SELECT page_id, item_pos, title, link FROM li_classified""",
    "links_filtered": f"""WITH {_ITEMS_CTE}
SELECT page_id, item_pos, title, link FROM li_classified WHERE reason = 'kept'""",
    "index_links": f"""WITH {_ITEMS_CTE}
SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY item_pos DESC) AS INTEGER) AS rank,
       title, link
FROM li_classified WHERE reason = 'kept'""",
    "links_absolute": f"""WITH {_ITEMS_CTE},
based AS (
  SELECT page_id, item_pos, link, url,
    nullif(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1), '') AS base,
    regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*):', 1) AS scheme,
    regexp_replace(url, '#.*$', '') AS no_frag
  FROM li_classified WHERE link IS NOT NULL
)
SELECT page_id, item_pos, link,
  CASE WHEN base IS NULL THEN NULL
       WHEN regexp_matches(link, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN link
       WHEN starts_with(link, '//') THEN scheme || ':' || link
       WHEN starts_with(link, '/') THEN base || link
       WHEN link = '' THEN no_frag
       WHEN starts_with(link, '?') THEN regexp_replace(no_frag, '\\?.*$', '') || link
       WHEN starts_with(link, '#') THEN no_frag || link
       ELSE base || coalesce(nullif(regexp_replace(
              regexp_extract(regexp_replace(no_frag, '\\?.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/.*)?$', 1),
              '[^/]*$', ''), ''), '/') || link
  END AS abs_url
FROM based""",
    "link_audit": f"""WITH {_ITEMS_CTE}
SELECT p.page_id,
  CAST(count(c.item_pos) AS BIGINT) AS total,
  CAST(count(c.item_pos) FILTER (WHERE c.reason = 'kept') AS BIGINT) AS kept,
  CAST(0 AS BIGINT) AS dropped_no_title,
  CAST(count(c.item_pos) FILTER (WHERE c.reason = 'no_link') AS BIGINT) AS dropped_no_link,
  CAST(count(c.item_pos) FILTER (WHERE c.reason = 'excluded') AS BIGINT) AS dropped_excluded
FROM pages p LEFT JOIN li_classified c ON c.page_id = p.page_id
GROUP BY p.page_id""",
    "distinct_links": f"""WITH {_ITEMS_CTE}
SELECT link, CAST(count(DISTINCT page_id) AS BIGINT) AS n_pages, min(page_id) AS first_page
FROM li_classified WHERE link IS NOT NULL GROUP BY link""",
    "keyed_flatten": """
SELECT event_id, CAST(i - 1 AS INTEGER) AS pos, keys[i] AS key, props ->> keys[i] AS value
FROM (SELECT event_id, props, keys, unnest(range(1, len(keys) + 1)) AS i
      FROM (SELECT event_id, props, json_keys(props) AS keys FROM events))""",
    "records_json": """
SELECT event_id, to_json({'event_id': event_id, 'user_id': user_id, 'event_type': event_type,
                          'props': json_transform(props, '"MAP(VARCHAR, BIGINT)"')})::VARCHAR AS json
FROM events""",
    "distinct_addresses": f"""
SELECT address, CAST(count(*) AS BIGINT) AS n, min(doc_id) AS first_doc
FROM (SELECT doc_id, unnest(regexp_extract_all(text, {_sql_str(IPV4_RE)})) AS address FROM documents)
GROUP BY address""",
    "extract_emails": _entities_sql(EMAIL_RE, "email"),
    "extract_phones": _entities_sql(PHONE_RE, "phone"),
    "extract_extensions": _entities_sql(r"#(\d{4})", "extension", 1),
    "contact_entities": f"""
SELECT doc_id, 'email' AS kind, pos, email AS value FROM ({_entities_sql(EMAIL_RE, "email")})
UNION ALL
SELECT doc_id, 'phone' AS kind, pos, phone AS value FROM ({_entities_sql(PHONE_RE, "phone")})
UNION ALL
SELECT doc_id, 'extension' AS kind, pos, extension AS value FROM ({_entities_sql(r"#(\d{4})", "extension", 1)})""",
    "entity_index": f"""
SELECT kind, value, CAST(count(DISTINCT doc_id) AS BIGINT) AS n_docs, min(doc_id) AS first_doc
FROM (
  SELECT doc_id, 'email' AS kind, unnest(regexp_extract_all(text, {_sql_str(EMAIL_RE)})) AS value FROM documents
  UNION ALL
  SELECT doc_id, 'phone', unnest(regexp_extract_all(text, {_sql_str(PHONE_RE)})) FROM documents
  UNION ALL
  SELECT doc_id, 'extension', unnest(regexp_extract_all(text, '#(\\d{{4}})', 1)) FROM documents)
GROUP BY kind, value""",
    "validated_numbers": f"""WITH {_ATTEMPTS_CTE}
SELECT event_id, raw, CAST(val AS VARCHAR) AS value,
  CASE WHEN NOT fmt_ok THEN 'format'
       WHEN val IS NULL OR val <= {LOWEST} OR val >= {HIGHEST} THEN 'range' ELSE 'ok' END AS reason
FROM checked""",
    "rejected_attempts": f"""WITH {_ATTEMPTS_CTE}
SELECT event_id, user_id, raw,
  CASE WHEN NOT fmt_ok THEN 'format' ELSE 'range' END AS reason
FROM checked WHERE NOT fmt_ok OR val IS NULL OR val <= {LOWEST} OR val >= {HIGHEST}""",
    "user_targets": f"""WITH {_ATTEMPTS_CTE}
SELECT DISTINCT user_id, target FROM attempts""",
    "bracket_history": f"""WITH RECURSIVE {_ATTEMPTS_CTE}, {_FOLD_CTE}
SELECT user_id, event_id, CAST(seq AS BIGINT) AS seq, lo, hi, outcome FROM fold""",
    "bracket_summary": f"""WITH RECURSIVE {_ATTEMPTS_CTE}, {_FOLD_CTE}
SELECT user_id, CAST(count(*) AS BIGINT) AS attempts,
  CAST(count(*) FILTER (WHERE outcome = 'format') AS BIGINT) AS n_format,
  CAST(count(*) FILTER (WHERE outcome = 'range') AS BIGINT) AS n_range,
  CAST(count(*) FILTER (WHERE outcome = 'low') AS BIGINT) AS n_low,
  CAST(count(*) FILTER (WHERE outcome = 'high') AS BIGINT) AS n_high,
  CAST(count(*) FILTER (WHERE outcome = 'hit') AS BIGINT) AS n_hit,
  CAST(greatest({LOWEST}, max(CASE WHEN outcome = 'low' THEN val END)) AS BIGINT) AS final_lo,
  CAST(least({HIGHEST}, min(CASE WHEN outcome = 'high' THEN val END)) AS BIGINT) AS final_hi
FROM fold GROUP BY user_id""",
}


def _clean_sql(body: str) -> str:
    return f"WITH cleaned AS (SELECT page_id, regexp_replace(html, {_sql_str(_CLEAN)}, '', 'g') AS c FROM pages)\n{body}"


_AD_RE = r'<div\s[^>]*class="([^"]*\s)?ad(\s[^"]*)?"[^>]*>([^<]*)</div>'
_FIRST_LI_RE = r"(?s)<ul(\s[^>]*)?>\s*<li(\s[^>]*)?>(.*?)</li\s*>"
_HREF_TEST = r'<a\s[^>]*href\s*=\s*"'
_HREF_RE = r'<a\s[^>]*?href\s*=\s*"([^"]*)"'


def _strip_sql(expr: str) -> str:
    for ent, ch in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'")):
        expr = f"replace({expr}, {_sql_str(ent)}, {_sql_str(ch)})"
    expr = f"replace(replace({expr}, '&nbsp;', chr(160)), '&amp;', '&')"
    return f"regexp_replace({expr}, {_sql_str(r'^\s+|\s+$')}, '', 'g')"


ORACLES["class_items"] = _clean_sql(f"""
SELECT page_id, CAST(i AS INTEGER) AS item_pos, {_strip_sql("m[i]")} AS title,
       CAST(NULL AS VARCHAR) AS link, 'no_link' AS reason
FROM (SELECT page_id, m, unnest(range(1, len(m) + 1)) AS i
      FROM (SELECT page_id, regexp_extract_all(c, {_sql_str(_AD_RE)}, 3) AS m FROM cleaned))""")

ORACLES["nav_first_links"] = _clean_sql(f"""
SELECT page_id, CAST(i AS INTEGER) AS item_pos,
  {_strip_sql("regexp_replace(m[i], '<[^>]*>', '', 'g')")} AS title,
  CASE WHEN regexp_matches(m[i], {_sql_str(_HREF_TEST)})
       THEN {_strip_sql(f"regexp_extract(m[i], {_sql_str(_HREF_RE)}, 1)")} END AS link,
  CASE WHEN regexp_matches(m[i], {_sql_str(_HREF_TEST)}) THEN 'kept' ELSE 'no_link' END AS reason
FROM (SELECT page_id, m, unnest(range(1, len(m) + 1)) AS i
      FROM (SELECT page_id, regexp_extract_all(c, {_sql_str(_FIRST_LI_RE)}, 3) AS m FROM cleaned))""")


def q_bracket_by_type(spark, root):
    """The bracket game keyed by event type: five keys of ~20% of all rows each,
    cut into days, so that a task holds one day of one type."""
    ev = _events(spark, root)
    raw = (F.when(F.col("event_type") == "error", F.col("value").cast("string"))
           .otherwise(F.get_json_object("props", "$.k")))
    att = ev.select("event_type", "ts", "event_id", raw.alias("raw"),
                    (F.lit(50) + F.length("event_type")).cast("long").alias("target"))
    h = N.bracket_history(att, "event_type", ["ts", "event_id"], bucket=F.date_trunc("day", "ts"))
    return h.select("event_type", "event_id", "seq", "lo", "hi", "outcome")


QUERIES["bracket_by_type"] = q_bracket_by_type

_TYPE_FOLD = _FOLD_CTE.replace("user_id", "event_type")
ORACLES["bracket_by_type"] = f"""WITH RECURSIVE attempts AS (
  SELECT event_type, ts, event_id,
    CASE WHEN event_type = 'error' THEN CAST(value AS VARCHAR) ELSE json_extract_string(props, '$.k') END AS raw,
    CAST(50 + length(event_type) AS BIGINT) AS target
  FROM events
),
checked AS (
  SELECT *, coalesce(regexp_full_match(raw, '\\s*[+-]?[0-9]+(_[0-9]+)*\\s*'), false) AS fmt_ok,
    CASE WHEN regexp_full_match(raw, '\\s*[+-]?[0-9]+(_[0-9]+)*\\s*')
      THEN TRY_CAST(replace(trim(raw), '_', '') AS DECIMAL(38,0)) END AS val,
    row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS seq
  FROM attempts
), {_TYPE_FOLD}
SELECT event_type, event_id, CAST(seq AS BIGINT) AS seq, lo, hi, outcome FROM fold"""

ORACLES["props_routing"] = """
SELECT event_id,
  CASE WHEN props IS NULL THEN NULL
       WHEN json_valid(props) AND json_type(props::JSON) = 'OBJECT' THEN 'parsed'
       ELSE 'rejected' END AS status
FROM events"""


# --- scan objects composed from event columns: several ports, a port twice (the
# later record wins), a record's own port, attributes outside the known ones, a
# script map, and text made malformed in known ways on a third of the rows.

def _scans(spark, root):
    port = F.col("user_id").cast("string")
    first = F.concat(F.lit('{"state": "early", "port": "x", "name": "old"}'))
    second = F.concat(F.lit('{"state": "'), F.col("event_type"), F.lit('", "port": 9, "banner": "b'), F.col("event_id").cast("string"),
                      F.lit('", "seen": {"n": 1}, "script": {"id": "'), F.col("event_id").cast("string"), F.lit('", "kind": "'), F.col("event_type"), F.lit('"}}'))
    other = F.lit('{"state": "open", "cpe": ""}')
    text = F.concat(F.lit('{"'), port, F.lit('": '), first, F.lit(', "p'), port, F.lit('": '), other, F.lit(', "'), port, F.lit('": '), second, F.lit("}"))
    broken = (F.when(F.col("event_id") % 12 == 0, F.concat(text, F.lit(" trailing"))).when(F.col("event_id") % 12 == 3, F.concat(text, text))
              .when(F.col("event_id") % 12 == 6, F.lit('{"a": {"script": ["x"]}}')).when(F.col("event_id") % 12 == 9, F.lit('{"a": {"state": ["x"]}}')))
    return _events(spark, root).select("event_id", F.coalesce(broken, text).alias("body"))


def q_scan_flatten(spark, root):
    good, _ = R.route_malformed(_scans(spark, root), "body")
    flat = R.flatten_keyed(good, "event_id", "parsed")
    return flat.select("event_id", "pos", "port", "state", "name", "cpe", F.to_json("rest").alias("rest"))


def q_scan_scripts(spark, root):
    good, _ = R.route_malformed(_scans(spark, root), "body")
    return R.flatten_scripts(R.flatten_keyed(good, "event_id", "parsed"), "event_id")


def q_scan_rejects(spark, root):
    _, bad = R.route_malformed(_scans(spark, root), "body")
    return bad.select("event_id")


QUERIES |= {"scan_flatten": q_scan_flatten, "scan_scripts": q_scan_scripts, "scan_rejects": q_scan_rejects}
ORACLES |= {
    "scan_flatten": """
SELECT event_id, 0 AS pos, user_id::VARCHAR AS port, event_type AS state, NULL AS name, NULL AS cpe,
  '{"banner":"b' || event_id || '","seen":"{\\"n\\":1}"}' AS rest FROM events WHERE event_id % 3 <> 0
UNION ALL SELECT event_id, 1, 'p' || user_id, 'open', NULL, '', '{}' FROM events WHERE event_id % 3 <> 0""",
    "scan_scripts": """
SELECT event_id, user_id::VARCHAR AS port, 0 AS script_pos, 'id' AS script_name, event_id::VARCHAR AS output FROM events WHERE event_id % 3 <> 0
UNION ALL SELECT event_id, user_id::VARCHAR, 1, 'kind', event_type FROM events WHERE event_id % 3 <> 0""",
    "scan_rejects": "SELECT event_id FROM events WHERE event_id % 3 = 0",
}


# --- contact lines glued from customer columns: name, address, phone and office
# extension without a space between them.

def _contacts(spark, root):
    c = read_table(spark, root, "customer")
    key = F.col("c_custkey").cast("string")
    line = F.concat(F.lit("Dr "), key, F.lit(" reach me: user"), key, F.lit("@dept"), F.col("c_nationkey").cast("string"), F.lit(".example.org"),
                    F.lit(" / "), F.lpad(key, 2, "0"), F.lit("-"), F.lpad(key, 8, "5"), F.lit("#"), F.lpad(key, 4, "7"), F.lit(" end"))
    return c.select(F.col("c_custkey").alias("doc_id"), line.alias("text"))


def q_contact_lines(spark, root):
    """C1 to C4 on glued contact lines."""
    return E.extract_entities(_contacts(spark, root))


QUERIES["contact_lines"] = q_contact_lines
_KEY = "c_custkey::VARCHAR"
ORACLES["contact_lines"] = f"""
SELECT c_custkey AS doc_id, 'email' AS kind, 0 AS pos, 'user' || {_KEY} || '@dept' || c_nationkey || '.example.org' AS value FROM customer
UNION ALL SELECT c_custkey, 'phone', 0, left(lpad({_KEY}, 2, '0'), 2) || '-' || left(lpad({_KEY}, 8, '5'), 8) FROM customer
UNION ALL SELECT c_custkey, 'extension', 0, left(lpad({_KEY}, 4, '7'), 4) FROM customer"""


def q_paragraph_audit(spark, root):
    """A12 on paragraphs titled by their bold text: most have no title, and
    titles have no link."""
    return L.link_audit(_pages(spark, root), ("p", None), ("b", None), WORDS)


QUERIES["paragraph_audit"] = q_paragraph_audit
# On these pages a bold title stands right behind its paragraph's tag, and no
# anchor follows it.
ORACLES["paragraph_audit"] = """
SELECT page_id, len(regexp_extract_all(html, '<p>'))::BIGINT AS total, 0::BIGINT AS kept,
  (len(regexp_extract_all(html, '<p>')) - len(regexp_extract_all(html, '<p><b>')))::BIGINT AS dropped_no_title,
  len(regexp_extract_all(html, '<p><b>'))::BIGINT AS dropped_no_link, 0::BIGINT AS dropped_excluded
FROM pages"""


def q_open_items(spark, root):
    """A2 on pages without any ``</li>``: the next item or the list's end ends each."""
    pages = _pages(spark, root).withColumn("html", F.replace("html", F.lit("</li>"), F.lit("")))
    return L.extract_links(pages, ITEM, None, WORDS).drop("reason")


QUERIES["open_items"] = q_open_items
# The items as they are with their end tags.
ORACLES["open_items"] = ORACLES["page_links"]


def q_links_resolved(spark, root):
    """A11 on links with dot segments: each is made relative to its page's
    folder, through a folder and up again twice."""
    pages = _pages(spark, root).withColumn("html", F.replace("html", F.lit('<a href="/'), F.lit('<a href="./x/y/.././../../')))
    return L.absolute_links(pages, ITEM, None, WORDS)


QUERIES["links_resolved"] = q_links_resolved
# The pages' links start at the root; their URLs are a host, a language and a page.
ORACLES["links_resolved"] = f"""WITH links AS ({ORACLES["page_links"]})
SELECT links.page_id, item_pos, './x/y/.././../../' || substr(link, 2) AS link,
  regexp_extract(url, '^([a-z]+://[^/?#]*)', 1)
    || coalesce(array_to_string(list_transform(string_split(regexp_extract(url, '^[a-z]+://[^/?#]*/([^?#]*)', 1), '/')[1:-3], lambda s: '/' || s), ''), '')
    || '/' || substr(link, 2) AS abs_url
FROM links JOIN pages USING (page_id)"""


def q_links_word_table(spark, root):
    """A6 with a large table: every word of five letters or more that a document has."""
    docs = _documents(spark, root).select(F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(r"\p{L}{5,}"), F.lit(0)))).alias("word"))
    links = L.extract_links(_pages(spark, root), ITEM, None, ()).drop("reason")
    return L.without_words(links, docs)


QUERIES["links_word_table"] = q_links_word_table
ORACLES["links_word_table"] = f"""WITH words AS (SELECT DISTINCT unnest(regexp_extract_all(text, '\\pL{{5,}}')) AS word FROM documents),
links AS ({ORACLES["page_links"]}),
hit AS (SELECT title FROM (SELECT DISTINCT title FROM links) WHERE EXISTS (SELECT 1 FROM words WHERE contains(title, word)))
SELECT * FROM links WHERE title NOT IN (SELECT title FROM hit)"""


# --- two persons a text, in six ways of writing: extension glued, after a line
# break, after an email, after an email and a line break, none at all; and an
# email without a phone before both.

def _people(spark, root):
    c = read_table(spark, root, "customer")
    key = F.col("c_custkey").cast("string")

    def person(who, kind):
        phone = F.concat(F.lit(f"{who}kim"), F.substring(F.lpad(key, 9, "4"), 1, 3), F.lit("02-"), F.lpad(key, 8, "5"))
        ext, mail = F.concat(F.lit("#"), F.lpad(key, 4, "7")), F.concat(F.lit(f" {who}"), key, F.lit("@lab.example.org"))
        return (F.when(kind == 0, F.concat(phone, ext, F.lit("Maps")))
                .when(kind == 1, F.concat(phone, F.lit("\n"), ext, F.lit("Maps")))
                .when(kind == 2, F.concat(phone, mail, ext, F.lit("Maps")))
                .when(kind == 3, F.concat(phone, mail, F.lit("\n"), ext, F.lit("Maps")))
                .when(kind == 4, F.concat(phone, F.lit(" Maps")))
                .otherwise(F.concat(phone, ext, mail, F.lit("/ Maps"))))

    way = F.col("c_custkey") % 6
    lead = F.when(way == 3, F.concat(F.lit("office"), key, F.lit("@lab.example.org\n"))).otherwise(F.lit("Ünï "))
    return c.select(F.col("c_custkey").alias("doc_id"), F.concat(lead, person("a", way), F.lit(" "), person("b", (F.col("c_custkey") + 2) % 6)).alias("text"))


def q_contact_records(spark, root):
    """C1 to C3 of one person together, over the hazards of contact text."""
    return E.contact_records(_people(spark, root)).drop("start")


QUERIES["contact_records"] = q_contact_records
_PHONE_SQL = f"'02-' || left(lpad({_KEY}, 8, '5'), 8)"


def _person_sql(who: str, way: str, rec: str) -> str:
    ext = f"CASE WHEN {way} <> 4 THEN left(lpad({_KEY}, 4, '7'), 4) END"
    mail = f"CASE WHEN {way} IN (2, 3, 5) THEN '{who}' || {_KEY} || '@lab.example.org' END"
    return f"SELECT c_custkey AS doc_id, CAST({rec} AS INTEGER) AS rec, {_PHONE_SQL} AS phone, {ext} AS extension, {mail} AS email FROM customer"


ORACLES["contact_records"] = f"""
{_person_sql("a", "c_custkey % 6", "CASE WHEN c_custkey % 6 = 3 THEN 1 ELSE 0 END")}
UNION ALL {_person_sql("b", "(c_custkey + 2) % 6", "CASE WHEN c_custkey % 6 = 3 THEN 2 ELSE 1 END")}
UNION ALL SELECT c_custkey, 0, NULL, NULL, 'office' || {_KEY} || '@lab.example.org' FROM customer WHERE c_custkey % 6 = 3"""


def q_links_written(spark, root):
    """A10: the pairs written to a table and read back."""
    path, links = scratch_path(spark, "links-written"), L.index_links(_pages(spark, root), ITEM, None, WORDS)
    write_table(links, path)
    return spark.read.schema(links.schema).parquet(path)


def q_records_written(spark, root):
    """The flattened records written by key, and read back."""
    path, records = scratch_path(spark, "records-written"), q_keyed_flatten(spark, root)
    write_table(records, path, ["key"])
    return spark.read.schema(records.schema).parquet(path)


QUERIES |= {"links_written": q_links_written, "records_written": q_records_written}
ORACLES |= {"links_written": ORACLES["index_links"], "records_written": ORACLES["keyed_flatten"]}
