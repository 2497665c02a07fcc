"""Contact entities in free text: emails, phones, office extensions, IPv4.

Extraction is narrow (a regex per kind over each document, then an explode);
indexes group by value with partial aggregation before their one shuffle, and
a document's repeats collapse inside its row first, so a value found in a
third of all documents still ships one row per map partition.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.patterns import (EMAIL_NEEDS, EMAIL_RE, ENTITY_PATTERNS, EXTENSION_NEEDS, EXTENSION_RE,
                                  IPV4_GUARD, IPV4_RE, PHONE_NEEDS, PHONE_RE)
from ..functions.html import let, prefix_sums
from ..functions.text import extract_all, match_spans


def extract_pattern(df: DataFrame, pattern: str, out: str, group: int = 0, *,
                    id_col: str = "doc_id", text_col: str = "text", needs: str | None = None,
                    guard: str | None = None) -> DataFrame:
    """Every match of ``pattern`` in each text, left to right:
    ``(id, pos, <out>)`` with ``pos`` from 0.  NULL or empty text: no rows."""
    m = df.select(id_col, extract_all(F.col(text_col), pattern, group, needs, guard).alias("_m"))
    return (m.select(id_col, F.posexplode_outer("_m").alias("pos", out))
            .where(F.col("pos").isNotNull())
            .select(id_col, F.col("pos").cast("int").alias("pos"), out))


def extract_emails(df: DataFrame, **kw) -> DataFrame:
    """Email addresses in order of appearance."""
    return extract_pattern(df, EMAIL_RE, "email", needs=EMAIL_NEEDS, **kw)


def extract_phones(df: DataFrame, **kw) -> DataFrame:
    """Phone numbers ('+1 (ddd) ddd-dddd' or 'dd-ddddddd[d]')."""
    return extract_pattern(df, PHONE_RE, "phone", needs=PHONE_NEEDS, **kw)


def extract_extensions(df: DataFrame, **kw) -> DataFrame:
    """Office extensions ('#' and four digits), as the digits."""
    return extract_pattern(df, EXTENSION_RE, "extension", 1, needs=EXTENSION_NEEDS, **kw)


def extract_addresses(df: DataFrame, **kw) -> DataFrame:
    """IPv4 addresses (four octets 0..255)."""
    return extract_pattern(df, IPV4_RE, "address", guard=IPV4_GUARD, **kw)


def extract_entities(df: DataFrame, patterns: Mapping[str, tuple] = ENTITY_PATTERNS, *,
                     id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """C4: long form ``(id, kind, pos, value)`` for a ``{kind: (regex, group[,
    literal every match contains])}`` table; ``pos`` counts per kind from 0."""
    per_kind = F.array(*[
        F.struct(F.lit(kind).alias("kind"), extract_all(F.col(text_col), *spec).alias("m"))
        for kind, spec in patterns.items()
    ])
    kinds = df.select(id_col, F.inline(per_kind))
    return (kinds.select(id_col, "kind", F.posexplode_outer("m").alias("pos", "value"))
            .where(F.col("pos").isNotNull())
            .select(id_col, "kind", F.col("pos").cast("int").alias("pos"), "value"))


def entity_index(df: DataFrame, patterns: Mapping[str, tuple] = ENTITY_PATTERNS, *,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per distinct ``(kind, value)``: documents holding it and the first
    such document."""
    per_kind = F.array(*[
        F.struct(F.lit(kind).alias("kind"),
                 F.array_distinct(extract_all(F.col(text_col), *spec)).alias("m"))
        for kind, spec in patterns.items()
    ])
    kinds = df.select(id_col, F.inline(per_kind))
    per_doc = (kinds.select(id_col, "kind", F.explode_outer("m").alias("value"))
               .where(F.col("value").isNotNull()))
    return per_doc.groupBy("kind", "value").agg(
        F.count(F.lit(1)).alias("n_docs"), F.min(id_col).alias("first_doc"))


def distinct_addresses(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """B4 on documents: each distinct IPv4 address, how often it occurs and the
    first document holding it."""
    found = extract_addresses(df, id_col=id_col, text_col=text_col)
    return found.groupBy("address").agg(F.count(F.lit(1)).alias("n"), F.min(id_col).alias("first_doc"))


def _tagged(text, kind, spec: tuple):
    """The spans of one pattern as ``array<struct<start, kind, end, value>>``."""
    spans = F.coalesce(match_spans(text, *spec), F.array().cast("array<struct<start:int,end:int,value:string>>"))
    return F.transform(spans, lambda m: F.struct(m["start"].alias("start"), kind.alias("kind"), m["end"].alias("end"), m["value"].alias("value")))


def extract_spans(df: DataFrame, patterns: Mapping[str, tuple] = ENTITY_PATTERNS, *,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """C4 with places: ``(id, kind, start, end, value)`` of every match, in
    characters from 0."""
    per_kind = F.concat(*[_tagged(F.col(text_col), F.lit(kind), spec) for kind, spec in patterns.items()])
    return df.select(id_col, F.inline_outer(per_kind)).where(F.col("kind").isNotNull()).select(id_col, "kind", "start", "end", "value")


def contact_records(df: DataFrame, patterns: Mapping[str, tuple] = ENTITY_PATTERNS, *,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """C1 to C3 of one person together: ``(id, rec, start, phone, extension, email)``.

    A phone starts a record, which takes the first extension and the first email
    after it and before the next phone, whatever stands between (a line break,
    another kind of entity).  An extension or email that no phone takes is a
    record of its own.  Records are numbered from 0 by place; ``start`` is the
    place of the first entity, in characters.

    In the row: the entities' places are merged; how many phones came before
    says whose each is, and a second sort puts each record's entities together."""
    kinds = ("phone", "extension", "email")
    merged = F.sort_array(F.concat(*[_tagged(F.col(text_col), F.lit(k), patterns[kind]) for k, kind in enumerate(kinds)]))

    def owned(v):
        phones = prefix_sums(F.transform(v["all"], lambda e: (e["kind"] == 0).cast("int")))

        def order(w):
            return F.sort_array(F.transform(v["all"], lambda e, i: F.struct(
                (F.get(w["phones"], i) + (e["kind"] == 0).cast("int")).alias("owner"), e["kind"].alias("kind"), e["start"].alias("start"), e["value"].alias("value"))))

        return let(lambda w: let(records, all=order(w)), phones=phones)

    def records(v):
        def first(e, i):
            before = F.get(v["all"], i - 1)
            return (e["owner"] > 0) & ((i == 0) | (before["owner"] != e["owner"]) | (before["kind"] != e["kind"]))

        taken = F.filter(v["all"], first)
        left = F.filter(v["all"], lambda e, i: ~first(e, i))

        def of_kind(e, kind):
            return F.when(e["kind"] == kind, e["value"])

        def with_phones(w):
            def one(e, i):
                one_on, two_on = F.get(w["taken"], i + 1), F.get(w["taken"], i + 2)
                return F.when(e["kind"] == 0, F.struct(
                    e["start"].alias("start"), e["value"].alias("phone"),
                    F.when(one_on["owner"] == e["owner"], of_kind(one_on, 1)).alias("extension"),
                    F.coalesce(F.when(one_on["owner"] == e["owner"], of_kind(one_on, 2)), F.when(two_on["owner"] == e["owner"], of_kind(two_on, 2))).alias("email")))
            return F.filter(F.transform(w["taken"], one), lambda r: r.isNotNull())

        alone = F.transform(left, lambda e: F.struct(e["start"].alias("start"), of_kind(e, 0).alias("phone"), of_kind(e, 1).alias("extension"), of_kind(e, 2).alias("email")))
        return F.sort_array(F.concat(let(with_phones, taken=taken), alone))

    rows = df.select(id_col, F.posexplode_outer(let(owned, all=merged)).alias("_p", "_r")).where(F.col("_p").isNotNull())
    return rows.select(id_col, F.col("_p").cast("int").alias("rec"), "_r.start", "_r.phone", "_r.extension", "_r.email")
