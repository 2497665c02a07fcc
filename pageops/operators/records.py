"""Keyed nested records: parse, flatten, serialise, distinct, route.

A scan object maps a key (a port, as text) to a record.  Flattening promotes
the key into the record, one row per key, in key order.  Duplicate keys in one
object follow dict semantics: the last value wins, at the first key's place.
That is decided inside the object's own row, so flattening is narrow.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.html import let

# Record of one port in a scan object.  All fields are text; '' means unknown
# and is kept as ''.
PORT_RECORD = T.StructType([
    T.StructField("state", T.StringType()),
    T.StructField("reason", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("product", T.StringType()),
    T.StructField("version", T.StringType()),
    T.StructField("extrainfo", T.StringType()),
    T.StructField("conf", T.StringType()),
    T.StructField("cpe", T.StringType()),
    T.StructField("script", T.MapType(T.StringType(), T.StringType())),
])
SCAN_OBJECT = T.MapType(T.StringType(), PORT_RECORD)


def parse_keyed(json: Column, value_type: T.DataType | str = PORT_RECORD) -> Column:
    """B1: JSON object text to ``map<string, value_type>``.  Malformed text, a
    non-object or a value of the wrong type gives NULL (see ``route_malformed``).
    A record's own ``port`` field is not in the schema, so the promoted key
    always wins over it."""
    if isinstance(value_type, str):
        return F.from_json(json, f"map<string,{value_type}>")
    return F.from_json(json, T.MapType(T.StringType(), value_type))


def _one(json: Column, kind: str) -> Column:
    """The text as ``kind`` if it is exactly one value of that kind, else NULL.
    Read as the one element of a list, anything before or after it makes the
    list malformed."""
    listed = F.from_json(F.concat(F.lit("["), json, F.lit("]")), f"array<{kind}>")
    return let(lambda v: F.when(F.size(v["l"]) == 1, F.get(v["l"], 0)), l=listed)


_TEXT = [f.name for f in PORT_RECORD.fields if f.name != "script"]


def _texts_plain(record: Column) -> Column:
    """No text field's text looks like a list or an object; these may still be
    plain texts that begin so."""
    return F.forall(F.map_entries(record), lambda e: F.coalesce(
        ~(e["key"].isin(*_TEXT) & (F.startswith(e["value"], F.lit("{")) | F.startswith(e["value"], F.lit("[")))), F.lit(True)))


def _record_ok(fields: Column, names: list[str]) -> Column:
    """Of a record's fields the named ones have their types: text fields hold a
    plain value, ``script`` an object; null is allowed anywhere."""
    return F.forall(F.map_entries(fields), lambda e: (
        F.when(~e["key"].isin(*names), F.lit(True))
        .when(e["key"] == "script", F.schema_of_variant(e["value"]).rlike("^(OBJECT|VOID)"))
        .otherwise(~F.schema_of_variant(e["value"]).rlike("^(OBJECT|ARRAY)"))))


def _record_reads_ok(record: Column) -> Column:
    """The same of a record's JSON text: no text field can be read as a list or
    an object, and ``script``, if it has a value, can be read as an object.  Of a
    repeated field every value counts."""
    def body(v: Column) -> Column:
        ok = v["objects"]["script"].isNotNull() | v["text"]["script"].isNull()
        for name in _TEXT:
            ok = ok & v["lists"][name].isNull() & v["objects"][name].isNull()
        return ok

    def read(kind: str, names: list[str]) -> Column:
        return F.from_json(record, ", ".join(f"`{n}` {kind}" for n in names))

    return let(body, lists=read("array<string>", _TEXT), objects=read("map<string,string>", [*_TEXT, "script"]), text=read("string", ["script"]))


def parse_scans(json: Column) -> Column:
    """B1: scan object text to ``map<string, struct>``: the fields of
    ``PORT_RECORD`` and ``rest``, every other attribute as text (JSON text for
    nested ones).  NULL if the text isn't exactly one object, a record isn't an
    object or a known field has another type.  Repeated attributes: last wins.

    Types are read off variants; where these refuse the text (a nested object
    repeats a key), by reading each record as what its fields may not be."""
    known = [f.name for f in PORT_RECORD.fields]

    def record(k: Column, fields: Column) -> Column:
        def body(v: Column) -> Column:
            def value(f: T.StructField) -> Column:
                text = F.element_at(v["last"], F.lit(f.name))
                return F.from_json(text, "map<string,string>") if f.name == "script" else text

            others = F.map_filter(v["last"], lambda name, _: ~name.isin(*known, "port"))
            return F.struct(*[value(f).alias(f.name) for f in PORT_RECORD.fields], others.alias("rest"))

        return F.when(fields.isNotNull(), let(body, last=F.map_from_entries(dedupe_keys(fields))))

    def whole(v: Column) -> Column:
        def typed(w: Column) -> Column:
            def every(names: list[str]) -> Column:
                return F.forall(F.map_values(w["k"]), lambda r: r.isNull() | _record_ok(r, names))

            plain = F.forall(F.map_values(v["m"]), lambda r: r.isNull() | _texts_plain(r))
            return F.when(plain, every(["script"])).otherwise(every([*_TEXT, "script"]))

        seen = let(lambda w: F.forall(F.map_values(w["r"]), lambda r: r.isNull() | _record_reads_ok(r)), r=_one(v["j"], "map<string,string>"))
        ok = F.coalesce(let(typed, k=_one(v["j"], "map<string,map<string,variant>>")), seen)
        return F.when(v["m"].isNotNull() & ok, F.transform_values(v["m"], record))

    return let(lambda j: let(whole, j=j["j"], m=_one(j["j"], "map<string,map<string,string>>")), j=json)


def dedupe_entries(e: Column) -> Column:
    """Entries (key, value) with duplicate keys collapsed with dict semantics
    (last value, first position).  Two native sorts of (key, position) find each key's
    first and last occurrence; no quadratic scan, no map-key policy setting."""
    def body(v):
        e = v["e"]
        pos = F.transform(e, lambda x, i: F.struct(x["key"].alias("key"), i.alias("p")))

        def collapse(w):
            heads = F.filter(
                F.transform(w["asc"], lambda s, i: F.struct(
                    s["p"].alias("first"),
                    (-F.get(w["desc"], i)["p"]).alias("last"),
                    ((i == 0) | (F.get(w["asc"], i - 1)["key"] != s["key"])).alias("head"))),
                lambda h: h["head"])
            ordered = F.sort_array(F.transform(heads, lambda h: F.struct(h["first"], h["last"])))
            return F.transform(ordered, lambda o: F.get(e, o["last"]))

        return let(collapse,
                   asc=F.sort_array(pos),
                   desc=F.sort_array(F.transform(pos, lambda x: F.struct(x["key"], (-x["p"]).alias("p")))))

    return let(body, e=e)


def dedupe_keys(m: Column) -> Column:
    """``dedupe_entries`` of a map.  Common case first, with plain compiled
    functions: no duplicate key.  ``m`` must be cheap to reference."""
    return F.when(F.size(F.array_distinct(F.map_keys(m))) == F.size(m), F.map_entries(m)).otherwise(
        dedupe_entries(F.map_entries(m)))


def flatten_keyed(df: DataFrame, id_col: str, map_col: str, key_name: str = "port") -> DataFrame:
    """B2: one row per key: ``(id, pos, <key_name>, <record fields>)``; ``pos``
    is the key's place (from 0) after duplicate keys are collapsed.  A struct
    value is spread into columns; any other value lands in ``value``."""
    entries = df.select(id_col, dedupe_keys(F.col(map_col)).alias("_e"))
    rows = (entries.select(id_col, F.posexplode_outer("_e").alias("pos", "_kv"))
            .where(F.col("pos").isNotNull()))
    value_type = df.schema[map_col].dataType.valueType
    if isinstance(value_type, T.StructType):
        def field(f):
            c = F.col("_kv")["value"][f.name]
            # nested maps (e.g. ``script``) follow dict semantics as well
            return (F.map_from_entries(dedupe_keys(c)) if isinstance(f.dataType, T.MapType) else c).alias(f.name)
        fields = [field(f) for f in value_type.fields if f.name != key_name]
    else:
        fields = [F.col("_kv")["value"].alias("value")]
    return rows.select(id_col, F.col("pos").cast("int").alias("pos"),
                       F.col("_kv")["key"].alias(key_name), *fields)


def flatten_scripts(records: DataFrame, id_col: str, key_name: str = "port",
                    script_col: str = "script") -> DataFrame:
    """Second-level flatten of each record's ``script`` map:
    ``(id, port, script_pos, script_name, output)``."""
    rows = (records.select(id_col, key_name, F.posexplode_outer(script_col).alias("script_pos", "script_name", "output"))
            .where(F.col("script_pos").isNotNull()))
    return rows.withColumn("script_pos", F.col("script_pos").cast("int"))


def to_json_text(col: Column, keep_nulls: bool = False) -> Column:
    """Serialise a struct or map as compact JSON text; NULL struct fields
    are written when ``keep_nulls``."""
    opts = {"ignoreNullFields": "false"} if keep_nulls else {}
    return F.to_json(col, opts)


def _parsed(json: Column, value_type: T.DataType | str) -> Column:
    """Strictly parsed: scan objects by ``parse_scans``, maps of another value
    type as the one element of a list."""
    if value_type == PORT_RECORD:
        return parse_scans(json)
    kind = value_type if isinstance(value_type, str) else value_type.simpleString()
    return _one(json, f"map<string,{kind}>")


def route_malformed(df: DataFrame, json_col: str, value_type: T.DataType = PORT_RECORD,
                    parsed_col: str = "parsed") -> tuple[DataFrame, DataFrame]:
    """Parse once, split into (parsed rows, rejected rows).  Rejected are
    rows whose text is present but isn't exactly one object of the schema; NULL
    text is neither (it yields nothing)."""
    # As a column of df, the filters below would parse each text once more.
    kept = [c for c in df.columns if c != parsed_col]
    parsed = df.select(*[F.col(f"`{c}`") for c in kept], F.explode(F.array(_parsed(F.col(json_col), value_type))).alias(parsed_col))
    good = parsed.where(F.col(parsed_col).isNotNull())
    bad = parsed.where(F.col(parsed_col).isNull() & F.col(json_col).isNotNull()).drop(parsed_col)
    return good, bad


def routing_status(json: Column, value_type: T.DataType | str = PORT_RECORD) -> Column:
    """B7 as a column: ``parsed`` when the text is exactly one object of the
    schema, ``rejected`` when present but not, NULL for NULL text."""
    return (F.when(json.isNull(), F.lit(None).cast("string"))
            .when(_parsed(json, value_type).isNull(), F.lit("rejected"))
            .otherwise(F.lit("parsed")))


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """The distinct non-NULL values of a column (a partial aggregate on
    the map side, then one shuffle)."""
    return df.select(col).where(F.col(col).isNotNull()).distinct()


def distinct_in_array(col: Column) -> Column:
    """B4 for a list held in one row: order of first occurrence kept."""
    return F.array_distinct(col)
