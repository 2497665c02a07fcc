"""Keyed records (flatten, duplicates, routing, JSON) and contact entities."""

import json
import random
import re

from pyspark.sql import functions as F

from pageops.functions.patterns import ENTITY_PATTERNS
from pageops.operators import entities as E
from pageops.operators import records as R

from .fixtures import (CONTACT_TEXT, EMAILS_EXPECTED, EXTENSIONS_EXPECTED, PHONES_EXPECTED, RECORDS_EXPECTED,
                       contact_docs, scans)


def _flat(spark):
    good, bad = R.route_malformed(scans(spark), "body")
    return R.flatten_keyed(good, "scan_id", "parsed"), bad


def test_flatten_order_duplicates_and_inner_port(spark):
    flat, _ = _flat(spark)
    got = sorted((r["scan_id"], r["pos"], r["port"], r["state"], r["name"], r["product"]) for r in flat.collect())
    assert got == sorted(RECORDS_EXPECTED)
    # the record's own "port" field never overrides the key; '' stays ''
    row = [r for r in flat.collect() if r["scan_id"] == 1 and r["port"] == "80"][0]
    assert row["version"] == "" and row["cpe"] == ""
    assert "port" in flat.columns and flat.columns.count("port") == 1


def test_routing_of_malformed(spark):
    flat, bad = _flat(spark)
    assert sorted(r["scan_id"] for r in bad.collect()) == [3, 4, 7]
    assert {r["scan_id"] for r in flat.collect()} == {1, 2}   # {} and NULL give nothing


def test_script_flatten(spark):
    flat, _ = _flat(spark)
    s = R.flatten_scripts(flat, "scan_id")
    got = sorted((r["scan_id"], r["port"], r["script_pos"], r["script_name"]) for r in s.collect())
    assert got == [(1, "22", 0, "ssh-hostkey"), (1, "80", 0, "http-title"), (1, "80", 1, "http-server-header"),
                   (2, "443", 0, "x")]


def test_json_round_trip(spark):
    good, _ = R.route_malformed(scans(spark), "body")
    out = good.select("scan_id", R.to_json_text(F.col("parsed")).alias("j")).collect()
    for r in out:
        parsed = json.loads(r["j"])
        assert all("port" not in v for v in parsed.values())
    one = [json.loads(r["j"]) for r in out if r["scan_id"] == 1][0]
    assert list(one) == ["80", "22"] and one["80"]["script"]["http-title"] == "Welcome\nhome"


def test_dedupe_many_duplicates(spark):
    body = json.dumps({"a": 1}).replace("}", ', "b": 2, "a": 3, "c": 4, "b": 5, "a": 6}')
    df = spark.createDataFrame([(1, body)], "id long, body string")
    parsed = df.select("id", R.parse_keyed(F.col("body"), "int").alias("m"))
    got = [(r["pos"], r["key"], r["value"]) for r in R.flatten_keyed(parsed, "id", "m", "key").orderBy("pos").collect()]
    assert got == [(0, "a", 6), (1, "b", 5), (2, "c", 4)]


def test_distinct_values(spark):
    df = spark.createDataFrame([("192.0.2.7",), ("198.51.100.4",), ("192.0.2.7",), (None,), ("203.0.113.9",)], "address string")
    assert sorted(r[0] for r in R.distinct_values(df, "address").collect()) == ["192.0.2.7", "198.51.100.4", "203.0.113.9"]
    arr = spark.createDataFrame([(["b", "a", "b", "c", "a"],)], "xs array<string>")
    assert arr.select(R.distinct_in_array(F.col("xs"))).first()[0] == ["b", "a", "c"]


def test_contacts(spark):
    docs = contact_docs(spark)
    assert sorted(tuple(r) for r in E.extract_emails(docs).collect()) == EMAILS_EXPECTED
    assert sorted(tuple(r) for r in E.extract_phones(docs).collect()) == PHONES_EXPECTED
    assert sorted(tuple(r) for r in E.extract_extensions(docs).collect()) == EXTENSIONS_EXPECTED


def test_entities_long_form_and_index(spark):
    docs = contact_docs(spark)
    long = sorted(tuple(r) for r in E.extract_entities(docs).collect())
    want = sorted([(d, "email", p, v) for d, p, v in EMAILS_EXPECTED]
                  + [(d, "phone", p, v) for d, p, v in PHONES_EXPECTED]
                  + [(d, "extension", p, v) for d, p, v in EXTENSIONS_EXPECTED])
    assert long == want
    idx = {(r["kind"], r["value"]): (r["n_docs"], r["first_doc"]) for r in E.entity_index(docs).collect()}
    assert idx[("phone", "02-23456789")] == (3, 1)
    assert idx[("extension", "3910")] == (1, 1)


def test_guard_gives_same_result_as_plain_regex(spark):
    docs = contact_docs(spark)
    plain = E.extract_pattern(docs, r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}", "email")
    assert sorted(plain.collect()) == sorted(E.extract_emails(docs).collect())


def test_addresses(spark):
    df = spark.createDataFrame([(1, "hosts 10.0.0.1, 10.0.0.1 and 256.1.1.1 or 1.2.3.4.5"), (2, "10.0.0.1"), (3, None)],
                               "doc_id long, text string")
    got = sorted(tuple(r) for r in E.distinct_addresses(df).collect())
    assert got == [("1.2.3.4", 1, 1), ("10.0.0.1", 3, 1)]


def test_nested_map_duplicates_last_wins(spark):
    body = '{"80": {"state": "open", "script": {"a": "1", "b": "x", "a": "2"}}}'
    df = spark.createDataFrame([(1, body)], "scan_id long, body string")
    good, _ = R.route_malformed(df, "body")
    flat = R.flatten_keyed(good, "scan_id", "parsed")
    assert flat.first()["script"] == {"a": "2", "b": "x"}
    s = R.flatten_scripts(flat, "scan_id")
    assert sorted((r["script_pos"], r["script_name"], r["output"]) for r in s.collect()) == [(0, "a", "2"), (1, "b", "x")]


def test_routing_status_column(spark):
    got = {r["scan_id"]: r["status"] for r in scans(spark).select(
        "scan_id", R.routing_status(F.col("body")).alias("status")).collect()}
    assert got == {1: "parsed", 2: "parsed", 3: "rejected", 4: "rejected", 5: "parsed", 6: None, 7: "rejected"}


def test_strict_routing(spark):
    texts = ['{"80": {"state": "open", "script": {"b": "1", "a": "2", "b": "3"}, "rack": 7, "tags": ["x"]}}', '{"a": {}} x', '{"a": {}}{"b": {}}',
             '{"a": {"state": ["x"]}}', '{"a": {"script": ["x"]}}', "[1]", "", '{"a": 5}', '{"a": {"state": null}}', "{}", None]
    df = spark.createDataFrame(list(enumerate(texts)), "scan_id int, body string")
    got = {r.scan_id: r.s for r in df.select("scan_id", R.routing_status(F.col("body")).alias("s")).collect()}
    assert [got[i] for i in range(11)] == ["parsed"] + ["rejected"] * 7 + ["parsed", "parsed", None]
    good, _ = R.route_malformed(df, "body")
    row = R.flatten_keyed(good, "scan_id", "parsed").filter("scan_id = 0").first()
    assert row.rest == {"rack": "7", "tags": '["x"]'} and row.script == {"b": "3", "a": "2"}


def test_types_are_checked_beside_repeated_nested_keys(spark):
    """A nested object that repeats a key turns no check off; texts that look
    like lists or objects are texts."""
    twice = '"x": {"k": 1, "k": 2}'
    texts = {f'{{"a": {{"state": ["y"], {twice}}}}}': "rejected", f'{{"a": {{"state": {{"z": 1}}, {twice}}}}}': "rejected",
             f'{{"a": {{"state": [], {twice}}}}}': "rejected", f'{{"a": {{{twice}}}, "b": {{"cpe": [1, {{"s": 2}}]}}}}': "rejected",
             f'{{"a": {{"script": "s", {twice}}}}}': "rejected", f'{{"a": {{"script": [1], {twice}}}}}': "rejected",
             f'{{"a": {{"state": "[y]", "name": "{{z}}", "conf": 10, "cpe": true, {twice}}}}}': "parsed", f'{{"a": {{"script": {{"q": "1", "q": "2"}}, {twice}}}}}': "parsed",
             f'{{"a": {{"script": null, "state": null, {twice}}}, "b": null}}': "parsed", f'{{"a": {{"state": ["y"], "state": "y", {twice}}}}}': "rejected"}
    df = spark.createDataFrame(list(texts.items()), "body string, want string")
    got = {r["body"]: r["s"] for r in df.select("body", R.routing_status(F.col("body")).alias("s")).collect()}
    assert got == texts


# --- places of matches, records of one person -------------------------------

def _spans_of(text):
    out = []
    for kind, (pattern, group, _) in ENTITY_PATTERNS.items():
        out += [(m.start(), kind, m.end(), m.group(group)) for m in re.finditer(pattern, text or "")]
    return sorted(out)


def _records_of(text):
    owner, fields, found = 0, {}, []
    for start, kind, _, value in sorted(_spans_of(text), key=lambda s: (s[0], ("phone", "extension", "email").index(s[1]))):
        if kind == "phone":
            owner += 1
            fields[owner] = {"start": start, "phone": value}
        elif owner and kind not in fields[owner]:
            fields[owner][kind] = value
        else:
            found.append({"start": start, kind: value})
    rows = sorted([*fields.values(), *found], key=lambda r: r["start"])
    return [(k, r["start"], r.get("phone"), r.get("extension"), r.get("email")) for k, r in enumerate(rows)]


def _contact_soup(rng):
    parts = ["jdoe77", "02-23456789", "02-2345678", "+1 (555) 010-2030", "#3910", "#39", "\n", " ", "a.b@x.example.org", "kwan@lab.example.edu.tw", "Ünï 中", "😀", "0223456789", "/ "]
    return "".join(rng.choice(parts) for _ in range(rng.randint(0, 40)))


def test_places_and_records_match_a_scan(spark):
    rng = random.Random(2)
    texts = [*CONTACT_TEXT.values(), *(_contact_soup(rng) for _ in range(300)), "x 02-23456789#3910 " * 700]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    spans, records = {}, {}
    for r in E.extract_spans(df).collect():
        spans.setdefault(r["doc_id"], []).append((r["start"], r["kind"], r["end"], r["value"]))
    for r in E.contact_records(df).collect():
        records.setdefault(r["doc_id"], []).append(tuple(r)[1:])
    for i, text in enumerate(texts):
        assert sorted(spans.get(i, [])) == _spans_of(text), text
        assert sorted(records.get(i, [])) == _records_of(text), text


def test_records_of_the_hazards(spark):
    got = {(r["doc_id"], r["rec"]): (r["phone"], r["extension"], r["email"]) for r in E.contact_records(contact_docs(spark)).collect()}
    assert got == {(1, 0): ("02-23456789", "3910", None), (2, 0): ("02-23456789", "3911", None), (3, 0): ("02-2345678", "3912", "kwan@lab.example.edu.tw"),
                   (5, 0): (None, None, "a.b@x.example.org"), (5, 1): (None, None, "c_d@y.example.com"), (6, 0): ("02-23456789", "3913", "rwu@lab.example.org"),
                   (7, 0): ("+1 (555) 010-2030", None, None), (7, 1): ("+1 (555) 010-4050", None, None)}
    plan = E.contact_records(contact_docs(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_scan_text_is_parsed_once(spark):
    rows = spark.sparkContext.parallelize([(1, '{"80": {"state": "{open", "script": {"a": "1"}}}')], 1)
    good, _ = R.route_malformed(spark.createDataFrame(rows, "scan_id long, body string"), "body")
    flat = R.flatten_keyed(good, "scan_id", "parsed")
    plan = flat._jdf.queryExecution().optimizedPlan().toString()
    assert sum("from_json(" in line for line in plan.splitlines()) == 1
    assert [(r.port, r.state, r.script) for r in flat.collect()] == [("80", "{open", {"a": "1"})]
