"""Sources and sinks: page corpus as JSON lines, scan objects as JSON lines,
partitioned parquet output."""

import json
import os
import tempfile

from pyspark.sql import functions as F

from pageops.functions.patterns import FORUM_EXCLUDED, FORUM_ITEM, FORUM_TITLE
from pageops.operators import links as L
from pageops.operators import records as R
from pageops.sources import tables as S

from .fixtures import INDEX_LINKS_EXPECTED, INDEX_PAGES, RECORDS_EXPECTED, SCAN_JSON


def test_pages_from_json_lines(spark):
    d = tempfile.mkdtemp(prefix="pageops-src-")
    with open(os.path.join(d, "pages.json"), "w") as f:
        for pid, html in INDEX_PAGES.items():
            f.write(json.dumps({"page_id": pid, "url": f"https://forum.example.org/{pid}", "html": html}) + "\n")
    pages = S.read_pages(spark, d, "json")
    assert pages.schema == S.PAGES
    got = sorted(tuple(r) for r in L.index_links(pages, FORUM_ITEM, FORUM_TITLE, FORUM_EXCLUDED).collect())
    assert got == sorted(INDEX_LINKS_EXPECTED)


def test_scans_from_json_lines(spark):
    d = tempfile.mkdtemp(prefix="pageops-src-")
    with open(os.path.join(d, "scans.json"), "w") as f:
        for sid, body in SCAN_JSON.items():
            f.write(json.dumps({"scan_id": sid, "body": body}) + "\n")
    good, bad = R.route_malformed(S.read_scans(spark, d), "body")
    flat = R.flatten_keyed(good, "scan_id", "parsed")
    got = sorted((r["scan_id"], r["pos"], r["port"], r["state"], r["name"], r["product"]) for r in flat.collect())
    assert got == sorted(RECORDS_EXPECTED)
    assert bad.count() == 3


def test_partitioned_sink_round_trip(spark, sf_small):
    d = tempfile.mkdtemp(prefix="pageops-sink-")
    links = L.index_links(S.read_table(spark, sf_small, "pages"), ("li", None), None, ("the",))
    out = links.withColumn("bucket", F.pmod(F.col("page_id"), F.lit(4)))
    S.write_table(out, f"{d}/links", partition_by=["bucket"])
    back = spark.read.parquet(f"{d}/links")
    assert sorted(back.columns) == sorted(out.columns)
    assert back.count() == links.count()
    assert back.where("bucket = 1").select(F.max(F.pmod("page_id", F.lit(4)))).first()[0] == 1


def test_html_files_source(spark):
    d = tempfile.mkdtemp(prefix="pageops-html-")
    os.makedirs(os.path.join(d, "day=1"))
    for pid, html in INDEX_PAGES.items():
        if html is not None:
            with open(os.path.join(d, "day=1", f"p{pid}.html"), "w", encoding="utf-8") as f:
                f.write(html)
    with open(os.path.join(d, "notes.txt"), "w") as f:
        f.write("<li><a href='/x'>not a page</a></li>")
    pages = S.read_html_files(spark, d)
    # six files written; the empty one (page 6) gives no row; notes.txt is skipped
    assert pages.count() == 5
    links = L.index_links(pages, FORUM_ITEM, FORUM_TITLE, FORUM_EXCLUDED)
    by_file = {}
    for r in links.join(pages.select("page_id", "url"), "page_id").collect():
        by_file.setdefault(os.path.basename(r["url"]), []).append((r["rank"], r["title"], r["link"]))
    want = {}
    for pid, rank, title, link in INDEX_LINKS_EXPECTED:
        want.setdefault(f"p{pid}.html", []).append((rank, title, link))
    assert {k: sorted(v) for k, v in by_file.items()} == {k: sorted(v) for k, v in want.items()}


def test_command_line(spark, sf_small, capsys):
    from pageops.__main__ import main
    d = tempfile.mkdtemp(prefix="pageops-cli-")
    assert main(["index_links", sf_small, "--out", f"{d}/out"]) == 0
    assert spark.read.parquet(f"{d}/out").count() == L.index_links(
        S.read_table(spark, sf_small, "pages"), ("li", None), None, ("the", "ou")).count()
    assert main(["extract_phones", sf_small, "--show", "3"]) == 0
    assert "phone" in capsys.readouterr().out
