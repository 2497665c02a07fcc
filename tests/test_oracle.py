"""Every registered query against its DuckDB oracle on the smallest tables,
plus plan checks: no Python evaluation in core queries and no raw html in
any shuffle."""

import pytest

from __spark_entry__ import entry
from pageops.plans.catalog import ORACLES, QUERIES
from pageops.plans.compare import compare
from pageops.plans.streams import STREAM_ORACLES, STREAM_QUERIES


def queries():
    return {**QUERIES, **STREAM_QUERIES}


def oracle_sql():
    return {**ORACLES, **STREAM_ORACLES}


NAMES = sorted(queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, sf_small, name):
    sql = oracle_sql().get(name)
    r = compare(spark, sf_small, name, queries()[name], sql)
    if sql is not None:
        assert r["match"], r
    assert r["rows"] > 0 or name == "extract_extensions"


def test_entry_runs(spark):
    df = entry(spark)
    assert df.columns == ["page_id", "rank", "title", "link"]
    assert df.count() > 0


@pytest.mark.parametrize("name", [n for n in NAMES if not n.startswith("stream_")])
def test_core_plans(spark, sf_small, name):
    df = queries()[name](spark, sf_small)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for node in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas",
                 "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan, (name, node)
    node = df._jdf.queryExecution().executedPlan()
    todo = [node.initialPlan() if node.nodeName() == "AdaptiveSparkPlan" else node]
    while todo:
        node = todo.pop()
        if "Exchange" in node.nodeName():
            assert "html#" not in node.output().toString(), f"{name}: html in a shuffle"
        kids = node.children()
        todo += [kids.apply(i) for i in range(kids.size())]
