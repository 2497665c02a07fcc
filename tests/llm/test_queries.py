"""The registered queries on the smallest tables: SQL where there is some,
invariants where there is none."""

import pytest
from pyspark.sql import functions as F

from pageops.llm.queries import ORACLES, QUERIES
from pageops.plans.compare import compare


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, sf_small, name):
    r = compare(spark, sf_small, name, QUERIES[name], ORACLES[name])
    assert r["match"] and r["rows"] > 0, r


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES) - {"op5_mincut_text"}))
def test_query_has_a_row_per_document(spark, sf_small, name):
    n = spark.read.parquet(f"{sf_small}/documents.parquet").count()
    out = QUERIES[name](spark, sf_small)
    assert out.count() == n == out.select("doc_id").distinct().count()


def test_outliers_run_no_python(spark, sf_small):
    plan = QUERIES["op3_mcd_outliers"](spark, sf_small)._jdf.queryExecution().executedPlan().toString()
    assert not [x for x in ("Python", "Arrow", "Pandas") if x in plan]


def test_classifiers_on_held_out_rows(spark):
    """Held-out accuracy on the tables of the bench scale."""
    d = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{d}/labels.parquet")
    for name, label, low in (("op1_subword_toxicity", "toxic", 0.9), ("op9_byte_cnn", "quality", 0.95)):
        out = QUERIES[name](spark, d).filter("held_out").join(labels, "doc_id")
        good, n = out.select(F.sum((F.col("predicted") == F.col(label)).cast("int")), F.count("*")).first()
        assert n > 300 and good / n >= low, (name, good / n)


def test_pipeline_runs(spark, sf_small):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    names, before = docs.columns, docs
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, before, sf_small)
        if k + 1 < len(corpus_pipeline.STAGES):
            assert docs.columns == names, name
            from pageops.llm.common import keep
            docs = keep(docs, "test-stage")
            if name != "mix_sources":
                assert 0 < docs.count() <= before.count(), name
        before = docs
    assert docs.count() > 0 and docs.filter("octet_length(ids) <> 4 * n_tokens").count() == 0


def test_stages_carry_any_columns(spark):
    """Extra columns, also those named as the operators' own, go through all but
    the last stage with their rows; so do null ids and repeated ids."""
    import corpus_pipeline
    from pageops.llm.common import keep

    words = [f"word{k}" for k in range(400)]
    rows = [(i if i % 7 else None, " ".join(words[(i * 37 + 11 * j) % 400] for j in range(120)) + f" tail{i}", "en", f"s{i % 3}", 1) for i in range(40)]
    rows += [rows[3], rows[4], (5, rows[8][1], "en", "s1", 1), (90, " ".join(words[:80]) + " a b c", "de", "s0", 1), (91, "x y " + " ".join(words[:80]), "de", "s0", 1)]
    extra = [(*r, k, f"v{k}", [k], float(k), k) for k, r in enumerate(rows)]
    docs = spark.createDataFrame(extra, "doc_id long, text string, lang string, source string, n_chars long, n_words long, repeats string, t array<long>, node double, carried long")
    by_mark = {f"v{k}": r for k, r in enumerate(extra)}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = keep(stage(spark, docs, ""), "any-columns")
        assert out.columns == docs.columns and dict(out.dtypes) == dict(docs.dtypes), name
        got = out.collect()
        assert got, name
        for r in got:
            was = by_mark[r["repeats"]]
            assert (r["doc_id"], r["lang"], r["source"], r["n_words"], r["t"], r["node"], r["carried"]) == (was[0], was[2], was[3], was[5], was[7], was[8], was[9]), name
            if name == "substring_dedup":
                assert r["n_chars"] == len(r["text"])
        docs = out
    assert corpus_pipeline.STAGES[-1][1](spark, docs, "").count() == docs.count()
