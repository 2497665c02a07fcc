"""Stream equals batch over several micro-batches (one file per trigger)."""

import random
import tempfile
from datetime import datetime

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from pageops.operators import links as L
from pageops.plans.catalog import ITEM, WORDS, attempts_from_events
from pageops.streaming import jobs as S
from pageops.streaming.store import KeyStore, Levels, exists


def _split(spark, src, table, parts, folder, newest_first=False):
    """Write the table as a folder ``<table>.parquet`` of ``parts`` consecutive
    row ranges, with file times in that order (test setup only)."""
    import os

    import pyarrow.parquet as pq
    os.makedirs(f"{folder}/{table}.parquet", exist_ok=True)
    t = pq.read_table(f"{src}/{table}.parquet")
    step = -(-t.num_rows // parts)
    for i in range(parts):
        pq.write_table(t.slice(i * step, step), f"{folder}/{table}.parquet/part-{i}.parquet")
        at = 1_700_000_000 + (parts - i if newest_first else i) * 60
        os.utime(f"{folder}/{table}.parquet/part-{i}.parquet", (at, at))
    return spark.read.parquet(f"{src}/{table}.parquet")


def _tmp():
    return tempfile.mkdtemp(prefix="pageops-stream-test-")


def _done(q):
    q.awaitTermination()
    assert q.exception() is None
    return q


def test_links_stream_equals_batch(spark, sf_small):
    d = _tmp()
    pages = _split(spark, sf_small, "pages", 3, f"{d}/in")
    q = _done(S.stream_index_links(S.read_stream(spark, f"{d}/in", "pages", max_files=1),
                                   f"{d}/out", f"{d}/ck", ITEM, None, WORDS))
    assert len(q.recentProgress) >= 3
    got = sorted(tuple(r) for r in spark.read.parquet(f"{d}/out").collect())
    want = sorted(tuple(r) for r in L.index_links(pages, ITEM, None, WORDS).collect())
    assert got == want


@pytest.mark.parametrize("newest_first", [False, True])
def test_bracket_state_stream_equals_one_epoch(spark, sf_small, newest_first):
    got = []
    for parts in (1, 4):
        d = _tmp()
        _split(spark, sf_small, "events", parts, f"{d}/in", newest_first)
        att = attempts_from_events(S.read_stream(spark, f"{d}/in", "events", max_files=1))
        _done(S.stream_bracket_state(att, "user_id", f"{d}/out", f"{d}/ck"))
        got.append(sorted(tuple(r) for r in S.bracket_state(spark, f"{d}/out", att.schema["user_id"]).collect()))
    assert got[0] and got[0] == got[1]


@pytest.mark.parametrize("newest_first", [False, True])
def test_distinct_stream_equals_batch(spark, sf_small, newest_first):
    d = _tmp()
    events = _split(spark, sf_small, "events", 4, f"{d}/in", newest_first)
    q = _done(S.stream_distinct(S.read_stream(spark, f"{d}/in", "events", max_files=1), ["user_id", "event_type"], f"{d}/out", f"{d}/ck"))
    assert len(q.recentProgress) >= 4
    got = sorted(tuple(r) for r in spark.read.parquet(f"{d}/out").select("user_id", "event_type").collect())
    assert got == sorted(tuple(r) for r in events.select("user_id", "event_type").distinct().collect())


def test_missing_table_is_an_error(spark, sf_small):
    with pytest.raises(AnalysisException):
        S.read_stream(spark, f"{sf_small}/nowhere", "events")


def test_registered_streams_read_folders(spark, sf_small, monkeypatch):
    from pageops.plans import streams
    from pageops.plans.compare import compare

    monkeypatch.setattr(streams, "FILES", 1)
    d = _tmp()
    for table in ("events", "pages", "documents"):
        _split(spark, sf_small, table, 4, d)
    for name, query in streams.STREAM_QUERIES.items():
        got = sorted(map(repr, query(spark, d).collect()))
        assert got, name
        assert got == sorted(map(repr, query(spark, sf_small).collect())), name


def test_entities_stream(spark, sf_small):
    d = _tmp()
    docs = _split(spark, sf_small, "documents", 2, f"{d}/in")
    from pageops.operators import entities as E
    _done(S.stream_entities(S.read_stream(spark, f"{d}/in", "documents", max_files=1), f"{d}/out", f"{d}/ck"))
    got = sorted(tuple(r) for r in spark.read.parquet(f"{d}/out").collect())
    assert got == sorted(tuple(r) for r in E.extract_entities(docs).collect())


def _history(att, out):
    return S.History(att.schema, "user_id", ("ts", "event_id"), out, F.unix_date(F.to_date("ts")))


@pytest.mark.parametrize("newest_first", [False, True])
def test_bracket_history_stream_equals_batch(spark, sf_small, newest_first):
    """Also of files in the wrong order: late attempts rewrite their own day."""
    from pageops.operators import numbers as N
    d = _tmp()
    events = _split(spark, sf_small, "events", 5, f"{d}/in", newest_first)
    att = attempts_from_events(S.read_stream(spark, f"{d}/in", "events", max_files=1))
    kept = _history(att, f"{d}/out")
    _done(S.stream_bracket_history(att, kept, f"{d}/ck"))
    cols = ["user_id", "event_id", "seq", "lo", "hi", "outcome"]
    got = sorted(tuple(r) for r in kept.read(spark).select(*cols).collect())
    want = sorted(tuple(r) for r in N.bracket_history(attempts_from_events(events), "user_id", ["ts", "event_id"]).select(*cols).collect())
    assert got == want


def test_late_attempts_rewrite_their_groups_only(spark):
    """Random attempts in random batches (keys and days null too): the history
    is that of all of them at every point, and an epoch writes no other group."""
    from pageops.operators import numbers as N
    rng = random.Random(6)
    schema = "user_id long, ts timestamp, event_id long, raw string, target long"
    rows = [(rng.choice([1, 2, 3, None]), rng.choice([None, datetime(2024, 1, rng.randint(1, 6), rng.randint(0, 23))]), i, rng.choice([str(rng.randint(1, 99)), "x", "50"]),
             50) for i in range(240)]
    everything = spark.createDataFrame(rows, schema)
    d = _tmp()
    kept = _history(everything, d)
    sizes = [90, 1, 60, 3, 86]
    for epoch, n in enumerate(sizes):
        done = sum(sizes[:epoch])
        batch = spark.createDataFrame(rows[done:done + n], schema)
        kept.write(batch, epoch)
        if epoch == 2:
            kept.write(batch, epoch)                      # tried again
        groups = {(r[0], r[1]) for r in spark.read.parquet(f"{d}/rows/epoch={epoch}").select("user_id", "_bucket").distinct().collect()}
        assert groups == {(r[0], r[1]) for r in batch.select("user_id", F.coalesce(F.unix_date(F.to_date("ts")), F.lit(-2**31))).distinct().collect()}
        cols = ["user_id", "event_id", "seq", "lo", "hi", "outcome"]
        got = sorted(map(repr, kept.read(spark).select(*cols).collect()))
        so_far = spark.createDataFrame(rows[:done + n], schema)
        assert got == sorted(map(repr, N.bracket_history(so_far, "user_id", ["ts", "event_id"]).select(*cols).collect())), epoch
    # An epoch of all groups leaves the earlier folders to the next one.
    kept.write(everything.withColumn("event_id", F.col("event_id") + 1000), len(sizes))
    kept.write(everything.limit(1).withColumn("event_id", F.lit(5000).cast("long")), len(sizes) + 1)
    import glob
    assert not [f for e in range(len(sizes)) for f in glob.glob(f"{d}/rows/epoch={e}/_bucket=*")]
    assert kept.read(spark).count() > 0


def _sums(spark, root, fan=3):
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("n", T.LongType())])
    return Levels(spark, root, schema, lambda rows: rows.groupBy("k").agg(F.sum("n").alias("n")), fan)


def test_levels_fold_a_logarithmic_number_of_tables(spark):
    d = _tmp()
    levels = _sums(spark, d)
    for epoch in range(30):
        levels.commit(epoch, spark.createDataFrame([(epoch % 4, 1), (9, 1)], "k long, n long").coalesce(1))
        tables = levels.tables(epoch + 1)
        assert len(tables) <= 2 * 4 and all(exists(spark, t) for t in tables), (epoch, tables)
        if epoch in (0, 2, 8, 13, 29):
            got = {r["k"]: r["n"] for r in levels.read().collect()}
            assert got == {9: epoch + 1, **{k: len(range(k, epoch + 1, 4)) for k in range(min(4, epoch + 1))}}
            assert {r["k"]: r["n"] for r in levels.read(before=epoch).collect()}.get(9, 0) == epoch
    import glob
    assert len(glob.glob(f"{d}/level=*/index=*")) <= 2 * 3 * 4 and len(glob.glob(f"{d}/pointer/0*")) <= 2


def test_a_crash_between_writing_and_pointing_changes_nothing(spark, monkeypatch):
    from pageops.streaming import store
    d = _tmp()
    levels = _sums(spark, d)
    batch = spark.createDataFrame([(1, 1)], "k long, n long").coalesce(1)
    for epoch in range(8):
        levels.commit(epoch, batch)
    before = levels.read().collect()

    def crash(*a):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(store, "_point", crash)
        with pytest.raises(RuntimeError):
            levels.commit(8, batch)                       # merges two levels, then is lost
    assert levels.read().collect() == before == [(1, 8)]
    levels.commit(8, batch)
    assert levels.read().collect() == [(1, 9)]


def test_key_store_reads_touched_buckets_only(spark):
    """Every key once over many epochs, retried ones too; what an epoch reads
    stays bounded by the buckets it has keys of."""
    rng = random.Random(9)
    d = _tmp()
    kept = KeyStore(spark, f"{d}/keys", ("a", "b"), buckets=4, bucket_rows=20, fan=3)
    seen, most = set(), []
    for epoch in range(14):
        rows = [(rng.choice([None, *range(12)]), rng.choice([None, "x", "y", str(rng.randrange(40))])) for _ in range(3 if epoch > 8 else 25)]
        batch = spark.createDataFrame(rows, "a long, b string").coalesce(1)
        if epoch:
            n = kept.manifest(epoch)[0]["buckets"]
            touched = {r[0] for r in batch.select(F.pmod(F.xxhash64("a", "b"), F.lit(n)).cast("int")).distinct().collect()}
            parts = kept.parts_read(epoch, touched)
            assert all(exists(spark, p) for p in parts) and len(parts) <= 3 * len(touched)
            most.append(n)
        for _ in range(2 if epoch == 5 else 1):
            kept.add(epoch, batch, f"{d}/out/epoch={epoch}")
        got = [tuple(r) for r in spark.read.schema("a long, b string").parquet(f"{d}/out/epoch={epoch}").collect()]
        assert len(got) == len(set(got)) and set(got) == set(rows) - seen, epoch
        seen |= set(rows)
    assert most[-1] > 4                                   # buckets were doubled


@pytest.mark.parametrize("newest_first", [False, True])
def test_registered_bracket_history_takes_any_order(spark, sf_small, monkeypatch, newest_first):
    from pageops.plans import catalog, streams

    monkeypatch.setattr(streams, "FILES", 1)
    d = _tmp()
    _split(spark, sf_small, "events", 4, d, newest_first)
    got = sorted(tuple(r) for r in streams.STREAM_QUERIES["stream_bracket_history"](spark, d).collect())
    assert got and got == sorted(tuple(r) for r in catalog.QUERIES["bracket_history"](spark, sf_small).collect())


def test_distinct_within_watermark_is_a_stream(spark, sf_small):
    d = _tmp()
    events = _split(spark, sf_small, "events", 1, f"{d}/in")
    first = S.distinct_within_watermark(S.read_stream(spark, f"{d}/in", "events"), ["user_id"], delay="3650 days").select("user_id")
    _done(first.writeStream.format("parquet").option("path", f"{d}/out").option("checkpointLocation", f"{d}/ck").trigger(availableNow=True).start())
    assert spark.read.parquet(f"{d}/out").count() == events.select("user_id").distinct().count()
