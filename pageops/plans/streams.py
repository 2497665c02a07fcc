"""Stream forms registered as queries.

Each runs its stream over the table's file with ``trigger(availableNow=True)``
into a fresh folder under the shared checkpoint folder, then reads the sink
back as a batch DataFrame - so the stream result is checked against the same
oracle as the batch query (stream equals batch).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..session import scratch_path
from ..streaming import jobs as S
from .catalog import ITEM, ORACLES, WORDS, _ATTEMPTS_CTE, attempts_from_events


#: Files a micro-batch takes at most.
FILES = 64


def _paths(spark, name):
    base = scratch_path(spark, name)
    return f"{base}/out", f"{base}/checkpoint"


def _finish(q):
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


def q_stream_index_links(spark, root):
    out, ck = _paths(spark, "stream-index-links")
    _finish(S.stream_index_links(S.read_stream(spark, root, "pages", FILES), out, ck, ITEM, None, WORDS))
    return spark.read.parquet(out)


def q_stream_contact_entities(spark, root):
    out, ck = _paths(spark, "stream-entities")
    _finish(S.stream_entities(S.read_stream(spark, root, "documents", FILES), out, ck))
    return spark.read.parquet(out)


def q_stream_distinct_keys(spark, root):
    out, ck = _paths(spark, "stream-distinct")
    _finish(S.stream_distinct(S.read_stream(spark, root, "events", FILES), ["user_id", "event_type"], out, ck))
    return spark.read.parquet(out).select("user_id", "event_type")


def q_stream_bracket_state(spark, root):
    out, ck = _paths(spark, "stream-bracket")
    att = attempts_from_events(S.read_stream(spark, root, "events", FILES))
    _finish(S.stream_bracket_state(att, "user_id", out, ck))
    return S.bracket_state(spark, out, att.schema["user_id"])


def q_stream_bracket_history(spark, root):
    out, ck = _paths(spark, "stream-bracket-history")
    att = attempts_from_events(S.read_stream(spark, root, "events", FILES))
    kept = S.History(att.schema, "user_id", ("ts", "event_id"), out, F.unix_date(F.to_date("ts")))
    _finish(S.stream_bracket_history(att, kept, ck))
    h = kept.read(spark)
    return h.select("user_id", "event_id", "seq", "lo", "hi", "outcome")


STREAM_QUERIES = {
    "stream_index_links": q_stream_index_links,
    "stream_contact_entities": q_stream_contact_entities,
    "stream_distinct_keys": q_stream_distinct_keys,
    "stream_bracket_state": q_stream_bracket_state,
    "stream_bracket_history": q_stream_bracket_history,
}

STREAM_ORACLES = {
    "stream_bracket_history": ORACLES["bracket_history"],
    "stream_index_links": ORACLES["index_links"],
    "stream_contact_entities": ORACLES["contact_entities"],
    "stream_distinct_keys": "SELECT DISTINCT user_id, event_type FROM events",
    "stream_bracket_state": f"""WITH {_ATTEMPTS_CTE}
SELECT user_id, CAST(count(*) AS BIGINT) AS attempts,
  CAST(greatest(1, max(CASE WHEN val < target THEN val END)) AS BIGINT) AS lo,
  CAST(least(100, min(CASE WHEN val > target THEN val END)) AS BIGINT) AS hi,
  max(CASE WHEN val = target AND target > 1 AND target < 100 THEN 1 ELSE 0 END) AS hit
FROM checked GROUP BY user_id""",
}

