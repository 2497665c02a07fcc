"""Validated numeric attempts and per-key bracket narrowing.

A key's attempts are read in a total order.  Each attempt is a string that
must parse as an integer the way Python's ``int()`` does; it must lie strictly
inside the live bracket ``(lo, hi)``; it is compared with the key's target;
a low or high attempt narrows the bracket; the first hit ends the key.

The sequential loop is a prefix computation: before attempt *i*,
``lo = max(LOWEST, max of earlier v < target)`` and
``hi = min(HIGHEST, min of earlier v > target)``.  An attempt outside the
bracket never moves it (it lies outside already), so no "accepted" filter is
needed.  Prefixes come from ``scan.running``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.patterns import HIGHEST, INT_GUARD_RE, INT_NOISE_RE, LOWEST
from . import scan

OUTCOMES = ("format", "range", "low", "high", "hit")
_INT = "decimal(38,0)"


def parse_int(raw: Column) -> Column:
    """``int(raw)`` as ``decimal(38,0)``; NULL when the text is not an
    integer or has more than 38 significant digits.  Accepts Unicode space
    padding, a sign, underscores between digits and any Unicode decimal digit."""
    ok = raw.rlike(INT_GUARD_RE)
    return F.when(ok, F.regexp_replace(raw, INT_NOISE_RE, "").try_cast(_INT))


def format_ok(raw: Column) -> Column:
    """True when ``raw`` is integer text (of any size); NULL text is not."""
    return F.coalesce(raw.rlike(INT_GUARD_RE), F.lit(False))


def validate(df: DataFrame, raw_col: str = "raw", lo: int = LOWEST, hi: int = HIGHEST) -> DataFrame:
    """D1, D2 against a fixed open interval: adds ``value`` and ``reason``
    (``format``, ``range`` or ``ok``).  Plain codegen'd columns; the guard
    regex runs once (``_ok`` is read twice, so it is not inlined)."""
    c = df.withColumn("_ok", format_ok(F.col(raw_col)))
    c = c.withColumn("value", F.when(F.col("_ok"), F.regexp_replace(F.col(raw_col), INT_NOISE_RE, "").try_cast(_INT)))
    reason = (F.when(~F.col("_ok"), F.lit("format"))
              .when(F.col("value").isNull() | (F.col("value") <= lo) | (F.col("value") >= hi), F.lit("range"))
              .otherwise(F.lit("ok")))
    return c.withColumn("reason", reason).drop("_ok")


def quarantine(df: DataFrame, raw_col: str = "raw", lo: int = LOWEST,
               hi: int = HIGHEST) -> tuple[DataFrame, DataFrame]:
    """Classify once and split into (accepted, rejected).

    A filter on ``reason`` would be pushed below the projection with the whole
    classification substituted into it (regex and cast repeated per branch of
    the test).  Passing the classified row through a one-row ``inline`` fences
    the filter: the row is classified once, in codegen, then filtered.  (On 4M
    attempts: 2.3 s, against 6.9 s with the pushed-down filter.)"""
    v = validate(df, raw_col, lo, hi)
    fenced = v.select(F.inline_outer(F.array(F.struct(*v.columns))))
    return fenced.where(F.col("reason") == "ok"), fenced.where(F.col("reason") != "ok")


def write_quarantine(df: DataFrame, path: str, raw_col: str = "raw", lo: int = LOWEST,
                     hi: int = HIGHEST, mode: str = "overwrite") -> None:
    """D9 in one pass: classify every row once and write a single dataset
    partitioned by ``reason`` (``reason=ok`` accepted; ``format``/``range``
    rejected), instead of two filtered scans."""
    validate(df, raw_col, lo, hi).write.mode(mode).partitionBy("reason").parquet(path)


def draw_in_range(key: Column, lo: int = LOWEST, hi: int = HIGHEST, seed: int = 0) -> Column:
    """A uniform integer in the closed range ``[lo, hi]``, reproducible per
    key (multiplicative hashing of the key's low 32 bits; portable to SQL)."""
    m, n = 4294967296, hi - lo + 1
    k = F.pmod(key.cast("long"), F.lit(m)).cast(_INT)
    h = F.pmod(k * F.lit(2654435761).cast(_INT) + F.lit(seed).cast(_INT), F.lit(m).cast(_INT))
    # Whole numbers all the way: h * n less its remainder is a multiple of m.
    scaled = h * F.lit(n).cast(_INT)
    exact = (scaled - F.pmod(scaled, F.lit(m).cast(_INT))) / F.lit(m).cast(_INT)
    return (F.lit(lo).cast(_INT) + exact).cast("long")


def draw_random(lo: int = LOWEST, hi: int = HIGHEST, seed: int | None = None) -> Column:
    """D6, non-reproducible form: ``randint(lo, hi)`` per row."""
    r = F.rand(seed) if seed is not None else F.rand()
    return (F.floor(r * (hi - lo + 1)) + lo).cast("long")


def parsed(attempts: DataFrame, raw_col: str) -> DataFrame:
    """Adds ``_ok`` (integer text) and ``value``."""
    with_ok = attempts.withColumn("_ok", format_ok(F.col(raw_col)))
    return with_ok.withColumn("value", F.when(F.col("_ok"), F.regexp_replace(F.col(raw_col), INT_NOISE_RE, "").try_cast(_INT)))


def bracket_history(attempts: DataFrame, key: str, order: list[str], raw_col: str = "raw",
                    target_col: str = "target", lo: int = LOWEST, hi: int = HIGHEST, *,
                    bucket: Column | None = None) -> DataFrame:
    """Per attempt the bracket before it and its outcome, up to and
    including the key's first hit.  Adds ``seq`` (1-based place in the key's
    order), ``value``, ``lo``, ``hi``, ``outcome``.  ``bucket`` cuts large keys
    into groups that fit a task (see ``scan``)."""
    t = F.col(target_col).cast(_INT)
    # the guard regex runs once per row: "_ok" feeds both the value and the outcome
    with_v = parsed(attempts, raw_col)
    val = F.col("value")
    return told(scan.running(with_v, key, order, moves(val, t, lo, hi), bucket=bucket), target_col, lo, hi)


def moves(val: Column, t: Column, lo: int, hi: int) -> dict[str, tuple[str, Column]]:
    """What an attempt does to its key's bracket, as running aggregates."""
    return {
        "below": ("max", F.when(val < t, val)),
        "above": ("min", F.when(val > t, val)),
        # A guess equal to a target on the bounds is out of range, never a hit.
        "hits": ("sum", F.when((val == t) & (t > lo) & (t < hi), F.lit(1)).otherwise(F.lit(0))),
        "before": ("sum", F.lit(1)),
    }


def told(run: DataFrame, target_col: str, lo: int, hi: int) -> DataFrame:
    """Brackets and outcomes of attempts (``_ok``, ``value``) with the running
    aggregates of ``moves`` over the attempts before each."""
    val, t = F.col("value"), F.col(target_col).cast(_INT)
    lo_c = F.greatest(F.lit(lo).cast(_INT), F.col("below"))
    hi_c = F.least(F.lit(hi).cast(_INT), F.col("above"))
    outcome = (F.when(~F.col("_ok"), F.lit("format"))
               .when(val.isNull() | (val <= F.col("lo")) | (val >= F.col("hi")), F.lit("range"))
               .when(val == t, F.lit("hit"))
               .when(val < t, F.lit("low"))
               .otherwise(F.lit("high")))
    return (run.where(F.coalesce(F.col("hits"), F.lit(0)) == 0)
            .withColumn("seq", (F.coalesce(F.col("before"), F.lit(0)) + 1).cast("long"))
            .withColumn("lo", lo_c.cast("long"))
            .withColumn("hi", hi_c.cast("long"))
            .withColumn("outcome", outcome)
            .drop("below", "above", "hits", "before", "_ok"))


def bracket_summary(history: DataFrame, key: str, target_col: str = "target",
                    lo: int = LOWEST, hi: int = HIGHEST) -> DataFrame:
    """Per key, attempts by outcome, whether it was hit and the final
    bracket.  Plain partial aggregates: a hot key costs one row per map task."""
    val = F.col("value")
    t = F.col(target_col).cast(_INT)
    oc = F.col("outcome")
    ok = oc.isin("low", "high", "hit")
    return history.groupBy(key).agg(
        F.count(F.lit(1)).alias("attempts"),
        F.count_if(oc == "format").alias("n_format"),
        F.count_if(oc == "range").alias("n_range"),
        F.count_if(oc == "low").alias("n_low"),
        F.count_if(oc == "high").alias("n_high"),
        F.count_if(oc == "hit").alias("n_hit"),
        F.greatest(F.lit(lo).cast(_INT), F.max(F.when(ok & (val < t), val))).cast("long").alias("final_lo"),
        F.least(F.lit(hi).cast(_INT), F.min(F.when(ok & (val > t), val))).cast("long").alias("final_hi"),
    )
