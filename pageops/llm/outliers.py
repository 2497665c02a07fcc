"""Quality rules: robust multivariate outliers, in DataFrame functions only.

Every whole text gets base counts and a vector of five transformed statistics.
Texts that fail the base rules are rejected.  The others' vectors are judged by
language and source: a minimum-covariance-determinant estimate (mean and
covariance of the ``SHARE`` of the group's vectors that lie closest, found by
concentration steps from two starts, of which the one with the smaller
determinant counts) gives each vector a Mahalanobis distance, and vectors beyond
``CUTOFF`` are rejected.

Vectors are rounded to 1/100, so all sums are whole numbers and results do not
depend on the order of addition.  Distances are compared in bins of 1/16.
Groups under ``MIN_GROUP`` vectors are judged by the estimate of all such
groups of their language, or of all languages; if those are too few as well,
they are kept.  ``estimate`` says which.

Null or empty text has no words and fails the base rules.  Null lang or source
is a value of its own.  Each row is judged by itself, repeated rows alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageops.functions.html import let

from .common import WORD, keep, only

WINDOW = 8
STEPS = 6
SHARE = 0.75
MIN_GROUP = 50
GROUPS_TO_BROADCAST = 100_000
REJECTS_TO_BROADCAST = 1_000_000
# For five dimensions and a share of 0.75: the factor that makes the covariance
# of the inner part that of all (fixed value), and the cutoff, the chi-squared
# quantile of 1 - 1e-6.
CONSISTENCY = 1.41
CUTOFF = 35.9
#: Standard deviations added to each statistic's own, so that a statistic that
#: is the same in nearly all texts of a group does not reject slight change.
FLOOR = {"v0": 1.0, "v1": 0.1, "v2": 0.25, "v3": 0.15, "v4": 0.15}
_V = list(FLOOR)
_BLANK = r"[\x20\x09-\x0D]+"
_SYMBOL = r"[#*$%&|<>]+"


def _covered(hashes: Column) -> Column:
    """Words in windows (of the given hashes, by first word) found twice or more."""
    pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def count(v: Column) -> Column:
        s = v["sorted"]
        def same(x: Column, at: Column) -> Column:
            return F.coalesce(F.get(s, at)["h"] == x["h"], F.lit(False))

        again = F.filter(s, lambda x, k: same(x, k - 1) | same(x, k + 1))
        return let(lambda w: F.aggregate(
            F.transform(w["at"], lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get(w["at"], k + 1) - p, F.lit(WINDOW))).cast("long")),
            F.lit(0).cast("long"), lambda a, b: a + b), at=F.sort_array(F.transform(again, lambda x: x["i"])))

    return let(count, sorted=pairs)


def base_counts(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source, t (hash of the text), n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words and n_lines of every row."""
    text = F.coalesce(F.col("text"), F.lit(""))

    def of_words(v: Column) -> Column:
        n = F.size(v["ws"])
        hashes = F.when(n >= WINDOW, F.transform(F.sequence(F.lit(1), n - WINDOW + 1), lambda i: F.xxhash64(F.slice(v["ws"], i, WINDOW))))
        repeat = let(lambda w: F.when(F.size(F.array_distinct(w["hs"])) < F.size(w["hs"]), _covered(w["hs"])).otherwise(F.lit(0).cast("long")), hs=hashes)
        return F.struct(n.cast("long").alias("n"), F.coalesce(repeat, F.lit(0).cast("long")).alias("r"))

    def of_lines(v: Column) -> Column:
        return F.struct((F.size(v["ls"]) - F.size(F.array_distinct(v["ls"]))).cast("long").alias("d"), F.size(v["ls"]).cast("long").alias("n"))

    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    found = only(docs, "doc_id", "lang", "source", "text").select(
        F.col("doc_id").cast("long"), "lang", "source", F.xxhash64("text").alias("t"),
        let(of_words, ws=F.regexp_extract_all(text, F.lit(WORD), F.lit(0))).alias("w"),
        F.char_length(F.regexp_replace(text, _BLANK, "")).cast("long").alias("word_chars"),
        (F.char_length(text) - F.char_length(F.regexp_replace(text, _SYMBOL, ""))).cast("long").alias("n_symbols"),
        let(of_lines, ls=lines).alias("l"))
    return found.select("doc_id", "lang", "source", "t", F.col("w.n").alias("n_words"), "word_chars", "n_symbols",
                        F.col("l.d").alias("n_dup_lines"), F.col("w.r").alias("n_repeat_words"), F.col("l.n").alias("n_lines"))


def vectors(base: DataFrame) -> DataFrame:
    """Adds base_failed and, for texts that pass, v0..v4 in hundredths."""
    def hundredths(c: Column) -> Column:
        return F.when(~F.col("base_failed"), F.round(c * 100)).cast("long")

    failed = (F.col("n_words") < 20) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 30)
    return base.withColumn("base_failed", failed).withColumns({
        "v0": hundredths(F.log(F.col("n_words"))),
        "v1": hundredths(F.log(F.col("word_chars") / F.col("n_words")) * 2),
        "v2": hundredths(F.log(F.col("n_symbols") * 10 / F.col("n_words") + 1)),
        "v3": hundredths(F.sqrt(F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1)))),
        "v4": hundredths(F.sqrt(F.col("n_repeat_words") / F.col("n_words"))),
        "gid": F.xxhash64(F.coalesce("lang", F.lit("")), F.col("lang").isNull(), F.coalesce("source", F.lit("")), F.col("source").isNull()),
        "lid": F.xxhash64(F.lit("language"), F.coalesce("lang", F.lit("")), F.col("lang").isNull()),
    })


def _few(df: DataFrame) -> DataFrame:
    """One row a group: broadcast if counted to be few, joined otherwise."""
    return F.broadcast(df) if df.count() <= GROUPS_TO_BROADCAST else df


def _start(passed: DataFrame) -> DataFrame:
    """Medians and quartile widths as a first estimate (``g``, m*, c*_*)."""
    marks = passed.groupBy("g").agg(F.count("*").alias("n"), *[F.percentile(v, F.array(*map(F.lit, (0.25, 0.5, 0.75)))).alias(v) for v in _V])
    cols = [F.col("g"), F.lit(0).alias("s"), F.col("n")]
    for i, v in enumerate(_V):
        cols.append((F.get(v, 1) / 100).alias(f"m{i}"))
        for j in range(i + 1):
            wide = (F.get(v, 2) - F.get(v, 0)) / 134.9
            cols.append((wide * wide + FLOOR[v] ** 2 if i == j else F.lit(0.0)).alias(f"c{i}_{j}"))
    return marks.select(*cols)


def _estimate(inner: DataFrame) -> DataFrame:
    """Mean and covariance of the inner vectors, by group and start."""
    n = F.count("*").cast("double")
    sums = [F.sum(v).cast("double").alias(f"s{i}") for i, v in enumerate(_V)]
    cross = [F.sum(F.col(_V[i]) * F.col(_V[j])).cast("double").alias(f"x{i}_{j}") for i in range(5) for j in range(i + 1)]
    got = inner.groupBy("g", "s").agg(n.alias("k"), *sums, *cross)
    cols = [F.col("g"), F.col("s")]
    for i, v in enumerate(_V):
        cols.append((F.col(f"s{i}") / F.col("k") / 100).alias(f"m{i}"))
        for j in range(i + 1):
            c = (F.col(f"x{i}_{j}") / F.col("k") - F.col(f"s{i}") / F.col("k") * (F.col(f"s{j}") / F.col("k"))) / 10000 * CONSISTENCY
            cols.append((c + FLOOR[v] ** 2 if i == j else c).alias(f"c{i}_{j}"))
    return got.select(*cols)


def _factor(est: DataFrame) -> DataFrame:
    """The Cholesky factor l*_* of each group's covariance, and its means."""
    for j in range(5):
        for i in range(j, 5):
            c = F.col(f"c{i}_{j}")
            for k in range(j):
                c = c - F.col(f"l{i}_{k}") * F.col(f"l{j}_{k}")
            est = est.withColumn(f"l{i}_{j}", F.sqrt(c) if i == j else c / F.col(f"l{j}_{j}"))
    return est.select("g", "s", *[f"m{i}" for i in range(5)], *[f"l{i}_{j}" for i in range(5) for j in range(i + 1)])


def determinant() -> Column:
    """The square root of a covariance's determinant, off its factor."""
    return F.col("l0_0") * F.col("l1_1") * F.col("l2_2") * F.col("l3_3") * F.col("l4_4")


def _squared(rows: DataFrame, names: list[str]) -> DataFrame:
    """``names`` and ``d2``, the squared Mahalanobis distance under the row's
    own model (m*, l*_*), by forward substitution."""
    for i, v in enumerate(_V):
        y = F.col(v) / 100 - F.col(f"m{i}")
        for k in range(i):
            y = y - F.col(f"l{i}_{k}") * F.col(f"y{k}")
        rows = rows.withColumn(f"y{i}", y / F.col(f"l{i}_{i}"))
    return rows.select(*names, sum((F.col(f"y{i}") * F.col(f"y{i}") for i in range(1, 5)), F.col("y0") * F.col("y0")).alias("d2"))


def _distances(rows: DataFrame, est: DataFrame) -> DataFrame:
    """Every row under each start's estimate of its group: ``s`` and ``bin``,
    the squared distance in sixteenths."""
    got = _squared(rows.join(_few(keep(_factor(est), "factors")), "g"), [*rows.columns, "s"])
    return got.withColumn("bin", F.least(F.floor(F.col("d2") * 16), F.lit(65535)).cast("long")).drop("d2")


def _places(rows: DataFrame) -> DataFrame:
    """(gid, g, estimate): the group whose estimate a language and source use.
    Their own, if it has MIN_GROUP vectors; else that of such groups of their
    language together; else that of all that is left, if enough."""
    sizes = rows.filter("not base_failed").groupBy("gid", "lid").agg(F.count("*").alias("size"))
    small = sizes.filter(F.col("size") < MIN_GROUP).groupBy("lid").agg(F.sum("size").alias("rest"))
    own, language = F.col("size") >= MIN_GROUP, F.col("rest") >= MIN_GROUP
    return sizes.join(small, "lid", "left").select(
        "gid", F.when(own, F.col("gid")).when(language, F.col("lid")).otherwise(F.lit(0)).alias("g"),
        F.when(own, "source").when(language, "language").otherwise("all").alias("estimate"))


def estimates(passed: DataFrame) -> list[DataFrame]:
    """Per step the factor of each group (``g``) and start (``s``): 0 starts
    from medians and quartile widths, 1 from the mean and covariance of all.  A
    step takes the mean and covariance of the SHARE of vectors that are nearest
    under the one before, which makes the determinant smaller but for ties within
    a bin.  The number of steps is fixed; most groups stand still before."""
    first = keep(_start(passed).filter(F.col("n") >= MIN_GROUP), "start").drop("n")
    whole = _estimate(passed.join(_few(first.select("g")), "g", "left_semi").withColumn("s", F.lit(1)))
    est, found = first.unionByName(whole), []
    for _ in range(STEPS):
        binned = keep(_distances(passed, est), "binned")
        limit = keep(binned.groupBy("g", "s").agg(F.percentile("bin", F.lit(SHARE)).alias("limit")), "limits")
        est = _estimate(binned.join(_few(limit), ["g", "s"]).filter(F.col("bin") <= F.col("limit")))
        found.append(keep(_factor(est), "factors"))
        est = keep(est, "estimates")
    return found


def judge(docs: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """doc_id, the base counts, base_failed, kept and the estimate used
    (``source``, ``language`` or ``all``; null without vectors) of every row."""
    rows = keep(vectors(base_counts(docs)), "vectors")
    places = keep(_places(rows), "places")
    passed = keep(rows.filter("not base_failed").join(_few(places), "gid").select("g", *_V), "passed")
    # Of a group's starts the smallest determinant counts.
    model = estimates(passed)[-1].withColumn("det", determinant())
    best = model.groupBy("g").agg(F.min_by("s", F.struct("det", "s")).alias("s"))
    model = keep(model.join(best, ["g", "s"]).drop("s", "det"), "model")
    out = rows.join(_few(places), "gid", "left").join(_few(model), "g", "left")
    out = _squared(out, [*rows.columns, "estimate"])
    far = F.coalesce(F.floor(F.col("d2") * 16) > int(cutoff * 16), F.lit(False))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                      (~F.col("base_failed") & ~far).alias("kept"), "estimate", F.col("d2").alias("distance"), "t", "lang", "source")


def filter_documents(docs: DataFrame) -> DataFrame:
    """``docs`` without the rejected rows, which are broadcast by id, text hash,
    language and source if counted to be few, and joined otherwise."""
    by = {"doc_id": F.col("doc_id"), "t": F.xxhash64("text"), "lang": F.col("lang"), "source": F.col("source")}
    gone = keep(judge(docs).filter("not kept").select(*[F.col(c).alias(f"__{c}") for c in by]).distinct(), "rejected")
    few = F.broadcast(gone) if gone.count() <= REJECTS_TO_BROADCAST else gone
    on = F.lit(True)
    for c, mine in by.items():
        on = on & mine.eqNullSafe(F.col(f"__{c}"))
    return docs.join(few, on, "left_anti")


def _select(into: str, source: str, rest: str = "", **columns: str) -> str:
    return f"{into} as (select *, {', '.join(f'{e} as {c}' for c, e in columns.items())} from {source} {rest})"


def sql() -> str:
    """``judge`` as DuckDB SQL, with the same steps unrolled."""
    words = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
    sides = [(i, j) for i in range(5) for j in range(i + 1)]
    with_ = [
        f"""d as (
          select row_number() over () as r, doc_id, lang, source, {words} as w, length(regexp_replace(coalesce(text, ''), '{_BLANK}', '', 'g')) as word_chars,
            length(coalesce(text, '')) - length(regexp_replace(coalesce(text, ''), '{_SYMBOL}', '', 'g')) as n_symbols,
            list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) as ls from documents)""",
        f"win as (select r, w, unnest(range(1, len(w) - {WINDOW - 2})) as i from d where len(w) >= {WINDOW})",
        f"h as (select r, i, md5(array_to_string(w[i:i + {WINDOW - 1}], ' ')) as h from win)",
        "again as (select r, i from (select r, i, count(*) over (partition by r, h) as m from h) where m > 1)",
        f"hit as (select r, count(*) as n from (select distinct r, unnest(range(i, i + {WINDOW})) as p from again) group by r)",
        """base as (
          select d.r, doc_id, lang, source, len(w)::bigint as n_words, word_chars, n_symbols, (len(ls) - len(list_distinct(ls)))::bigint as n_dup_lines,
            coalesce(n, 0) as n_repeat_words, len(ls) as n_lines from d left join hit using (r))""",
        _select("judged", "base", base_failed="n_words < 20 or 100 * n_repeat_words > 30 * n_words",
                gid="coalesce('=' || lang, '-') || '/' || coalesce('=' || source, '-')", lid="coalesce('=' || lang, '-')"),
        """passed as (
          select r, gid, lid, round(ln(n_words) * 100)::bigint as v0, round(ln(word_chars / n_words) * 2 * 100)::bigint as v1,
            round(ln(n_symbols * 10 / n_words + 1) * 100)::bigint as v2, round(sqrt(n_dup_lines / greatest(n_lines, 1)) * 100)::bigint as v3,
            round(sqrt(n_repeat_words / n_words) * 100)::bigint as v4 from judged where not base_failed)""",
        "sized as (select *, count(*) over (partition by gid) as own from passed)",
        f"left_over as (select *, count(*) filter (own < {MIN_GROUP}) over (partition by lid) as rest from sized)",
        f"""placed as (
          select *, case when own >= {MIN_GROUP} then 'source' when rest >= {MIN_GROUP} then 'language' else 'all' end as estimate from left_over)""",
        "grouped as (select *, case estimate when 'source' then gid when 'language' then lid else '' end as g from placed)",
        f"marks as (select g, {', '.join(f'quantile_cont({v}, [0.25, 0.5, 0.75]) as q{i}' for i, v in enumerate(_V))} from grouped group by g having count(*) >= {MIN_GROUP})",
    ]
    start = {f"m{i}": f"q{i}[2] / 100" for i in range(5)}
    for i, j in sides:
        wide = f"((q{i}[3] - q{i}[1]) / 134.9::double)"
        start[f"c{i}_{j}"] = f"{wide} * {wide} + {FLOOR[_V[i]] ** 2!r}::double" if i == j else "0.0::double"
    def moments(of: str) -> str:
        sums = [f"sum({v})::double as s{i}" for i, v in enumerate(_V)] + [f"sum({_V[i]} * {_V[j]})::double as x{i}_{j}" for i, j in sides]
        return f"select g, s, count(*)::double as k, {', '.join(sums)} from {of} group by g, s"

    def estimate(of: str) -> str:
        cols = [f"s{i} / k / 100 as m{i}" for i in range(5)]
        for i, j in sides:
            c = f"(x{i}_{j} / k - s{i} / k * (s{j} / k)) / 10000 * {CONSISTENCY}::double"
            cols.append(f"{c} + {FLOOR[_V[i]] ** 2!r}::double as c{i}_{j}" if i == j else f"{c} as c{i}_{j}")
        return f"select g, s, {', '.join(cols)} from {of}"

    with_.append(f"whole as ({moments('(select *, 1 as s from grouped semi join marks using (g))')})")
    with_.append(f"est0 as (select g, 0 as s, {', '.join(f'{e} as {c}' for c, e in start.items())} from marks union all {estimate('whole')})")

    def distances(step: int) -> str:
        """CTEs of the factor and of every vector's squared distance; the last's name."""
        last = f"est{step}"
        for j in range(5):
            for i in range(j, 5):
                less = "".join(f" - l{i}_{k} * l{j}_{k}" for k in range(j))
                with_.append(_select(f"f{step}_{i}_{j}", last, **{f"l{i}_{j}": f"sqrt(c{i}_{j}{less})" if i == j else f"(c{i}_{j}{less}) / l{j}_{j}"}))
                last = f"f{step}_{i}_{j}"
        if step == STEPS:              # of the starts the smallest determinant
            det = " * ".join(f"l{i}_{i}" for i in range(5))
            with_.append(f"best as (select * from {last} qualify row_number() over (partition by g order by {det}, s) = 1)")
            last = "best"
        with_.append(f"y{step} as (select grouped.*, {last}.* exclude (g) from grouped join {last} using (g))")
        last = f"y{step}"
        for i, v in enumerate(_V):
            less = "".join(f" - l{i}_{k} * y{k}" for k in range(i))
            with_.append(_select(f"y{step}_{i}", last, **{f"y{i}": f"({v} / 100 - m{i}{less}) / l{i}_{i}"}))
            last = f"y{step}_{i}"
        with_.append(f"far{step} as (select r, g, s, v0, v1, v2, v3, v4, {' + '.join(f'y{i} * y{i}' for i in range(5))} as d2 from {last})")
        return f"far{step}"

    for step in range(STEPS):
        with_.append(_select(f"bin{step}", distances(step), bin="least(floor(d2 * 16), 65535)::bigint"))
        with_.append(f"limit{step} as (select g, s, quantile_cont(bin, {SHARE}) as most from bin{step} group by g, s)")
        with_.append(f"sum{step} as ({moments(f'bin{step} join limit{step} using (g, s) where bin <= most')})")
        with_.append(f"est{step + 1} as ({estimate(f'sum{step}')})")
    last = distances(STEPS)
    return f"""with {', '.join(with_)}
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and not coalesce(floor(d2 * 16) > {int(CUTOFF * 16)}, false) as kept, estimate
from judged left join {last} using (r) left join (select distinct gid, estimate from placed) using (gid)"""
