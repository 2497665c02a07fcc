"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession

from . import bytecnn, idpack, linefilter, mincut, mixing, outliers, partenum, periodic, prefixtrie, substring, topk, toxicity, treebpe
from .common import read


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return idpack.digest(read(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def op1_subword_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op2_pivotal_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.digest(read(spark, sf_dir, "documents"))


def op3_mcd_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outliers.judge(read(spark, sf_dir, "documents")).drop("t", "distance", "lang", "source")


def op5_mincut_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mincut.extract(read(spark, sf_dir, "pages"))


def op6_segment_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(read(spark, sf_dir, "embeddings"))


def op7_seed_extend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.digest(read(spark, sf_dir, "documents"))


def op8_partenum_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return partenum.jaccard_components(read(spark, sf_dir, "documents"), n=3, percent=90)


def op9_byte_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bytecnn.quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op10_tree_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return treebpe.encode_documents(read(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), carry=("doc_id",))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixtrie.digest(read(spark, sf_dir, "conversations"))


def planted_period(doc_id: int | None, ws: list[bytes]) -> list[bytes]:
    """Every tenth document (by hash) repeats a stretch of its words to the end."""
    h, n = zlib.crc32(str(doc_id).encode()), len(ws)
    if doc_id is None or h % 10 or not n:
        return ws
    g = h // 10
    a = g % n
    period = ws[a:a + 1 + (n - a) // (3 + g % 8)]
    return ws[:a] + (period * ((n - a) // len(period) + 1))[:n - a]


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.digest(read(spark, sf_dir, "documents"), rewrite=planted_period)


def op13_line_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linefilter.digest(read(spark, sf_dir, "documents"), min_docs=10, min_chars=1)


QUERIES = {
    "op4_token_files": op4_token_files,
    "op1_subword_toxicity": op1_subword_toxicity,
    "op2_pivotal_mix": op2_pivotal_mix,
    "op3_mcd_outliers": op3_mcd_outliers,
    "op5_mincut_text": op5_mincut_text,
    "op6_segment_topk": op6_segment_topk,
    "op7_seed_extend": op7_seed_extend,
    "op8_partenum_join": op8_partenum_join,
    "op9_byte_cnn": op9_byte_cnn,
    "op10_tree_bpe": op10_tree_bpe,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_line_filter": op13_line_filter,
}
_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP7_SQL = f"""
with d as (select doc_id, {_WORDS} as w from documents),
win as (select doc_id, unnest(range(1, len(w) - 48)) as i, w from d where len(w) >= 50),
hashed as (select doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) as h from win),
lowest as (select h, min(doc_id) as m from hashed group by h),
gone as (select distinct doc_id, unnest(range(i, i + 50)) as p from hashed join lowest using (h) where doc_id > m),
lost as (select doc_id, list(p) as ps from gone group by doc_id),
marked as (select d.doc_id, w, coalesce(ps, []) as ps from d left join lost using (doc_id)),
flat as (select doc_id, unnest(w) as word, unnest(range(1, len(w) + 1)) as p from d),
kept as (select doc_id, string_agg(word, ' ' order by p) as t from flat anti join gone using (doc_id, p) group by doc_id)
select marked.doc_id, len(w) as n_words, len(ps) as n_removed, sha256(coalesce(t, '')) as kept_sha256
from marked left join kept using (doc_id)"""

OP8_SQL = r"""
with recursive d as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
s as (
  select distinct doc_id, x from (
    select doc_id, unnest(case when len(w) = 0 then [] when len(w) < 3 then [array_to_string(w, ' ')]
      else list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')) end) as x from d)),
n as (select doc_id, count(*) as n from s group by doc_id),
common as (select a.doc_id as a, b.doc_id as b, count(*) as c from s a join s b on a.x = b.x and a.doc_id < b.doc_id group by all),
link as (
  select a, b from common join n p on p.doc_id = a join n q on q.doc_id = b where 100 * c >= 90 * (p.n + q.n - c)),
both_ways as (select a, b from link union all select b, a from link),
reach as (select doc_id as root, doc_id as node from d union select root, b from reach join both_ways on a = node)
select d.doc_id, coalesce(n, 0) as n_shingles, min(root) as component_id
from d left join n using (doc_id) join reach on node = d.doc_id group by all"""

# CRC-32 of a number's decimal digits: a table of 256 entries, then a fold over the bytes.
_CRC_TABLE = """crc as (select list(x order by i) as tab from (
  select i, list_reduce(range(0, 8), lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, i) as x from range(0, 256) r(i)))"""


def _crc32(number: str) -> str:
    digits = f"list_transform(range(1, length({number}::varchar) + 1), lambda i: ord(({number}::varchar)[i])::bigint)"
    return f"xor(list_reduce({digits}, lambda c, b: xor(c >> 8, tab[xor(c & 255, b) + 1]), 4294967295::bigint), 4294967295::bigint)"


OP11_SQL = rf"""
with {_CRC_TABLE},
t as (select conv_id as c, row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), md5(coalesce(text, ''))) - 1 as pos,
    dense_rank() over (order by coalesce(role, ''), coalesce(text, '')) as x, len(regexp_extract_all(coalesce(text, ''), '[^ 	-
]+')) as words
  from conversations where conv_id is not null),
conv as (select c, n, c - c % 20 as b, {_crc32('c')} % 4 as h from (select c, count(*) as n from t group by c), crc),
turn as (
  select conv.c, pos as k, x from conv join t on t.c = conv.b where pos < h
  union all select conv.c, least(conv.h, coalesce(base.n, 0)) + pos - conv.h, x from conv join t on t.c = conv.c left join conv base on base.c = conv.b where pos >= conv.h),
built as (select conv.c, coalesce(list(x order by k) filter (x is not null), []) as p from conv left join turn on turn.c = conv.c group by conv.c),
member as (select c, p[1:d] as p, d, len(p) as m from (select c, p, unnest(range(0, len(p) + 1)) as d from built)),
word as (select distinct x, words from t),
node as (select p, d, min(c) as conv_id, count(*) as n_convs, coalesce(string_agg(c::varchar, ',' order by c) filter (d = m), '') as ends from member group by p, d),
child as (select p[1:d - 1] as p, count(*) as n_children from node where d > 0 group by all),
full_node as (select node.*, coalesce(n_children, 0) as n_children, (n_convs - 1) * coalesce(words, 0) as saved
  from node left join child using (p) left join word on x = p[d]),
above as (select p[1:a] as p, n_children, saved from (select *, unnest(range(0, d + 1)) as a from full_node)),
subtree as (select p, count(*) filter (n_children = 0) as n_leaves, sum(saved) as saved_tokens from above group by p)
select n.conv_id, d as depth, parent.conv_id as parent_conv_id, n.n_convs, n_children, n_leaves, saved_tokens::bigint as saved_tokens, sha256(ends) as ends_sha256
from full_node n join subtree using (p) left join (select p as up, conv_id from node) parent on n.d > 0 and up = p[1:d - 1]"""

OP12_SQL = rf"""
with {_CRC_TABLE},
d as (select doc_id, {_WORDS} as w, {_crc32('doc_id')} as h from documents, crc),
e as (select doc_id, w, len(w) as n, h % 10 = 0 and len(w) > 0 as planted, h // 10 as g, case when len(w) > 0 then (h // 10) % len(w) end as a from d),
f as (select doc_id, n, case when planted then list_transform(range(0, n), lambda i: case when i < a then w[i + 1] else w[a + (i - a) % (1 + (n - a) // (3 + g % 8)) + 1] end) else w end as w from e),
word as (select doc_id, n, unnest(range(0, n)) as i, unnest(w) as x from f),
pair as (select a.doc_id, a.i, b.i - a.i as q from word a join word b on a.doc_id = b.doc_id and a.x = b.x and a.i < b.i and 2 * (b.i - a.i) <= a.n),
island as (select doc_id, q, i, i - row_number() over (partition by doc_id, q order by i) as grp from pair),
stretch as (select doc_id, q, min(i) as s, max(i) + 1 + q as z from island group by doc_id, q, grp having count(*) + q >= greatest(12, 2 * q)),
run as (select doc_id, s, z - s as l, min(q) as q from stretch group by doc_id, s, z),
best as (select doc_id, count(*) as n_runs, arg_max({{'s': s, 'l': l, 'q': q}}, [l, -s, -q]) as r, string_agg(s || ',' || l || ',' || q || chr(10), '' order by s, q) as told from run group by doc_id),
gone as (select distinct doc_id, unnest(range(s + q, s + l)) as i from run),
kept as (select doc_id, string_agg(x, ' ' order by i) as t from word anti join gone using (doc_id, i) group by doc_id)
select f.doc_id, coalesce(n_runs, 0) as n_runs, r.s as start, r.l as length, r.q as period, (1000 * r.l) // r.q as exponent_milli,
  sha256(coalesce(told, '')) as runs_sha256, sha256(coalesce(t, '')) as collapsed_sha256
from f left join best using (doc_id) left join kept using (doc_id)"""

OP13_SQL = r"""
with l as (select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as i from documents),
k as (select *, translate(regexp_replace(line, '^[ 	-
]+|[ 	-
]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from l),
often as (select key from k where length(key) >= 1 group by key having count(distinct doc_id) >= 10)
select doc_id, count(*) as n_lines, count(*) filter (often.key is not null) as n_dropped, sha256(coalesce(string_agg(line, chr(10) order by i) filter (often.key is null), '')) as kept_sha256
from k left join often using (key) group by doc_id"""

ORACLES: dict[str, str] = {
    "op3_mcd_outliers": outliers.sql(),
    "op6_segment_topk": topk.SQL,
    "op7_seed_extend": OP7_SQL,
    "op8_partenum_join": OP8_SQL,
    "op11_prefix_trie": OP11_SQL,
    "op12_periodic_runs": OP12_SQL,
    "op13_line_filter": OP13_SQL,
}
