"""The queries of the text operators, over whole tables, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from purchaseflow.llm import (
    conversation_trie,
    decontaminate,
    exact_dedup,
    fingerprints,
    langid,
    licenses,
    line_dedup,
    ngram_join,
    packing,
    pieces,
    pii,
    toxicity,
    whitening,
)
from purchaseflow.sources.scratch import staged


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_language_id(spark: SparkSession, sf: str) -> DataFrame:
    return langid.identify(_table(spark, sf, "documents"))


def op2_ngram_join(spark: SparkSession, sf: str) -> DataFrame:
    """Per document: its class of near copies and how many texts and documents it resembles."""
    return ngram_join.similar(_table(spark, sf, "documents")).drop("kd", "kh")


def op3_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents")
    return toxicity.score(docs, toxicity.fit(docs, _table(spark, sf, "labels")))


def op4_sentencepiece(spark: SparkSession, sf: str) -> DataFrame:
    """Two sampled segmentations of each document: their ids, scores and whether they decode."""
    return pieces.encode(_table(spark, sf, "documents"), _tokenizer("piece_bpe_32k.model"))


def op5_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    return fingerprints.with_edited(_table(spark, sf, "documents"))


def op6_pii(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents")
    return pii.detect(docs, pii.fit(docs))


def op7_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return exact_dedup.find_copies(_table(spark, sf, "documents"))


def op8_license_scan(spark: SparkSession, sf: str) -> DataFrame:
    return licenses.scan(_table(spark, sf, "documents"))


def op9_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Per document: lines, lines deleted, and the text that is left."""
    return line_dedup.dedup_lines(_table(spark, sf, "documents")).select(
        F.col("__id").alias("doc_id"),
        F.size(F.split("__text", "\n", -1)).cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_deleted"),
        F.length("left").cast("long").alias("n_chars"),
        F.sha2("left", 256).alias("text_sha256"),
    )


def op10_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack(_table(spark, sf, "documents"), _tokenizer("word_bpe_49k.json"))


def op11_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    """Per document: its words in benchmark windows and the items these belong to."""
    found = decontaminate.find(_table(spark, sf, "documents"), _table(spark, sf, "benchmark"))
    hit = decontaminate.hit_words()
    return found.select(
        F.col("__id").alias("doc_id"),
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


def op12_whitening(spark: SparkSession, sf: str) -> DataFrame:
    """Per embedding that counts and component: its whitened value, and how good that is."""
    return whitening.whiten(_table(spark, sf, "embeddings"))


def op13_prefix_trie(spark: SparkSession, sf: str) -> DataFrame:
    """Per prefix of conversations that share openings by hundreds: its subtree's totals."""
    numbered = conversation_trie.numbered(_table(spark, sf, "conversations"))
    turns, ids = conversation_trie.with_shared_openings(staged(numbered, "turns"))
    return conversation_trie.trie(turns, ids)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    listed = [
        op1_language_id,
        op2_ngram_join,
        op3_toxicity,
        op4_sentencepiece,
        op5_fingerprints,
        op6_pii,
        op7_exact_dedup,
        op8_license_scan,
        op9_line_dedup,
        op10_packing,
        op11_decontamination,
        op12_whitening,
        op13_prefix_trie,
    ]
    return {query.__name__: query for query in listed}


_SIMILAR = """with recursive w as (select doc_id,
    string_split_regex(trim(regexp_replace(lower(text), '\\s+', ' ', 'g')), ' ') as ws
  from documents where regexp_matches(text, '\\S')),
s as (select distinct doc_id, array_to_string(ws[i:i + 4], ' ') as run
  from (select doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) as i from w)),
n as (select doc_id, count(*) as n from s group by doc_id),
p as (select a.doc_id as a, b.doc_id as b, count(*) as c
  from s a join s b using (run) where a.doc_id <> b.doc_id group by all),
l as (select a, b, c = na.n and c = nb.n as same from p
  join n na on na.doc_id = a join n nb on nb.doc_id = b where 5 * c >= 4 * (na.n + nb.n - c)),
own as (select d.doc_id, least(d.doc_id, min(l.b)) as first
  from documents d left join l on l.a = d.doc_id and l.same group by d.doc_id),
reach as (select doc_id as a, doc_id as m from documents
  union select l.a, reach.m from reach join l on l.b = reach.a),
c as (select a as doc_id, min(m) as class_id from reach group by a)
select c.doc_id, class_id, count(distinct case when not same then own.first end) as n_links,
  count(l.b) as n_similar, c.doc_id = class_id as representative
from c left join l on l.a = c.doc_id left join own on own.doc_id = l.b
group by c.doc_id, class_id"""

_COPIES = """select doc_id, max(doc_id) over (partition by text) as keep_id,
  count(*) over (partition by text) as group_size,
  doc_id = max(doc_id) over (partition by text) as kept, sha256(coalesce(text, '')) as text_sha256
from documents"""

_LINES = f"""with split as (select doc_id, string_split(text, chr(10)) as lines from documents),
every as (select doc_id, unnest(lines) as raw, generate_subscripts(lines, 1) as pos from split),
l as (select *, trim(raw, ' ' || chr(9) || chr(13)) as line from every),
w as (select *, 1 + length(line) - length(replace(line, ' ', '')) as words from l where line <> ''),
u as (select *, sum(words) over (partition by doc_id order by pos) as upto from w),
v as (select *, upto - words as before from u),
x as (select doc_id, pos as start, max(pos) over ahead as stop,
    array_to_string(list(line) over ahead, chr(10)) as run, sum(words) over ahead as total
  from v window ahead as (partition by doc_id order by before
    range between current row and {line_dedup.MIN_WORDS - 1} following)
  union all select doc_id, min(pos) over behind, pos,
    array_to_string(list(line) over behind, chr(10)), sum(words) over behind
  from v window behind as (partition by doc_id order by upto
    range between {line_dedup.MIN_WORDS - 1} preceding and current row)),
y as (select * from x where total >= {line_dedup.MIN_WORDS}),
z as (select *, min((doc_id, start)) over (partition by run) as first from y),
gone as (select distinct doc_id, unnest(range(start, stop + 1)) as pos from z
  where (doc_id, start) > first),
kept as (select e.doc_id, count(*) as n_lines, count(g.pos) as n_deleted,
    coalesce(string_agg(raw, chr(10) order by e.pos) filter (g.pos is null), '') as text
  from every e left join gone g on g.doc_id = e.doc_id and g.pos = e.pos group by e.doc_id)
select doc_id, n_lines, n_deleted, length(text) as n_chars, sha256(text) as text_sha256 from kept"""


_TEST_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

_LEAKS = f"""with d as (select row_number() over () as r, doc_id, {_TEST_WORDS} as w from documents),
t as (select coalesce(item_id::varchar, 'null') as item, {_TEST_WORDS} as w from benchmark),
win as (select distinct item, m, array_to_string(w[i:i + m - 1], ' ') as run
  from (select item, w, m, unnest(range(1, len(w) - m + 2)) as i
    from (select *, least({decontaminate.WINDOW}, len(w)) as m from t where len(w) > 0))),
occ as (select r, i, m, array_to_string(w[i:i + m - 1], ' ') as run
  from (select r, w, m, unnest(range(1, len(w) - m + 2)) as i
    from d cross join (select distinct m from win))),
hits as (select distinct r, i, m, item from occ join win using (m, run)),
n as (select r, count(distinct p) as n_hit
  from (select r, unnest(range(i, i + m)) as p from hits) group by r),
own as (select r, count(*) as n_items, string_agg(item, ',' order by item) as items
  from (select distinct r, item from hits) group by r)
select doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join n using (r) left join own using (r)"""

# CRC-32 bit by bit: a byte is mixed in, then eight steps follow
_CRC32 = """xor(4294967295, list_reduce(list_prepend(4294967295::bigint, flatten(list_transform(
  string_split(c::varchar, ''), lambda s: [ascii(s)::bigint, -1, -1, -1, -1, -1, -1, -1, -1]))),
  lambda a, x: case when x >= 0 then xor(a, x) when a & 1 = 1 then xor(a >> 1, 3988292384)
    else a >> 1 end))"""

_TRIE = f"""with t as (select conv_id as c, coalesce(role, '') as role, coalesce(text, '') as text,
    row_number() over (partition by conv_id order by turn nulls first) as p
  from conversations where conv_id is not null),
ids as (select c, {_CRC32} % {conversation_trie.SHARED} as h from (select distinct c from t)),
lent as (select ids.c, p as d, role, text
  from ids join t on t.c = ids.c - ids.c % {conversation_trie.GROUP} and p <= h),
shift as (select ids.c, h, count(d) as n from ids left join lent using (c) group by ids.c, h),
turns as (select * from lent union all
  select t.c, p - h + n, role, text from t join shift using (c) where p > h),
pre as (select c, d, length(text) as n, sha256(string_agg(length(role) || ':' || role || length(text)
    || ':' || text, '') over (partition by c order by d)) as k from turns
  union all select c, 0, 0, '' from ids),
node as (select d, k, min(c) as conv_id, count(*) as n_convs, any_value(n) as n from pre group by d, k),
kids as (select pk as k, count(*) as n_children from (select distinct a.k as pk, b.k
    from pre a join pre b on a.c = b.c and b.d = a.d + 1) group by pk),
whole as (select node.*, coalesce(n_children, 0) as n_children from node left join kids using (k)),
tot as (select a.k, sum(case when w.n_children = 0 then 1 else 0 end) as n_leaves,
    sum((w.n_convs - 1) * w.n) as saved_tokens
  from whole w join pre a on a.c = w.conv_id and a.d <= w.d group by a.k),
ends as (select k, string_agg(c::varchar, ',' order by c) as ids
  from (select c, max(d) as d from pre group by c) join pre using (c, d) group by k),
above as (select distinct b.k, a.k as pk from pre a join pre b on a.c = b.c and b.d = a.d + 1)
select w.conv_id, w.d::bigint as depth, p.conv_id as parent_conv_id, w.n_convs, w.n_children,
  n_leaves::bigint as n_leaves, saved_tokens::bigint as saved_tokens,
  sha256(coalesce(ids, '')) as ends_sha256
from whole w join tot using (k) left join ends using (k) left join above using (k)
  left join node p on p.k = above.pk"""


def oracle_sql() -> dict[str, str]:
    return {
        "op2_ngram_join": _SIMILAR,
        "op7_exact_dedup": _COPIES,
        "op9_line_dedup": _LINES,
        "op11_decontamination": _LEAKS,
        "op13_prefix_trie": _TRIE,
    }
