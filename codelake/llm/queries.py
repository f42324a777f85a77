"""The operators over the provided tables, with their SQL where SQL can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codelake.llm import byte_bpe, divergence, exact_dedup, jaccard, language, line_rules, mixing, pii, prefix_trie, quality, records, simhash, toxicity

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    coded = byte_bpe.encode(table(spark, folder, "documents"), ranks, public_tokenizers.PATTERN)
    return byte_bpe.decode(coded, ranks).select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op2_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken")


ORACLES["op2_mix_sources"] = r"""
with d as (
 select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT as size,
  ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, 'null')), 1, 12))::BIGINT as draw from documents),
s as (select source, sum(size)::BIGINT as source_size from d group by source),
k as (select *, [3, 1, 2][1 + (row_number() over (order by source nulls last) - 1) % 3]::BIGINT as weight,
 source_size * 2.0::DOUBLE as most from s),
f as (select *, (sum(source_size) over () * 1.5::DOUBLE - coalesce(sum(most) over before, 0))
  / (sum(weight) over () - coalesce(sum(weight) over before, 0)) as level
 from k window before as (order by most / weight, source nulls last rows between unbounded preceding and 1 preceding)),
t as (select source, source_size, case when most <= level * weight then most
  else max(case when most <= level * weight then null else level end) over () * weight end as target from f),
r as (select d.doc_id, d.size, d.draw, t.source, t.source_size, t.target,
  case when t.source_size > 0 then floor(t.target / t.source_size)::BIGINT else 0 end as whole
 from d join t on d.source is not distinct from t.source),
c as (select *, sum(size) over (partition by source order by draw) as upto, sum(size) over (partition by source, draw) as same from r)
select doc_id, size, source_size, target,
 (size * (whole + (upto * 2 - same <= (target - whole * source_size) * 2)::INTEGER))::BIGINT as taken from c"""


@query
def op3_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, folder, "documents"), digest_all=True)


ORACLES["op3_exact_dedup"] = r"""
with d as (select doc_id, length(coalesce(text, '')) as chars,
 sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) as text_sha256 from documents),
g as (select text_sha256, first(doc_id order by chars desc, doc_id) as keep_id, count(*)::BIGINT as group_size from d group by text_sha256)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, text_sha256 from d join g using (text_sha256)"""


@query
def op4_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = quality.fit(docs, table(spark, folder, "labels"))
    return quality.quality(docs, model).select(
        "doc_id", quality.held_out(F.col("doc_id"), 5, 0).alias("held_out"), "score",
        (F.col("score") >= quality.ACCEPT).cast("int").alias("predicted"))


@query
def op5_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return language.predict(docs, language.fit(docs)).select(
        "doc_id", quality.held_out(F.col("doc_id"), 4, 2).alias("held_out"), "lang_pred", "score")


@query
def op6_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    return pii.span_texts(pii.personal_data(table(spark, folder, "documents")))


@query
def op7_line_rules(spark: SparkSession, folder: str) -> DataFrame:
    return line_rules.line_rules(table(spark, folder, "documents"))


ORACLES["op7_line_rules"] = rf"""
with d as (select row_number() over () as rn, doc_id, source, coalesce(text, '') as body from documents),
w as (select rn, regexp_extract_all(body, '[^\x20\x09-\x0D]+') as words from d),
x as (select rn, i, words[i] as a, words[i + 1] as b, words[i + 2] as c
 from (select rn, words, unnest(range(1, len(words) - 1)) as i from w)),
n as (select rn, i, count(*) over (partition by rn, a, b, c) as met from x),
r as (select rn, count(distinct p) as n_repeat_words from (select rn, unnest([i, i + 1, i + 2]) as p from n where met > 1) group by rn),
l as (select rn, unnest(string_split(body, chr(10))) as line from d),
u as (select rn, count(*) - count(distinct line) as n_dup_lines from l where regexp_matches(line, '[^\x20\x09-\x0D]') group by rn),
p as (select rn, trim(regexp_replace(lower(line), '[\x20\x09\x0B-\x0D]+', ' ', 'g')) as line from l),
q as (select rn, line, length(line) - length(replace(line, ' ', '')) + 1 as words from p where line <> ''),
one as (select min(rn) as rn, source from d group by source, body),
o as (select one.source, line from (select distinct rn, line from q) join one using (rn)
 group by one.source, line having count(*) > {line_rules.LINE_DOCS}),
gone as (select q.rn, sum(q.words) as gone from q join d using (rn) join o on d.source is not distinct from o.source and q.line = o.line group by q.rn),
m as (select d.rn, d.doc_id, len(w.words)::BIGINT as n_words, coalesce(list_sum([length(z) for z in w.words]), 0)::BIGINT as word_chars,
  (length(body) - length(regexp_replace(body, '[#*$%&|<>]', '', 'g')))::BIGINT as n_symbols,
  coalesce(u.n_dup_lines, 0)::BIGINT as n_dup_lines, coalesce(r.n_repeat_words, 0)::BIGINT as n_repeat_words,
  (len(w.words) - coalesce(gone.gone, 0))::BIGINT as words_left
 from d join w using (rn) left join u using (rn) left join r using (rn) left join gone using (rn))
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
 n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
 not (n_words < 50 or 100 * n_repeat_words > 50 * n_words) and words_left >= {line_rules.LEFT_WORDS}
  and words_left >= n_words * {line_rules.LEFT_SHARE}::DOUBLE as kept, words_left from m"""


@query
def op8_token_records(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return records.token_records(table(spark, folder, "documents"), path, end_id=2)


@query
def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = toxicity.fit(docs, table(spark, folder, "labels"))
    return toxicity.toxicity(docs, model).select(
        "doc_id", quality.held_out(F.col("doc_id"), 3, 1).alias("held_out"), "score",
        (F.col("score") >= toxicity.REJECT).cast("int").alias("predicted"))


@query
def op10_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")


@query
def op11_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.divergence(table(spark, folder, "documents"))


ORACLES["op11_source_divergence"] = r"""
with d as (select row_number() over () as rn, coalesce(lang, '') as lang, coalesce(source, '') as source,
 regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as terms from documents),
t as (select rn, lang, source, unnest(terms) as term from d),
k as (select lang, term, count(*)::HUGEINT as n from t group by lang, term having count(distinct rn) >= 10),
v as (select lang, count(*)::HUGEINT as terms, sum(n)::HUGEINT as total from k group by lang),
g as (select distinct lang, source from d),
c as (select lang, source, term, count(*)::HUGEINT as n from t group by lang, source, term),
m as (select g.lang, g.source, k.term, coalesce(c.n, 0)::HUGEINT as n, k.n as lang_n from g join k using (lang) left join c using (lang, source, term)),
s as (select *, sum(n) over (partition by lang, source)::HUGEINT as total from m),
p as (select s.lang, source, term, n, 1 + 1000000000 * (n + 2) // (s.total + 2 * v.terms) as p,
 1 + 1000000000 * (lang_n + 2) // (v.total + 2 * v.terms) as q from s join v using (lang)),
f as (select a.lang, a.source, b.source as item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) as value
 from p a join p b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
pairs as (select a.lang, a.source, 'pair' as part, b.source as item, coalesce(f.value, 0)::BIGINT as value
 from g a join g b on a.lang = b.lang and a.source <> b.source left join f on f.lang = a.lang and f.source = a.source and f.item = b.source),
terms as (select lang, source, 'term' as part, term as item, ((p - q) * (p - q) // (p + q))::BIGINT as value from p where n > 0 and p > q),
r as (select *, row_number() over (partition by lang, source, part order by value desc, item)::INTEGER as rank
 from (select * from pairs union all select * from terms))
select * from r where part = 'pair' or rank <= 10"""


@query
def op12_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.jaccard_join(table(spark, folder, "documents"))


ORACLES["op12_jaccard_join"] = r"""
with d as (select row_number() over () as rn, doc_id, regexp_extract_all(
 translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as words from documents),
g as (select rn, doc_id, list_sort(list_distinct(case when len(words) = 0 then [] when len(words) < 5 then [array_to_string(words, ' ')]
 else list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')) end)) as grams from d),
s as (select md5(array_to_string(grams, chr(10))) as name, any_value(grams) as grams, any_value(len(grams)) as n, min(doc_id) as least
 from g where len(grams) > 0 group by 1),
e as (select name, n, unnest(grams) as gram from s),
r as (select a.name as x, b.name as y from e a join e b on a.gram = b.gram and a.name <> b.name and a.n <= b.n * 5 // 4 + 1 and b.n <= a.n * 5 // 4 + 1
 group by a.name, b.name, a.n, b.n having 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reach as (with recursive w(x, y) as (select name, name from s union select w.x, r.y from w join r on w.y = r.x) select x, y from w),
c as (select reach.x as name, min(s.least) as component_id from reach join s on s.name = reach.y group by reach.x)
select g.doc_id, len(g.grams)::BIGINT as n_shingles, case when len(g.grams) = 0 then g.doc_id else c.component_id end as component_id
from g left join c on c.name = md5(array_to_string(g.grams, chr(10)))"""


@query
def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, folder, "conversations"))


ORACLES["op13_prefix_trie"] = r"""
with t as (select conv_id as c, row_number() over (partition by conv_id order by turn nulls first,
  md5(strlen(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, ''))) as pos,
  md5(strlen(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) as said,
  len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT as words from conversations where conv_id is not null),
h as (select distinct c, c - c % 20 as base, xor(list_reduce(list_concat([4294967295::BIGINT],
  list_transform(string_split(c::VARCHAR, ''), lambda ch: ascii(ch)::BIGINT)),
  lambda crc, b: list_reduce([xor(crc, b), 0, 0, 0, 0, 0, 0, 0, 0],
   lambda x, z: case when x % 2 = 1 then xor(x // 2, 3988292384) else x // 2 end)), 4294967295) % 4 as h from t),
r as (select h.c, t.pos as pos, t.said, t.words from h join t on t.c = h.base and t.pos <= h.h
 union all select h.c, t.pos, t.said, t.words from h join t on t.c = h.c and t.pos > h.h),
d as (select c, row_number() over w as depth, words, string_agg(said, '') over w as path from r window w as (partition by c order by pos)),
p as (select c, depth, words, path, left(path, (depth - 1) * 32) as up from d
 union all select c, 0, 0, '', null from h),
n as (select path, any_value(up) as up, any_value(depth) as depth, any_value(words) as words, min(c) as conv_id, count(*) as n_convs from p group by path),
e as (select path, sha256(string_agg(c::VARCHAR, ',' order by c)) as ends
 from (select c, max_by(path, depth) as path from p group by c) group by path),
k as (select up as path, count(*) as n_children from n where up is not null group by up),
v as (select n.*, coalesce(n_children, 0) as n_children, (n_convs - 1) * words as saved from n left join k using (path)),
s as (select a.path, sum(b.saved) as saved, count(*) filter (b.n_children = 0) as leaves from v a join v b on starts_with(b.path, a.path) group by a.path)
select v.conv_id, v.depth::BIGINT as depth, u.conv_id as parent_conv_id, v.n_convs, v.n_children, s.leaves as n_leaves, s.saved::BIGINT as saved_tokens,
 coalesce(e.ends, sha256('')) as ends_sha256
from v join s using (path) left join n u on u.path = v.up left join e on e.path = v.path"""
