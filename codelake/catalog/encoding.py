"""Token ids to blocks, pairs, masks and batches."""

from pyspark.sql import functions as F

from codelake.catalog.base import (
    CODE, ENCODED, SPLIT_SQL, VOCAB_SIZE, encoded, key_sql, query, table, text_of, word_sql)
from codelake.functions import arrays as A
from codelake.functions import text as T
from codelake.functions.keys import draw_key
from codelake.operators import encode, stats, vocab
from codelake.session import durable
from codelake.sources.generated import generated_code

PAD, CLS, SEP, MASK = 0, 1, 2, 3
KEYWORD_LIST = ",".join(f"'{k}'" for k in T.KEYWORDS)
JOIN = "array_to_string({}, ',')"


@query("enc1_encode_right", f"""
with {ENCODED} select doc_id, array_to_string(list_concat(list_concat([1], ids[1:62]), [2]), ',') as ids from encoded""")
def encode_right(spark, folder):
    return encoded(spark, folder).select("doc_id", text_of(A.encode_single("ids", 64, CLS, SEP)).alias("ids"))


@query("enc1_encode_left", f"""
with {ENCODED} select doc_id, array_to_string(ids[greatest(1, len(ids) - 63):len(ids)], ',') as ids from encoded""")
def encode_left(spark, folder):
    return encoded(spark, folder).select("doc_id", text_of(A.encode_single("ids", 64, side="left")).alias("ids"))


PAIRS = f"""{ENCODED}, sided as (select a.doc_id, a.ids as a, b.ids as b, len(a.ids) as x, len(b.ids) as y
 from encoded a join encoded b on b.doc_id = a.doc_id + 1)"""


def budget_sql(budget: int) -> str:
    half = budget // 2
    return f"""kept as (select *, case when x + y <= {budget} then x when x <= y then least(x, {half})
  else {budget} - least(y, {half}) end as ka, case when x + y <= {budget} then y when x <= y then {budget} - least(x, {half})
  else least(y, {half}) end as kb from sided)"""


def neighbours(spark, folder):
    """Each document with the next one."""
    rows = encoded(spark, folder)
    return rows.select("doc_id", F.col("ids").alias("a")).join(
        rows.select((F.col("doc_id") - 1).alias("doc_id"), F.col("ids").alias("b")), "doc_id")


@query("enc2_encode_pair_left", f"""
with {PAIRS}, {budget_sql(125)}
select doc_id, array_to_string([1] || a[x - ka + 1:x] || [2] || b[y - kb + 1:y] || [2], ',') as ids,
 repeat('0', (ka + 2)::BIGINT) || repeat('1', (kb + 1)::BIGINT) as segments from kept""")
def encode_pair_left(spark, folder):
    ids, segments = A.encode_pair("a", "b", 128, (CLS, SEP), side="left")
    return neighbours(spark, folder).select(
        "doc_id", text_of(ids).alias("ids"),
        F.array_join(F.transform(segments, lambda s: s.cast("string")), "").alias("segments"))


@query("enc2_encode_pair_double_separator", f"""
with {PAIRS}, {budget_sql(124)}
select doc_id, array_to_string([1] || a[1:ka] || [2, 2] || b[1:kb] || [2], ',') as ids from kept""")
def encode_pair_double_separator(spark, folder):
    ids, _ = A.encode_pair("a", "b", 128, (CLS, SEP, SEP))
    return neighbours(spark, folder).select("doc_id", text_of(ids).alias("ids"))


@query("enc2_encode_pair_cut_right", f"""
with {PAIRS} select doc_id, array_to_string((a || b)[1:384], ',') as ids from sided""")
def encode_pair_cut_right(spark, folder):
    ids, _ = A.encode_pair("a", "b", 384, strategy="cut_right")
    return neighbours(spark, folder).select("doc_id", text_of(ids).alias("ids"))


@query("enc3_pad_to_eight", f"""
with {ENCODED}, p as (
 select doc_id, len(ids) as n, ids || [0 for i in range(0, (ceil(len(ids) / 8.0) * 8)::BIGINT - len(ids))] as ids from encoded)
select doc_id, array_to_string(ids, ',') as ids, array_to_string([(x <> 0)::INTEGER for x in ids], ',') as mask from p""")
def pad_to_eight(spark, folder):
    padded = encoded(spark, folder).withColumn("ids", A.pad("ids", A.round_up(F.size("ids")), PAD))
    return padded.select("doc_id", text_of("ids").alias("ids"), text_of(A.attention_mask("ids", PAD)).alias("mask"))


def mask_sql(protected: str) -> str:
    share = lambda x: int(round(x * 2**32))
    drawn = [word_sql(start, 5, "doc_id", "i") for start in (1, 9, 17)]
    chosen = f"({drawn[0]} < {share(0.15)} and x not in ({protected}))"
    return f"""
with {ENCODED}, c as (select doc_id, [1] || ids[1:126] || [2] as ids from encoded),
e as (select doc_id, unnest(ids) as x, unnest(range(0, len(ids))) as i from c),
m as (select doc_id, i, case when not {chosen} then x when {drawn[1]} < {share(0.8)} then 3
  when {drawn[1]} < {share(0.9)} then ({drawn[2]} % {VOCAB_SIZE})::INTEGER else x end as input,
 case when {chosen} then x else -100 end as label from e)
select doc_id, string_agg(input::VARCHAR, ',' order by i) as inputs, string_agg(label::VARCHAR, ',' order by i) as labels
from m group by doc_id"""


def masked(spark, folder, protected):
    rows = encoded(spark, folder).withColumn("ids", A.encode_single("ids", 128, CLS, SEP))
    outcome = rows.withColumn("m", A.mask_mlm("ids", 5, "doc_id", VOCAB_SIZE, MASK, protected))
    return outcome.select("doc_id", text_of("m.input").alias("inputs"), text_of("m.label").alias("labels"))


@query("enc4_mask_protect_specials", mask_sql("0, 1, 2, 3, 4"))
def mask_protect_specials(spark, folder):
    return masked(spark, folder, (0, 1, 2, 3, 4))


@query("enc4_mask_protect_pad", mask_sql("0"))
def mask_protect_pad(spark, folder):
    return masked(spark, folder, (PAD,))


@query("enc5_rtd_labels", f"""
with {ENCODED}, c as (select doc_id, [1] || ids[1:62] || [2] as o from encoded),
p as (select doc_id, o || [0 for i in range(0, 64 - len(o))] as o from c),
e as (select doc_id, unnest(o) as o, unnest(range(0, 64)) as i from p)
select doc_id, string_agg((case when o in (0, 1, 2, 3, 4) then -100
 else (o <> case when i % 5 = 0 then 5 + o % 7 else o end)::INTEGER end)::VARCHAR, ',' order by i) as labels
from e group by doc_id""")
def rtd_labels(spark, folder):
    rows = encoded(spark, folder).withColumn("o", A.pad(A.encode_single("ids", 64, CLS, SEP), 64, PAD))
    rows = rows.withColumn("r", F.transform("o", lambda x, i: F.when(i % 5 == 0, 5 + x % 7).otherwise(x)))
    labels = A.rtd_labels("o", "r", A.attention_mask("o", PAD), (0, 1, 2, 3, 4))
    return rows.select("doc_id", text_of(labels).alias("labels"))


@query("enc6_role_batch", f"""
with w as (select doc_id, ['[CLS]'] || {SPLIT_SQL} || ['[SEP]'] as w from documents),
r as (select doc_id, len(w) as n, [case when x in ('[CLS]', '[SEP]') then 6 when lower(x) in ({KEYWORD_LIST}) then 2
 when regexp_full_match(x, '\\d+(\\.\\d+)?') then 5 when length(x) >= 2 and left(x, 1) in ('''', '"') then 5
 when regexp_full_match(x, '[-()\\[\\]{{}},:.;+*/%=!<>&|^~@]+') then 4 else 3 end for x in w] as roles from w)
select doc_id, array_to_string(roles || [0 for i in range(0, (ceil(n / 8.0) * 8)::BIGINT - n)], ',') as role_ids,
 array_to_string(roles || [-100 for i in range(0, (ceil(n / 8.0) * 8)::BIGINT - n)], ',') as role_labels,
 n::BIGINT as attended from r""")
def role_batch(spark, folder):
    words = T.words_by_space(F.col("text"))
    rows = table(spark, folder, "documents").select(
        "doc_id", F.concat(F.array(F.lit("[CLS]")), words, F.array(F.lit("[SEP]"))).alias("tokens"))
    rows = rows.withColumn("ids", F.transform("tokens", lambda w: (F.pmod(draw_key("id", w), F.lit(995)) + 5).cast("int")))
    out = encode.role_batch(rows, "tokens", "ids", A.round_up(F.size("ids")), PAD)
    attended = F.aggregate("attention_mask", F.lit(0).cast("long"), lambda s, x: s + x)
    return out.select(
        "doc_id", text_of("role_ids").alias("role_ids"), text_of("role_labels").alias("role_labels"),
        attended.alias("attended"))


@query("win2_pack_blocks", f"""
with {ENCODED}, e as (select doc_id // 1000 as shard, doc_id, unnest(ids) as x, unnest(range(0, len(ids))) as i from encoded),
p as (select shard, x, row_number() over (partition by shard order by doc_id, i) - 1 as place from e),
b as (select shard, place // 512 as block, string_agg(x::VARCHAR, ',' order by place) as ids, count(*) as n from p group by all)
select shard, block, ids from b where n = 512""")
def pack_blocks(spark, folder):
    rows = encoded(spark, folder).withColumn("shard", F.floor(F.col("doc_id") / 1000))
    packed = encode.pack_blocks(rows, "shard", "doc_id", "ids", 512)
    return packed.select("shard", "block", text_of("input_ids").alias("ids"))


@query("srt3_bucket_by_length", f"""
with {ENCODED}, s as (select doc_id, len(ids) as n, (ceil(len(ids) / 8.0) * 8)::INTEGER as bucket from encoded),
p as (select *, (row_number() over (partition by bucket order by {key_sql(11, 'doc_id')}, doc_id) - 1) // 16 as batch from s)
select doc_id, bucket, batch, (ceil(max(n) over (partition by bucket, batch) / 8.0) * 8)::INTEGER as padded_length from p""")
def bucket_by_length(spark, folder):
    rows = encoded(spark, folder).select("doc_id", "ids")
    return encode.bucket_by_length(rows, "doc_id", "ids", 11, 16).select("doc_id", "bucket", "batch", "padded_length")


@query("agg6_token_range", f"""
with {ENCODED} select min(list_min(ids)) as min_id, max(list_max(ids)) as max_id,
 min(len(ids))::INTEGER as min_length, max(len(ids))::INTEGER as max_length from encoded""")
def token_range(spark, folder):
    return stats.token_range(encoded(spark, folder), "ids")


@query("agg6_token_violations", f"""
with {ENCODED}, e as (select doc_id, unnest(ids) as token, unnest(range(0, len(ids)))::INTEGER as pos from encoded)
select doc_id, pos, token from e where token >= 990 order by doc_id, pos limit 10""")
def token_violations(spark, folder):
    return stats.token_violations(encoded(spark, folder), "doc_id", "ids", 990)


WORDS = rf"regexp_extract_all(text, '[A-Za-z0-9_]+|[^A-Za-z0-9_\s]+')"
COMMON = f"""
{CODE}, counted as (select w as word, count(*) as freq from (select unnest({WORDS}) as w from code) group by w),
v as (select word, 1 + row_number() over (order by {key_sql('vocab', 'word')}, word) as id from counted where freq >= 1)"""


@query("join10_lookup_pieces", f"""
with {COMMON}, e as (select submission_id, unnest({WORDS}) as word, unnest(range(0, len({WORDS}))) as i from code)
select submission_id, string_agg(coalesce(id, 1)::VARCHAR, ',' order by i) as ids
from e left join v on v.word = e.word group by submission_id""")
def lookup_pieces(spark, folder):
    code = generated_code(spark, folder).select("submission_id", "text")
    counts = durable(vocab.word_counts(code, T.words(F.col("text"))))
    words = vocab.word_vocab(counts, ["<pad>", "<unk>"], 1)
    pieces = words.select(F.col("piece").alias("word"), F.array("id").alias("ids"))
    out = encode.lookup_pieces(code, "submission_id", T.words(F.col("text")), pieces, unknown=1)
    return out.select("submission_id", text_of("input_ids").alias("ids"))


@query("enc7_decode", f"""
with {COMMON}, e as (select submission_id, unnest({WORDS}) as word, unnest(range(0, len({WORDS}))) as i from code)
select submission_id, string_agg(coalesce(v.word, '<unk>'), ' ' order by i) as text
from e left join v on v.word = e.word group by submission_id""")
def decode(spark, folder):
    code = generated_code(spark, folder).select("submission_id", "text")
    counts = durable(vocab.word_counts(code, T.words(F.col("text"))))
    words = vocab.word_vocab(counts, ["<pad>", "<unk>"], 1)
    pieces = words.select(F.col("piece").alias("word"), F.array("id").alias("ids"))
    ids = durable(encode.lookup_pieces(code, "submission_id", T.words(F.col("text")), pieces, unknown=1))
    return encode.decode(ids, "submission_id", "input_ids", words)
