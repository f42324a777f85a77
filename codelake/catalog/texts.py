"""Reading and text normalisation."""

from pyspark.sql import functions as F

from codelake.catalog.base import CODE, SPLIT_SQL, documents, query, table
from codelake.functions import code as C
from codelake.functions import text as T
from codelake.sources import corpus as S
from codelake.sources.generated import generated_code


@query("src1_read_corpus", "select doc_id, source, n_chars from documents where lang = 'en' and n_chars > 500")
def read_corpus(spark, folder):
    return S.read_corpus(
        spark, f"{folder}/documents.parquet", ["doc_id", "source", "n_chars"], "lang = 'en' AND n_chars > 500")


@query("src7_text_corpus_space", "select replace(text, chr(10), ' ') as value from documents")
def text_corpus_space(spark, folder):
    return S.text_corpus(table(spark, folder, "documents"), "text", "space")


@query("src7_text_corpus_strip", r"""
select regexp_replace(regexp_replace(html, '\s+$', ''), '^\s+', '') as value from pages
where length(regexp_replace(html, '\s', '', 'g')) > 0""")
def text_corpus_strip(spark, folder):
    return S.text_corpus(table(spark, folder, "pages"), "html", "strip")


@query("txt1_strip_comments_scan", rf"""
with {CODE} select submission_id, regexp_replace(text, '\n *#[^\n]*', chr(10), 'g') as code from code""")
def strip_comments_scan(spark, folder):
    return generated_code(spark, folder).select("submission_id", T.strip_comments_scan(F.col("text")).alias("code"))


@query("txt2_strip_comments_fallback", """
with lines as (select doc_id, string_split(rtrim(text, chr(10)), chr(10)) as ls from documents)
select doc_id, array_to_string([case when instr(l, '#') > 0
  and (length(left(l, instr(l,'#')-1)) - length(replace(left(l, instr(l,'#')-1), '"', ''))) % 2 = 0
  and (length(left(l, instr(l,'#')-1)) - length(replace(left(l, instr(l,'#')-1), '''', ''))) % 2 = 0
  then rtrim(left(l, instr(l,'#')-1)) else l end for l in ls], chr(10)) as code from lines""")
def strip_comments_fallback(spark, folder):
    return documents(spark, folder).select("doc_id", T.strip_comments_fallback(F.col("text")).alias("code"))


# Commas become tabs and sentence ends blank lines, so that both rules have work to do.
@query("txt4_normalize_whitespace", """
with lines as (select doc_id, string_split(replace(replace(text, ', ', chr(9)), '. ', chr(10)||' '||chr(10)), chr(10)) as ls
 from documents),
expanded as (select doc_id, [rtrim(list_reduce(string_split(l, chr(9)),
  lambda a, y: a || repeat(' ', (4 - length(a) % 4)::BIGINT) || y)) for l in ls] as ls from lines)
select doc_id, array_to_string([l for l in ls if length(l) > 0], chr(10)) as code from expanded""")
def normalize_whitespace(spark, folder):
    text = F.replace(F.replace(F.col("text"), F.lit(", "), F.lit("\t")), F.lit(". "), F.lit("\n \n"))
    return documents(spark, folder).select("doc_id", T.normalize_whitespace(text).alias("code"))


@query("txt5_collapse_blank_lines", r"""
select doc_id, regexp_replace(replace(text, '. ', chr(10)||' '||chr(10)||chr(10)), '\n\s*\n+', chr(10)||chr(10), 'g') as code
from documents""")
def collapse_blank_lines(spark, folder):
    text = F.replace(F.col("text"), F.lit(". "), F.lit("\n \n\n"))
    return documents(spark, folder).select("doc_id", T.collapse_blank_lines(text).alias("code"))


@query("txt5_tidy_layout", r"""
with t as (select doc_id, replace(replace(replace(text, ', ', chr(9)), '. ', '  '||chr(10)||chr(10)||chr(10)), chr(9), '    ') as x
 from documents)
select doc_id, regexp_replace(array_to_string([rtrim(l) for l in string_split(
  case when right(x, 1) = chr(10) then left(x, length(x) - 1) else x end, chr(10))], chr(10)),
  '\n{3,}', chr(10)||chr(10), 'g') as code from t""")
def tidy_layout(spark, folder):
    text = F.replace(F.replace(F.col("text"), F.lit(", "), F.lit("\t")), F.lit(". "), F.lit("  \n\n\n"))
    return documents(spark, folder).select("doc_id", T.tidy_layout(text).alias("code"))


@query("txt8_mark_newlines", r"""
select doc_id, trim(regexp_replace(replace(text, chr(10), ' <newline> '), '\s+', ' ', 'g')) as marked from documents""")
def mark_newlines(spark, folder):
    return documents(spark, folder).select("doc_id", T.mark_newlines(F.col("text")).alias("marked"))


KEYWORD_LIST = ",".join(f"'{k}'" for k in T.KEYWORDS)


@query("txt9_role_tags", rf"""
select doc_id, array_to_string([case when w in ('[PAD]','[CLS]','[SEP]','[MASK]','[UNK]') then 6
  when lower(w) in ({KEYWORD_LIST}) then 2
  when regexp_full_match(w, '\d+(\.\d+)?') then 5
  when length(w) >= 2 and left(w, 1) in ('''', '"') then 5
  when regexp_full_match(w, '[-()\[\]{{}},:.;+*/%=!<>&|^~@]+') then 4 else 3 end for w in {SPLIT_SQL}], ',') as roles
from documents""")
def role_tags(spark, folder):
    roles = T.role_tags(T.words_by_space(F.col("text")))
    return documents(spark, folder).select(
        "doc_id", F.array_join(F.transform(roles, lambda r: r.cast("string")), ",").alias("roles"))


@query("txt10_content_hash", "select doc_id, sha1(text) as sha1, md5(text) as md5, sha256(text) as sha256 from documents")
def content_hash(spark, folder):
    return documents(spark, folder).select(
        "doc_id", F.sha1("text").alias("sha1"), F.md5("text").alias("md5"), F.sha2("text", 256).alias("sha256"))


@query("txt11_text_size", """
select doc_id, length(text) as chars, case when length(text) = 0 then 0
 else length(text) - length(replace(text, chr(10), '')) + 1 end as lines from documents""")
def text_size(spark, folder):
    return documents(spark, folder).select(
        "doc_id", T.n_chars(F.col("text")).alias("chars"), T.n_lines(F.col("text")).alias("lines"))


@query("txt12_words_by_space", f"select doc_id, array_to_string({SPLIT_SQL}, '|') as words from documents")
def words_by_space(spark, folder):
    return documents(spark, folder).select(
        "doc_id", F.array_join(T.words_by_space(F.col("text")), "|").alias("words"))


@query("txt12_words", rf"""
with {CODE} select submission_id, array_to_string(regexp_extract_all(text, '[A-Za-z0-9_]+|[^A-Za-z0-9_\s]+'), '|') as words from code""")
def words(spark, folder):
    return generated_code(spark, folder).select("submission_id", F.array_join(T.words(F.col("text")), "|").alias("words"))


@query("txt12_words_punct_digits", rf"""
with {CODE} select submission_id,
 array_to_string(regexp_extract_all(text, '[0-9]|[!-/:-@\[-`{{-~]|[A-Za-z]+'), '|') as words from code""")
def words_punct_digits(spark, folder):
    return generated_code(spark, folder).select(
        "submission_id", F.array_join(T.words_punct_digits(F.col("text")), "|").alias("words"))


@query("txt12_strip_accents", "select doc_id, strip_accents(text) as plain from documents")
def strip_accents(spark, folder):
    plain = C.unicode_normalize(F.col("text"), "NFD", strip_accents=True)
    return documents(spark, folder).select("doc_id", plain.alias("plain"))


@query("txt12_nfkc")
def nfkc(spark, folder):
    return documents(spark, folder).select("doc_id", C.unicode_normalize(F.col("text"), "NFKC").alias("plain"))


# runs of three or more blanks, where the look-ahead matters, are not in these texts
@query("txt12_words_with_space", r"""
select doc_id, array_to_string(regexp_extract_all(text,
 '''''s|''t|''re|''ve|''m|''ll|''d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s'), '|') as words from documents""")
def words_with_space(spark, folder):
    return documents(spark, folder).select("doc_id", F.array_join(T.words_with_space(F.col("text")), "|").alias("words"))
