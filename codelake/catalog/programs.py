"""Jobs that read code with the Python grammar, on the generated programs."""

from pyspark.sql import functions as F

from codelake.catalog.base import CODE, query
from codelake.functions import code as C
from codelake.functions import text as T
from codelake.operators import dedup, graph, normalize
from codelake.plans.corpus import prepare_corpus
from codelake.operators.select import problem_ids
from codelake.sources.generated import generated_code

# The constants of each program, from the order it was rendered from.
PARTS = f"""{CODE}, parts as (select c.*, o_orderkey as k, o_custkey % 3 as a, o_custkey % 5 as b, o_custkey % 2 as d,
 o_orderkey % 50 <> 0 as good from code c join orders o on o_orderkey = c.submission_id)"""
BROKEN = "replace(printf('def f%d(:~    return 1', k), '~', chr(10))"
CLEAN = """replace(printf('def f%d(a%d):~    if a%d > %d:~        return a%d * %d~    return ''p%d''',
 k, k, k, a, k, b, d), '~', chr(10))"""
RENAMED = """replace(printf('def func1(v1):~    if v1 > %d:~        return v1 * %d~    return ''p%d''',
 a, b, d), '~', chr(10))"""


def dump_sql(name: str, var: str, *values: str) -> str:
    args = "".join(f", {v}" for v in values)
    return f"""printf('Module(body=[FunctionDef(name=''{name}'', args=arguments(args=[arg(arg=''{var}'')]), body=[If(test=Compare(left=Name(id=''{var}'', ctx=Load()), ops=[Gt()], comparators=[Constant(value=%d)]), body=[Return(value=BinOp(left=Name(id=''{var}'', ctx=Load()), op=Mult(), right=Constant(value=%d)))]), Return(value=Constant(value=''p%d''))])])'{args})"""


@query("flt6_parse_report", f"""
with {PARTS} select count(*) as total, count(*) filter (good) as valid, count(*) filter (not good) as invalid,
 count(*) filter (good) / count(*)::DOUBLE * 100 as success_rate from parts""")
def parse_report(spark, folder):
    return normalize.partition_parseable(generated_code(spark, folder))[1]


@query("flt6_parseable_rows", f"with {PARTS} select submission_id, problem_id from parts where good")
def parseable_rows(spark, folder):
    return normalize.partition_parseable(generated_code(spark, folder))[0].select("submission_id", "problem_id")


@query("flt6_parse_documents", "select count(*) as total, 0::BIGINT as valid, count(*) as invalid, 0.0::DOUBLE as success_rate from documents")
def parse_documents(spark, folder):
    return normalize.partition_parseable(spark.read.parquet(f"{folder}/documents.parquet"))[1]


@query("txt2_strip_comments_tok", f"""
with {PARTS} select submission_id, case when good then replace(printf('def f%d (a%d ):~~    if a%d >%d :~        return a%d *%d ~    return "p%d"~',
 k, k, k, a, k, b, d), '~', chr(10)) else {BROKEN} end as code from parts""")
def strip_comments_tok(spark, folder):
    text = F.col("text")
    bare = F.coalesce(C.strip_comments_tok(text), T.strip_comments_fallback(text))
    return generated_code(spark, folder).select("submission_id", bare.alias("code"))


@query("txt5_tidy_code", f"""
with {PARTS} select submission_id, case when good then replace(printf('def f%d (a%d ):~~    if a%d >%d :~        return a%d *%d~    return "p%d"',
 k, k, k, a, k, b, d), '~', chr(10)) else {BROKEN} end as tidy from parts""")
def tidy_code(spark, folder):
    return normalize.tidy_corpus(generated_code(spark, folder)).select("submission_id", "tidy")


@query("txt3_drop_docstrings", f"""
with {PARTS} select submission_id, case when good and k % 2 = 0 then {CLEAN} when good then printf('def f%d():', k)
 else replace(printf('def f%d(:~    return 1~', k), '~', chr(10)) end as code from parts""")
def drop_docstrings(spark, folder):
    """Every other program gets a docstring before its first statement, the rest nothing but one."""
    key = F.col("submission_id").cast("string")
    only = F.concat(F.lit("def f"), key, F.lit('():\n    "words"\n'))
    documented = F.replace(F.col("text"), F.lit("):\n    #"), F.lit('):\n    """words\n    and words"""\n    #'))
    code = generated_code(spark, folder).withColumn("text", F.when(
        F.contains("text", F.lit("(:")), F.col("text")).when(F.col("submission_id") % 2 == 0, documented).otherwise(only))
    return code.select("submission_id", C.code_facts(F.col("text"), "no_docstrings")["no_docstrings"].alias("code"))


@query("txt6_preprocess_corpus", f"""
with {PARTS} select submission_id, case when good then {CLEAN} else {BROKEN} end as processed_code,
 'comments_removed,docstrings_removed,whitespace_normalized' as steps, null as error from parts""")
def preprocess_corpus(spark, folder):
    return normalize.preprocess_corpus(generated_code(spark, folder)).select(
        "submission_id", "processed_code", F.array_join("steps", ",").alias("steps"), "error")


@query("txt7_alpha_rename", f"""
with {PARTS} select submission_id, case when good then {RENAMED} else {BROKEN} end as text_norm from parts""")
def alpha_rename(spark, folder):
    return normalize.normalized_text(generated_code(spark, folder)).select("submission_id", "text_norm")


@query("nrm1_normalize_corpus", f"""
with {PARTS}, n as (select submission_id, problem_id, case when good then {RENAMED} else {BROKEN} end as text_norm from parts),
k as (select *, row_number() over (partition by text_norm order by submission_id) as rn from n)
select submission_id, problem_id, text_norm, sha1(text_norm) as text_norm_sha1, length(text_norm) as n_chars_norm,
 length(text_norm) - length(replace(text_norm, chr(10), '')) + 1 as n_lines_norm from k where rn = 1""")
def normalize_corpus(spark, folder):
    return normalize.normalize_corpus(generated_code(spark, folder), "submission_id").select(
        "submission_id", "problem_id", "text_norm", "text_norm_sha1", "n_chars_norm", "n_lines_norm")


def marked_sql(number: str, string: str, values: str) -> str:
    return f"""printf('def f%d ( a%d ) : <newline> <newline> <indent> if a%d > {number} : <newline> <indent> return a%d * {number} <newline> <dedent> return {string} <newline> <dedent>', {values})"""


@query("txt8_mark_structure", f"""
with {PARTS} select submission_id, case when good then {marked_sql('<num>', '<str>', 'k, k, k, k')}
 else printf('def f%d(: <newline> return 1 <newline>', k) end as marked from parts""")
def mark_structure(spark, folder):
    return normalize.mark_corpus(generated_code(spark, folder)).select("submission_id", "marked")


@query("txt8_mark_structure_literals", f"""
with {PARTS} select submission_id, case when good then {marked_sql('%d', '"p%d"', 'k, k, k, a, k, b, d')}
 else printf('def f%d(: <newline> return 1 <newline>', k) end as marked from parts""")
def mark_structure_literals(spark, folder):
    return normalize.mark_corpus(generated_code(spark, folder), normalize_literals=False).select("submission_id", "marked")


@query("txt10_syntax_hashes", f"""
with {PARTS} select submission_id,
 case when good then md5(replace(replace({dump_sql('fNAME', 'aNAME', 'a', 'b', 'd')}, 'fNAME', 'f' || k), 'aNAME', 'a' || k)) end as dump_md5,
 case when good then sha256({dump_sql('func_0', 'var_0', 'a', 'b', 'd')}) end as structure_sha256 from parts""")
def syntax_hashes(spark, folder):
    return normalize.with_facts(generated_code(spark, folder), "dump_md5", "structure_sha256").select(
        "submission_id", "dump_md5", "structure_sha256")


def hashed(spark, folder):
    return normalize.with_facts(generated_code(spark, folder), "structure_sha256")


@query("ded2_dedup_structural", f"""
with {PARTS} select submission_id from parts where not good union all
select min(submission_id) from parts where good group by problem_id, a, b, d""")
def dedup_structural(spark, folder):
    return dedup.dedup_structural(hashed(spark, folder), "submission_id").select("submission_id")


@query("ded2_duplicates", f"""
with {PARTS}, f as (select submission_id, problem_id, min(submission_id) over (partition by problem_id, a, b, d) as original
 from parts where good)
select problem_id, original, submission_id as duplicate from f where submission_id <> original""")
def structural_duplicates(spark, folder):
    return dedup.structural_duplicates(hashed(spark, folder), "submission_id").select("problem_id", "original", "duplicate")


@query("ded2_groups", f"""
with {PARTS} select problem_id, min(submission_id) as original, count(*) as members from parts where good
group by problem_id, a, b, d having count(*) > 1""")
def structural_groups(spark, folder):
    return dedup.structural_groups(hashed(spark, folder), "submission_id").drop("structure_sha256")


@query("udf2_facts_shared", f"""
with {PARTS} select submission_id, good as parse_ok, good::INTEGER as n_functions from parts""")
def facts_shared(spark, folder):
    """Programs without their names, so that few distinct texts are parsed for many rows."""
    code = generated_code(spark, folder).withColumn("text", F.regexp_replace("text", r"f\d+\(", "f("))
    code = code.withColumn("text", F.regexp_replace("text", r"a\d+", "a"))
    return normalize.with_facts_shared(code, "submission_id", "parse_ok", "n_functions").select(
        "submission_id", "parse_ok", "n_functions")


@query("agg7_code_stats", f"""
with {PARTS} select submission_id, good::INTEGER as n_functions, 0 as n_classes, case when good then 6 else 3 end as n_lines
from parts""")
def code_stats(spark, folder):
    return normalize.code_stats(generated_code(spark, folder)).select(
        "submission_id", "n_functions", "n_classes", "n_lines")


# Nodes of a generated program in breadth-first order: (nid, type, parent).
SHAPE = [
    ("Module", -1), ("FunctionDef", 0), ("arguments", 1), ("If", 1), ("Return", 1), ("arg", 2), ("Compare", 3),
    ("Return", 3), ("Constant", 4), ("Name", 6), ("Gt", 6), ("Constant", 6), ("BinOp", 7), ("Load", 9), ("Name", 12),
    ("Mult", 12), ("Constant", 12), ("Load", 14),
]
SHAPE_SQL = "shape(nid, type, parent) as (values " + ", ".join(
    f"({i}, '{kind}', {parent})" for i, (kind, parent) in enumerate(SHAPE)) + ")"
NODES = f"""{PARTS}, {SHAPE_SQL}, nodes as (select submission_id as doc, nid, type, parent from parts, shape where good
 union all select submission_id, 0, '<unk>', -1 from parts where not good)"""
TYPE_IDS = "known(type, type_id) as (values ('<unk>', 0), " + ", ".join(
    f"('{name}', {i})" for i, name in enumerate(C.node_types(), 1)) + ")"


@query("grf1_nodes", f"""
with {NODES}, {TYPE_IDS} select doc, nid, type_id from nodes join known on nodes.type = known.type""")
def syntax_nodes(spark, folder):
    nodes = graph.syntax_nodes(generated_code(spark, folder), "submission_id")
    return nodes.join(F.broadcast(graph.type_ids(spark)), "type").select("doc", "nid", "type_id")


@query("udf4_syntax_rows", f"""
with {NODES} select doc, nid, type, parent from nodes""")
def syntax_rows(spark, folder):
    """As GRF-1, by a Python table function over a partitioned table."""
    return graph.syntax_rows(generated_code(spark, folder), "submission_id")


@query("grf1_edges", f"""
with {NODES} select doc, parent as src, nid as dst from nodes where parent >= 0
union all select doc, nid, parent from nodes where parent >= 0""")
def syntax_edges(spark, folder):
    return graph.syntax_edges(graph.syntax_nodes(generated_code(spark, folder), "submission_id"))


ROUND = """
s{n} as (select v.doc, v.nid, v.type, v.value * s.scale as sent from v{p} v join scale s on s.doc = v.doc and s.nid = v.nid),
v{n} as (select l.doc, l.dst as nid, s.type, sum(s.sent) * any_value(c.scale) as value from s{n} s
 join links l on l.doc = s.doc and l.src = s.nid join scale c on c.doc = l.doc and c.nid = l.dst group by l.doc, l.dst, s.type)"""


@query("grf2_propagate", f"""
with {NODES}, links as (select doc, parent as src, nid as dst from nodes where parent >= 0
 union all select doc, nid, parent from nodes where parent >= 0 union all select doc, nid, nid from nodes),
scale as (select doc, src as nid, 1 / sqrt(count(*)) as scale from links group by all),
v0 as (select doc, nid, type, 1.0::DOUBLE as value from nodes), {ROUND.format(n=1, p=0)}, {ROUND.format(n=2, p=1)},
pooled as (select v2.doc, type, sum(value) / any_value(c.n) as value from v2
 join (select doc, count(*) as n from nodes group by doc) c on c.doc = v2.doc group by v2.doc, type)
select doc, type, round(value / sqrt(sum(value * value) over (partition by doc)), 6) as value from pooled""")
def propagate(spark, folder):
    smoothed = graph.propagate_rows(generated_code(spark, folder), "submission_id")
    return smoothed.withColumn("value", F.round("value", 6))


PREPARED = f"""{PARTS}, kept as (select *, length({CLEAN}) as len, row_number() over (
 partition by problem_id, a, b, d order by submission_id) as rn from parts where good)"""


@query("run_prepare_problems", f"""
with {PREPARED}, p as (select printf('p%05d', i) as problem_id from range(0, 12) r(i)),
b as (select problem_id, count(*) as n from kept group by problem_id),
f as (select problem_id, count(*) as n, avg(len) as m, sum(len) as s from kept where rn = 1 group by problem_id)
select p.problem_id, coalesce(b.n, 0) as original_count, coalesce(f.n, 0) as final_count,
 coalesce(b.n, 0) - coalesce(f.n, 0) as removal_count,
 round(case when b.n > 0 then (b.n - f.n) / b.n::DOUBLE * 100 else 0.0::DOUBLE end, 6) as removal_rate,
 round(coalesce(f.m, 0.0::DOUBLE), 6) as avg_code_length, coalesce(f.s, 0)::BIGINT as total_code_length
from p left join b on b.problem_id = p.problem_id left join f on f.problem_id = p.problem_id""")
def prepare_problems(spark, folder):
    listed = problem_ids(spark, 0, 12)
    out = prepare_corpus(generated_code(spark, folder), listed=listed).problems(listed)
    return out.withColumns({c: F.round(c, 6) for c in ("removal_rate", "avg_code_length")})


@query("run_prepare_final", f"""
with {PREPARED} select submission_id, problem_id, submission_id as original_index, {CLEAN} as processed_code,
 text as original_code, len as code_length, 'Python' as language, status, null as user_id from kept where rn = 1""")
def prepare_final(spark, folder):
    return prepare_corpus(generated_code(spark, folder)).final


@query("run_prepare_stages", f"""
with {PREPARED}, n as (select count(*) as total, count(*) filter (good) as good from parts),
k as (select count(*) as kept from kept where rn = 1)
select 'parse' as stage, total, good as passed, total - good as failed, good / total::DOUBLE * 100 as success_rate from n
union all select 'preprocess', good, good, 0, 100.0::DOUBLE from n
union all select 'dedup', good, kept, good - kept, kept / good::DOUBLE * 100 from n, k""")
def prepare_stages(spark, folder):
    return prepare_corpus(generated_code(spark, folder)).stages()
