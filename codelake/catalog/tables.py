"""Filters, joins, duplicates, aggregates, sorts and set operations."""

import re
import uuid

from pyspark.sql import functions as F

from codelake.catalog.base import CODE, CORPUS, TURNS, key_sql, query, table, turns
from codelake.functions import text as T
from codelake.functions.keys import draw_bucket, draw_key
from codelake.operators import dedup, evaluate, ranking, select, stats
from codelake.session import ensure_checkpoint_dir
from codelake.sources import corpus as S
from codelake.sources.generated import generated_code


@query("ded1_dedup_exact", """
select doc_id, source, sha from (select doc_id, source, sha1(text) as sha,
 row_number() over (partition by sha1(text) order by doc_id) as rn from documents) where rn = 1""")
def dedup_exact(spark, folder):
    hashed = table(spark, folder, "documents").select("doc_id", "source", F.sha1("text").alias("sha"))
    return dedup.dedup_exact(hashed, "sha", "doc_id")


@query("ded1_removed_per_source", """
with n as (select doc_id, source, sha1(array_to_string([rtrim(l) for l in string_split(text, chr(10)) if length(rtrim(l)) > 0],
  chr(10))) as sha from documents),
k as (select *, row_number() over (partition by sha order by doc_id) as rn from n)
select source as problem_id, count(*) as original_count, count(*) filter (rn > 1) as duplicate_count,
 count(*) filter (rn = 1) as remaining_count from k group by source""")
def removed_per_source(spark, folder):
    documents = table(spark, folder, "documents").select(
        "doc_id", F.col("source").alias("problem_id"), F.sha1(T.normalize_whitespace(F.col("text"))).alias("sha"))
    kept = dedup.dedup_exact(documents, "sha", "doc_id")
    totals = documents.groupBy("problem_id").agg(F.count(F.lit(1)).alias("original_count"))
    left = kept.groupBy("problem_id").agg(F.count(F.lit(1)).alias("_n"))
    remaining = F.coalesce("_n", F.lit(0))
    return totals.join(left, "problem_id", "left").select(
        "problem_id", "original_count", (F.col("original_count") - remaining).alias("duplicate_count"),
        remaining.alias("remaining_count"))


@query("ded1_report", """
select count(*) as total, count(*) - count(distinct text) as removed, count(distinct text) as kept,
 count(distinct text) / count(*)::DOUBLE * 100 as kept_pct from documents""")
def dedup_report(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id", F.sha1("text").alias("sha"))
    return dedup.dedup_report(documents, dedup.dedup_exact(documents, "sha", "doc_id"))


@query("ded3_dedup_pairs", f"""
with {TURNS} select pair_id, "similar" from (select *, row_number() over (
 partition by code1, code2, "similar" order by pair_id) as rn from turns) where rn = 1""")
def dedup_pairs(spark, folder):
    return dedup.dedup_pairs(turns(spark, folder), "pair_id").select("pair_id", "similar")


@query("prj2_row_problem", """
select doc_id, (row_number() over (order by doc_id) - 1)::VARCHAR as problem_id from documents""")
def row_problem(spark, folder):
    return select.with_row_problem(table(spark, folder, "documents").select("doc_id"), "doc_id")


@query("prj2_row_problem_string_key", """
select 's' || (doc_id * 7919 % 100003) as submission_id,
 (row_number() over (order by 's' || (doc_id * 7919 % 100003)) - 1)::VARCHAR as problem_id from documents""")
def row_problem_string_key(spark, folder):
    keyed = table(spark, folder, "documents").select(F.format_string("s%d", F.col("doc_id") * 7919 % 100003).alias("submission_id"))
    return select.with_row_problem(keyed, "submission_id")


@query("prj2_row_problem_by_key", "select doc_id, doc_id::VARCHAR as problem_id from documents")
def row_problem_by_key(spark, folder):
    return select.with_row_problem(table(spark, folder, "documents").select("doc_id"), "doc_id", dense=False)


@query("prj1_prj3_resolve_and_export", f"""
with {TURNS} select code1 as text1, code2 as text2, "similar" as labels from turns""")
def resolve_and_export(spark, folder):
    odd = turns(spark, folder).toDF("pair_id", "CODE1_norm", "Code2_Processed", "Similar")
    named = select.require_columns(
        odd, ["code1_processed", "code2_processed", "similar"], {"CODE1_norm": "code1_processed"})
    return select.export_pairs(named)


@query("flt1_filter_problems", f"""
with {CODE} select submission_id, problem_id from code where problem_id in (select printf('p%05d', i) from range(0, 6) r(i))""")
def filter_problems(spark, folder):
    ids = select.problem_ids(spark, 0, 6)
    return select.filter_problems(generated_code(spark, folder), ids).select("submission_id", "problem_id")


@query("flt1_filter_problem_list", "select doc_id from documents where source in ('src0', 'src3', 'src11')")
def filter_problem_list(spark, folder):
    documents = table(spark, folder, "documents").withColumnRenamed("source", "problem_id")
    return select.filter_problems(documents, ["src0", "src3", "src11"]).select("doc_id")


@query("flt2_filter_language", "select doc_id from documents where lang = 'de'")
def filter_language(spark, folder):
    documents = table(spark, folder, "documents").withColumnRenamed("lang", "language")
    return select.filter_language(documents, "de").select("doc_id")


@query("flt3_filter_accepted", f"""
with {CORPUS} select submission_id from corpus where upper(trim(status)) in ('AC', 'ACCEPTED')""")
def filter_accepted(spark, folder):
    return select.filter_accepted(S.documents_as_corpus(spark, folder)).select("submission_id")


@query("flt3_filter_accepted_code", "select event_id from events where (event_id % 6) = 4")
def filter_accepted_code(spark, folder):
    coded = table(spark, folder, "events").select("event_id", (F.col("event_id") % 6).cast("int").alias("judge_status"))
    return select.filter_accepted(coded).select("event_id")


@query("flt3_filter_accepted_exact", f"with {CODE} select submission_id, problem_id from code where status = 'Accepted'")
def filter_accepted_exact(spark, folder):
    return select.filter_accepted(
        generated_code(spark, folder).select("submission_id", "problem_id", "status"), exact=True)


@query("flt4_null_text", f"with {CORPUS} select submission_id, status from corpus where status is not null")
def drop_null_text(spark, folder):
    return select.drop_null_text(S.documents_as_corpus(spark, folder), "status").select("submission_id", "status")


@query("flt4_fill_empty", f"with {CORPUS} select submission_id, coalesce(status, '') as status from corpus")
def fill_empty(spark, folder):
    return select.fill_empty(S.documents_as_corpus(spark, folder), "status").select("submission_id", "status")


@query("flt5_usable_text", r"""
select doc_id from documents where length(regexp_replace(text, '[a-z\s]', '', 'g')) > 0 and lang <> 'fr'""")
def usable_text(spark, folder):
    rows = table(spark, folder, "documents").select(
        "doc_id", F.regexp_replace("text", "[a-z]", "").alias("processed_code"),
        F.when(F.col("lang") == "fr", "error").when(F.col("lang") == "de", "").alias("error"))
    return select.usable_text(rows).select("doc_id")


@query("flt7_sample_n", f"""
select doc_id from documents order by {key_sql(7, 'doc_id')}, doc_id limit 137""")
def sample_n(spark, folder):
    return select.sample_n(table(spark, folder, "documents").select("doc_id"), 137, 7, "doc_id")


@query("join3_drop_by_ids", "select doc_id from documents where doc_id not in (select doc_id from labels where quality = 0)")
def drop_by_ids(spark, folder):
    bad = table(spark, folder, "labels").where("quality = 0")
    return select.drop_by_ids(table(spark, folder, "documents").select("doc_id"), bad, "doc_id")


@query("join4_keep_by_ids", "select doc_id, source from documents where doc_id in (select doc_id from labels where quality = 1)")
def keep_by_ids(spark, folder):
    good = table(spark, folder, "labels").where("quality = 1")
    return select.keep_by_ids(table(spark, folder, "documents").select("doc_id", "source"), good, "doc_id")


@query("join5_duplicates_by_problem", """
with k as (select source, row_number() over (partition by source, sha1(text) order by doc_id) as rn from documents)
select source as problem_id, count(*) as original_count, count(*) filter (rn > 1) as duplicate_count,
 count(*) filter (rn = 1) as remaining_count from k group by source""")
def duplicates_by_problem(spark, folder):
    hashed = table(spark, folder, "documents").select(
        "doc_id", F.col("source").alias("problem_id"), F.sha1("text").alias("sha"))
    return stats.duplicates_by_problem(hashed, dedup.structural_duplicates(hashed, "doc_id", "sha"))


@query("join6_before_after_by_problem", """
with p as (select 'src' || i as problem_id from range(0, 25) r(i)),
b as (select source, count(*) as n from documents group by source),
a as (select source, count(*) as n, avg(n_chars) as m, sum(n_chars) as s from documents where lang = 'en' group by source)
select p.problem_id, coalesce(b.n, 0) as original_count, coalesce(a.n, 0) as final_count,
 coalesce(b.n, 0) - coalesce(a.n, 0) as removal_count,
 case when b.n > 0 then (b.n - coalesce(a.n, 0)) / b.n::DOUBLE * 100 else 0.0::DOUBLE end as removal_rate,
 round(coalesce(a.m, 0.0::DOUBLE), 6) as avg_code_length, coalesce(a.s, 0)::BIGINT as total_code_length
from p left join b on b.source = p.problem_id left join a on a.source = p.problem_id""")
def before_after_by_problem(spark, folder):
    listed = spark.range(25).select(F.concat(F.lit("src"), F.col("id").cast("string")).alias("problem_id"))
    documents = table(spark, folder, "documents").withColumnRenamed("source", "problem_id")
    out = stats.before_after_by_problem(listed, documents, documents.where("lang = 'en'"), "n_chars")
    return out.withColumn("avg_code_length", F.round("avg_code_length", 6))


@query("join7_attach_predictions", f"""
with {TURNS} select t.pair_id, (s.similar = 0)::INTEGER as similar from turns t join turns s on t.pair_id = s.pair_id""")
def attach_predictions(spark, folder):
    pairs = turns(spark, folder)
    predicted = pairs.select("pair_id", (F.col("similar") == 0).cast("int").alias("similar"))
    return select.attach_predictions(pairs, predicted)


@query("agg1_value_counts", """
select lang, count(*) as n, count(*) / (select count(*) from documents)::DOUBLE * 100 as pct from documents group by lang""")
def value_counts(spark, folder):
    return stats.value_counts(table(spark, folder, "documents"), "lang")


@query("agg1_value_counts_top", """
select user_id, count(*) as n, count(*) / (select count(*) from events)::DOUBLE * 100 as pct
from events group by user_id order by n desc, user_id limit 10""")
def value_counts_top(spark, folder):
    return stats.value_counts(table(spark, folder, "events"), "user_id", top=10)


@query("agg2_count_distinct", """
select count(distinct user_id) as n_user_id, count(distinct event_type) as n_event_type, count(distinct event_id) as n_event_id
from events""")
def count_distinct(spark, folder):
    return stats.count_distinct(table(spark, folder, "events"), "user_id", "event_type", "event_id")


@query("agg3_length_stats", """
select source, grouping(source)::INTEGER as level, count(*) as n, round(avg(length(text)), 6) as avg_length, sum(length(text))::BIGINT as total_length
from documents group by rollup(source)""")
def length_stats(spark, folder):
    out = stats.length_stats(table(spark, folder, "documents"), "text", by="source")
    return out.withColumn("avg_length", F.round("avg_length", 6))


@query("agg4_stage_rates", """
with s as (select unnest([{'stage': 'long', 'ok': n_chars > 200}, {'stage': 'english', 'ok': lang = 'en'}], recursive := true)
 from documents)
select stage, count(*) as total, count(*) filter (ok) as passed, count(*) filter (not ok) as failed,
 count(*) filter (ok) / count(*)::DOUBLE * 100 as success_rate from s group by stage""")
def stage_rates(spark, folder):
    return stats.stage_rates(
        table(spark, folder, "documents"), long=F.col("n_chars") > 200, english=F.col("lang") == "en")


@query("agg5_label_distribution", """
select quality, count(*) as n, count(*) / (select count(*) from labels)::DOUBLE * 100 as pct from labels group by quality""")
def label_distribution(spark, folder):
    return stats.label_distribution(table(spark, folder, "labels"), "quality")


@query("agg5_positive_rate", "select count(*) as n, round(avg(quality), 9) as positive_rate from labels")
def positive_rate(spark, folder):
    return stats.positive_rate(table(spark, folder, "labels"), "quality").withColumn(
        "positive_rate", F.round("positive_rate", 9))


@query("win1_first_n_per_group", """
select o_custkey, o_orderkey from (select o_custkey, o_orderkey,
 row_number() over (partition by o_custkey order by o_orderkey) as rn from orders) where rn <= 3""")
def first_n_per_group(spark, folder):
    orders = table(spark, folder, "orders").select("o_custkey", "o_orderkey")
    return ranking.first_n_per_group(orders, ["o_custkey"], [F.col("o_orderkey")], 3)


@query("win1_first_many_per_group", """
select o_orderstatus, o_orderkey from (select o_orderstatus, o_orderkey,
 row_number() over (partition by o_orderstatus order by o_orderkey) as rn from orders) where rn <= 2000""")
def first_many_per_group(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderstatus", "o_orderkey")
    return ranking.first_n_per_group(orders, ["o_orderstatus"], [F.col("o_orderkey")], 2000)


@query("srt1_seeded_shuffle", f"""
select doc_id, row_number() over (order by {key_sql(3, 'doc_id')}, doc_id) - 1 as place from documents""")
def seeded_shuffle(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id")
    draw = draw_key(3, "doc_id")
    return ranking.position(documents, "place", [draw, F.col("doc_id")], draw_bucket(draw))


@query("srt2_sorted_ids", "select distinct source from documents order by source")
def sorted_ids(spark, folder):
    return stats.sorted_ids(table(spark, folder, "documents"), "source")


@query("srt2_head", "select doc_id, n_chars from documents order by n_chars desc, doc_id limit 10")
def head(spark, folder):
    return stats.head(table(spark, folder, "documents").select("doc_id", "n_chars"), [F.desc("n_chars"), "doc_id"])


@query("set1_union_examples", f"""
with {TURNS} select pair_id, "similar" from turns where "similar" = 1 union all select pair_id, 0 from turns""")
def union_examples(spark, folder):
    pairs = turns(spark, folder).select("pair_id", "similar")
    return select.union_examples(pairs.where("similar = 1"), pairs.withColumn("similar", F.lit(0)))


@query("src6_submission", f'with {TURNS} select pair_id, "similar" from turns')
def submission(spark, folder):
    return S.submission(turns(spark, folder)).orderBy("pair_id")


@query("src8_report", """
with s as (select source, grouping(source)::INTEGER as level, count(*) as n, round(avg(length(text)), 6) as avg_length, sum(length(text)) as total_length
 from documents group by source)
select 'length' as section, source as item, 'n' as metric, n::DOUBLE as value from s
union all select 'length', source, 'avg_length', avg_length from s
union all select 'length', source, 'total_length', total_length::DOUBLE from s
union all select 'labels', '', 'n', (select count(*)::DOUBLE from labels)""")
def report(spark, folder):
    lengths = stats.length_stats(table(spark, folder, "documents"), "text", by="source").where("level = 0 and source IS NOT NULL")
    lengths = lengths.drop("level").withColumn("avg_length", F.round("avg_length", 6))
    labels = table(spark, folder, "labels").agg(F.count(F.lit(1)).alias("n"))
    return stats.report_rows("length", lengths, "source").unionByName(stats.report_rows("labels", labels))


METRICS_SQL = """
with c as (select count(*) filter (y = 1 and p = 1) as tp, count(*) filter (y = 0 and p = 1) as fp,
 count(*) filter (y = 1 and p = 0) as fn, count(*) filter (y = 0 and p = 0) as tn from judged)
select tp, fp, fn, tn, (tp + tn) / (tp + fp + fn + tn)::DOUBLE as accuracy,
 case when tp + fp > 0 then tp / (tp + fp)::DOUBLE else 0.0::DOUBLE end as precision,
 case when tp + fn > 0 then tp / (tp + fn)::DOUBLE else 0.0::DOUBLE end as recall,
 case when 2 * tp + fp + fn > 0 then 2 * tp / (2 * tp + fp + fn)::DOUBLE else 0.0::DOUBLE end as f1,
 round(((case when 2 * tp + fp + fn > 0 then 2 * tp / (2 * tp + fp + fn)::DOUBLE else 0 end)
  + (case when 2 * tn + fp + fn > 0 then 2 * tn / (2 * tn + fp + fn)::DOUBLE else 0 end))
  / ((tp + fp + fn > 0)::INTEGER + (tn + fp + fn > 0)::INTEGER), 9) as macro_f1 from c"""
JUDGED = f"judged as (select doc_id, quality as y, (({key_sql(1, 'doc_id')} / 1152921504606846976.0::DOUBLE) >= 0.5)::INTEGER as p from labels)"


def scored_labels(spark, folder):
    """Labels with a seeded score in [0, 1)."""
    return table(spark, folder, "labels").select(
        "doc_id", F.col("quality").alias("y"), (draw_key(1, "doc_id") / F.lit(2.0**60)).alias("score"))


@query("evl1_classification_metrics", f"with {JUDGED} select * from ({METRICS_SQL})")
def classification_metrics(spark, folder):
    judged = scored_labels(spark, folder).withColumn("p", (F.col("score") >= 0.5).cast("int"))
    return evaluate.classification_metrics(judged, "y", "p").withColumn("macro_f1", F.round("macro_f1", 9))


@query("evl1_batch_accuracy", f"""
with {JUDGED}, b as (select doc_id // 32 as batch, avg((y = p)::INTEGER) as acc from judged group by all)
select round(avg(acc), 9) as accuracy, count(*) as batches from b""")
def batch_accuracy(spark, folder):
    judged = scored_labels(spark, folder).withColumns({
        "p": (F.col("score") >= 0.5).cast("int"), "batch": F.floor(F.col("doc_id") / 32)})
    return evaluate.batch_accuracy(judged, "batch", "y", "p").withColumn("accuracy", F.round("accuracy", 9))


SCORED = f"scored as (select doc_id, quality as y, {key_sql(1, 'doc_id')} / 1152921504606846976.0::DOUBLE as score from labels)"
SWEEP = """sweep as (select k / 20.0::DOUBLE as threshold,
 count(*) filter (y = 1 and score >= k / 20.0::DOUBLE) as tp, count(*) filter (y = 0 and score >= k / 20.0::DOUBLE) as fp,
 count(*) filter (y = 1 and score < k / 20.0::DOUBLE) as fn from scored, range(1, 20) r(k) group by k)"""
F1 = "case when 2 * tp + fp + fn > 0 then 2 * tp / (2 * tp + fp + fn)::DOUBLE else 0.0::DOUBLE end"


@query("evl2_threshold_sweep", f"with {SCORED}, {SWEEP} select threshold, tp, fp, fn, {F1} as f1 from sweep")
def threshold_sweep(spark, folder):
    return evaluate.threshold_sweep(scored_labels(spark, folder), "y", "score")


@query("evl2_best_threshold", f"""
with {SCORED}, {SWEEP} select threshold, tp, fp, fn, {F1} as f1 from sweep order by f1 desc, threshold limit 1""")
def best_threshold(spark, folder):
    return evaluate.best_threshold(scored_labels(spark, folder), "y", "score")


@query("evl3_roc_auc", """
with s as (select toxic as y, quality * 2 + doc_id % 7 as score from labels),
r as (select y, (rank() over (order by score) + (count(*) over (partition by score) - 1) / 2.0::DOUBLE) as rk from s)
select round((sum(rk) filter (y = 1) - count(*) filter (y = 1) * (count(*) filter (y = 1) + 1) / 2.0::DOUBLE)
 / (count(*) filter (y = 1)::DOUBLE * count(*) filter (y = 0)), 9) as auc from r""")
def roc_auc(spark, folder):
    labels = table(spark, folder, "labels").select(
        F.col("toxic").alias("y"), (F.col("quality") * 2 + F.col("doc_id") % 7).alias("score"))
    return evaluate.roc_auc(labels, "y", "score").withColumn("auc", F.round("auc", 9))


@query("evl3_roc_auc_scores", f"""
with {SCORED}, r as (select y, rank() over (order by score) as rk from scored)
select round((sum(rk) filter (y = 1) - count(*) filter (y = 1) * (count(*) filter (y = 1) + 1) / 2.0::DOUBLE)
 / (count(*) filter (y = 1)::DOUBLE * count(*) filter (y = 0)), 9) as auc from r""")
def roc_auc_scores(spark, folder):
    return evaluate.roc_auc(scored_labels(spark, folder), "y", "score").withColumn("auc", F.round("auc", 9))


@query("evl6_experiment_summary", """
select 'all_positive' as model, 256 as max_length, count(*) as n, round(avg(quality), 9) as accuracy from labels
union all select 'all_negative', 512, count(*), round(avg(1 - quality), 9) from labels""")
def experiment_summary(spark, folder):
    labels = table(spark, folder, "labels")

    def accuracy(value):
        return labels.agg(
            F.count(F.lit(1)).alias("n"), F.round(F.avg((F.col("quality") == value).cast("double")), 9).alias("accuracy"))

    return evaluate.experiment_summary({"all_positive": (256, accuracy(1)), "all_negative": (512, accuracy(0))})


# A small program for each supplier, a folder for each nation; every third one is Latin-1, every fourth has Windows line ends.
SUPPLIED = r"""files as (select format('{:05d}', s_nationkey) as problem_id, format('{:05d}/{:09d}.py', s_nationkey, s_suppkey) as file,
 '# caf' || chr(233) || chr(10) || 'name = "' || s_name || '"' || chr(10) as code, s_suppkey from supplier)"""


def written_tree(spark, folder, root):
    suppliers = table(spark, folder, "supplier")
    ends = F.when(F.col("s_suppkey") % 4 == 0, F.lit("\r\n")).otherwise(F.lit("\n"))
    code = F.concat(F.lit("# caf\u00e9"), ends, F.lit('name = "'), F.col("s_name"), F.lit('"'), ends)
    content = F.when(F.col("s_suppkey") % 3 == 0, F.encode(code, "ISO-8859-1")).otherwise(F.encode(code, "UTF-8"))
    files = suppliers.select(F.format_string("%05d", "s_nationkey").alias("problem"), F.format_string("%09d.py", "s_suppkey").alias("name"),
                             content.alias("content"))
    return S.write_source_tree(files, root, "problem", "name", "content")


def stored_tree(spark, folder) -> str:
    shared = re.sub("^file:/+", "/", ensure_checkpoint_dir(spark))
    root = f"{shared}/tree-{uuid.uuid4().hex}"
    written_tree(spark, folder, root).agg(F.sum("size")).collect()
    return root


def tree_rows(found):
    return found.select("problem_id", F.concat_ws("/", "problem_id", F.element_at(F.split("file_path", "/"), -1)).alias("file"), "code")


@query("src3_source_tree", f"with {SUPPLIED} select problem_id, file, code from files")
def source_tree(spark, folder):
    return tree_rows(S.read_source_tree(spark, stored_tree(spark, folder)))


@query("src3_source_tree_capped", f"""
with {SUPPLIED}, r as (select *, dense_rank() over (order by problem_id) as p, row_number() over (partition by problem_id order by file) as f from files)
select problem_id, file, code from r where p <= 10 and f <= 3""")
def source_tree_capped(spark, folder):
    return tree_rows(S.read_source_tree(spark, stored_tree(spark, folder), max_problems=10, max_files=3))
