"""Splits."""

from pyspark.sql import functions as F

from codelake.catalog.base import CODE, key_sql, query, table
from codelake.operators import splits
from codelake.sources.generated import generated_code


@query("spl1_split_random", f"""
select doc_id, case when row_number() over (order by {key_sql(42, 'doc_id')}, doc_id)
 <= ceil((select count(*) from documents) * 0.1::DOUBLE) then 'validation' else 'train' end as split from documents""")
def split_random(spark, folder):
    return splits.split_random(table(spark, folder, "documents").select("doc_id"), "doc_id", 0.1, 42)


@query("spl1_split_random_floor", f"""
select conv_id, turn, case when {key_sql(42, 'conv_id*1000+turn')} <= (select max(k) from (
  select {key_sql(42, 'conv_id*1000+turn')} as k from conversations order by k
  limit (select greatest(1, floor(count(*) * 0.05::DOUBLE)::BIGINT) from conversations)))
 then 'validation' else 'train' end as split from conversations""")
def split_random_floor(spark, folder):
    said = table(spark, folder, "conversations").select(
        "conv_id", "turn", (F.col("conv_id") * 1000 + F.col("turn")).alias("id"))
    return splits.split_random(said, "id", 0.05, 42, "floor").drop("id")


def quota_sql(rows: str, label: str, ratio: float, seed) -> str:
    """Rows to hold out per label: largest-remainder training shares."""
    return f"""
sizes as (select {label} as label, count(*) as n from {rows} group by {label}),
total as (select sum(n)::BIGINT as total, sum(n)::BIGINT - ceil(sum(n)::BIGINT * {ratio}::DOUBLE)::BIGINT as n_train from sizes),
shares as (select label, n, n * n_train // total as share, n * n_train % total as rest from sizes, total),
ranked as (select *, row_number() over (order by rest desc, {key_sql(seed, 'label')}, label) as place from shares),
quotas as (select label, n - share - (place <= (select n_train from total) - (select sum(share) from shares))::INTEGER as want
 from ranked)"""


@query("spl2_split_stratified", f"""
with {quota_sql('labels', 'quality', 0.2, 42)}
select doc_id, quality, case when row_number() over (partition by quality order by {key_sql(42, 'doc_id')}, doc_id) <= want
 then 'validation' else 'train' end as split from labels join quotas on quality = label""")
def split_stratified(spark, folder):
    labels = table(spark, folder, "labels").select("doc_id", "quality")
    return splits.split_stratified(labels, "quality", "doc_id", 0.2, 42)


THREE_WAY = f"""
with {CODE}, {quota_sql('code', 'problem_id', 0.2, '42:first')},
first as (select submission_id, problem_id, row_number() over (
 partition by problem_id order by {key_sql('42:first', 'submission_id')}, submission_id) <= want as held
 from code join quotas on problem_id = label),
rest as (select submission_id, problem_id from first where held)"""
SECOND = quota_sql("rest", "problem_id", 0.5, "42:second")
for name in ("sizes", "total", "shares", "ranked", "quotas"):
    SECOND = SECOND.replace(f"{name} as (", f"{name}_2 as (").replace(f"from {name}", f"from {name}_2").replace(
        f", {name})", f", {name}_2)")
THREE_WAY += f""", {SECOND},
second as (select submission_id, row_number() over (
 partition by problem_id order by {key_sql('42:second', 'submission_id')}, submission_id) <= want as test
 from rest join quotas_2 on problem_id = label)
select c.submission_id, c.problem_id, case when s.test is null then 'train' when s.test then 'test' else 'validation' end as split
from code c left join second s on c.submission_id = s.submission_id"""


@query("spl3_split_stratified_3way", THREE_WAY)
def split_stratified_3way(spark, folder):
    rows = generated_code(spark, folder).select("submission_id", "problem_id")
    return splits.split_stratified_3way(rows, "submission_id", 0.1, 0.1, 42).select("submission_id", "problem_id", "split")


@query("spl3_split_random_fallback", f"""
with r as (select user_id, count(*) as n, {key_sql('42:first', 'user_id')} as k1, {key_sql('42:second', 'user_id')} as k2
 from events group by user_id),
f as (select *, row_number() over (order by k1, user_id) <= ceil((select count(*) from r) * 0.2::DOUBLE) as held from r),
s as (select user_id, row_number() over (order by k2, user_id)
 <= ceil((select count(*) from f where held) * 0.5::DOUBLE) as test from f where held)
select f.user_id, case when s.test is null then 'train' when s.test then 'test' else 'validation' end as split
from f left join s on f.user_id = s.user_id""")
def split_random_fallback(spark, folder):
    users = table(spark, folder, "events").select("user_id").distinct().withColumn(
        "problem_id", F.col("user_id").cast("string"))
    return splits.split_stratified_3way(users, "user_id", 0.1, 0.1, 42).select("user_id", "split")


def disjoint_sql(counts: str, names: tuple[str, str, str]) -> str:
    return f"""
with p as (select source, row_number() over (order by {key_sql(42, 'source')}, source) as place
  from (select distinct source from documents)),
t as (select count(*) as total from p), c as ({counts})
select doc_id, d.source, case when place <= first then '{names[0]}' when place <= second then '{names[1]}' else '{names[2]}' end as split
from documents d join p on d.source = p.source, c"""


DISJOINT = disjoint_sql(
    """select v as first, v + case when v + s >= total then greatest(0, total - v - 1) else s end as second
 from (select total, greatest(1, floor(total * 0.1::DOUBLE)::BIGINT) as v, greatest(1, floor(total * 0.15::DOUBLE)::BIGINT) as s from t)""",
    ("validation", "test", "train"))


@query("spl4_split_disjoint", DISJOINT)
def split_disjoint(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id", "source")
    return splits.split_disjoint(documents, 0.1, 0.15, 42, problem="source")


@query("spl4_split_disjoint_floors", disjoint_sql(
    "select floor(0.8::DOUBLE * total) as first, floor(0.9::DOUBLE * total) as second from t", ("train", "validation", "test")))
def split_disjoint_floors(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id", "source")
    return splits.split_disjoint(documents, 0.1, 0.1, 42, problem="source", minimum=False)


@query("set2_split_overlap", f"""
with s as (select doc_id, source, case when row_number() over (order by {key_sql(42, 'doc_id')}, doc_id)
 <= ceil((select count(*) from documents) * 0.02::DOUBLE) then 'validation' else 'train' end as split from documents)
(select source from s where split = 'train' intersect select source from s where split = 'validation')""")
def split_overlap(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id", "source")
    return splits.split_overlap(splits.split_random(documents, "doc_id", 0.02, 42), "source")
