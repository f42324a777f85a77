"""Scores and retrieval metrics on the embeddings."""

from pyspark.sql import functions as F

from codelake.catalog.base import query, table
from codelake.operators import evaluate
from codelake.plans.pairs import judge_retrieval

BATCH = 16
TAU = 0.1
PAIRED = """paired as (select a.vec_id // 2 as n, a.embedding::DOUBLE[] as a, b.embedding::DOUBLE[] as b,
 case a.label % 3 when 0 then 'positive' when 1 then 'hard_negative' else 'semi_hard_negative' end as pair_type
 from embeddings a join embeddings b on b.vec_id = a.vec_id + 1 where a.vec_id % 2 = 0)"""
MATRIX = f"""{PAIRED}, placed as (select *, n // {BATCH} as batch, (n % {BATCH})::INTEGER as row from paired),
matrix as (select x.batch, x.row, y.row as col, list_dot_product(x.a, y.b) as score
 from placed x join placed y on y.batch = x.batch)"""


def paired(spark, folder):
    """Even vectors with the odd ones that follow."""
    vectors = table(spark, folder, "embeddings")
    left = vectors.where("vec_id % 2 = 0").select(
        F.floor(F.col("vec_id") / 2).alias("n"), F.col("embedding").alias("a"),
        F.when(F.col("label") % 3 == 0, "positive").when(F.col("label") % 3 == 1, "hard_negative")
        .otherwise("semi_hard_negative").alias("pair_type"))
    right = vectors.where("vec_id % 2 = 1").select(F.floor(F.col("vec_id") / 2).alias("n"), F.col("embedding").alias("b"))
    return left.join(right, "n")


def batched(spark, folder):
    return evaluate.with_batches(paired(spark, folder), "n", BATCH)


@query("scr1_score_cosine", f"""
with {PAIRED} select n, round(1 / (1 + exp(-list_dot_product(a, b) / {TAU}::DOUBLE)), 6) as score,
 (list_dot_product(a, b) >= 0)::INTEGER as similar from paired""")
def score_cosine(spark, folder):
    return evaluate.score_cosine(paired(spark, folder), "a", "b", TAU).select("n", F.round("score", 6).alias("score"), "similar")


@query("scr2_predict_threshold", """
select vec_id, round(exp(embedding[2]::DOUBLE) / (exp(embedding[1]::DOUBLE) + exp(embedding[2]::DOUBLE)), 6) as probability,
 (embedding[2] >= embedding[1])::INTEGER as similar from embeddings""")
def predict_threshold(spark, folder):
    rows = table(spark, folder, "embeddings").select("vec_id", F.slice("embedding", 1, 2).alias("logits"))
    return evaluate.predict_threshold(rows, "logits").select(
        "vec_id", F.round("probability", 6).alias("probability"), "similar")


@query("scr2_predict_argmax", """
with l as (select vec_id, embedding::DOUBLE[] as l from embeddings)
select vec_id, round(exp(list_max(l)) / list_sum([exp(x) for x in l]), 6) as probability,
 (list_position(l, list_max(l)) - 1)::INTEGER as similar from l""")
def predict_argmax(spark, folder):
    rows = table(spark, folder, "embeddings").select("vec_id", F.col("embedding").alias("logits"))
    return evaluate.predict_argmax(rows, "logits").select(
        "vec_id", F.round("probability", 6).alias("probability"), "similar")


@query("join8_similarity_matrix", f'with {MATRIX} select batch, "row", col, round(score, 6) as score from matrix')
def similarity_matrix(spark, folder):
    return evaluate.similarity_matrix(batched(spark, folder), "a", "b").withColumn("score", F.round("score", 6))


RANKED = f"""{MATRIX}, ranked as (select *, row_number() over (partition by batch, row order by score desc, col) as rank
 from matrix), own as (select batch, row, rank::INTEGER as rank from ranked where col = row)"""


@query("win3_rank_candidates", f'with {RANKED} select batch, "row", rank from own')
def rank_candidates(spark, folder):
    return evaluate.rank_candidates(batched(spark, folder), "a", "b").select("batch", "row", "rank")


METRICS = f"""{RANKED}, m as (select batch, avg((rank <= 1)::INTEGER) as r1, avg((rank <= 5)::INTEGER) as r5,
 avg((rank <= 10)::INTEGER) as r10, avg(1 / rank::DOUBLE) as mrr from own group by batch)"""
METRIC_COLUMNS = """round(avg(r1), 6) as recall_at_1, round(avg(r5), 6) as recall_at_5, round(avg(r10), 6) as recall_at_10,
 round(avg(mrr), 6) as mrr, round(avg(r1), 6) as accuracy"""


@query("evl4_retrieval_metrics", f"with {METRICS} select {METRIC_COLUMNS} from m")
def retrieval_metrics(spark, folder):
    out = evaluate.retrieval_metrics(batched(spark, folder), "a", "b")
    return out.select(*[F.round(c, 6).alias(c) for c in out.columns])


LOSSES = f"""across as (select batch, row, ln(sum(exp(score / {TAU}::DOUBLE))) as lse from matrix group by batch, row),
down as (select batch, col, ln(sum(exp(score / {TAU}::DOUBLE))) as lse from matrix group by batch, col),
losses as (select m.batch, avg(((a.lse - m.score / {TAU}::DOUBLE) + (d.lse - m.score / {TAU}::DOUBLE)) / 2
  * case pair_type when 'hard_negative' then 1.5::DOUBLE when 'semi_hard_negative' then 1.3::DOUBLE else 1 end) as loss
 from matrix m join across a on a.batch = m.batch and a.row = m.row join down d on d.batch = m.batch and d.col = m.row
 join placed p on p.batch = m.batch and p.row = m.row where m.col = m.row group by m.batch)"""


@query("evl5_weighted_info_nce", f"with {MATRIX}, {LOSSES} select batch, round(loss, 6) as loss from losses")
def weighted_info_nce(spark, folder):
    return evaluate.weighted_info_nce(batched(spark, folder), "a", "b", "pair_type", TAU).withColumn(
        "loss", F.round("loss", 6))


@query("run_judge_retrieval", f"""
with {METRICS}, {LOSSES} select {METRIC_COLUMNS}, (select round(avg(loss), 6) from losses) as loss from m""")
def retrieval_run(spark, folder):
    out = judge_retrieval(paired(spark, folder), "n", "a", "b", "pair_type", BATCH, TAU)
    return out.select(*[F.round(c, 6).alias(c) for c in out.columns])
