"""Registration of queries, and the SQL spellings shared by their oracles."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codelake.functions import text as T
from codelake.operators.vocab import each_word_once
from codelake.session import spread
from codelake.sources.generated import render_sql

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function (spark, folder) -> DataFrame under ``name``."""
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    """Documents dealt over all cores, for jobs that cost far more than reading."""
    return spread(table(spark, folder, "documents").select("doc_id", "text", "source", "lang"), "doc_id")


def key_sql(seed, *parts: str) -> str:
    return f"(('0x'||substr(md5(concat_ws(':','{seed}',{','.join(parts)})),1,15))::BIGINT)"


def word_sql(start: int, seed, *parts: str) -> str:
    return f"(('0x'||substr(md5(concat_ws(':','{seed}',{','.join(parts)})),{start},8))::BIGINT)"


CODE = f"code as ({render_sql('orders', 'printf')})"
CORPUS = """corpus as (
 select d.doc_id as submission_id, d.source as problem_id, d.lang as language, d.text as text,
  case when l.doc_id is null then null when l.quality = 1 then 'Accepted' else 'Wrong Answer' end as status
 from documents d left join labels l on d.doc_id = l.doc_id)"""
TURNS = """turns as (
 select u.conv_id * 1000 + u.turn as pair_id, u.text as code1, a.text as code2, (u.conv_id % 2)::INTEGER as similar
 from conversations u join conversations a on a.conv_id = u.conv_id and a.turn = u.turn + 1
 where u.role = 'user' and a.role = 'assistant')"""

# Word ids for the encoding queries: five special ids, then 995 hashed ones.
VOCAB_SIZE = 1000
SPLIT_SQL = r"regexp_extract_all(text, '\S+')"
IDS_SQL = f"[(5 + {key_sql('id', 'w')} % 995)::INTEGER for w in {SPLIT_SQL}]"
ENCODED = f"encoded as (select doc_id, text, {IDS_SQL} as ids from documents)"


def turns(spark: SparkSession, folder: str) -> DataFrame:
    """User turns with the assistant turn that follows."""
    said = table(spark, folder, "conversations")
    users = said.where("role = 'user'").select("conv_id", "turn", F.col("text").alias("code1"))
    answers = said.where("role = 'assistant'").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("code2"))
    return users.join(answers, ["conv_id", "turn"]).select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("pair_id"), "code1", "code2",
        (F.col("conv_id") % 2).cast("int").alias("similar"))


def hashed_ids(words):
    """One of 995 ids from the draw key of each word, made once for each distinct word of an Arrow batch."""
    def ids(distinct):
        return [[int(hashlib.md5(f"id:{w}".encode()).hexdigest()[:15], 16) % 995 + 5] for w in distinct]

    return F.when(words.isNotNull(), F.flatten(each_word_once(ids, words)))


def encoded(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as hashed word ids."""
    return documents(spark, folder).select("doc_id", "text", hashed_ids(T.words_by_space(F.col("text"))).alias("ids"))


def text_of(ids) -> "F.Column":
    return F.array_join((F.col(ids) if isinstance(ids, str) else ids).cast("array<string>"), ",")
