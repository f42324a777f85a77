"""Counts, rates and length statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codelake.functions import text as T


def percent(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole * 100).otherwise(F.lit(0.0))


def value_counts(df: DataFrame, column: str, top: int | None = None, by_key: bool = False) -> DataFrame:
    """AGG-1: frequencies with share of the total, most frequent first or by key."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    total = df.agg(F.count(F.lit(1))).scalar()
    shares = counts.withColumn("pct", F.col("n") / total * 100)
    ordered = shares.orderBy(column) if by_key else shares.orderBy(F.desc("n"), column)
    return ordered.limit(top) if top else ordered


def count_distinct(df: DataFrame, *columns: str, approximate: bool = False) -> DataFrame:
    """AGG-2."""
    count = F.approx_count_distinct if approximate else F.count_distinct
    return df.agg(*[count(F.col(c)).alias(f"n_{c}") for c in columns])


def length_stats(df: DataFrame, text: str, by: str = "problem_id") -> DataFrame:
    """AGG-3: per group and overall in one pass; ``level`` is 0 for a group, also for the null one, and 1 for the total."""
    sized = df.select(by, T.n_chars(F.col(text)).alias("_len"))
    return sized.rollup(by).agg(
        F.grouping(by).cast("int").alias("level"), F.count(F.lit(1)).alias("n"), F.avg("_len").alias("avg_length"), F.sum("_len").alias("total_length"))


def stage_rates(df: DataFrame, **passed: Column) -> DataFrame:
    """AGG-4: one row per stage with passed / failed counts and the success rate."""
    counted = df.agg(F.count(F.lit(1)).alias("total"), *[F.count_if(c).alias(f"_{s}") for s, c in passed.items()])
    stages = F.array(*[F.struct(F.lit(s).alias("stage"), F.col(f"_{s}").alias("passed")) for s in passed])
    return counted.select("total", F.inline(stages)).select(
        "stage", "total", "passed", (F.col("total") - F.col("passed")).alias("failed"),
        percent(F.col("passed"), F.col("total")).alias("success_rate"))


def label_distribution(df: DataFrame, label: str = "similar") -> DataFrame:
    """AGG-5."""
    return value_counts(df, label, by_key=True)


def positive_rate(df: DataFrame, label: str = "similar") -> DataFrame:
    """AGG-5."""
    return df.agg(F.count(F.lit(1)).alias("n"), F.avg(F.col(label).cast("double")).alias("positive_rate"))


def token_range(df: DataFrame, ids: str) -> DataFrame:
    """AGG-6: smallest and largest id and the sequence lengths, without exploding."""
    return df.agg(
        F.min(F.array_min(ids)).alias("min_id"), F.max(F.array_max(ids)).alias("max_id"),
        F.min(F.size(ids)).alias("min_length"), F.max(F.size(ids)).alias("max_length"))


def token_violations(df: DataFrame, key: str, ids: str, vocab_size: int, top: int = 10) -> DataFrame:
    """AGG-6: the first positions holding an id outside [0, vocab_size)."""
    def outside(x):
        return (x < 0) | (x >= vocab_size)

    return (
        df.where(F.exists(ids, outside)).select(key, F.posexplode(ids).alias("pos", "token"))
        .where(outside(F.col("token"))).orderBy(key, "pos").limit(top)
    )


def check_token_range(df: DataFrame, key: str, ids: str, vocab_size: int) -> DataFrame:
    """AGG-6: ``df`` itself, or an error naming the first violations."""
    bad = [tuple(row) for row in token_violations(df, key, ids, vocab_size).collect()]
    if bad:
        raise ValueError(f"token ids outside [0, {vocab_size}): {bad}")
    return df


def duplicates_by_problem(df: DataFrame, duplicates: DataFrame) -> DataFrame:
    """JOIN-5: per problem the original count, duplicates (0 if none) and the remainder."""
    totals = df.groupBy("problem_id").agg(F.count(F.lit(1)).alias("original_count"))
    found = duplicates.groupBy("problem_id").agg(F.count(F.lit(1)).alias("_n"))
    joined = totals.join(found, "problem_id", "left").withColumn("duplicate_count", F.coalesce("_n", F.lit(0)))
    return joined.select(
        "problem_id", "original_count", "duplicate_count",
        (F.col("original_count") - F.col("duplicate_count")).alias("remaining_count"))


def before_after_by_problem(problems: DataFrame, before: DataFrame, after: DataFrame, length: str) -> DataFrame:
    """JOIN-6: per listed problem, counts before and after and the lengths of what is left."""
    was = before.groupBy("problem_id").agg(F.count(F.lit(1)).alias("_was"))
    now = after.groupBy("problem_id").agg(
        F.count(F.lit(1)).alias("_now"), F.avg(length).alias("_avg"), F.sum(length).alias("_sum"))
    joined = problems.select("problem_id").join(was, "problem_id", "left").join(now, "problem_id", "left")
    n_was, n_now = F.coalesce("_was", F.lit(0)), F.coalesce("_now", F.lit(0))
    return joined.select(
        "problem_id", n_was.alias("original_count"), n_now.alias("final_count"),
        (n_was - n_now).alias("removal_count"), percent(n_was - n_now, n_was).alias("removal_rate"),
        F.coalesce("_avg", F.lit(0.0)).alias("avg_code_length"),
        F.coalesce("_sum", F.lit(0)).alias("total_code_length"))


def sorted_ids(df: DataFrame, column: str) -> DataFrame:
    """SRT-2."""
    return df.select(column).distinct().orderBy(column)


def head(df: DataFrame, order: list, n: int = 10) -> DataFrame:
    """SRT-2: preview or top-k."""
    return df.orderBy(*order).limit(n)


def report_rows(section: str, stats: DataFrame, key: str | None = None) -> DataFrame:
    """SRC-8: a statistics table as (section, item, metric, value) rows."""
    metrics = [c for c in stats.columns if c != key]
    item = F.col(key).cast("string") if key else F.lit("")
    pairs = F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics])
    return stats.select(F.lit(section).alias("section"), item.alias("item"), F.inline(pairs))
