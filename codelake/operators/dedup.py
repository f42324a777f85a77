"""Exact, structural and pair duplicates, always keeping the first row by an explicit order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from codelake.operators.skew import lookup_join
from codelake.session import durable


def _first_of(df: DataFrame, keys: list, order: str) -> DataFrame:
    # row_number = 1 plans a group limit before the shuffle: a hot key sends one row per map task
    window = Window.partitionBy(*keys).orderBy(order)
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def dedup_exact(df: DataFrame, key: str, order: str) -> DataFrame:
    """DED-1: first row per content hash."""
    return _first_of(df, [key], order)


def dedup_structural(df: DataFrame, order: str, hash_col: str = "structure_sha256") -> DataFrame:
    """DED-2: first row per (problem, structure); rows without a hash are never duplicates."""
    own = F.when(F.col(hash_col).isNull(), F.col(order))
    return _first_of(df, ["problem_id", hash_col, own], order)


def structural_duplicates(df: DataFrame, order: str, hash_col: str = "structure_sha256") -> DataFrame:
    """DED-2: (original, duplicate) ids with their problem and structure."""
    keys = ["problem_id", hash_col]
    # hashes are costly to make and read several times, so the key table is stored
    rows = durable(df.where(F.col(hash_col).isNotNull()).select(*keys, order))
    firsts = (
        rows.groupBy(*keys).agg(F.min(order).alias("original"), F.count(F.lit(1)).alias("_n"))
        .where("_n > 1").drop("_n")
    )
    joined = lookup_join(rows, firsts, keys, spread=[order])
    return joined.where(F.col(order) != F.col("original")).withColumnRenamed(order, "duplicate")


def structural_groups(df: DataFrame, order: str, hash_col: str = "structure_sha256") -> DataFrame:
    """DED-2: one row per repeated structure: its problems and members are counted, not gathered."""
    keys = ["problem_id", hash_col]
    return (
        df.where(F.col(hash_col).isNotNull()).groupBy(*keys)
        .agg(F.min(order).alias("original"), F.count(F.lit(1)).alias("members"))
        .where("members > 1")
    )


def dedup_pairs(pairs: DataFrame, order: str, first="code1", second="code2") -> DataFrame:
    """DED-3: first row per (code1, code2, similar); the order of the codes matters."""
    return _first_of(pairs, [F.sha2(first, 256), F.sha2(second, 256), "similar"], order)


def dedup_report(before: DataFrame, after: DataFrame) -> DataFrame:
    """DED-1: removed, kept and kept share."""
    total = before.agg(F.count(F.lit(1))).scalar()
    counts = after.agg(F.count(F.lit(1)).alias("kept")).withColumn("total", total)
    return counts.select(
        "total", (F.col("total") - F.col("kept")).alias("removed"), "kept",
        F.when(F.col("total") > 0, F.col("kept") / F.col("total") * 100).otherwise(F.lit(0.0)).alias("kept_pct"))
