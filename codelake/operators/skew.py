"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_SHARE = 0.005


def hot_keys(
    rows: DataFrame, on: list[str], share: float | None = None, counts: DataFrame | None = None
) -> DataFrame:
    """Keys holding at least ``share`` of all rows, and ``_salts``: how many such shares each holds.

    The share is that of one shuffle partition, ``HOT_SHARE`` at most, so what a salt gets shrinks as
    partitions are added for more data. There are never more than 1/share keys.
    """
    if share is None:
        share = min(HOT_SHARE, 1 / int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    if counts is None:
        counts = rows.groupBy(*on).agg(F.count(F.lit(1)).alias("n"))
    limit = F.lit(counts.agg(F.sum("n")).scalar() * F.lit(share))
    return counts.where(F.col("n") >= limit).select(*on, F.ceil(F.col("n") / F.greatest(limit, F.lit(1))).alias("_salts"))


def lookup_join(
    rows: DataFrame,
    table: DataFrame,
    on: list[str],
    spread: list[str],
    how: str = "inner",
    share: float | None = None,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Join many rows to a table with few rows per key.

    Rows of a hot key are dealt by their ``spread`` columns over as many salts as its own
    count asks for, and the table's rows for that key are repeated once per salt. Known key
    ``counts`` (on..., n) save the pass that finds the hot keys.
    """
    hot = F.broadcast(hot_keys(rows, on, share, counts))  # at most 1/share rows
    dealt = rows.join(hot, on, "left").withColumn(
        "_salt", F.pmod(F.xxhash64(*spread), F.coalesce("_salts", F.lit(1))))
    repeated = table.join(hot, on, "left").withColumn(
        "_salt",
        F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("_salts", F.lit(1)) - 1)))
    return (
        dealt.drop("_salts")
        .join(repeated.drop("_salts"), [*on, "_salt"], how)
        .drop("_salt")
    )
