"""Ranks and exact cuts that never gather a large group in one task.

A plain window over one group sorts that group in one task. Here a group is first
cut into buckets that keep the sort order; bucket sizes give each bucket's offset,
and rows are ranked only within their bucket.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType

from codelake.session import durable

WINDOW_LIMIT = "spark.sql.optimizer.windowGroupLimitThreshold"
TOP_SALTS = 1024
#: Rows of a cut's bucket that one task sorts; a larger bucket is cut again.
SORTED_ROWS = 1_000_000


def global_cut(
    rows: DataFrame, order: list[Column], bucket: Column, want: Callable[[int], int]
) -> tuple | None:
    """The order value of row number ``want(size)`` in a global order; None when no row is wanted.

    Reads only the order columns: a histogram of at most as many rows as buckets, then
    a sort of the one bucket in which the cut falls. ``bucket`` must not decrease with
    ``order``.
    """
    keyed = rows.select(*[c.alias(f"_o{i}") for i, c in enumerate(order)], bucket.alias("_bucket"))
    sizes = sorted(map(tuple, keyed.groupBy("_bucket").agg(F.count(F.lit(1))).collect()))
    total = sum(n for _, n in sizes)
    nth = min(want(total), total)
    if nth <= 0:
        return None
    for at, n in sizes:
        if nth <= n:
            break
        nth -= n
    names = [f"_o{i}" for i in range(len(order))]
    edge, n, nth = refined(keyed.where(F.col("_bucket") == at), n, nth)
    ranked = edge.withColumn(
        "_nth", F.row_number().over(Window.partitionBy("_bucket").orderBy(*names)))
    return tuple(ranked.where(F.col("_nth") == nth).select(*names).first())


def refined(edge: DataFrame, n: int, nth: int) -> tuple[DataFrame, int, int]:
    """Narrow the bucket of a cut, by histograms over its range of the first order value, until a task can sort it."""
    while n > SORTED_ROWS and isinstance(edge.schema["_o0"].dataType, LongType):
        low, high = edge.agg(F.min("_o0"), F.max("_o0")).first()
        if low == high:
            break
        shift = max((high - low).bit_length() - 10, 0)
        parts = F.shiftright(F.col("_o0") - F.lit(low), shift)
        for at, n in sorted(map(tuple, edge.groupBy(parts.alias("at")).agg(F.count(F.lit(1))).collect())):
            if nth <= n:
                break
            nth -= n
        edge = edge.where(parts == at)
    return edge, n, nth


def upto_cut(order: list[Column], cut: tuple | None) -> Column:
    """True for rows up to the cut; no cut keeps none."""
    if cut is None:
        return F.lit(False)
    kept = F.lit(True)
    for column, value in zip(reversed(order), reversed(cut)):
        kept = (column < F.lit(value)) | ((column == F.lit(value)) & kept)
    return kept


def take_first(rows: DataFrame, order: list[Column], bucket: Column, want: Callable[[int], int]) -> DataFrame:
    """Exactly the first ``want(size)`` rows in a global order, without a global sort."""
    return rows.where(upto_cut(order, global_cut(rows, order, bucket, want)))


def group_cuts(
    rows: DataFrame, order: list[Column], bucket: Column, wanted: DataFrame, by: list[str]
) -> DataFrame:
    """As ``global_cut`` for every group: (by..., cut) from a table (by..., want).

    Only the bucket in which a group's cut falls is sorted. The result has one row per
    group and is stored, since the rows it was read from are needed again.
    """
    keyed = rows.select(*by, F.struct(*order).alias("_at"), bucket.alias("_bucket"))
    upto = Window.partitionBy(*by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sizes = keyed.groupBy(*by, "_bucket").agg(F.count(F.lit(1)).alias("_n")).withColumn("_upto", F.sum("_n").over(upto))
    edge = sizes.join(wanted, by).where("want > _upto - _n AND want <= _upto").select(
        *by, "_bucket", F.expr("want - _upto + _n").alias("_nth"))
    within = Window.partitionBy(*by, "_bucket").orderBy("_at")
    ranked = keyed.join(edge, [*by, "_bucket"]).withColumn("_at_rank", F.row_number().over(within))
    return durable(ranked.where("_at_rank = _nth").select(*by, F.col("_at").alias("cut")))


def position(
    rows: DataFrame, name: str, order: list[Column], bucket: Column, by: tuple[str, ...] = ()
) -> DataFrame:
    """Dense zero-based position within each group, as column ``name``."""
    by = list(by)
    tagged = rows.withColumn("_bucket", bucket)
    group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    before = group.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        tagged.groupBy(*by, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .drop("_n")
    )
    if not by:  # as many rows as buckets
        offsets = F.broadcast(offsets)
    within = Window.partitionBy(*by, "_bucket").orderBy(*order)
    return (
        tagged.withColumn(name, F.row_number().over(within) - 1)
        .join(offsets, [*by, "_bucket"])
        .withColumn(name, (F.col(name) + F.col("_before")).cast("long"))
        .drop("_bucket", "_before")
    )


def first_n_per_group(
    rows: DataFrame, by: list[str], order: list[Column], n: int, spread: list[str] | None = None
) -> DataFrame:
    """WIN-1: the first ``n`` rows of each group.

    Up to the planner's limit Spark keeps only ``n`` rows per group on the map side.
    Beyond it, the first ``n`` per salt of the ``spread`` columns are taken first.
    """
    limit = int(rows.sparkSession.conf.get(WINDOW_LIMIT, "1000"))
    windows = [Window.partitionBy(*by).orderBy(*order)]
    if n > limit:
        salt = F.pmod(F.xxhash64(*(spread or rows.columns)), F.lit(TOP_SALTS))
        windows.insert(0, Window.partitionBy(*by, salt).orderBy(*order))
    for window in windows:
        rows = rows.withColumn("_rank", F.row_number().over(window)).where(F.col("_rank") <= n).drop("_rank")
    return rows


def range_bucket(value: Column, low: Column, high: Column, buckets: int = 1024) -> Column:
    """Equal-width buckets that keep the order of a number known to lie in [low, high]."""
    width = F.greatest(high - low, F.lit(1)).cast("double")
    return F.least(F.floor((value - low) / width * buckets), F.lit(buckets - 1)).cast("int")


def with_quantile_bucket(rows: DataFrame, value: str, to: str, buckets: int = 1024) -> DataFrame:
    """Near-equal buckets that keep the order of a number or string, cut at approximate quantiles.

    Strings are cut at whole keys of a sample of their distinct values, so a long common start does no harm.
    """
    if isinstance(rows.schema[value].dataType, StringType):
        return with_string_bucket(rows, value, to, buckets)
    steps = [i / buckets for i in range(1, buckets)]
    cuts = rows.agg(F.percentile_approx(F.col(value).cast("double"), steps, 10 * buckets)).first()[0] or [0.0]
    ends = [float("-inf"), *sorted(set(cuts)), float("inf")]
    tagged = rows.withColumn("_value", F.col(value).cast("double"))
    bucketizer = Bucketizer(splits=ends, inputCol="_value", outputCol=to, handleInvalid="keep")
    return bucketizer.transform(tagged).drop("_value")


def with_string_bucket(rows: DataFrame, value: str, to: str, buckets: int, sample: int = 20_000) -> DataFrame:
    """Buckets of strings between cuts from about ``sample`` values, drawn by hash; the cuts steer the work, not the result."""
    counted = rows.agg(F.approx_count_distinct(value)).first()[0]
    drawn = rows.where(F.pmod(F.xxhash64(value), F.lit(max(counted // sample, 1))) == 0).select(F.substring(value, 1, 200).alias("cut"))
    values = sorted(r.cut for r in drawn.distinct().where("cut IS NOT NULL").limit(4 * sample).collect())
    cuts = np.array(sorted({values[len(values) * i // buckets] for i in range(1, buckets)}) if values else [], dtype=object)

    @F.pandas_udf("int")
    def place(keys: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, keys.fillna("").to_numpy(dtype=object), side="right"), dtype="int32")

    return rows.withColumn(to, F.when(F.col(value).isNotNull(), place(value)).otherwise(F.lit(-1)))


def running_before(rows: DataFrame, bucket: Column, order: str, sums: dict[str, str]) -> DataFrame:
    """For each value column, its sum over all rows earlier in a global order with distinct values."""
    tagged = rows.withColumn("_bucket", bucket)
    before_bucket = (
        Window.partitionBy(F.lit(0)).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1))
    totals = tagged.groupBy("_bucket").agg(*[F.sum(c).alias(f"_t_{c}") for c in sums])
    totals = totals.select(
        "_bucket", *[F.coalesce(F.sum(f"_t_{c}").over(before_bucket), F.lit(0)).alias(f"_t_{c}") for c in sums])
    within = Window.partitionBy("_bucket").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    # as many rows as buckets
    out = tagged.join(F.broadcast(totals), "_bucket")
    for column, name in sums.items():
        out = out.withColumn(name, F.coalesce(F.sum(column).over(within), F.lit(0)) + F.col(f"_t_{column}"))
    return out.drop("_bucket", *[f"_t_{c}" for c in sums])
