"""Mixing sources to target weights by hash-threshold histograms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from codelake.llm.common import WORD, stored

#: Bits of the draw that one histogram level resolves, and the levels: 4 x 12 bits tell 2.8e14 positions apart.
LEVEL_BITS, LEVELS = 12, 4


def draw(key: Column) -> Column:
    """48 bits of the MD5 of a key: the place of a document in its source's order. Null keys share one place."""
    text = F.concat(F.lit("mix:"), F.coalesce(key.cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(text), 1, LEVEL_BITS * LEVELS // 4), 16, 10).cast("long")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = (3, 1, 2), budget: float = 1.5, most: float = 2.0) -> DataFrame:
    """What each source may give: source, source_size, target.

    ``sizes`` has source and source_size, one row per source. Sources in code-point order, null last, get the weights
    in turn and share ``budget`` times the sum of sizes; a target stops at ``most`` times its source and the
    excess is shared again. In order of ``most * size / weight`` the stopped sources are a prefix, so running sums give
    the final share per weight at once. One row per source is all that the window sorts.
    """
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    place = F.row_number().over(order) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (place % len(weights) + 1).cast("int")).cast("long")
    known = sizes.withColumn("weight", weight).withColumn("limit", F.col("source_size") * F.lit(most))
    full = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").isNull(), F.col("source"))
    before, everything = full.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    level = (F.sum("source_size").over(everything) * F.lit(budget) - F.coalesce(F.sum("limit").over(before), F.lit(0.0))) / (
        F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    levels = known.withColumn("level", level).withColumn("stops", F.col("limit") <= F.col("level") * F.col("weight"))
    final = F.max(F.when(~F.col("stops"), F.col("level"))).over(everything)  # levels rise up to it, then fall
    target = F.when(F.col("stops"), F.col("limit")).otherwise(final * F.col("weight"))
    return levels.select("source", "source_size", F.coalesce(target, F.lit(0.0)).alias("target"))


def thresholds(rows: DataFrame, shares: DataFrame) -> DataFrame:
    """The first draw of each source that its mix leaves out: source, whole, cut.

    ``rows``: source, size, draw. Every document is taken ``whole`` times, and once more where its draw is below
    ``cut``. Level by level, a histogram over the next bits of the draw finds the bucket in which the budget
    ends; only rows of that bucket enter the next level. The last level decides for the bucket as a whole (rows
    that share a draw go together): it is taken if that ends nearer to the budget, or as near.
    """
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    state = shares.withColumn("whole", whole.cast("long")).select(
        "source", "whole", (F.col("target") - F.col("whole") * F.col("source_size")).alias("left"),
        F.lit(0).cast("long").alias("prefix"))
    for level in range(LEVELS):
        last = level == LEVELS - 1
        shift = LEVEL_BITS * (LEVELS - 1 - level)
        inside = rows.withColumn("bucket", F.shiftright("draw", shift)).join(
            F.broadcast(state.withColumnRenamed("source", "its_source")), F.col("source").eqNullSafe(F.col("its_source")))
        if level:
            inside = inside.where(F.shiftright("draw", shift + LEVEL_BITS) == F.col("prefix"))
        histogram = inside.groupBy("source", "bucket").agg(F.sum("size").alias("size"))
        along = Window.partitionBy("source").orderBy("bucket")
        sums = histogram.withColumn("upto", F.sum("size").over(along)).join(
            state.withColumnRenamed("source", "its_source"), F.col("source").eqNullSafe(F.col("its_source")), "right")
        # a bucket that fits is passed; at the last level also one that ends nearer to the budget taken than left out
        fits = F.col("upto") * 2 - F.col("size") <= F.col("left") * 2 if last else F.col("upto") <= F.col("left")
        base = F.shiftleft(F.max("prefix"), LEVEL_BITS) if level else F.lit(0).cast("long")
        state = stored(sums.groupBy(F.col("its_source").alias("source")).agg(
            F.max("whole").alias("whole"),
            (F.max("left") - F.coalesce(F.max(F.when(fits, F.col("upto"))), F.lit(0))).alias("left"),
            F.coalesce(F.min(F.when(~fits, F.col("bucket"))), base + (1 << LEVEL_BITS)).alias("prefix")), "mix-cuts")
    return state.select("source", "whole", F.col("prefix").alias("cut"))


def plan_of(rows: DataFrame, weights: tuple[int, ...], budget: float, most: float) -> DataFrame:
    """source, source_size, target, whole, cut: one row per source, stored."""
    shares = stored(targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, budget, most), "mix-targets")
    if shares.count() > SOURCES:
        raise ValueError(f"more than {SOURCES} sources; mix groups of sources instead")
    cuts = thresholds(rows, shares)
    return stored(shares.alias("s").join(cuts.alias("c"), F.expr("s.source <=> c.source")).select(
        F.col("s.source").alias("its_source"), "source_size", "target", "whole", "cut"), "mix-plan")


def sized(docs: DataFrame, key: str, text: str, source: str) -> DataFrame:
    return stored(docs.select(
        F.col(key).alias("doc_id"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"),
        draw(F.col(key)).alias("draw")), "mix-sizes")


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
        weights: tuple[int, ...] = (3, 1, 2), budget: float = 1.5, most: float = 2.0) -> DataFrame:
    """How often each document enters the mix: doc_id, source, size, source_size, target, copies, taken.

    Nothing is sorted: sums by (source, hash bucket) find a nested threshold per source, and a comparison with it
    takes the documents. Reruns agree, as the order is a hash of the key. Sums are combined before each shuffle,
    so a source with most rows costs one row per bucket and task. One row per source reaches every task: the
    number of sources is checked against ``SOURCES`` before they are broadcast.

    Null text or empty text has size 0 (taken 0 words; copies by its draw). A null source is a source of its own.
    Rows with the same key share a draw and go together. An empty table gives an empty result.
    """
    rows = sized(docs, key, text, source)
    plan = plan_of(rows, weights, budget, most)
    copies = F.col("whole") + (F.col("draw") < F.col("cut")).cast("long")
    return rows.join(F.broadcast(plan), F.col("source").eqNullSafe(F.col("its_source"))).select(
        "doc_id", "source", "size", "source_size", "target", copies.alias("copies"), (F.col("size") * copies).alias("taken"))


def mixed(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
          weights: tuple[int, ...] = (3, 1, 2), budget: float = 1.5, most: float = 2.0) -> DataFrame:
    """The documents of the mix, each as often as it is taken; all columns stay and no text is shuffled."""
    plan = plan_of(sized(docs, key, text, source), weights, budget, most).select(
        F.col("its_source").alias("__source"), F.col("whole").alias("__whole"), F.col("cut").alias("__cut"))
    copies = (F.col("__whole") + (draw(F.col(key)) < F.col("__cut")).cast("long")).cast("int")
    chosen = docs.join(F.broadcast(plan), F.col(source).eqNullSafe(F.col("__source"))).withColumn("__copies", copies).where("__copies > 0")
    return chosen.select(*[F.col(f"`{c}`") for c in docs.columns], F.explode(F.sequence(F.lit(1), F.col("__copies"))).alias("__nth")).drop("__nth")


#: Most sources that one mix takes: a row of some 60 bytes each is sent to every task.
SOURCES = 200_000
