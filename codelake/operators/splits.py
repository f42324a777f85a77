"""Train / validation / test splits with exact counts.

A split is decided by comparing a row's seeded draw with a cut point, so finding the
cut reads only keys, and labelling the corpus is a map-side pass without a shuffle.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codelake.functions.keys import draw_bucket, draw_key
from codelake.operators.ranking import global_cut, group_cuts, upto_cut
from codelake.operators.skew import lookup_join
from codelake.session import durable

BROADCAST_LABELS = 100_000


def holdout_size(total: int, ratio: float, rounding: str = "ceil") -> int:
    """``ceil`` of the share, or its ``floor`` but at least one."""
    return math.ceil(total * ratio) if rounding == "ceil" else max(1, int(total * ratio))


def _order(seed, key: str):
    draw = draw_key(seed, key)
    return [draw, F.col(key)], draw_bucket(draw)


def split_random(df: DataFrame, key: str, ratio: float, seed, rounding: str = "ceil") -> DataFrame:
    """SPL-1: column ``split`` of train / validation."""
    order, bucket = _order(seed, key)
    cut = global_cut(df, order, bucket, lambda total: holdout_size(total, ratio, rounding))
    return df.withColumn("split", F.when(upto_cut(order, cut), "validation").otherwise("train"))


def _label_sizes(df: DataFrame, label: str) -> tuple[DataFrame, int, int, int]:
    """Rows per label (stored), and in all: rows, labels, rows of the rarest label."""
    sizes = durable(df.groupBy(label).agg(F.count(F.lit(1)).alias("n")))
    total, labels, rarest = sizes.agg(F.sum("n"), F.count(F.lit(1)), F.min("n")).first()
    return sizes, total or 0, labels, rarest or 0


def _quotas(sizes: DataFrame, total: int, label: str, ratio: float, seed) -> DataFrame:
    """Rows to hold out per label: training shares by largest remainder, the rest is held out."""
    n_train = total - math.ceil(total * ratio)
    product = F.col("n").cast("decimal(38,0)") * F.lit(n_train).cast("decimal(18,0)")
    whole = F.lit(total).cast("decimal(18,0)")
    shares = sizes.withColumns({
        "_rest": (product % whole).cast("long"),
        "_floor": ((product - product % whole) / whole).cast("long"),
    })
    missing = n_train - (shares.agg(F.sum("_floor")).first()[0] or 0)
    draw = draw_key(seed, label)
    order = [-F.col("_rest"), draw, F.col(label)]
    # labels of equal remainders, as many as there are, are told apart by the five leading bits of their draws
    rest = F.floor((F.lit(1.0) - F.col("_rest") / F.lit(max(total, 1))) * 1023).cast("int")
    bucket = rest * 32 + F.shiftright(draw, 55).cast("int")
    raised = upto_cut(order, global_cut(shares, order, bucket, lambda _: missing))
    return shares.select(label, (F.col("n") - F.col("_floor") - raised.cast("int")).alias("want"))


def _held_by_label(
    df: DataFrame, label: str, key: str, ratio: float, seed, sizes: DataFrame, total: int, labels: int
) -> DataFrame:
    """``df`` with boolean ``_held``: seeded rows up to each label's quota."""
    order, bucket = _order(seed, key)
    order[0] = order[0].alias("draw")
    cuts = group_cuts(df.where(F.col(label).isNotNull()), order, bucket, _quotas(sizes, total, label, ratio, seed), [label])
    # one row per label: broadcast while there are few labels, else a join that deals hot labels
    if labels <= BROADCAST_LABELS:
        joined = df.join(F.broadcast(cuts), label, "left")
    else:
        joined = lookup_join(df, cuts, [label], spread=[key], how="left", counts=sizes)
    draw, at = draw_key(seed, key), F.col("cut")
    held = (draw < at["draw"]) | ((draw == at["draw"]) & (F.col(key) <= at[key]))
    return joined.withColumn("_held", F.coalesce(held, F.lit(False))).drop("cut")


def _held_at_random(df: DataFrame, key: str, ratio: float, seed) -> DataFrame:
    order, bucket = _order(seed, key)
    cut = global_cut(df, order, bucket, lambda total: math.ceil(total * ratio))
    return df.withColumn("_held", upto_cut(order, cut))


def split_stratified(df: DataFrame, label: str, key: str, ratio: float, seed) -> DataFrame:
    """SPL-2: the label ratio is kept; one label alone is a plain random split."""
    sizes, total, labels, _ = _label_sizes(df, label)
    held = _held_by_label(df, label, key, ratio, seed, sizes, total, labels)
    return held.withColumn("split", F.when(F.col("_held"), "validation").otherwise("train")).drop("_held")


def _stratified_or_random(df: DataFrame, label: str, key: str, ratio: float, seed, allowed: bool) -> tuple[DataFrame, bool]:
    """Stratify when there are several labels of two rows or more, and no more labels than rows on a side."""
    sizes, total, labels, rarest = _label_sizes(df, label)
    wanted = allowed and labels > 1 and rarest >= 2
    held = math.ceil(total * ratio)
    if wanted and min(held, total - held) >= labels:
        return _held_by_label(df, label, key, ratio, seed, sizes, total, labels), wanted
    return _held_at_random(df, key, ratio, seed), wanted


def split_stratified_3way(
    df: DataFrame, key: str, val_ratio: float, test_ratio: float, seed, label: str = "problem_id"
) -> DataFrame:
    """SPL-3: two stratified cuts, each falling back to a random one when it has to.

    The held-out keys are stored between the cuts; they are a share of the key columns.
    """
    held_ratio = val_ratio + test_ratio
    keys = df.select(key, label)
    first, wanted = _stratified_or_random(keys, label, key, held_ratio, f"{seed}:first", True)
    rest = durable(first.where("_held").drop("_held"))
    second, _ = _stratified_or_random(rest, label, key, test_ratio / held_ratio, f"{seed}:second", wanted)
    named = second.select(key, F.when(F.col("_held"), "test").otherwise("validation").alias("split"))
    return df.join(named, key, "left").withColumn("split", F.coalesce("split", F.lit("train")))


def disjoint_counts(total: int, val_ratio: float, test_ratio: float) -> tuple[int, int]:
    """Floors, at least one problem per wanted split, and test gives way so that train keeps one."""
    val, test = (max(1, int(total * r)) if r > 0 else 0 for r in (val_ratio, test_ratio))
    return val, (max(0, total - val - 1) if val + test >= total else test)


def split_disjoint(
    df: DataFrame, val_ratio: float, test_ratio: float, seed, problem: str = "problem_id", minimum: bool = True
) -> DataFrame:
    """SPL-4: whole problems go to one split, in the order of their draws.

    Without ``minimum`` the cuts are plain floors, train first. The split is a function
    of the problem id alone, so labelling the rows needs no join.
    """
    problems = durable(df.select(problem).distinct())
    order, bucket = _order(seed, problem)
    if minimum:
        names = ("validation", "test", "train")
        wants = (
            lambda total: disjoint_counts(total, val_ratio, test_ratio)[0],
            lambda total: sum(disjoint_counts(total, val_ratio, test_ratio)))
    else:
        names = ("train", "validation", "test")
        train, train_val = round(1 - val_ratio - test_ratio, 12), round(1 - test_ratio, 12)
        wants = (lambda total: int(train * total), lambda total: int(train_val * total))
    first, second = (upto_cut(order, global_cut(problems, order, bucket, want)) for want in wants)
    return df.withColumn("split", F.when(first, names[0]).when(second, names[1]).otherwise(names[2]))


def split_overlap(df: DataFrame, problem: str = "problem_id") -> DataFrame:
    """SET-2: problems found in more than one split; must be empty."""
    return (
        df.groupBy(problem).agg(F.min("split").alias("_a"), F.max("split").alias("_b"))
        .where("_a <> _b").select(problem)
    )
