"""Labelled code pairs, drawn without listing the pairs of a problem.

The n(n-1)/2 pairs of a problem are numbered on a circle: number p means distance
``p div n + 1`` from position ``p mod n``. A cap of m cuts the numbers into m equal
stretches and draws one from each, so exactly min(m, n(n-1)/2) distinct pairs come
out of m small rows, whatever n is. Only ids are shuffled; texts join at the end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codelake.functions.keys import draw_bucket, draw_key
from codelake.operators.ranking import first_n_per_group, position, range_bucket, take_first
from codelake.session import durable

PAIR_COUNT = (
    "cast(if(n % 2 = 0, n div 2, n) as decimal(19,0)) * cast(if(n % 2 = 0, n - 1, (n - 1) div 2) as decimal(19,0))"
)


def _positions(df: DataFrame, by: list[str], key: str, seed) -> DataFrame:
    draw = draw_key(seed, key)
    return position(df, "pos", [draw, F.col(key)], draw_bucket(draw), tuple(by))


def _slots(groups: DataFrame, by: list[str], cap: int, seed) -> DataFrame:
    """For each group with ``total`` numbers, min(cap, total) distinct ones as ``number``."""
    slots = groups.withColumn("_m", F.least(F.col("total"), F.lit(cap)).cast("long")).where("_m > 0")
    slots = slots.withColumn("slot", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_m") - 1)))
    draw = draw_key(seed, *[F.col(c).cast("string") for c in by], F.col("slot"))

    def edge(slot):
        return f"(({slot}) * (total div _m) + (({slot}) * cast(total % _m as bigint)) div _m)"

    return (
        slots.withColumn("_low", F.expr(f"cast({edge('cast(slot as decimal(10,0))')} as decimal(38,0))"))
        .withColumn("_high", F.expr(f"cast({edge('cast(slot + 1 as decimal(10,0))')} as decimal(38,0))"))
        .withColumn("_draw", draw)
        .withColumn("number", F.expr("cast(_low + _draw % (_high - _low) as decimal(38,0))"))
        .drop("_m", "_low", "_high", "_draw")
    )


def _pick(chosen: DataFrame, positions: DataFrame, by: list[str], key: str, at: str, to: str) -> DataFrame:
    named = positions.select(*by, F.col("pos").alias(at), F.col(key).alias(to))
    return chosen.join(named, [*by, at])


def positive_pairs(df: DataFrame, key: str, cap: int = 250, seed=42, by: str = "problem_id") -> DataFrame:
    """JOIN-1: up to ``cap`` seeded pairs per problem, as (by, id1, id2) with id1 < id2."""
    rows = df.select(by, key)
    groups = rows.groupBy(by).agg(F.count(F.lit(1)).alias("n")).withColumn("total", F.expr(PAIR_COUNT))
    chosen = _slots(groups, [by], cap, seed).selectExpr(
        by, "cast(number % n as bigint) AS _i", "cast((number % n + number div n + 1) % n as bigint) AS _j")
    positions = _positions(rows, [by], key, seed)
    picked = _pick(_pick(chosen, positions, [by], key, "_i", "_a"), positions, [by], key, "_j", "_b")
    return picked.select(by, F.least("_a", "_b").alias("id1"), F.greatest("_a", "_b").alias("id2"))


def crossed_pairs(left: DataFrame, right: DataFrame, key: str, cap: int, seed, by: str = "problem_id") -> DataFrame:
    """Up to ``cap`` seeded (left, right) pairs per group, as (by, id1, id2)."""
    n_left = left.groupBy(by).agg(F.count(F.lit(1)).alias("n_left"))
    n_right = right.groupBy(by).agg(F.count(F.lit(1)).alias("n_right"))
    groups = n_left.join(n_right, by).withColumn(
        "total", F.expr("cast(n_left as decimal(19,0)) * cast(n_right as decimal(19,0))"))
    chosen = _slots(groups, [by], cap, seed).selectExpr(
        by, "cast(number div n_right as bigint) AS _i", "cast(number % n_right as bigint) AS _j")
    picked = _pick(chosen, _positions(left.select(by, key), [by], key, seed), [by], key, "_i", "id1")
    return _pick(picked, _positions(right.select(by, key), [by], key, seed), [by], key, "_j", "id2").select(by, "id1", "id2")


def negatives_needed(df: DataFrame, cap: int, ratio: float) -> dict:
    """Counts that size the negative draw: one pass over problem sizes."""
    sizes = df.groupBy("problem_id").agg(F.count(F.lit(1)).alias("n"))
    row = sizes.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
        F.sum(F.col("n").cast("double") * F.col("n")).alias("squares"),
        F.count(F.lit(1)).alias("problems"),
        F.coalesce(F.sum(F.expr(f"least({PAIR_COUNT}, {cap})")), F.lit(0)).cast("long").alias("positives"),
    ).first()
    # below two problems no draw can ever be a negative
    need = int(row.positives * ratio) if row.problems > 1 else 0
    return {"total": row.total, "need": need, "accept": 1 - row.squares / row.total**2 if need else 0.0}


def negative_pairs(df: DataFrame, key: str, cap: int = 250, ratio: float = 1.0, seed=42) -> DataFrame:
    """JOIN-2: int(positives x ratio) cross-problem pairs drawn with replacement.

    Draw number s picks two rows by position; the first ``need`` draws that land in
    two problems are the result. More draws are made until there are enough.
    """
    sizing = negatives_needed(df, cap, ratio)
    need, total = sizing["need"], sizing["total"]
    spark = df.sparkSession
    if need == 0:
        draws, accepted, tries = spark.range(0), None, 1
    else:
        expected = need / sizing["accept"]
        tries = int(expected * 1.05 + 40 * expected**0.5 + 64)
    positions = _positions(df.select("problem_id", key), [], key, f"{seed}:position")
    positions = positions.select("pos", key, "problem_id")

    def drawn(upto):
        slots = spark.range(upto).select(
            F.col("id").alias("slot"),
            F.pmod(draw_key(f"{seed}:a", "id"), F.lit(max(total, 1))).alias("_i"),
            F.pmod(draw_key(f"{seed}:b", "id"), F.lit(max(total, 1))).alias("_j"))
        first = positions.toDF("_i", "id1", "problem1")
        second = positions.toDF("_j", "id2", "problem2")
        return slots.join(first, "_i").join(second, "_j").where("problem1 <> problem2").select(
            "slot", "problem1", "problem2", "id1", "id2")

    if need == 0:
        return drawn(0)
    accepted = durable(drawn(tries))
    while accepted.count() < need:
        tries *= 2
        accepted = durable(drawn(tries))
    bucket = range_bucket(F.col("slot"), F.lit(0), F.lit(tries))
    return take_first(accepted, [F.col("slot")], bucket, lambda size: need)


def attach_code(pairs: DataFrame, df: DataFrame, key: str, text: str, source: str | None = None) -> DataFrame:
    """Texts (and sources) of both sides, with the pair's other columns."""
    for side in ("1", "2"):
        columns = [F.col(key).alias(f"id{side}"), F.col(text).alias(f"code{side}")]
        if source:
            columns.append(F.col(source).alias(f"source{side}"))
        pairs = pairs.join(df.select(*columns), f"id{side}")
    return pairs


def build_pairs(df: DataFrame, key: str, cap: int = 250, ratio: float = 1.0, seed=42) -> DataFrame:
    """JOIN-1 and JOIN-2 together: (id1, id2, similar)."""
    positives = positive_pairs(df, key, cap, seed).select("id1", "id2", F.lit(1).alias("similar"))
    negatives = negative_pairs(df, key, cap, ratio, seed).select("id1", "id2", F.lit(0).alias("similar"))
    return positives.unionByName(negatives)


def mine_pairs(df: DataFrame, key: str, cap: int = 250, seed=42, hash_col: str = "structure_sha256",
               per_problem: int | None = 1) -> DataFrame:
    """JOIN-9: positive, hard_negative and semi_hard_negative tiers, each capped per group.

    Semi-hard pairs join different problems that share a structure. Each problem is represented by its first
    ``per_problem`` rows with that structure, all of them for None; draws that meet one problem twice are left out.
    """
    accepted, wrong = df.where("status = 'Accepted'"), df.where("status = 'Wrong Answer'")
    positive = positive_pairs(accepted, key, cap, f"{seed}:p").select("id1", "id2", F.lit("positive").alias("pair_type"))
    hard = crossed_pairs(accepted, wrong, key, cap, f"{seed}:h").select(
        "id1", "id2", F.lit("hard_negative").alias("pair_type"))
    # a small id table that is read several times below, made from costly hashes
    shaped = df.where(F.col(hash_col).isNotNull()).select(hash_col, "problem_id", key)
    if per_problem is not None:
        shaped = first_n_per_group(shaped, [hash_col, "problem_id"], [F.col(key)], per_problem)
    representatives = durable(shaped)
    semi = positive_pairs(representatives, key, cap, f"{seed}:s", by=hash_col).select("id1", "id2")
    if per_problem != 1:
        of = representatives.select(key, "problem_id")
        semi = semi.join(of.toDF("id1", "_p1"), "id1").join(of.toDF("id2", "_p2"), "id2").where("_p1 <> _p2").select("id1", "id2")
    semi = semi.withColumn("pair_type", F.lit("semi_hard_negative"))
    return positive.unionByName(hard).unionByName(semi)

