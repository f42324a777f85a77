"""JOIN-9: programs of similar structure, found by banded MinHash over node-type n-grams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codelake.functions.code import code_shapes
from codelake.operators.pairs import _positions, _slots, positive_pairs
from codelake.operators.skew import lookup_join
from codelake.session import durable

#: 32 bands of 5 hashes: structures at similarity 0.8 miss each other in three cases of 10^6; at 0.4 a quarter meet in a band.
BANDS, HASHES, LEAST = 32, 5, 0.8


def type_grams(graph: Column) -> Column:
    """The distinct (type, parent's type, grandparent's type) of a syntax graph's nodes, as hashes in ascending order."""
    types, parents = graph["types"], graph["parents"]

    def gram(at):
        parent = F.get(parents, at)
        return F.xxhash64(F.get(types, at), F.get(types, parent), F.get(types, F.get(parents, parent)))

    at = F.sequence(F.lit(0), F.greatest(F.size(types), F.lit(1)) - 1)
    return F.array_sort(F.array_distinct(F.transform(at, gram)))


def structures(df: DataFrame, key: str, text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(structure, grams, members) per distinct set of n-grams, and (structure, problem_id, key) for every program that parses.

    Programs of one structure share its row from here on; the second table keeps who they are. Graphs are stored and their n-grams
    made once for all programs that share one, but for a repeat per task that reads them.
    """
    facts = df.select(key, "problem_id", code_shapes(F.col(text)).alias("facts")).where("facts.parse_ok")
    rows = durable(facts.select(key, "problem_id", "facts.shape", "facts.graph"))
    graphs = durable(rows.where("graph IS NOT NULL").groupBy("shape").agg(F.first("graph").alias("graph")))
    grams = durable(graphs.select("shape", type_grams(F.col("graph")).alias("grams")))
    name = F.sha2(F.array_join(F.transform("grams", lambda g: g.cast("string")), ","), 256)
    named = durable(grams.withColumn("structure", name))
    counts = durable(rows.groupBy("shape").agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("first")))
    shapes = named.join(counts, "shape").groupBy("structure").agg(
        F.first("grams").alias("grams"), F.sum("n").alias("members"), F.min("first").alias("first"))
    members = lookup_join(rows.select("shape", "problem_id", key), named.select("shape", "structure"), ["shape"], [key], counts=counts.select("shape", "n"))
    return durable(shapes), members.select("structure", "problem_id", key)


def band_buckets(shapes: DataFrame, bands: int = BANDS, hashes: int = HASHES) -> DataFrame:
    """(bucket, structure): a row per band; structures that agree in all hashes of a band share its bucket."""
    least = F.transform(F.sequence(F.lit(0), F.lit(bands * hashes - 1)), lambda n: F.array_min(
        F.transform("grams", lambda g: F.xxhash64(g, n))))
    signed = shapes.select("structure", least.alias("least"))
    bucket = F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), lambda b: F.xxhash64(b, F.slice("least", b * hashes + 1, F.lit(hashes))))
    return signed.select("structure", F.explode(bucket).alias("bucket"))


def similar_structures(shapes: DataFrame, least: float = LEAST, cap: int = 100_000, seed=42, bands: int = BANDS, hashes: int = HASHES) -> DataFrame:
    """(structure1, structure2, shared, total) with shared / total >= ``least``; structure1 < structure2.

    A bucket gives all of its pairs, or ``cap`` seeded ones if it has more: pairs are numbered and drawn, not listed. Each pair
    drawn is compared in full, once.
    """
    buckets = durable(band_buckets(shapes, bands, hashes).distinct())
    drawn = positive_pairs(buckets, "structure", cap, seed, by="bucket").select("id1", "id2").distinct()
    sides = [shapes.select(F.col("structure").alias(f"id{n}"), F.col("grams").alias(f"grams{n}")) for n in (1, 2)]
    met = lookup_join(lookup_join(durable(drawn), sides[0], ["id1"], ["id2"]), sides[1], ["id2"], ["id1"])
    shared = F.size(F.array_intersect("grams1", "grams2"))
    compared = met.select(F.col("id1").alias("structure1"), F.col("id2").alias("structure2"), shared.alias("shared"),
                          (F.size("grams1") + F.size("grams2") - shared).alias("total"))
    return compared.where(F.col("shared") >= F.col("total") * F.lit(least))


def similar_pairs(alike: DataFrame, members: DataFrame, key: str, per_pair: int = 4, seed=42) -> DataFrame:
    """(id1, id2, pair_type): for each pair of similar structures up to ``per_pair`` seeded pairs of their programs.

    Programs are drawn by their position within their structure, so any of them can come out, however many share it;
    draws that meet one problem twice are left out.
    """
    sizes = members.groupBy("structure").agg(F.count(F.lit(1)).alias("n"))
    groups = alike.select("structure1", "structure2")
    for side in ("1", "2"):
        groups = groups.join(sizes.toDF(f"structure{side}", f"n{side}"), f"structure{side}")
    groups = groups.withColumn("total", F.expr("cast(n1 as decimal(19,0)) * cast(n2 as decimal(19,0))"))
    chosen = _slots(groups, ["structure1", "structure2"], per_pair, seed).selectExpr(
        "structure1", "structure2", "cast(number div n2 as bigint) AS i1", "cast(number % n2 as bigint) AS i2")
    placed = durable(_positions(members, ["structure"], key, seed).select("structure", "pos", key, "problem_id"))
    for side in ("1", "2"):
        chosen = chosen.join(placed.toDF(f"structure{side}", f"i{side}", f"id{side}", f"problem{side}"), [f"structure{side}", f"i{side}"])
    return chosen.where("problem1 <> problem2").select("id1", "id2", F.lit("semi_hard_negative").alias("pair_type"))
