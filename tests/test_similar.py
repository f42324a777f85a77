import random

from pyspark.sql import functions as F

from codelake.functions import code
from codelake.operators import similar
from codelake.sources.generated import generated_shapes


def brute(grams, least):
    names = sorted(grams)
    return {(a, b) for i, a in enumerate(names) for b in names[i + 1:] if len(grams[a] & grams[b]) >= least * len(grams[a] | grams[b])}


def test_recall_of_bands(spark):
    draw = random.Random(5)
    base = [draw.getrandbits(60) for _ in range(400)]
    rows = []
    for i in range(300):
        own = set(base[(i % 10) * 40:(i % 10) * 40 + 40])
        for g in draw.sample(sorted(own), draw.randrange(12)):
            own.discard(g)
            own.add(draw.getrandbits(60))
        rows.append((f"s{i:03d}", sorted(own), 1))
    shapes = spark.createDataFrame(rows, "structure string, grams array<long>, members long").repartition(3)
    wanted = brute({s: set(g) for s, g, _ in rows}, 0.8)
    found = [(r.structure1, r.structure2) for r in similar.similar_structures(shapes).collect()]
    assert len(found) == len(set(found)) and set(found) <= wanted and len(wanted) > 200
    assert len(found) >= 0.99 * len(wanted)
    # coarse bands find fewer, but at least nine in ten
    few = {(r.structure1, r.structure2) for r in similar.similar_structures(shapes, bands=12, hashes=4).collect()}
    assert 0.9 * len(wanted) <= len(few) and few <= wanted
    # a cap bounds what a bucket draws
    assert similar.similar_structures(shapes, cap=1, bands=1).count() <= similar.band_buckets(shapes, bands=1).select("bucket").distinct().count()


def test_members_and_pairs(spark, small):
    code = generated_shapes(spark, small)
    shapes, members = similar.structures(code, "submission_id")
    parsed = code.where("submission_id % 50 <> 0").count()
    assert members.count() == parsed == shapes.agg(F.sum("members")).first()[0] > 1000
    alike = similar.similar_structures(shapes)
    pairs = similar.similar_pairs(alike, members, "submission_id", per_pair=3)
    side = members.select("submission_id", "problem_id", "structure")
    named = pairs.join(side.toDF("id1", "p1", "s1"), "id1").join(side.toDF("id2", "p2", "s2"), "id2")
    assert named.where("p1 = p2 OR s1 = s2").isEmpty() and named.count() == pairs.count() > alike.count()
    allowed = alike.select(F.col("structure1").alias("s1"), F.col("structure2").alias("s2"))
    assert named.join(allowed, ["s1", "s2"], "left_anti").isEmpty()


def test_nothing(spark):
    empty = spark.createDataFrame([(1, "p", "def (:")], "id long, problem_id string, text string")
    shapes, members = similar.structures(empty, "id")
    assert similar.similar_structures(shapes).count() == 0 and members.count() == 0


def test_shapes_once(spark, small):
    """The graph of every program, however its names and numbers read, stored about once for each task and shape."""
    odd = ["x1 = 1.e5", "0b12", "a = 0b10", "a1 = 12 if b2 else 3", "f(a1=1, a2=2)", "def f(a1, a2):\n    return '12 a1'", "'\\N{VARIATION SELECTOR-17}'",
           "é1 = 2", "a² = 1", "a²1 = 1", "match x1:\n    case {1: a1, 2: a2}: pass", "f'{x1:>{w2}.3}'", "1if a else 2", "007", "x = 1_000", "1.e5j", "v1'a'", ""]
    assert all(code._facts_of(code.alike(t), ("parse_ok", "graph"))["graph"] == code._facts_of(t, ("graph",))["graph"] for t in odd)
    programs = generated_shapes(spark, small).select("text").repartition(4)
    found = programs.select("text", code.code_shapes(F.col("text")).alias("f"), code.code_facts(F.col("text"), "graph").alias("g")).cache()
    graphs = found.where("f.graph IS NOT NULL").select("f.shape", F.col("f.graph").alias("graph")).distinct()
    assert graphs.count() == graphs.select("shape").distinct().count()
    assert found.join(graphs, F.col("f.shape") == F.col("shape")).where("graph = g.graph").count() == found.count() == programs.count()
    assert found.where("f.graph IS NOT NULL").count() <= 4 * graphs.count() < found.count()
    spans = programs.select(code.code_shapes(F.lit(None).cast("string")).alias("f"))
    assert spans.where("f.shape IS NOT NULL OR f.parse_ok IS NOT NULL").isEmpty()
