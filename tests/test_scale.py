"""Hot groups, partition invariance and exact counts."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from codelake.functions import arrays as A
from codelake.functions.keys import draw_bucket, draw_key
from codelake.operators import dedup, encode, evaluate, graph, pairs, ranking, skew, splits, stats


def hot_rows(spark, n=900):
    """A third of the rows in one problem, the rest in problems of 1 to 9 rows."""
    rows = [(i, "hot") for i in range(n // 3)]
    rows += [(i, f"p{int((i * 7919) % 97)}") for i in range(n // 3, n)]
    return spark.createDataFrame(rows, "id long, problem_id string")


@pytest.mark.parametrize("cap", [1, 7, 250, 100000])
def test_positive_pairs_are_whole(spark, cap):
    rows = hot_rows(spark)
    sizes = Counter(r.problem_id for r in rows.collect())
    if cap > 1000:
        rows = rows.where("id < 400")
        sizes = Counter(r.problem_id for r in rows.collect())
    found = pairs.positive_pairs(rows, "id", cap).collect()
    problem = {r.id: r.problem_id for r in rows.collect()}
    assert len({(r.id1, r.id2) for r in found}) == len(found)
    assert all(r.id1 < r.id2 and problem[r.id1] == problem[r.id2] == r.problem_id for r in found)
    assert Counter(r.problem_id for r in found) == {
        p: min(cap, n * (n - 1) // 2) for p, n in sizes.items() if n > 1}


def test_circle_numbers_every_pair_once():
    for n in range(2, 12):
        seen = {frozenset((p % n, (p % n + p // n + 1) % n)) for p in range(n * (n - 1) // 2)}
        assert len(seen) == n * (n - 1) // 2 and all(len(s) == 2 for s in seen)


def test_negatives(spark):
    rows = hot_rows(spark)
    problem = {r.id: r.problem_id for r in rows.collect()}
    found = pairs.negative_pairs(rows, "id", 20, 1.5).collect()
    assert len(found) == int(pairs.positive_pairs(rows, "id", 20).count() * 1.5)
    assert all(problem[r.id1] != problem[r.id2] for r in found)
    assert pairs.negative_pairs(rows.where("problem_id = 'hot'"), "id", 20).count() == 0


def test_pairs_do_not_depend_on_partitions(spark):
    rows = hot_rows(spark)
    results = [
        {tuple(r) for r in pairs.positive_pairs(rows.repartition(n), "id", 30).collect()} for n in (1, 4, 32)]
    assert results[0] == results[1] == results[2]


def test_position_is_the_sorted_order(spark):
    rows = hot_rows(spark)
    draw = draw_key(1, "id")
    found = ranking.position(rows, "pos", [draw, F.col("id")], draw_bucket(draw), ("problem_id",)).collect()
    by_problem = {}
    keys = {r.id: r.k for r in rows.select("id", draw.alias("k")).collect()}
    for r in found:
        by_problem.setdefault(r.problem_id, []).append((r.pos, r.id))
    for members in by_problem.values():
        members.sort()
        assert [p for p, _ in members] == list(range(len(members)))
        assert [i for _, i in members] == sorted((i for _, i in members), key=lambda i: (keys[i], i))


def test_hot_lookup(spark):
    rows = hot_rows(spark).withColumn("k", F.when(F.col("problem_id") == "hot", "hot").otherwise(F.col("id").cast("string")))
    table = spark.createDataFrame([("hot", 1), ("700", 2), ("none", 3)], "k string, v int")
    found = skew.lookup_join(rows, table, ["k"], ["id"], how="left").collect()
    assert len(found) == 900
    assert Counter(r.v for r in found) == {1: 300, 2: 1, None: 599}
    assert skew.lookup_join(rows, table, ["k"], ["id"]).count() == 301


def test_first_n_beyond_the_window_limit(spark):
    rows = spark.range(9000).select("id", (F.col("id") % 2).alias("g"))
    kept = ranking.first_n_per_group(rows, ["g"], [F.col("id")], 2000).collect()
    assert sorted(r.id for r in kept) == list(range(4000))


def test_group_limit_runs_before_the_shuffle(spark):
    rows = hot_rows(spark)
    plan = dedup.dedup_exact(rows, "problem_id", "id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


@pytest.mark.parametrize("total, wanted", [(1, (1, 0)), (2, (1, 0)), (3, (1, 1)), (10, (1, 1)), (40, (4, 4))])
def test_disjoint_counts(total, wanted):
    assert splits.disjoint_counts(total, 0.1, 0.1) == wanted


def test_disjoint_split_has_no_overlap(spark):
    out = splits.split_disjoint(hot_rows(spark), 0.1, 0.1, 7)
    assert splits.split_overlap(out).count() == 0
    assert out.count() == 900


def test_stratified_single_label(spark):
    rows = spark.range(95).select("id", F.lit(1).alias("label"))
    out = splits.split_stratified(rows, "label", "id", 0.1, 3)
    assert out.where("split = 'validation'").count() == 10


def test_metrics_edge_cases(spark):
    one_class = spark.createDataFrame([(1, 0.5), (1, 0.7)], "y int, score double")
    assert evaluate.roc_auc(one_class, "y", "score").first().auc != evaluate.roc_auc(one_class, "y", "score").first().auc
    equal = spark.createDataFrame([(1, 0.99), (0, 0.99), (1, 0.99)], "y int, score double")
    assert evaluate.best_threshold(equal, "y", "score").first().threshold == 0.05
    none = spark.createDataFrame([(0, 0)], "y int, p int")
    assert evaluate.classification_metrics(none, "y", "p").first().f1 == 0.0


def test_pair_budget_matches_library(spark):
    from tokenizers import Tokenizer, models, pre_tokenizers

    tool = Tokenizer(models.WordLevel({"x": 0, "y": 1}, unk_token="x"))
    tool.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
    cases = [(i, a, b, m) for i, (a, b, m) in enumerate((a, b, m) for a in range(0, 9) for b in range(0, 9) for m in (3, 4, 7))]
    wanted = {}
    for i, a, b, m in cases:
        tool.enable_truncation(m)
        ids = tool.encode("x " * a, "y " * b).ids
        wanted[i] = (ids.count(0), ids.count(1))
    for m in (3, 4, 7):
        rows = spark.createDataFrame([c for c in cases if c[3] == m], "i int, a int, b int, m int")
        ka, kb = A.pair_budget(F.col("a"), F.col("b"), m)
        for r in rows.select("i", ka.alias("ka"), kb.alias("kb")).collect():
            assert (r.ka, r.kb) == wanted[r.i]


def test_blocks_equal_a_plain_loop(spark):
    rows = [(i, i // 10, list(range(i * 100, i * 100 + (i * 37) % 23))) for i in range(40)]
    packed = encode.pack_blocks(spark.createDataFrame(rows, "id int, shard int, ids array<int>"), "shard", "id", "ids", 8)
    wanted = set()
    for shard in range(4):
        stream = [x for _, s, ids in rows if s == shard for x in ids]
        wanted |= {(shard, n, tuple(stream[n * 8: n * 8 + 8])) for n in range(len(stream) // 8)}
    assert {(r.shard, r.block, tuple(r.input_ids)) for r in packed.collect()} == wanted


def test_token_check(spark):
    rows = spark.createDataFrame([(1, [0, 5]), (2, [7, -1])], "id int, ids array<int>")
    assert stats.check_token_range(rows.where("id = 1"), "id", "ids", 8).count() == 1
    with pytest.raises(ValueError, match=r"\(2, 1, -1\)"):
        stats.check_token_range(rows, "id", "ids", 8)


def test_no_group_reaches_one_task_in_auc(spark):
    rows = spark.range(3000).select((F.col("id") % 3 == 0).cast("int").alias("y"), (F.col("id") * 7 % 1000 / 1000).alias("s"))
    points = rows.toPandas()
    pos, neg = points[points.y == 1].s, points[points.y == 0].s
    wanted = sum((p > neg).sum() + (p == neg).sum() / 2 for p in pos) / (len(pos) * len(neg))
    assert abs(evaluate.roc_auc(rows, "y", "s").first().auc - wanted) < 1e-9


def test_many_labels_take_the_salted_join(spark, monkeypatch):
    rows = hot_rows(spark)
    few = splits.split_stratified(rows, "problem_id", "id", 0.2, 5)
    monkeypatch.setattr(splits, "BROADCAST_LABELS", 0)
    many = splits.split_stratified(rows, "problem_id", "id", 0.2, 5)
    assert {tuple(sorted(r.asDict().items())) for r in few.collect()} == {
        tuple(sorted(r.asDict().items())) for r in many.collect()}
    assert few.where("split = 'validation'").count() == 180


def test_splits_do_not_depend_on_partitions(spark):
    rows = hot_rows(spark)
    results = [
        {(r.id, r.split) for r in splits.split_random(rows.repartition(n), "id", 0.1, 9).collect()} for n in (1, 4, 32)]
    assert results[0] == results[1] == results[2]
    assert sum(s == "validation" for _, s in results[0]) == 90


def test_propagation_by_matrices(spark):
    import numpy as np

    parents = {1: [-1, 0, 0, 1, 1, 3], 2: [-1], 3: [-1, 0]}
    kinds = {1: "abcaba", 2: "a", 3: "bb"}
    rows = [(d, i, kinds[d][i], p) for d, ps in parents.items() for i, p in enumerate(ps)]
    nodes = spark.createDataFrame(rows, "doc int, nid int, type string, parent int")
    found = {(r.doc, r.type): r.value for r in graph.propagate(nodes, graph.syntax_edges(nodes)).collect()}
    for doc, ps in parents.items():
        size = len(ps)
        joined = np.eye(size)
        for child, parent in enumerate(ps):
            if parent >= 0:
                joined[child, parent] = joined[parent, child] = 1
        scale = np.diag(joined.sum(axis=1) ** -0.5)
        names = sorted(set(kinds[doc]))
        x = np.array([[float(k == n) for n in names] for k in kinds[doc]])
        smooth = scale @ joined @ scale
        mean = (smooth @ smooth @ x).mean(axis=0)
        mean /= np.linalg.norm(mean)
        assert all(abs(found[doc, n] - v) < 1e-9 for n, v in zip(names, mean))


def test_graph_per_row_equals_tables(spark):
    code = spark.createDataFrame([(1, "def f(a):\n    return [a, a + 1]\n"), (2, "x = 1\n"), (3, "not code (")], "k int, text string")
    nodes, edges = graph.syntax_graph(code, "k")
    by_table = {(r.doc, r.type): r.value for r in graph.propagate(nodes, edges).collect()}
    by_row = {(r.doc, r.type): r.value for r in graph.propagate_rows(code, "k").collect()}
    assert by_table.keys() == by_row.keys() and all(abs(by_table[k] - by_row[k]) < 1e-9 for k in by_row)
    assert "Join" not in graph.propagate_rows(code, "k")._jdf.queryExecution().executedPlan().toString()


def test_large_bucket_is_cut_again(spark, monkeypatch):
    monkeypatch.setattr(ranking, "SORTED_ROWS", 50)
    rows = spark.range(5000).select((F.col("id") * F.col("id")).alias("v"))
    taken = ranking.take_first(rows, [F.col("v")], F.lit(0), lambda n: 1234)
    assert sorted(r.v for r in taken.collect()) == [i * i for i in range(1234)]
    same = spark.range(500).select(F.lit(7).cast("long").alias("v"), "id")
    assert ranking.take_first(same, [F.col("v"), F.col("id")], F.lit(0), lambda n: 99).count() == 99


def test_salts_follow_the_key(spark):
    rows = spark.range(10_000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), "id")
    found = {r.k: r._salts for r in skew.hot_keys(rows, ["k"], share=0.01).collect()}
    assert found == {"hot": 34}
    table = spark.createDataFrame([("hot", 1), ("5", 2)], "k string, v int")
    assert skew.lookup_join(rows, table, ["k"], ["id"], share=0.01).count() == 3334 + 1


def test_stored_tables_are_released(spark):
    from codelake.session import durable, release

    kept = durable(spark.range(5))
    assert kept.count() == 5 and release(spark) >= 1


def test_packing_spreads_a_hot_shard(spark):
    rows = [("hot" if i % 2 else f"s{i % 7}", f"https://example.org/a/long/start/{i:07d}", list(range(i % 13))) for i in range(4000)]
    df = spark.createDataFrame(rows, "shard string, at string, ids array<int>").repartition(5)
    wanted = {}
    for shard in {r[0] for r in rows}:
        flat = [x for s, _, ids in sorted(rows, key=lambda r: r[1]) if s == shard for x in ids]
        wanted |= {(shard, b): flat[b * 64:b * 64 + 64] for b in range(len(flat) // 64)}
    packed = {(r.shard, r.block): r.input_ids for r in encode.pack_blocks(df, "shard", "at", "ids", 64).collect()}
    assert packed == wanted
    ranges = ranking.with_quantile_bucket(df.where("shard = 'hot'"), "at", "range").groupBy("range").count()
    assert ranges.count() > 500 and ranges.agg(F.max("count")).first()[0] < 20


def test_string_buckets_keep_order(spark):
    keys = ["", "a", "aa", "ab", "é", "z", "\U0001F600", None, "x" * 500, "x" * 500 + "y"] * 3
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    found = ranking.with_quantile_bucket(df, "k", "at").orderBy("k").collect()
    assert [r.at for r in found] == sorted(r.at for r in found)


def test_dictionary_lookups_cross_once_per_group(spark):
    rows = [(i, ["the"] * 50 + [f"w{i % 40}", "missing"] if i else None) for i in range(500)]
    df = spark.createDataFrame(rows, "id long, words array<string>").repartition(4)
    pieces = spark.createDataFrame([("the", [7]), *((f"w{i}", [i, i + 1]) for i in range(40))], "word string, ids array<int>")
    out = {r.id: r.input_ids for r in encode.lookup_pieces(df, "id", F.col("words"), pieces, unknown=1, group_rows=100).collect()}
    assert out == {i: [7] * 50 + [i % 40, i % 40 + 1, 1] if i else [] for i in range(500)}
    # a group asks for a word once: at most groups x words rows leave the documents, not one row per use
    groups = df.select(F.pmod(F.xxhash64("id"), F.lit(5)).alias("g"), F.explode("words").alias("w"))
    assert groups.distinct().count() <= 5 * 42 < groups.count()
    vocab = spark.createDataFrame([(7, "the"), (1, "?")], "id int, piece string")
    ids = spark.createDataFrame([(1, [7, 1, 9]), (2, []), (3, None)], "id long, input_ids array<int>")
    back = encode.decode(ids, "id", "input_ids", vocab)
    assert {r.id: r.text for r in back.collect()} == {1: "the ? <unk>", 2: "", 3: ""}


def test_table_function_gives_the_same_graph(spark):
    code = spark.createDataFrame([(1, "x = 1\n"), (2, "def (:"), (3, None), (4, "class A:\n    pass\n")], "id long, text string")
    found = sorted(map(tuple, graph.syntax_rows(code, "id").collect()))
    assert [r for r in found if r[0] != 3] == sorted(map(tuple, graph.syntax_nodes(code.where("id <> 3"), "id").collect()))
    assert [r for r in found if r[0] in (2, 3)] == [(2, 0, "<unk>", -1), (3, 0, "<unk>", -1)]


def test_tiles_of_a_large_batch(spark):
    import numpy as np

    draw = np.random.default_rng(3)
    sizes = {0: 700, 1: 3, 2: 64}
    sides = {b: (draw.integers(-4, 5, (n, 6)).astype(float), draw.integers(-4, 5, (n, 6)).astype(float)) for b, n in sizes.items()}
    rows = [(b, i, x[i].tolist(), y[i].tolist()) for b, (x, y) in sides.items() for i in range(len(x))]
    df = spark.createDataFrame(rows, "batch long, row int, a array<double>, b array<double>").repartition(6)
    found = evaluate.similarity_matrix(df, "a", "b", tile=64).toPandas()
    assert len(found) == sum(n * n for n in sizes.values())
    for b, (x, y) in sides.items():
        part = found[found.batch == b].sort_values(["row", "col"])
        assert np.array_equal(part.score.to_numpy().reshape(len(x), len(x)), x @ y.T)


def test_quotas_of_many_equal_labels(spark):
    rows = spark.range(8000).selectExpr("id", "id div 4 as label")
    split = splits.split_stratified(rows, "label", "id", 0.1, 7)
    held = split.where("split = 'validation'").groupBy("label").count().agg(F.max("count"), F.sum("count")).first()
    assert tuple(held) == (1, 800)
    buckets = rows.select(F.shiftright(draw_key(7, "label"), 55).alias("b")).groupBy("b").count()
    assert buckets.count() == 32 and buckets.agg(F.max("count")).first()[0] < 600


def test_ids_are_made_once_for_batches_and_blocks(spark):
    made = spark.sparkContext.accumulator(0)

    @F.udf("array<int>")
    def ids(n):
        made.add(1)
        return list(range(n % 37))

    rows = spark.range(300).repartition(3).select("id", (F.col("id") % 2).alias("shard"), ids("id").alias("ids"))
    out = encode.bucket_by_length(rows, "id", "ids", 11, 16).select("id", "bucket", "padded_length").collect()
    assert len(out) == 300 and all(r.bucket == -(-(r.id % 37) // 8) * 8 == r.padded_length for r in out)
    assert made.value == 300
    made.value = 0
    blocks = encode.pack_blocks(rows, "shard", "id", "ids", 64).collect()
    for shard in (0, 1):
        flat = [x for i in range(shard, 300, 2) for x in range(i % 37)]
        assert {r.block: r.input_ids for r in blocks if r.shard == shard} == {b: flat[64 * b:64 * b + 64] for b in range(len(flat) // 64)}
    assert made.value == 300
