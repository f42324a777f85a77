"""Whole runs on small files."""

from codelake.plans import corpus, pairs
from codelake.sources import corpus as S


def write_tree(root, problems=4, files=6):
    for p in range(problems):
        (root / f"p{p}").mkdir()
        for f in range(files):
            body = f"def f{f}(a):  # {f}\n    return a * {p} + {f % 3}\n" if f else "def broken(:\n"
            (root / f"p{p}" / f"{f}.py").write_text(body)


def test_pairs_from_tree_and_submission(spark, tmp_path):
    root = tmp_path / "tree"
    root.mkdir()
    write_tree(root)
    table = S.read_or_build(spark, str(tmp_path / "pairs"), lambda: pairs.pairs_from_tree(spark, str(root), cap=10))
    assert {(r.similar, r["count"]) for r in table.groupBy("similar").count().collect()} == {(1, 40), (0, 40)}
    rows = table.collect()
    folder = {r.source1: r.source1.split("/")[-2] for r in rows} | {r.source2: r.source2.split("/")[-2] for r in rows}
    assert all((folder[r.source1] == folder[r.source2]) == bool(r.similar) for r in rows)
    assert not any("#" in r.code1_processed for r in rows)
    keyed = table.selectExpr(
        "concat(source1, source2, similar) AS pair_id", "code1_processed AS code1", "code2_processed AS code2", "similar")
    judged = pairs.train_and_judge(keyed, "pair_id", 0.2)
    assert judged.metrics.first().tp + judged.metrics.first().fn > 0
    path, shares = pairs.predict_and_submit(judged.model, keyed.drop("similar"), str(tmp_path / "out"), "base")
    assert spark.read.csv(path, header=True).count() == keyed.count()
    assert abs(sum(r.pct for r in shares.collect()) - 100) < 1e-9


def test_processed_pairs(spark):
    rows = spark.createDataFrame([("x=1 # a", "def f(:\t#", 1)], "code1 string, code2 string, similar int")
    out = pairs.processed_pairs(rows).first()
    assert (out.code1_processed, out.code2_processed, out.source1) == ("x = 1", "def f(:", "train_csv")


def test_prepare_corpus(spark):
    texts = ["x = 1", "y = 1", "# only", "def f(:", '"""doc"""', None, "x = 2"]
    rows = spark.createDataFrame(
        [(i, "p1", t) for i, t in enumerate(texts)], "submission_id long, problem_id string, text string")
    run = corpus.prepare_corpus(rows)
    assert {r.submission_id: r.processed_code for r in run.final.collect()} == {0: "x = 1", 6: "x = 2"}
    stages = {r.stage: (r.total, r.passed) for r in run.stages().collect()}
    assert stages == {"parse": (7, 5), "preprocess": (5, 5), "dedup": (5, 3)}
    report = run.report(rows.select("problem_id").distinct())
    assert {r.value for r in report.where("metric = 'total_samples'").collect()} == {2.0}
    assert {r.word for r in run.words().collect()} == {"x", "=", "1", "2"}


def test_pair_auc(spark, small):
    from codelake.catalog import vocabularies
    from codelake.session import durable

    scored = durable(vocabularies.language_pairs(spark, small).select("label", "score"))
    rows = [(r.label, r.score) for r in scored.collect()]
    good, bad = [s for x, s in rows if x == 1], [s for x, s in rows if x == 0]
    wins = sum((g > b) + (g == b) / 2 for g in good for b in bad) / (len(good) * len(bad))
    from codelake.operators.evaluate import roc_auc

    assert abs(roc_auc(scored, "label", "score").first()[0] - wins) < 1e-9
    assert wins > 0.7
