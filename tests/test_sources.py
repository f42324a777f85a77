"""Files in, files out."""

import pytest
from pyspark.sql import functions as F

from codelake.operators import select
from codelake.sources import corpus as S


def test_csv_cells_with_code(spark, tmp_path):
    path = tmp_path / "train.csv"
    path.write_bytes('Code1,CODE2,similar\n"x = ""a, b""\n\ny",,1\n"  lead\\n\'",z,0\n'.encode())
    rows = S.read_pairs(spark, str(path), ["code1", "code2", "similar"]).collect()
    assert {tuple(r) for r in rows} == {('x = "a, b"\n\ny', "", 1), ("  lead\\n'", "z", 0)}
    with pytest.raises(ValueError, match="code9"):
        S.read_pairs(spark, str(path), ["code9"])


def test_source_tree(spark, tmp_path):
    for problem in ("p2", "p1", "p3"):
        (tmp_path / problem / "deep").mkdir(parents=True)
        for name in ("b.py", "a.py", "c.txt"):
            (tmp_path / problem / name).write_text(f"{problem}{name}\r\nx", newline="")
        (tmp_path / problem / "deep" / "d.py").write_text("deep")
    (tmp_path / "top.py").write_text("top")
    (tmp_path / "p1" / "a.py").write_bytes("é".encode("latin-1"))
    tree = S.read_source_tree(spark, str(tmp_path))
    assert {(r.problem_id, r.code) for r in tree.collect()} == {
        ("p1", "é"), ("p1", "p1b.py\nx"), ("p2", "p2a.py\nx"), ("p2", "p2b.py\nx"), ("p3", "p3a.py\nx"), ("p3", "p3b.py\nx")}
    capped = S.read_source_tree(spark, str(tmp_path), max_problems=2, max_files=1)
    assert {(r.problem_id, r.file_path.rsplit("/", 1)[1]) for r in capped.collect()} == {("p1", "a.py"), ("p2", "a.py")}


def test_read_or_build(spark, tmp_path):
    path = str(tmp_path / "table")
    empty = S.read_or_build(spark, path, lambda: spark.range(0))
    assert empty.isEmpty() and not (tmp_path / "table").exists()
    assert S.read_or_build(spark, path, lambda: spark.range(3)).count() == 3
    assert S.read_or_build(spark, path, lambda: spark.range(9)).count() == 3


@pytest.mark.parametrize("suffix", [".json", ".parquet"])
def test_vocab_files(spark, tmp_path, suffix):
    path = str(tmp_path / f"v{suffix}")
    with pytest.raises(FileNotFoundError):
        S.read_vocab(spark, path)
    table = spark.createDataFrame([("a", 0, -1.0), ("\n", 1, -2.0)], "piece string, id int, score double")
    merges = spark.createDataFrame([(0, "a", "b")], "rank int, left string, right string")
    S.write_vocab(table, path, merges)
    vocab, found = S.read_vocab(spark, path)
    assert {tuple(r) for r in vocab.collect()} == {("a", 0, -1.0), ("\n", 1, -2.0)}
    assert [(r.left, r.right) for r in found.collect()] == [("a", "b")]


def test_stats_files(spark, tmp_path):
    rows = spark.createDataFrame([("s", "", "n", 2.0), ("s", "p1", "n", 1.5)], "section string, item string, metric string, value double")
    S.write_stats(rows, str(tmp_path))
    lines = [r.value for r in spark.read.text(f"{tmp_path}/report").collect()]
    assert set(lines) == {"[s] n: 2.00", "[s] p1 n: 1.50"}
    assert spark.read.json(f"{tmp_path}/json").count() == 2


def test_scan_prunes_and_pushes_down(spark, small):
    df = S.read_corpus(spark, f"{small}/documents.parquet", ["doc_id"], F.col("lang") == "en")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(lang,en)" in plan and "ReadSchema: struct<doc_id:bigint,lang:string>" in plan


def test_resolver(spark):
    frame = spark.createDataFrame([("a", "b")], "source_code string, n string")
    assert select.resolve_text(frame, "text", guess=True).columns == ["text", "n"]
    both = spark.createDataFrame([("a", "b")], "text_norm string, text_a string")
    assert select.resolve_text(both, "corpus_or_pairs").columns == ["text", "text_a"]
    with pytest.raises(ValueError):
        select.resolve_text(both, "processed")


def test_status_forms(spark):
    words = spark.createDataFrame([(" accepted ",), ("AC",), ("wa",), (None,)], "Status string")
    assert select.filter_accepted(words).count() == 2
    codes = spark.createDataFrame([(4,), (3,), (None,)], "judge_status int")
    assert select.filter_accepted(codes).count() == 1
    assert select.filter_accepted(codes.select(F.lit(1).alias("x"))).count() == 3


def test_source_tree_round_trip(spark, tmp_path):
    rows = [("p1", "a.py", b"x = 1\n"), ("p1", "b.py", "# é\n".encode("latin-1")), ("p2", "c.py", "# é\r\n".encode()), ("p2", "d.txt", b"no"),
            ("p3", None, b"no"), (None, "e.py", b"no"), ("p3", "f.py", None), ("p3", "g.py", b"")]
    df = spark.createDataFrame(rows, "problem string, name string, content binary").repartition(3)
    written = S.write_source_tree(df, str(tmp_path / "tree"), "problem", "name", "content")
    assert sorted(map(tuple, written.collect())) == [("p1/a.py", 6), ("p1/b.py", 4), ("p2/c.py", 6), ("p2/d.txt", 2), ("p3/g.py", 0)]
    written.collect()  # once more: the same files
    found = S.read_source_tree(spark, str(tmp_path / "tree")).collect()
    assert sorted((r.problem_id, r.code) for r in found) == [("p1", "# é\n"), ("p1", "x = 1\n"), ("p2", "# é\n")]  # an empty file gives no row
