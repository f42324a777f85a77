import random

import numpy as np
import pytest

from codelake.llm.jaccard import gram_set, jaccard_join
from codelake.llm.queries import op12_jaccard_join


def shingles(text, n=5):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[i:i + n]) for i in range(len(words) - n + 1)) if len(words) >= n else frozenset([tuple(words)] if words else [])


def brute(rows):
    """(doc_id, size, component) of (doc_id, text) rows, all pairs compared."""
    sets = [shingles(t) for _, t in rows]
    boss = list(range(len(rows)))

    def top(i):
        while boss[i] != i:
            i = boss[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= 80 * len(a | sets[j]):
                boss[max(top(i), top(j))] = min(top(i), top(j))
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[top(i)] = min(key, least.get(top(i), key))
    return sorted(((key, len(s), least.get(top(i))) for i, ((key, _), s) in enumerate(zip(rows, sets))), key=str)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_query(spark, small):
    rows = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    assert found(op12_jaccard_join(spark, small)) == brute([tuple(r) for r in rows])


def crowd(seed):
    """Near copies at every distance of three texts, texts that share a passage, copies, and texts of their own."""
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    passage = [draw.choice(words) for _ in range(60)]
    bases = [[draw.choice(words) for _ in range(n)] for n in (40, 150, 90)]
    rows = []
    for i in range(220):
        body = list(draw.choice(bases))
        for _ in range(draw.choice([0, 0, 1, 2, 3, 5, 9])):
            body[draw.randrange(len(body))] = draw.choice(words)
        if draw.random() < 0.3:
            body = [draw.choice(words) for _ in range(draw.choice([3, 10, 80]))]
        if draw.random() < 0.4:
            body += passage
        rows.append((i, " ".join(w.upper() if draw.random() < 0.1 else w for w in body)))
    return rows + [(500 + i, t) for i, t in rows[:30]]


@pytest.mark.parametrize("tuning", [{}, {"most": 20, "column_entries": 500}, {"most": 7, "column_entries": 100}])
def test_crowd(spark, tuning):
    rows = crowd(tuning.get("most", 3))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert found(jaccard_join(df, **tuning)) == brute(rows)


def test_counted_columns(spark, monkeypatch):
    """With nothing held to be frequent, every n-gram goes through its column block; with everything, through none; then half."""
    from codelake.llm import jaccard

    rows = crowd(11)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    cells = jaccard.frequent_cells
    for change in (lambda c: c * 0, lambda c: c + 1, lambda c: np.arange(len(c)) % 2):
        monkeypatch.setattr(jaccard, "frequent_cells", lambda s: (change(cells(s)[0]), cells(s)[1]))
        assert found(jaccard_join(df, column_entries=2_000)) == brute(rows)


def test_odd_rows(odd, nothing):
    rows = [(r["doc_id"], r["text"]) for r in odd.select("doc_id", "text").collect()]
    assert found(jaccard_join(odd)) == brute(rows)
    assert jaccard_join(nothing).count() == 0


def test_gram_sizes():
    for text in ("", "one", "a b c d", "a b c d e", "a b c d e f", "x x x x x x x x"):
        assert len(gram_set(text)) == len(shingles(text))
