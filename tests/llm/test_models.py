"""Learned operators: held-out accuracy, and defined results at the edges."""

import numpy as np
from codelake.llm import language, quality, queries, toxicity
from conftest import LABELS, ODD
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.1"


def measured(spark, name, label):
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", F.col(label).alias("label"))
    rows = queries.QUERIES[name](spark, SF)
    assert rows.count() == 10_000
    found = rows.where("held_out").join(labels, "doc_id").groupBy("label", "predicted").count().collect()
    return {(r["label"], r["predicted"]): r["count"] for r in found}


def test_languages_in_parts(spark):
    """40 languages: several parts give the code lengths of one model, and every language is learned."""
    import random
    rng = random.Random(3)
    letters = "abcdefghijklmnopqrstuvwxyz"
    own = [rng.sample(letters, 5) for _ in range(40)]
    text = lambda i: " ".join("".join(rng.choice(own[i]) for _ in range(5)) for _ in range(40))
    values = [(n, text(n % 40), f"l{n % 40:02d}") for n in range(1200)]
    df = spark.createDataFrame(values, "doc_id long, text string, lang string")
    model, whole = language.fit(df), language.fit(df, part=100)
    assert len(model) == 2 and len(whole) == 1
    raw = [v[1].encode() for v in values[:50]]
    assert np.allclose(np.concatenate([language.code_lengths(part, raw) for part in model], axis=1), language.code_lengths(whole[0], raw))
    got = {r["doc_id"]: r["lang_pred"] for r in language.predict(df, model).collect()}
    assert got == {r["doc_id"]: r["lang_pred"] for r in language.predict(df, whole).collect()}
    assert sum(got[n] == tag for n, _, tag in values) > 1000


def test_op4(spark):
    n = measured(spark, "op4_quality", "quality")
    assert n[(1, 1)] >= 0.98 * (n[(1, 1)] + n.get((1, 0), 0)) and n[(0, 0)] >= 0.9 * (n[(0, 0)] + n.get((0, 1), 0))


def test_op9(spark):
    n = measured(spark, "op9_toxicity", "toxic")
    # here the insults of three languages are made of common syllables, so that harmless words come close
    assert n[(0, 0)] >= 0.94 * (n[(0, 0)] + n.get((0, 1), 0)) and n[(1, 1)] >= 0.88 * (n[(1, 1)] + n.get((1, 0), 0))


def test_op5(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    rows = queries.op5_language(spark, SF).where("held_out").join(docs, "doc_id").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.97 * len(rows) and all(0 <= r["score"] <= 1 for r in rows)


def test_code_lengths_are_a_code():
    """Under each language the probabilities of all next bytes sum to one, seen or not."""
    texts = {"x": [b"banana bandana"] * 5, "y": [b"strength strong"] * 9}
    langs, grams, uses = [], [], []
    for lang, values in texts.items():
        g, u = np.unique(np.concatenate([language.grams_of(t) for t in values]), return_counts=True)
        langs, grams, uses = langs + [lang] * len(g), [*grams, g], [*uses, u]
    model = language.frozen(np.array(langs, object), np.concatenate(grams).astype(np.int64), np.concatenate(uses).astype(np.int64))
    for lead in (b"", b"ban", b"str", b"zzz", b"nan"):
        bits = language.code_lengths(model, [lead + bytes([b]) for b in range(256)]) - language.code_lengths(model, [lead])
        total = np.exp2(-bits).sum(axis=0)
        assert (total <= 1 + 1e-4).all() and (total > 0.5).all()  # without exclusion an escape wastes a little
    assert (language.code_lengths(model, [b"banana"]).argmin(), language.code_lengths(model, [b"strong"]).argmin()) == (0, 1)
    long = b"bandana " * 300_000
    whole = language.code_lengths(model, [long, b"", long[:100]])
    assert np.allclose(whole[0] / len(long), language.code_lengths(model, [long[:80_000]])[0] / 80_000, rtol=1e-3) and (whole[1] == 0).all()


def test_gapped_insults():
    calm = [b"the weather is good and the people walk in the old town", b"we read a long book about rivers and stones"] * 30
    rude = [b"you are an idiot and more", b"what a moron he is", b"the people are idiots here"] * 20
    model = toxicity.trained(calm + rude, np.r_[np.zeros(len(calm)), np.ones(len(rude))].astype(int))
    low, spaced, *high = toxicity.scores(model, [calm[0], b"such an i.d.i.o.t he is", b"an IdxIot", b"an idi-ot"])
    assert low < 0.1 < spaced and min(high) > 0.7  # a mark after every letter is noticed but not enough
    long = b"we walk in the old town " * 100_000
    assert toxicity.scores(model, [long])[0] < 0.3 and toxicity.scores(model, [long + rude[0]])[0] > 0.7


def test_spelled_insults():
    calm = [b"the weather is good and the people walk in the old town", b"we read a long book about rivers and stones"] * 30
    rude = [b"you are an idiot and more", b"what a moron he is", b"the people are idiots here"] * 20
    model = toxicity.trained(calm + rude, np.r_[np.zeros(len(calm)), np.ones(len(rude))].astype(int))
    spelled = ["such an i.d.i.o.t he is", "an IdxIot", "m-o-r-o-n", "what a m..o..r--o..n he", "an i\u00b7d\u00b7i\u00b7o\u00b7t", "an i\u200bd\u200bi\u200bo\u200bt",
               "an i d i o t here", "an ixdxixoxt he"]
    assert min(toxicity.scores(model, [t.encode() for t in spelled])) > 0.7
    alone = [toxicity.scores(model, [t.encode()])[0] for t in spelled]
    assert np.allclose(toxicity.scores(model, [b"", *[t.encode() for t in spelled]])[1:], alone)  # whatever text comes next
    assert toxicity.scores(model, [calm[0], b"idiot"])[0] < 0.3
    harmless = [calm[0], b"the p.e.o.p.l.e walk", b"U.S.A. a.m. e.g. x y z", b"", b"a"]
    assert max(toxicity.scores(model, harmless)) < 0.3
    long = "\u00e9t\u00e9 we walk in the old town " * 60_000  # cut between characters, not within
    found = toxicity.scores(model, [long.encode(), (long + "an i.d.i.o.t " + long).encode()])
    assert found[0] < 0.3 and found[1] > 0.7


def test_edges(spark, odd, nothing, labels):
    some = spark.createDataFrame([(1, 1, 0), (3, 0, 1), (3, 0, 1), (5, None, None), (7, 1, 0), (10, 0, 1)], LABELS)
    none = spark.createDataFrame([], LABELS)
    for given in (some, none):
        for model, apply in ((quality.fit(odd, given), quality.quality), (toxicity.fit(odd, given), toxicity.toxicity)):
            rows = apply(odd, model).collect()
            assert len(rows) == len(ODD) and all(0 <= r["score"] <= 1 for r in rows)
            assert apply(nothing, model).count() == 0
    model = quality.fit(odd, some)
    kept = quality.keep_good(odd, model)
    assert kept.columns == odd.columns and kept.count() <= len(ODD) and quality.keep_good(nothing, model).count() == 0
    for model in (language.fit(odd), language.fit(nothing)):
        rows = language.predict(odd, model).collect()
        assert len(rows) == len(ODD)
        assert all(r["lang_pred"] == "und" and r["score"] == 0 for r in rows if r["doc_id"] in (2, 3, 4))
    assert language.predict(nothing, language.fit(odd)).count() == 0
