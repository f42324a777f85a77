"""Personal data and line rules against brute force."""

import hashlib
import re

from codelake.llm import line_rules, pii, queries
from codelake.llm.common import release
from conftest import ODD
from pyspark.sql import functions as F

PLAIN = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
]


def good(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        total = sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(map(int, reversed(digits))))
        return 13 <= len(digits) <= 19 and total % 10 == 0
    return kind != "phone" or 9 <= len(digits) <= 15


def plain(text):
    return [f"{k}:{m.start()}:{m.end()}" for k, p in PLAIN for m in re.finditer(p, text) if good(k, m.group())]


def test_op6(spark, texts):
    rows = queries.op6_personal_data(spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == len(texts)
    for r in rows:
        spans = plain(texts[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(",".join(spans).encode()).hexdigest()
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(s.startswith(k) for s in spans) for k in pii.KINDS]
        assert set(spans) <= set(r["spans"].split(","))


def test_hard_matches(spark):
    texts = [
        "a@b.c_d@e.f x@y. z@q..w a@b.c@d.e mail:x.y+z@host-1.example.org.", "1.2.3.4.5.6.7.8 256.1.1.1 01.002.3.255 1.2.3",
        "4111 1111 1111 1111 4111-1111-1111-1112 5500000000000004 41111111111111111111111 7", "é+1 (555) 123-4567 +12 +49 30 1234567. +1-2-3",
        "😀 a@b.co 😀 10.0.0.1", "+1 555 123 4567 +1 555 123 4568", "a" * 50_000, "a.b@" * 5000, "1" * 30_000, "1.1." * 5000, None, "", "@", "+", "4111111111111111",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in pii.span_texts(pii.personal_data(df)).collect():
        assert r["base_sha256"] == hashlib.sha256(",".join(plain(texts[r["doc_id"]] or "")).encode()).hexdigest(), texts[r["doc_id"]][:80]


def test_contexts_discover(spark):
    seeds = [(i, f"Please mail me at user{i}@site.org today.") for i in range(8)]
    new = [(100, "Please mail me at user9(at)site-2024.org today."), (101, "Built in the year 2024-2025 by us."), (102, "mail me at user10000 now")]
    noise = [(200 + i, f"It was the version {1000 + i}0 of it") for i in range(10)]
    rows = {r["doc_id"]: r for r in pii.personal_data(spark.createDataFrame(seeds + new + noise, "doc_id long, text string")).collect()}
    assert [s["match"] for s in rows[100]["found"]] == ["user9(at)site-2024.org"]
    assert [s["match"] for s in rows[102]["found"]] == ["user10000"]
    assert not rows[101]["found"] and not any(rows[i]["found"] for i, _ in noise + seeds)


def test_contexts_reach_further(spark):
    """A context that no rule's match follows is reached through instances it shares with a trusted one."""
    seeds = [(i, f"Please mail me at user{i}@site.org today.") for i in range(8)]
    shared = [(20 + i, f"Please mail me at person{i}0000 today.") for i in range(3)] + [(30 + i, f"our staff id person{i}0000 is") for i in range(3)]
    unseen = [(40 + i, f"our staff id person{i}9999 is") for i in range(2)]
    noise = [(200 + i, f"It was the version {1000 + i}0 of it") for i in range(10)]
    rows = pii.personal_data(spark.createDataFrame(seeds + shared + unseen + noise, "doc_id long, text string")).collect()
    found = {r["doc_id"]: [s["match"] for s in r["found"]] for r in rows}
    assert [found[i] for i in (20, 30, 40, 41)] == [["person00000"], ["person00000"], ["person09999"], ["person19999"]]
    assert not any(found[i] for i, _ in noise + seeds)


def scored_plainly(links, rounds, support):
    """Confidence of each pattern, from (pattern, kind, instance, seed): the rounds of pii.judged in plain loops."""
    view = {kind: v for v, kinds in pii.VIEWS.items() for kind in kinds}
    scores = {}
    for turn in range(rounds + 1):
        new = {}
        for pattern, kind in {(p, k) for p, k, _, _ in links}:
            mine = [(i, s) for p, _, i, s in links if p == pattern]
            known = []
            for instance, seed in mine:
                others = [scores[p] for p, k, i, _ in links if i == instance and p in scores and view[k] != view[kind]]
                known += [1.0] if seed else [max(others)] if others and turn else []
            if len(mine) >= support and len(known) >= 2:
                new[pattern] = sum(known) / (len(mine) if sum(s for _, s in mine) >= 2 else len(known))
        scores = new
    return scores


def test_scores_are_those_of_plain_loops(spark):
    import random
    random.seed(11)
    kinds = (pii.TWO, pii.BEFORE, pii.AFTER, pii.SHAPE)
    seeds = {i: random.random() < 0.3 for i in range(60)}
    links = sorted({(f"{k} {random.randrange(6)}", k, i, seeds[i]) for i in seeds for k in kinds for _ in range(2)})
    df = spark.createDataFrame(links, "pattern string, kind string, instance long, seed boolean")
    scores = pii.judged(df, None, 5)
    for rounds in range(4):
        got = {r["pattern"]: r["confidence"] for r in scores.collect()}
        want = scored_plainly(links, rounds, 5)
        assert got.keys() == want.keys() and all(abs(got[p] - want[p]) < 1e-9 for p in want)
        scores = pii.judged(df, scores, 5)


def test_planted_identifiers(spark):
    """Varied sentences: badges that no rule knows are found by their neighbours and shape, years and counts are not."""
    import random
    random.seed(5)
    word = lambda: "".join(random.choice("bcdfglmnprst") + random.choice("aeiou") for _ in range(random.randint(2, 3)))
    words = lambda n: " ".join(word() for _ in range(n))
    texts, badges = [], {}
    for i in range(600):
        ask, end = random.choice(["contact", "reach", "mail"]), random.choice(["soon", "please", "directly"])
        if i % 3 == 0:
            texts.append(f"{words(4)} {ask} {word()}{i}@{word()}.org {end} {words(3)}")
        elif i % 3 == 1:
            badges[i] = f"zk{random.randrange(10 ** 8):08d}"
            texts.append(f"{words(4)} {random.choice([ask, word()])} {badges[i]} {random.choice([end, word()])} {words(3)}")
        else:
            texts.append(f"{words(3)} in {random.randrange(1900, 2020)} or {random.randrange(10000, 99999)} {words(3)}")
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {(r["doc_id"], s["match"]) for r in pii.personal_data(df).collect() for s in r["found"]}
    right = found & set(badges.items())
    assert len(right) / len(found) >= 0.95 and len(right) / len(badges) >= 0.6


def test_tokens_are_found(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    rows = pii.personal_data(docs).select("doc_id", F.explode("found").alias("s")).collect()
    found = {(r["doc_id"], r["s"]["start"]) for r in rows}
    after = re.compile(r"(?<![^\x20\x09-\x0D])token =[\x20\x09-\x0D]+(?=\S*[0-9]\S*[0-9]\S*[0-9]\S*[0-9])")
    tokens = {(r["doc_id"], m.end()) for r in docs.where("text like '%token =%'").collect() for m in after.finditer(r["text"])}
    assert len(tokens) > 100 and tokens <= found


def test_many_matches(spark):
    """Work grows with a text's matches, not with their square; starts are right beyond one block of sums."""
    import time
    texts = [" ".join(f"{100000 + i}" for i in range(n)) for n in (63, 64, 65, 4097, 100_000)]
    texts.append(" ".join(f"u{i}@h.org {10000 + i}" for i in range(20_000)))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(6)
    at = time.time()
    rows = {r["doc_id"]: r for r in pii.read(df).collect()}
    assert time.time() - at < 60
    for i, text in enumerate(texts):
        want = [(m.start(), m.end()) for m in re.finditer("[^ ]+", text) if "@" not in m.group()]
        taken = [(s["start"], s["end"]) for k in pii.KINDS for s in rows[i][k]]
        if not taken:
            assert [(s["start"], s["end"]) for s in rows[i]["other"]] == want
    assert len(rows[5]["email"]) == 20_000 and len(rows[5]["other"]) == 20_000


def test_context_before_a_match(spark):
    url = "https://" + "long/" * 20
    texts = ["call 5550101 or 5550102 now", "id 12345 ssn 98765", f"see {url} at {url}b no 77777", "7777 x", ""]
    df = spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1)
    found = [[s["context"] for s in r[0]] for r in df.select(pii.found(F.col("text"), pii.CANDIDATE)).collect()]
    assert found == [["", "@ or"], ["", "@ ssn"], [f"{url}b no"], [""], []]


def test_odd(odd, nothing):
    assert pii.span_texts(pii.personal_data(odd)).count() == len(ODD)
    assert pii.personal_data(nothing).count() == 0
    rows = line_rules.line_rules(odd).collect()
    assert len(rows) == len(ODD) and {r["doc_id"]: r["n_words"] for r in rows}[2] == 0
    assert line_rules.line_rules(nothing).count() == 0


def test_furniture_is_removed(spark):
    import random
    random.seed(4)
    word = lambda: "".join(random.choice("abcdefgh") for _ in range(6))
    body = lambda n: "\n".join(" ".join(word() for _ in range(20)) for _ in range(n))
    foot = "\n".join(" ".join(word() for _ in range(11)) for _ in range(10))
    values = [(i, body(12) + "\n" + foot, "h") for i in range(30)] + [(50 + i, body(2) + "\n" + foot, "h") for i in range(5)]
    values += [(70, body(2) + "\n" + foot, "other")] + [(80 + i, values[0][1], "copies") for i in range(40)]
    rows = {r["doc_id"]: r for r in line_rules.line_rules(spark.createDataFrame(values, "doc_id long, text string, source string")).collect()}
    assert all(rows[i]["kept"] and rows[i]["words_left"] == 240 for i in range(30))
    assert not any(rows[50 + i]["kept"] for i in range(5))
    assert rows[70]["kept"] and all(rows[80 + i]["kept"] for i in range(40))


def test_limit_knows_no_length_and_no_size(spark):
    """Footers of 45 and 400 words go; the same footer gets the same verdict on a host thirty times as large."""
    import random
    random.seed(9)
    word = lambda: "".join(random.choice("abcdefgh") for _ in range(8))
    line = lambda n: " ".join(word() for _ in range(n))
    feet = {45: line(45), 400: line(400)}
    values = [(1000 * n + i, f"{line(20)}\n{foot}", f"host {n}") for n, foot in feet.items() for i in range(30)]
    values += [(10_000 + i, f"{line(20)}\n{feet[45]}", "large") for i in range(30)] + [(20_000 + i, line(60), "large") for i in range(900)]
    values += [(30_000 + i, f"{line(20)}\n{feet[400]}", "few") for i in range(line_rules.LINE_DOCS)]
    rows = {r["doc_id"]: r for r in line_rules.line_rules(spark.createDataFrame(values, "doc_id long, text string, source string")).collect()}
    for start in (45_000, 400_000, 10_000):
        assert all(rows[start + i]["words_left"] == 20 and not rows[start + i]["kept"] for i in range(30))
    assert all(rows[20_000 + i]["kept"] for i in range(900)) and all(rows[30_000 + i]["kept"] for i in range(line_rules.LINE_DOCS))


def test_release(spark):
    assert release(spark) > 0
