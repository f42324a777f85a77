import re
from collections import Counter, defaultdict

import pytest

from codelake.llm.divergence import divergence, joint, planted


def brute(rows, least, top):
    """Rows of (text, lang, source), priced term by term."""
    held, counts, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        groups[lang or ""].add(source or "")
        held[lang or ""].update(set(terms))
        counts[lang or "", source or ""].update(terms)
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in held[lang].items() if n >= least]

        def shares(found):
            total = sum(found[t] for t in kept)
            return {t: 1 + 10**9 * (found[t] + 2) // (total + 2 * len(kept)) for t in kept}

        p = {s: shares(counts[lang, s]) for s in sources}
        q = shares(sum((counts[lang, s] for s in sources), Counter()))
        for s in sources:
            pairs = [(sum((p[s][t] - p[o][t]) ** 2 // (p[s][t] + p[o][t]) for t in kept), o) for o in sources - {s}]
            terms = [((p[s][t] - q[t]) ** 2 // (p[s][t] + q[t]), t) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, len(pairs)), ("term", terms, top)):
                ranked = sorted(found, key=lambda x: (-x[0], x[1].encode()))[:most]
                out += [(lang, s, part, item, value, i + 1) for i, (value, item) in enumerate(ranked)]
    return sorted(out)


def made(groups, tongues=("en", "fr", None)):
    rows = []
    for g in range(groups):
        for i in range(4):
            words = [f"Word{chr(97 + (g * k + i) % 23)}{chr(97 + k % 19)}é" for k in range((g * 7) % 40)] + ["the"] * (g % 3)
            rows.append((" ".join(words) + "...12", tongues[(g + i) % len(tongues)], f"s{g}" if g else None))
    return rows + [(None, "xx", "a"), ("", "xx", "b"), ("lonely", "yy", "a")]


@pytest.mark.parametrize("groups,least,block_terms", [(9, 2, 1024), (150, 3, 40), (70, 1, 7)])
def test_brute_force(spark, groups, least, block_terms):
    rows = made(groups)
    df = spark.createDataFrame(rows, "text string, lang string, source string").repartition(5)
    assert sorted(map(tuple, divergence(df, least_docs=least, block_terms=block_terms, top=4).collect())) == brute(rows, least, 4)


def test_long_text_and_odd_rows(spark, odd, nothing):
    rows = [(r["text"], r["lang"], r["source"]) for r in odd.collect()]
    assert sorted(map(tuple, divergence(odd, least_docs=2).collect())) == brute(rows, 2, 10)
    long = [("Aa bé " * 400_000 + "x" * 3_000_000 + " end", "en", "a"), ("aa", "en", "b"), ("bé end", "en", "c")]
    df = spark.createDataFrame(long, "text string, lang string, source string")
    assert sorted(map(tuple, divergence(df, least_docs=2).collect())) == brute(long, 2, 10)
    assert divergence(nothing).count() == 0


def test_tree():
    import numpy as np

    occupied = np.random.default_rng(1).random((64, 64)) < 0.01
    bits, leaves = planted(occupied)
    assert len(leaves) == occupied.sum() and occupied[leaves[:, 0], leaves[:, 1]].all() and len(bits) < 64 * 64
    value, visited = joint(64, (None, None, [3] * 5), (None, None, [9] * 5), False)
    assert not value.any() and not visited.any()
