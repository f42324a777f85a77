"""Exact and near dedup, and mixing, against brute force."""

import itertools
import random

import numpy as np
import pytest
from codelake.llm import exact_dedup, mixing, queries, simhash
from codelake.llm.components import components, forest
from conftest import ODD


def brute_components(prints, limit=4):
    rows, root = [(i, v) for i, v in prints], {}
    find = lambda x: x if root.get(x, x) == x else find(root[x])
    for (a, (i, x)), (b, (j, y)) in itertools.combinations(enumerate(rows), 2):
        if (x ^ y).bit_count() <= limit and find(a) != find(b):
            root[max(find(a), find(b))] = min(find(a), find(b))
    groups = {}
    for a, (i, _) in enumerate(rows):
        groups.setdefault(find(a), []).append(i)
    return {i: min(g) for g in groups.values() for i in g}


def plain_print(text):
    import re

    import xxhash
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text))
    shingles = [" ".join(words[i:i + 4]) for i in range(len(words) - 3)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_op10(spark, texts):
    rows = {r["doc_id"]: r for r in queries.op10_simhash(spark, "/root/testdata/sf0.01").collect()}
    wanted = {i: plain_print(t) for i, t in texts.items() if len(t) < 4000}
    assert all(rows[i]["fingerprint"] == f"{v:016x}" for i, v in wanted.items())
    prints = sorted((i, int(r["fingerprint"], 16)) for i, r in rows.items())
    assert {i: r["component_id"] for i, r in rows.items()} == brute_components(prints)


def test_anchors_meet_every_pair():
    random.seed(1)
    for first, bits in simhash.BLOCKS:
        table = simhash.flips(bits)
        for _ in range(300):
            x = random.getrandbits(bits)
            y = x ^ random.choice([0, *[1 << b for b in range(bits)]])
            masks = [table[np.bitwise_xor.reduce([b + 1 for b in range(15) if v >> b & 1] or [0])] for v in (x, y)]
            assert x ^ masks[0][0] in {y ^ m for m in masks[1]}
            anchors = {y ^ m for m in masks[1]}
            assert all(np.bitwise_xor.reduce([b + 1 for b in range(15) if a >> b & 1] or [0]) == 0 for a in anchors)


@pytest.mark.parametrize("cell_homes", [50_000, 3])
def test_links_of_close_fingerprints(spark, cell_homes):
    random.seed(2)
    centres = [random.getrandbits(64) for _ in range(12)] + [0, 2**64 - 1]
    values = set(centres)
    for c in centres:
        for _ in range(40):
            values.add(c ^ sum(1 << b for b in random.sample(range(64), random.randrange(1, 8))))
    signed = [int(np.uint64(v).astype(np.int64)) for v in values]
    members = simhash.replicated(spark.createDataFrame([(v,) for v in signed], "fingerprint long"))
    roots = {r["node"]: r["root"] for r in components(simhash.anchor_links(members, cell_homes=cell_homes)).collect()}
    got = {v: roots.get(v, v) for v in signed}
    wanted = brute_components([(v, v & (2**64 - 1)) for v in signed])
    assert got == wanted


def test_majority_of_many():
    h = np.random.default_rng(1).integers(0, 2**63, 3000).astype(np.uint64)
    assert simhash.majority(h) == sum(1 << b for b in range(64) if 2 * int(((h >> np.uint64(b)) & np.uint64(1)).sum()) > len(h))


def test_odd_near(odd, nothing):
    rows = simhash.near_duplicates(odd).collect()
    found = {(r["doc_id"], r["fingerprint"]): r["component_id"] for r in rows}
    assert len(rows) == len(ODD)
    assert found[(2, 0)] == found[(3, 0)] == found[(4, 0)] == 2
    assert len({v for (i, _), v in found.items() if i in (1, 7)}) == 1
    kept = simhash.drop_near_duplicates(odd)
    assert kept.columns == odd.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert 7 not in ids and 1 in ids and 3 not in ids and 2 in ids
    assert simhash.near_duplicates(nothing).count() == 0 and simhash.drop_near_duplicates(nothing).count() == 0


def test_forest_joins_chains():
    child, root = forest(np.array([5, 4, 9, 3]), np.array([4, 3, 8, 1]))
    assert dict(zip(child.tolist(), root.tolist())) == {3: 1, 4: 1, 5: 1, 9: 8}


def test_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1001)], "src long, dst long")
    roots = {r["node"]: r["root"] for r in components(links).collect()}
    assert all(roots[i] == 0 for i in range(1, 301)) and roots[1001] == 1000


def test_odd_exact(odd, nothing):
    rows = exact_dedup.exact_duplicates(odd, digest_all=True).collect()
    assert len(rows) == len(ODD)
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], []).append(r)
    assert by[2][0]["group_size"] == 3 and by[4][0]["kept"] and not by[2][0]["kept"]  # most code points stay
    assert by[6][0]["kept"] and by[5][0]["keep_id"] == 6
    assert {r["keep_id"] for r in by[7]} == {1} and by[1][0]["group_size"] == 4
    left = exact_dedup.drop_exact_duplicates(odd)
    assert left.columns == odd.columns
    assert sorted(repr(r["doc_id"]) for r in left.collect()) == sorted(map(repr, [1, 4, 6, None, -8, 9, 10]))
    assert exact_dedup.exact_duplicates(nothing).count() == 0 and exact_dedup.drop_exact_duplicates(nothing).count() == 0


def test_many_groups_join_by_shuffle(docs, monkeypatch):
    usual = {tuple(r) for r in exact_dedup.exact_duplicates(docs).collect()}
    monkeypatch.setattr(exact_dedup, "GROUPS_TO_SEND", 0)
    assert {tuple(r) for r in exact_dedup.exact_duplicates(docs).collect()} == usual


def test_repeated_rows_leave_one(spark):
    df = spark.createDataFrame([(1, "a b"), (1, "a b"), (2, "ab"), (1, "other"), (None, "x"), (None, "x")], "doc_id long, text string")
    left = sorted((repr(r["doc_id"]), r["text"]) for r in exact_dedup.drop_exact_duplicates(df).collect())
    assert left == [("1", "a b"), ("1", "other"), ("None", "x")]


def test_mix_meets_targets(docs):
    rows = mixing.mix(docs).collect()
    sums = {}
    for r in rows:
        s = sums.setdefault(r["source"], [0, 0, r["target"], r["source_size"], 0])
        s[0] += r["taken"]
        s[1] += r["size"]
        s[4] = max(s[4], r["size"])
        assert 0 <= r["taken"] <= 2 * r["size"]
    assert all(s[1] == s[3] and abs(s[0] - s[2]) <= s[4] for s in sums.values())
    assert abs(sum(s[2] for s in sums.values()) - 1.5 * sum(s[1] for s in sums.values())) < 1
    assert sorted(map(tuple, rows)) == sorted(map(tuple, mixing.mix(docs.repartition(7)).collect()))


def test_odd_mix(odd, nothing, spark):
    rows = mixing.mix(odd).collect()
    assert len(rows) == len(ODD) and sum(r["size"] for r in rows if r["source"] is None) == 0
    out = mixing.mixed(odd)
    assert out.columns == odd.columns
    want = sorted(repr(r["doc_id"]) for r in rows for _ in range(r["copies"]))
    assert sorted(repr(r["doc_id"]) for r in out.collect()) == want
    assert mixing.mix(nothing).count() == 0 and mixing.mixed(nothing).count() == 0


def test_targets_stop_at_twice_the_source(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), (None, 1000), ("c", 0)], "source string, source_size long")
    got = {r["source"]: r["target"] for r in mixing.targets(sizes).collect()}
    # weights a 3, b 1, c 2, null 3 of 3015 words; a stops at 20, c at 0, null at 2000, b takes the rest
    assert got == {"a": 20.0, "c": 0.0, None: 2000.0, "b": 995.0}
