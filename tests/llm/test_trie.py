import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from codelake.llm.prefix_trie import prefix_trie
from codelake.llm.queries import op13_prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, depth long, node string"


def signed_rest(c, n):
    return -(-c % n) if c < 0 else c % n


def brute(rows):
    """The trie of plain tuples."""
    said = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            role, text = role or "", text or ""
            mark = hashlib.md5((str(len(role.encode())) + ":" + role + text).encode()).hexdigest()
            said[c].append(((turn is not None, turn or 0, mark), (role, text)))
    own = {c: [t for _, t in sorted(v, key=lambda x: x[0])] for c, v in said.items()}
    whole = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        whole[c] = tuple(own.get(c - signed_rest(c, 20), [])[:h] + turns[h:])
    members, ends, children = defaultdict(list), defaultdict(list), defaultdict(set)
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
            if d:
                children[turns[:d - 1]].add(turns[:d])
        ends[turns].append(c)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        saved[node] = (len(members[node]) - 1) * words + sum(saved[k] for k in children[node])
        leaves[node] = sum(leaves[k] for k in children[node]) or 1
    return sorted((min(m), len(n), min(members[n[:-1]]) if n else None, len(m), len(children[n]), leaves[n], saved[n],
                   hashlib.sha256(",".join(map(str, sorted(ends[n]))).encode()).hexdigest()) for n, m in members.items())


def key(rows):
    return sorted(rows, key=lambda r: (r[1], r[0], str(r)))


def found_rows(df):
    return [tuple(r) for r in df.collect()]


def test_query(spark, small):
    rows = spark.read.parquet(f"{small}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    assert key(found_rows(op13_prefix_trie(spark, small))) == key(brute(map(tuple, rows)))


def made(seed, convs, longest):
    draw = random.Random(seed)
    rows = []
    for c in range(-25, convs):
        copy = draw.random() < 0.5
        for t in range(draw.choice([1, 2, 3, 5, longest])):
            text = f"word {t % 7} again" if copy or draw.random() < 0.7 else f"own {c} {t}"
            rows.append((c, t if draw.random() < 0.95 else None, draw.choice(["user", None]) if not copy else "user", text, 1, "x"))
    return rows


@pytest.mark.parametrize("band,segment,piece", [(2, 4, 3), (3, 6, 1), (16, 4096, 4096)])
def test_bands_and_segments(spark, band, segment, piece):
    rows = made(band, 45, 23)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert key(found_rows(prefix_trie(df, band=band, segment=segment, piece=piece))) == key(brute(rows))


def test_odd_rows(spark):
    rows = [(None, 1, "user", "nobody", 0, ""), (20, 1, None, None, 0, ""), (20, 1, None, None, 0, ""), (20, None, "user", " \t ", 0, ""),
            (21, 1, "user", "a " * 50_000, 0, ""), (22, 1, "us", "era", 0, ""), (23, 1, "user", "a", 0, ""), (-3, 5, "user", "é b", 0, "")]
    assert key(found_rows(prefix_trie(spark.createDataFrame(rows, SCHEMA)))) == key(brute(rows))
    assert prefix_trie(spark.createDataFrame([], SCHEMA)).count() == 0


def test_one_conversation_with_equal_turns(spark):
    rows = [(40, None, "user", "the same", 0, "")] * 300 + [(41, 1, "user", "the same", 0, "")]
    assert key(found_rows(prefix_trie(spark.createDataFrame(rows, SCHEMA), band=4, segment=16))) == key(brute(rows))
