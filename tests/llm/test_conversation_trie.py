"""The conversation trie against a dictionary of prefixes."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from sensorflow.llm.conversation_trie import Parentheses, conversation_trie, range_minima

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    convs = {}
    for c, t, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((t is not None, t or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(ts)] for c, ts in convs.items()}
    nodes = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - int(np.fmod(c, 20))
        path = tuple(own.get(base, [])[:h] + turns[h:])
        for d in range(len(path) + 1):
            nodes.setdefault(path[:d], ([], []))[0].append(c)
        nodes[path][1].append(c)
    children = {}
    for p in nodes:
        if p:
            children.setdefault(p[:-1], []).append(p)

    def total(p):
        leaves, saved = 0, (len(nodes[p][0]) - 1) * (len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0)
        for q in children.get(p, []):
            a, b = total(q)
            leaves, saved = leaves + a, saved + b
        return (leaves if p in children else 1), saved

    out = []
    for p, (members, ended) in nodes.items():
        leaves, saved = total(p)
        ids = ",".join(map(str, sorted(ended)))
        out.append((min(members), len(p), min(nodes[p[:-1]][0]) if p else None, len(members), len(children.get(p, [])),
                    leaves, saved, hashlib.sha256(ids.encode()).hexdigest()))
    return sorted(out, key=str)


def check(spark, rows, parts=4, **options):
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    df = df.withColumns({c: F.lit(1) for c in ("conv", "path", "words", "part", "kind", "depth", "d", "t", "w", "family")})
    got = sorted((tuple(r) for r in conversation_trie(df, **options).collect()), key=str)
    assert got == brute(rows)


def tree_rows(rng, n, length, texts):
    rows = []
    for c in rng.sample(range(-200, 10 * n), n):
        for t in range(rng.randint(1, length)):
            rows.append((c, t, rng.choice(["user", "assistant"]), rng.choice(texts)))
    return rows


@pytest.mark.parametrize("nodes", [1, 5, 40, 100_000])
def test_equals_brute_force(spark, nodes):
    rng = random.Random(nodes)
    rows = tree_rows(rng, 120, 7, ["", "a b", "c d e"])
    check(spark, rows, shard_nodes=nodes, list_bytes=8)


def test_copies_over_many_ranges_and_long_conversations(spark):
    rng = random.Random(2)
    long = [(7, t, "user", f"w{t % 3} x") for t in range(900)] + [(27, t, "user", f"w{t % 3} x") for t in range(890)]
    same = [(c, t, "user", f"hello there {t}") for c in range(1_000, 1_400) for t in range(3)]
    check(spark, long + same + tree_rows(rng, 40, 4, ["q", "r s"]), shard_nodes=50, list_bytes=64)
    check(spark, [(40 * c, 0, "u", "one two") for c in range(300)], shard_nodes=1, list_bytes=16)


def test_odd_rows(spark):
    rows = [(None, 1, "user", "x"), (0, None, None, None), (0, 1, "user", "hi you"), (0, 2, "user", ""), (1, 0, "user", "a"),
            (2, 5, None, "b c"), (2, 5, None, "b c"), (20, 0, "", ""), (41, 3, "user", "z " * 5_000), (-3, 0, "ab", "c"),
            (-23, 0, "a", "bc"), (2 ** 62, 0, "user", "far"), (-2 ** 62, 0, "user", "far")]
    check(spark, rows)
    check(spark, [(1, 0, "user", "alone")])
    assert conversation_trie(spark.createDataFrame([], SCHEMA)).count() == 0
    assert conversation_trie(spark.createDataFrame([(None, 1, "a", "b")], SCHEMA)).count() == 0


def test_closing_and_minima_equal_a_scan():
    rng = random.Random(4)
    for n in (1, 2, 63, 64, 65, 1_000, 5_000):
        bits = np.array([rng.random() < 0.55 for _ in range(n)])
        tree = Parentheses(bits, 3)
        places = np.flatnonzero(bits)
        want = []
        for p in places:
            e = int(tree.excess[p])
            want.append(next((q for q in range(p + 1, n) if tree.excess[q] < e), n))
        assert tree.closing(places).tolist() == want
        values = np.array([rng.randint(0, 99) for _ in range(n)])
        start = np.array([rng.randrange(n) for _ in range(50)])
        end = np.array([rng.randint(s + 1, n) for s in start])
        assert range_minima(values, start, end).tolist() == [int(values[s:e].min()) for s, e in zip(start, end)]
