"""Exact and near deduplication against brute force."""

import hashlib
import random
import re

import pytest

from sensorflow.llm.components import connected_components
from sensorflow.llm.exact_dedup import exact_dedup
from sensorflow.llm.near_dedup import NearParams, Signer, near_duplicates, shingles

from .helpers import documents, words

SPACES = "[ \t-\r]+"


def brute_exact(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub(SPACES, " ", t or ""), []).append(i)
    out = []
    for i, t in rows:
        t = re.sub(SPACES, " ", t or "")
        keep = min((x for x in groups[t] if x is not None), default=None)
        out.append((i, keep, len(groups[t]), i == keep, hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("digits", [32, 1])
def test_exact_dedup_equals_brute_force(spark, digits):
    rng = random.Random(1)
    base = [" ".join(words(rng, rng.randint(0, 6))) for _ in range(25)]
    rows = [(i, rng.choice(base).replace(" ", rng.choice([" ", "\n", " \t "]))) for i in range(120)]
    rows += [(200, None), (201, ""), (202, " "), (203, " "), (None, base[0]), (None, "alone"),
             (5, rows[5][1]), (300, "w " * 60_000), (301, "w\n" * 60_000)]
    got = exact_dedup(documents(spark, rows, clashing=True), hash_hex_digits=digits).collect()
    assert sorted(map(tuple, got), key=str) == brute_exact(rows)


def test_empty_tables(spark):
    empty = documents(spark, [])
    assert exact_dedup(empty).count() == 0
    assert near_duplicates(empty).count() == 0


def brute_near(rows, k, percent):
    def of(t):
        w = re.findall("[^ \t-\r]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        if not w:
            return frozenset()
        return frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1)))
    sets = [(i, of(t)) for i, t in rows]
    parent = {i: i for i, _ in sets if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if i is None or j is None or not a or not b:
                continue
            if 100 * len(a & b) >= percent * len(a | b):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return sorted(((i, len(s), None if i is None else find(i), i is None or find(i) == i)
                   for i, s in sets), key=str)


@pytest.mark.parametrize("k", [4, 5])
def test_near_duplicates_equal_brute_force(spark, k):
    rng = random.Random(k)
    rows = []
    for g in range(6):  # families of copies with edits on both sides of the threshold
        base = words(rng, 90)
        for c in range(rng.choice([2, 6, 25])):
            copy = list(base)
            for _ in range(rng.randint(0, 6)):
                copy[rng.randrange(len(copy))] = words(rng, 1)[0]
            if rng.random() < 0.3:
                copy = copy[rng.randint(0, 12):]
            rows.append((1000 * g + 7 * c + 1, " ".join(copy)))
    shared = " ".join(words(rng, 30))  # a passage that many documents repeat
    rows += [(20_000 + i, shared + " " + " ".join(words(rng, 60))) for i in range(25)]
    rows += [(9_001, None), (9_002, ""), (9_003, " \n"), (9_004, "one Two"), (9_005, "ONE two"),
             (9_006, "Été one two three four five"), (9_007, "été one two three four five"),
             (None, rows[0][1]), (rows[1][0], rows[1][1]),
             (9_100, " ".join(f"w{i}" for i in range(9_000))),
             (9_101, " ".join(f"w{i}" for i in range(300, 9_300)))]
    got = near_duplicates(documents(spark, rows, clashing=True), NearParams(words=k)).collect()
    assert sorted(map(tuple, got), key=str) == brute_near(rows, k, 80)


def test_packed_signatures_estimate_similarity():
    p = NearParams()
    signer = Signer(p)
    rng = random.Random(3)
    a = words(rng, 400)
    b = a[:360] + words(rng, 40)
    x, y = (shingles(" ".join(t), 5) for t in (a, b))
    true = len(set(x.tolist()) & set(y.tolist())) / len(set(x.tolist()) | set(y.tolist()))
    mismatches = 0
    for m, n in zip(signer.sign(x)[1].tolist(), signer.sign(y)[1].tolist()):
        d = (m ^ n) & (2**64 - 1)
        mismatches += sum(1 for lane in range(16) if d >> (4 * lane) & 15)
    agree = 1 - mismatches / p.minima
    assert abs((agree - 1 / 16) / (1 - 1 / 16) - true) < 0.15
    assert p.most_mismatches() > (1 - 0.8) * p.minima


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 130)] + [(7, 7), (105, 104)]
    got = {r["id"]: r["component"] for r in connected_components(
        spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 130)}}
