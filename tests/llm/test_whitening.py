"""Whitening against brute force in Python integers and numpy."""

import math
import random

import numpy as np
import pytest

from sensorflow.llm import queries
from sensorflow.llm.whitening import limbs, LIMB, scatter, whiten

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, scale=256, components=4):
    good = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    dims = max((len(v) for _, v in good), default=0)
    x = [(i, tuple(math.floor(scale * float(np.float32(c))) for c in v) + (0,) * (dims - len(v))) for i, v in good]
    fit = sorted({v for _, v in x})
    n = len(fit)
    s = [sum(c) for c in zip(*fit)]
    v = np.array([[sum((n * f[a] - s[a]) * (n * f[b] - s[b]) for f in fit) / n ** 3 for b in range(dims)]
                  for a in range(dims)])
    values, vectors = np.linalg.eigh(v)
    order = np.argsort(-values)[:components]
    out = {}
    for i, r in x:
        z = np.array([(n * c - t) / n for c, t in zip(r, s)])
        for k, o in enumerate(order):
            out.setdefault((i, k + 1), []).append(
                (n, sum((n * c - t) ** 2 for c, t in zip(r, s)), z @ vectors[:, o] / math.sqrt(values[o]),
                 values[o] / np.trace(v)))
    return out


def compare(got, rows):
    want = brute(rows)
    assert len(got) == sum(map(len, want.values()))
    sign = {}
    for r in got:
        n, far, w, share = want[r["vec_id"], r["component"]].pop(0)
        assert (r["n"], r["deviation"], r["deviation_digits"]) == (n, far, str(far))
        if abs(w) > 1e-6:
            sign.setdefault(r["component"], r["whitened"] * w > 0)
        assert r["whitened"] == pytest.approx(w if sign.get(r["component"], True) else -w, abs=1e-7)
        assert r["explained"] == pytest.approx(share, rel=1e-9)
        assert 0 <= r["identity_error"] < 1e-9


def test_scatter_is_exact():
    rng = random.Random(3)
    for top, rows, dims in ((200, 130, 5), (1, 64, 3), (2 ** 40, 70, 4), (2 ** 63 - 1, 9, 3), (0, 5, 2)):
        x = [[rng.randint(-top, top) for _ in range(dims)] for _ in range(rows)]
        sums, products = scatter(np.array(x, np.int64))
        assert sums == [sum(c) for c in zip(*x)]
        assert products == [[sum(r[a] * r[b] for r in x) for b in range(dims)] for a in range(dims)]
    for v in (0, -1, 2 ** 200, -2 ** 200 + 12345, 2 ** 59, -2 ** 60):
        assert sum(d << (LIMB * k) for k, d in enumerate(limbs(v))) == v


def test_equals_brute_force(spark):
    rng = random.Random(5)
    base = [[rng.gauss(0.2, 0.1 * (k + 1)) for k in range(7)] for _ in range(60)]
    rows = [(i, rng.choice(base)) for i in range(150)] + [(3, base[0]), (3, base[0]), (None, base[1])]
    rows += [(500, None), (501, [None] * 7), (502, [float("nan")] + [0.0] * 6), (503, [float("inf")] + [0.0] * 6),
             (504, [0.25] * 3), (505, []), (506, [-0.0] * 7)]
    table = spark.createDataFrame([(i, v, 1) for i, v in rows], SCHEMA).repartition(5)
    clashing = table.selectExpr("*", "1 AS i", "2 AS x", "3 AS n", "4 AS component", "5 AS l0")
    compare(sorted(whiten(clashing, block_rows=17).collect(), key=lambda r: (str(r["vec_id"]), r["component"])), rows)


def test_without_variance_and_empty(spark):
    one = whiten(spark.createDataFrame([(1, [0.5, 0.5], 0), (2, [0.5, 0.5], 0)], SCHEMA)).collect()
    assert len(one) == 4 and all(r["whitened"] is r["explained"] is r["identity_error"] is None for r in one)
    assert {(r["n"], r["deviation"]) for r in one} == {(1, 0)}
    flat = whiten(spark.createDataFrame([(1, [0.0, 1.0], 0), (2, [0.5, 1.0], 0)], SCHEMA)).collect()
    assert sorted((r["vec_id"], r["component"], r["explained"]) for r in flat) == [(1, 1, 1.0), (1, 2, 0.0), (2, 1, 1.0), (2, 2, 0.0)]
    assert [abs(r["whitened"]) for r in flat if r["component"] == 1] == [1.0, 1.0]
    assert all(r["whitened"] is None for r in flat if r["component"] == 2)
    assert whiten(spark.createDataFrame([], SCHEMA)).count() == 0
    assert whiten(spark.createDataFrame([(1, [], 0)], SCHEMA)).count() == 0


def test_values_beyond_64_bits(spark):
    rows = [(1, [3e38, 1.0]), (2, [-3e38, 2.0]), (3, [1e30, 3.0])]
    got = whiten(spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)).collect()
    assert len(got) == 6 and all(r["deviation"] is None and int(r["deviation_digits"]) > 2 ** 63 for r in got)
    assert all(r["identity_error"] < 1e-4 for r in got)


def test_given_embeddings(spark, sf_dir):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    compare(queries.op12_embedding_whitening(spark, sf_dir).collect(), rows)
