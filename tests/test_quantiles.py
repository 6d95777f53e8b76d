"""Exact quantiles against numpy."""

import random
import re

import numpy as np

from sensorflow.operators import quantiles
from sensorflow.operators.quantiles import exact_quantiles


def test_equal_to_numpy_with_ties_and_outliers(spark):
    rng = random.Random(3)
    groups = {"even": [rng.random() for _ in range(4_000)], "tied": [1.0] * 2_500 + [2.0] * 900 + [rng.random() for _ in range(600)],
              "far": [rng.gauss(0, 1) for _ in range(1_500)] + [1e300, -1e300, 1e-300], "one": [5.0], "two": [1.0, 2.0], None: [3.0, -0.5, 9.0]}
    rows = [(k, x) for k, xs in groups.items() for x in xs] + [("even", None), ("even", float("nan")), ("none", None)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "site string, v double").repartition(6)
    probs = [0.0, 0.025, 0.5, 0.975, 1.0]
    for gather in (20, 10_000):
        got = {(r.site, r.prob): r.quantile for r in exact_quantiles(df, ["site"], "v", probs, gather=gather).collect()}
        assert got.keys() == {(k, p) for k in groups for p in probs}
        for (k, p), q in got.items():
            want = float(np.quantile(groups[k], p))
            assert q == want or abs(q - want) <= 1e-15 * abs(want), (k, p, q, want)
    assert exact_quantiles(df.limit(0), ["site"], "v", probs).count() == 0


def test_no_step_shuffles_a_group_to_one_task(spark, tmp_path, monkeypatch):
    spark.range(3_000).selectExpr("id % 2 as g", "cast(id as double) as v").write.parquet(f"{tmp_path}/rows")
    plans, written = [], quantiles._written
    monkeypatch.setattr(quantiles, "_written", lambda d: plans.append(d._jdf.queryExecution().executedPlan().toString()) or written(d))
    found = exact_quantiles(spark.read.parquet(f"{tmp_path}/rows"), ["g"], "v", [0.5], gather=20)
    plans.append(found._jdf.queryExecution().executedPlan().toString())
    assert sorted((r.g, r.quantile) for r in found.collect()) == [(0, 1499.0), (1, 1500.0)]
    assert len(plans) >= 4
    # by the group alone only its count, least and greatest value are dealt out
    assert not any(re.search(r"SortMergeJoin \[k#\d+\]", p) for p in plans)
