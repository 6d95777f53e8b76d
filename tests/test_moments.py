"""Mergeable moments: twelve merges against one pass, retries, series without values."""

import math
import statistics

import pytest
from pyspark.sql import functions as F

from sensorflow.operators import moments


def rows(n=2_400):
    return [(f"s{i % 3}", f"k{i % 5}", i % 12, None if i % 17 == 0 else float("nan") if i % 23 == 0
             else 1e6 + math.sin(i) * 3) for i in range(n)]


def test_twelve_merges_equal_one_pass(spark, tmp_path):
    data = rows()
    df = spark.createDataFrame(data, "site string, kind string, month int, v double").cache()
    for month in range(12):
        state = moments.update_state(df.where(F.col("month") == month), ["site", "kind"], "v", str(tmp_path), month)
    got = {(r["site"], r["kind"]): r for r in moments.mean_and_sd(state, ["site", "kind"]).collect()}
    groups = {}
    for site, kind, _, v in data:
        groups.setdefault((site, kind), []).append(v)
    assert set(got) == set(groups)
    for key, values in groups.items():
        known = [v for v in values if v is not None and not math.isnan(v)]
        assert got[key]["mean"] == pytest.approx(statistics.fmean(known), rel=1e-12)
        assert got[key]["sd"] == pytest.approx(statistics.stdev(known), rel=1e-9)
    df.unpersist()


def test_a_batch_counts_once_and_a_failed_one_is_written_anew(spark, tmp_path):
    schema = "k int, v double"
    first = spark.createDataFrame([(1, 1.0), (1, 3.0), (2, None)], schema)
    moments.update_state(first, ["k"], "v", str(tmp_path), 0)
    again = moments.update_state(first, ["k"], "v", str(tmp_path), 0)
    assert {(r["k"], r["n"], r["mean"], r["m2"]) for r in again.collect()} == {(1, 2, 2.0, 2.0), (2, 0, None, None)}
    second = spark.createDataFrame([(1, 5.0), (2, 7.0), (3, 4.0)], schema)
    moments.update_state(second, ["k"], "v", str(tmp_path), 1)
    marker = tmp_path / "state-000000000001" / "_SUCCESS"
    marker.unlink()  # as a job that was killed leaves it
    with pytest.raises(ValueError, match="not completed"):
        moments.read_state(spark, str(tmp_path), 1)
    state = moments.update_state(second, ["k"], "v", str(tmp_path), 1)
    out = {r["k"]: (r["mean"], r["sd"]) for r in moments.mean_and_sd(state, ["k"]).collect()}
    assert out == {1: (3.0, 2.0), 2: (7.0, None), 3: (4.0, None)}
    with pytest.raises(ValueError, match="not there"):
        moments.update_state(second, ["k"], "v", str(tmp_path), 7)


def test_a_null_key_is_a_key_and_an_empty_batch_changes_nothing(spark, tmp_path):
    df = spark.createDataFrame([(None, 1.0), (None, 2.0)], "k int, v double")
    before = moments.update_state(df, ["k"], "v", str(tmp_path), 0).collect()
    assert moments.update_state(df.limit(0), ["k"], "v", str(tmp_path), 1).collect() == before
