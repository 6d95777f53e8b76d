"""Kept differences: twelve batches against one pass, late rows, series without values."""

import datetime as dt
import math
import statistics

import pytest
from pyspark.sql import functions as F

from sensorflow.operators.differences import difference_state, differences_of, update_differences

SCHEMA = "site_id string, variable string, time date, observed double, n int, mean string"
DAY = dt.date(2021, 1, 25)


def rows():
    out = []
    for i in range(400):
        value = None if i % 11 == 0 else float("nan") if i % 29 == 0 else 1e5 + math.sin(i) * 7
        out += [(s, None, DAY + dt.timedelta(days=i), value, 1, "own") for s in ("a", "b") if s == "a" or i < 150]
    return [*out, ("none", "v", DAY, None, 1, ""), ("one", "v", DAY, 4.0, 1, ""), ("a", None, None, 9.0, 1, "")]


def test_twelve_batches_equal_one_pass(spark, tmp_path):
    data = rows()
    df = spark.createDataFrame(data, SCHEMA).cache()
    for i in range(12):  # most batches end inside a month
        at = F.coalesce(F.floor(F.datediff("time", F.lit(DAY)) / 34), F.lit(0))
        state = update_differences(df.where(at == i), str(tmp_path), i)
    got = {(r["site_id"], r["variable"]): r for r in differences_of(state).collect()}
    once = {(r["site_id"], r["variable"]): r for r in differences_of(difference_state(df)).collect()}
    assert set(got) == set(once) == {("a", None), ("b", None), ("one", "v")}
    for key, r in got.items():
        known = [(x[2], x[3]) for x in data if (x[0], x[1]) == key and x[2] and x[3] is not None and x[3] == x[3]]
        values = [v for _, v in sorted(known)]
        d = [y - x for x, y in zip(values, values[1:])]
        for found in (r, once[key]):
            assert (found["n_diff"], found["last_time"], found["last_value"]) == (len(d), max(known)[0], values[-1])
            assert found["diff_sd"] == (pytest.approx(statistics.stdev(d), rel=1e-9) if len(d) > 1 else None)
    df.unpersist()


def test_late_rows_are_an_error_and_a_batch_counts_once(spark, tmp_path):
    def batch(*days):
        return spark.createDataFrame([("a", "v", dt.date(2021, 3, d), float(d * d), 0, "") for d in days], SCHEMA)

    first = update_differences(batch(1, 4), str(tmp_path), 0).collect()
    assert update_differences(batch(1, 4), str(tmp_path), 0).collect() == first
    for late in (batch(2, 9), batch(4)):
        with pytest.raises(Exception, match="build the state anew"):
            update_differences(late, str(tmp_path), 1)
    state = update_differences(batch(6, 9), str(tmp_path), 1)
    r = differences_of(state).first()
    assert (r["n_diff"], r["last_value"]) == (3, 81.0)
    assert r["diff_sd"] == pytest.approx(statistics.stdev([15, 20, 45]))
    assert update_differences(batch(6).limit(0), str(tmp_path), 2).collect() == state.collect()
