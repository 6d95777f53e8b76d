"""The bucketed scans equal plain whole-series windows (property tests on random series)."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from sensorflow.operators.seriesscan import (
    known_neighbours, lag_columns, linear_fill, row_index,
)


def _nk(row):
    return tuple((v is None, v if v is not None else 0) for v in row)


def _sorted(rows):
    return sorted((tuple(r) for r in rows), key=_nk)


def _series(spark, seed, n=400):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        key = rnd.choice(["a", "b", None])
        sub = rnd.choice([1, 2])
        # sparse days over ~3 years so that many buckets are empty
        t = dt.date(2019, 1, 1) + dt.timedelta(days=rnd.randrange(0, 1100))
        v = None if rnd.random() < 0.3 else round(rnd.uniform(-5, 30), 3)
        rows.append((key, sub, t, i, v))
    return spark.createDataFrame(rows, "k string, s int, t date, tie int, v double")


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_lag_matches_window(spark, seed):
    df = _series(spark, seed)
    w = Window.partitionBy("k", "s").orderBy("t", "tie")
    want = df.withColumn("prev_v", F.lag("v").over(w)).withColumn("prev_t", F.lag("t").over(w))
    got = lag_columns(df, ["k", "s"], ["t", "tie"], ["v", "t"])
    cols = ["k", "s", "t", "tie", "v", "prev_v", "prev_t"]
    assert _sorted(got.select(cols).collect()) == _sorted(want.select(cols).collect())


@pytest.mark.parametrize("seed", [4, 5])
def test_lag_single_time_key_uses_hash_summary(spark, seed):
    df = _series(spark, seed).dropDuplicates(["k", "s", "t"])
    w = Window.partitionBy("k", "s").orderBy("t")
    want = df.withColumn("prev_v", F.lag("v").over(w))
    got = lag_columns(df, ["k", "s"], ["t"], ["v"])
    cols = ["k", "s", "t", "v", "prev_v"]
    assert _sorted(got.select(cols).collect()) == _sorted(want.select(cols).collect())


@pytest.mark.parametrize("seed", [6, 7])
def test_row_index_and_neighbours_match_window(spark, seed):
    df = _series(spark, seed)
    w = Window.partitionBy("k", "s").orderBy("t", "tie")
    x = F.datediff("t", F.lit(dt.date(2019, 1, 1)))
    known = F.when(F.col("v").isNotNull(), F.struct(F.col("v").alias("v"), x.alias("x")))
    want = (df.withColumn("idx", F.row_number().over(w).cast("long"))
            .withColumn("p", F.last(known, True).over(
                w.rowsBetween(Window.unboundedPreceding, 0)))
            .withColumn("n", F.first(known, True).over(
                w.rowsBetween(0, Window.unboundedFollowing))))
    got = known_neighbours(row_index(df, ["k", "s"], ["t", "tie"]), ["k", "s"],
                           ["t", "tie"], "v", x)
    a = _sorted((r.k, r.s, r.tie, r.idx, r.prev_v, r.prev_x, r.next_v, r.next_x)
                for r in got.collect())
    b = _sorted((r.k, r.s, r.tie, r.idx, r.p.v if r.p else None, r.p.x if r.p else None,
                 r.n.v if r.n else None, r.n.x if r.n else None) for r in want.collect())
    assert a == b


def test_linear_fill_ends_and_gaps(spark):
    rows = [("a", dt.date(2020, 1, d), v) for d, v in
            [(1, None), (2, 1.0), (3, None), (4, None), (5, 4.0), (6, None)]]
    rows += [("b", dt.date(2020, 1, 1), None), ("c", dt.date(2020, 3, 1), 7.0),
             ("c", dt.date(2020, 1, 1), None)]
    df = spark.createDataFrame(rows, "k string, t date, v double")
    x = F.datediff("t", F.lit(dt.date(2020, 1, 1)))
    got = {(r.k, r.t.isoformat()): r.f for r in linear_fill(df, ["k"], ["t"], "v", x,
                                                             "f").collect()}
    assert got[("a", "2020-01-01")] == 1.0          # leading gap held constant
    assert got[("a", "2020-01-03")] == 2.0          # straight line 1 -> 4
    assert got[("a", "2020-01-04")] == 3.0
    assert got[("a", "2020-01-06")] == 4.0          # trailing gap held constant
    assert got[("b", "2020-01-01")] is None         # no known value at all
    assert got[("c", "2020-01-01")] == 7.0          # one known value: constant
