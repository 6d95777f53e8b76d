"""Disjoint segments of dated rules against brute force over days, and against the packed rules."""

import datetime as dt
import random

from pyspark.sql import functions as F

from sensorflow.operators.depth import correct_depth
from sensorflow.operators.segments import apply_segments, rule_segments

RULES = "site_id string, vertical_position int, valid_from date, valid_to date, depth double"
ROWS = "n int, site string, pos int, at date, depth double, segment_from string"
KEYS = ["site_id", "vertical_position"]
DAY = dt.date(2020, 1, 1)


def some_rules(rng, n):
    out = []
    for i in range(n):
        a = None if rng.random() < 0.1 else DAY + dt.timedelta(days=rng.randrange(400))
        b = None if rng.random() < 0.1 else (a or DAY) + dt.timedelta(days=rng.randrange(-3, 90))
        out.append((rng.choice("ab"), rng.randrange(2), a, b, None if rng.random() < 0.1 else float(i)))
    return [*out, out[0], (None, 1, DAY, None, 5.0), ("a", None, DAY, None, 6.0)]


def counting(rules, site, pos, day):
    low = dt.date.min
    found = [r for r in rules if (r[0], r[1]) == (site, pos) and (r[2] or low) <= day <= (r[3] or dt.date.max)]
    return max(found, default=None, key=lambda r: (r[2] is not None, r[2] or low, r[3] is not None, r[3] or low,
                                                   r[4] is not None, r[4] or 0))


def test_segments_equal_brute_force(spark):
    rules = some_rules(random.Random(1), 60)
    found = rule_segments(spark.createDataFrame(rules, RULES), KEYS, "valid_from", "valid_to", ["depth"]).collect()
    days = [dt.date.min, dt.date.max, *[DAY + dt.timedelta(days=i) for i in range(-5, 520)]]
    for site in "ab":
        for pos in (0, 1):
            own = [r for r in found if (r["site_id"], r["vertical_position"]) == (site, pos)]
            for day in days:
                hit = [r for r in own if r["segment_from"] <= day <= r["segment_to"]]
                rule = counting(rules, site, pos, day)
                assert len(hit) == (rule is not None)
                assert not hit or hit[0]["depth"] == rule[4]
    assert {r["site_id"] for r in found} == {"a", "b"}


def test_rows_keep_their_number_and_equal_the_packed_rules(spark):
    rng = random.Random(2)
    rules = spark.createDataFrame(some_rules(rng, 80), RULES)
    rows = [(i, rng.choice(["a", "b", "c", None]), rng.choice([0, 1, None]),
             rng.choice([None, dt.date(1, 1, 1), dt.date(1850, 5, 5), dt.date(9999, 12, 31)]) if i % 20 == 0
             else DAY + dt.timedelta(days=rng.randrange(-10, 520)), -1.0, "own") for i in range(400)]
    df = spark.createDataFrame(rows, ROWS)
    segments = rule_segments(rules, KEYS, "valid_from", "valid_to", ["depth"])
    on = {"site": "site_id", "pos": "vertical_position"}
    got = apply_segments(df.drop("segment_from"), segments, on, "at", "depth", "depth", bin_days=16)
    packed = correct_depth(df.drop("segment_from"), rules, "site", "pos", "at", "depth")
    assert got.columns == packed.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, packed.collect()))
    assert got.where(F.col("depth") >= 0).count() > 100


def test_columns_named_as_the_segments_have_them_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "a", 0, DAY, -1.0, "own")], ROWS)
    rules = spark.createDataFrame([("a", 0, None, None, 2.0)], RULES)
    on = {"site": "site_id", "pos": "vertical_position"}
    segments = rule_segments(rules, KEYS, "valid_from", "valid_to", ["depth"])
    got = apply_segments(df, segments, on, "at", "depth", "depth").collect()
    assert [(r["depth"], r["segment_from"]) for r in got] == [(2.0, "own")]
    none = rule_segments(rules.limit(0), KEYS, "valid_from", "valid_to", ["depth"])
    assert none.count() == 0
    assert [r["depth"] for r in apply_segments(df, none, on, "at", "depth", "depth").collect()] == [-1.0]
    assert apply_segments(df.limit(0), segments, on, "at", "depth", "depth").count() == 0


def joins_of(df, column):
    """Lines of the plan with a join by this column."""
    return [x for x in df._jdf.queryExecution().executedPlan().toString().splitlines() if "Join" in x and column in x]


def test_neither_lookups_nor_blocks_go_through_the_driver(spark, tmp_path):
    spark.createDataFrame(some_rules(random.Random(4), 40), RULES).write.parquet(f"{tmp_path}/rules")
    segments = rule_segments(spark.read.parquet(f"{tmp_path}/rules"), KEYS, "valid_from", "valid_to", ["depth"])
    joins = joins_of(segments, "__block")
    assert joins and not any("Broadcast" in x for x in joins), joins


def test_rules_that_begin_on_one_day_and_outer_dates(spark):
    low, high, day = dt.date.min, dt.date.max, dt.timedelta(days=1)
    rules = [("a", 0, None, DAY, 1.0), ("a", 0, low, DAY - 9 * day, 2.0), ("a", 0, low, None, 3.0), ("a", 0, None, None, 4.0),
             ("a", 0, DAY, DAY + 3 * day, 5.0), ("a", 0, DAY, DAY + day, 6.0), ("a", 0, DAY, None, 7.0), ("a", 0, DAY, DAY + 3 * day, None),
             ("a", 0, DAY + 20 * day, high, 8.0), ("a", 0, DAY + 20 * day, None, 9.0), ("a", 0, DAY + 20 * day, DAY + 30 * day, 10.0)]
    found = rule_segments(spark.createDataFrame(rules, RULES), KEYS, "valid_from", "valid_to", ["depth"]).collect()
    for at in (low, low + day, high, *[DAY + i * day for i in range(-12, 40)]):
        assert [r["depth"] for r in found if r["segment_from"] <= at <= r["segment_to"]] == [counting(rules, "a", 0, at)[4]]
    opens = {r[2] or low for r in rules} | {r[3] + day for r in rules if r[3] and r[3] < high}
    assert {r["segment_from"] for r in found} == opens


def test_lists_of_segments_do_not_go_through_the_driver(spark, tmp_path):
    segments = spark.createDataFrame([("a", 0, DAY, DAY, 2.0)], "site_id string, vertical_position int, segment_from date, segment_to date, depth double")
    segments.write.parquet(f"{tmp_path}/segments")
    df = spark.createDataFrame([(1, "a", 0, DAY, -1.0, "own")], ROWS)
    got = apply_segments(df, spark.read.parquet(f"{tmp_path}/segments"), {"site": "site_id", "pos": "vertical_position"}, "at", "depth", "depth")
    joins = joins_of(got, "__bin")
    assert joins and not any("Broadcast" in x for x in joins), joins
    assert [r["depth"] for r in got.collect()] == [2.0]
