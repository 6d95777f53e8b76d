"""Semantic traps on inline micro-fixtures."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from sensorflow.functions.missing import mean_skip, mean_strict, nan_to_null, standard_error
from sensorflow.operators.depth import correct_depth, lookup_depth, validate_corrections
from sensorflow.operators.quality import (
    any_flag_passes, gross_range, mask_rules, qc_series, qf_mask, qf_or_after_date,
)
from sensorflow.operators.reshape import (
    coalesce_value, drop_matching, keep_existing, terms_to_columns, to_long, union_all,
)
from sensorflow.operators.rollup import hourly_mean, merge_sources
from sensorflow.plans import targets as tg
from sensorflow.sources import demo, rules

D = dt.date
T = dt.datetime
NAN = float("nan")


def test_nan_and_null_are_both_missing(spark):                       # S1
    df = spark.createDataFrame([("a", NAN), ("a", None), ("b", 1.0), ("b", NAN)],
                               "k string, v double")
    out = {r.k: r.m for r in df.groupBy("k").agg(mean_skip(nan_to_null("v")).alias("m"))
           .collect()}
    assert out == {"a": None, "b": 1.0}


def test_strict_mean_vs_skipping_mean(spark):                         # S2
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("b", 1.0), ("b", 3.0)],
                               "k string, v double")
    r = {x.k: (x.s, x.m) for x in df.groupBy("k").agg(
        mean_skip("v").alias("s"), mean_strict("v").alias("m")).collect()}
    assert r == {"a": (1.0, None), "b": (2.0, 2.0)}


def test_standard_error(spark):
    df = spark.createDataFrame([(1.0,), (3.0,), (None,)], "v double")
    se = df.agg(standard_error("v").alias("se")).first().se
    assert se == pytest.approx(2 ** 0.5 / 2 ** 0.5)


def _qc_fixture(spark):
    vals = [10.0, 10.0, 16.0, None, 12.0, 40.0, 33.0, 50.0]
    rows = [("s", D(2020, 1, i + 1), v) for i, v in enumerate(vals)]
    return spark.createDataFrame(rows, "site_id string, time date, observed double")


def test_qc_keep_mode(spark):                                          # S3, S8, S9
    out = qc_series(_qc_fixture(spark), ["site_id"], "time", "observed", -5, 40, 6,
                    unknown="keep")
    got = [r.observed for r in out.orderBy("time").collect()]
    # first row kept (unknown), flat 10->10 removed, change exactly = spike kept (6 > 6
    # is false), NULL stays NULL, row after NULL kept, 40 = bound kept, 40->33 is a
    # 7 jump > 6 removed, 50 out of range removed
    assert got == [10.0, None, 16.0, None, 12.0, None, None, None]


def test_qc_reject_mode(spark):                                        # S3
    out = qc_series(_qc_fixture(spark), ["site_id"], "time", "observed", -5, 40, 6,
                    unknown="reject")
    got = [r.observed for r in out.orderBy("time").collect()]
    # first row and the row after a NULL are lost; the rest as in keep mode
    assert got == [None, None, 16.0, None, None, None, None, None]


def test_qc_strict_subset_of_keep(spark):
    s = _qc_fixture(spark)
    keep = {r.time: r.observed for r in qc_series(s, ["site_id"], "time").collect()}
    strict = {r.time: r.observed for r in qc_series(s, ["site_id"], "time",
                                                    unknown="reject").collect()}
    assert set(keep) == set(strict)
    assert all(keep[t] == v for t, v in strict.items() if v is not None)


def test_unpivot_keeps_nulls_and_pivot_roundtrip(spark):               # S6
    w = spark.createDataFrame([("a", 1.0, None), ("b", None, 2.0)],
                              "site_id string, oxygen double, chla double")
    long = to_long(w, ["site_id"], ["oxygen", "chla"])
    assert long.count() == 4
    back = terms_to_columns(long, ["site_id"], ["oxygen", "chla"], "variable", "observed")
    assert sorted(back.collect()) == sorted(w.collect())


def test_terms_to_columns_missing_term_and_duplicates(spark):          # RSH-2, PRJ-9
    rows = [("X", "t1", 1.0, None), ("X", "t1", 3.0, None), ("X", "aQF", None, 0),
            ("X", "aQF", None, 1)]
    df = coalesce_value(spark.createDataFrame(
        rows, "siteName string, termName string, doubleValue double, intValue int"))
    w = terms_to_columns(df, ["siteName"], ["t1", "t2", "aQF"]).first()
    assert (w.t1, w.t2, w.aQF) == (2.0, None, 1.0)


def test_archive_mask_per_value_vs_provisional_any_flag(spark):        # S10
    df = spark.createDataFrame([(5.0, 1, 0), (6.0, 0, None)],
                               "v double, aQF int, bQF int")
    masked = [r.m for r in df.select(qf_mask("v", "aQF").alias("m")).collect()]
    assert masked == [None, 6.0]
    # row 1: aQF fails but bQF passes -> the whole row (and its failed value) is kept
    assert any_flag_passes(df).count() == 2
    assert any_flag_passes(df.withColumn("bQF", F.lit(None).cast("int"))).count() == 1


def test_merge_mean_of_means_vs_union(spark):                          # S11
    a = spark.createDataFrame([("s", 1.0), ("s", 3.0)], "k string, observed double") \
        .groupBy("k").agg(F.avg("observed").alias("observed"))
    b = spark.createDataFrame([("s", 10.0)], "k string, observed double")
    assert merge_sources(a, b, keys=["k"]).first().observed == 6.0
    assert merge_sources(a, b, keys=["k"], mode="union").count() == 2


def test_gross_range_and_unknown_variable(spark):
    df = spark.createDataFrame([("oxygen", 1.0), ("oxygen", 15.0), ("chla", 201.0),
                                ("other", 5.0)], "variable string, observed double")
    out = [r.observed for r in gross_range(df, rules.ranges(spark)).collect()]
    assert sorted(out, key=lambda v: (v is None, v)) == [15.0, None, None, None]
    keep = gross_range(df, rules.ranges(spark), unknown="keep")
    assert keep.where("variable = 'other'").first().observed == 5.0


def test_mask_rules_no_row_multiplication(spark):                      # FLT-12
    masks = spark.createDataFrame(
        [("S", "oxygen", None, None, 4.0, None), ("S", "oxygen", None, None, None, 11.0),
         ("S", "oxygen", D(2020, 1, 2), D(2020, 1, 2), None, None)], rules.MASKS_SCHEMA)
    df = spark.createDataFrame(
        [(D(2020, 1, 1), "S", "oxygen", 3.0), (D(2020, 1, 1), "S", "oxygen", 5.0),
         (D(2020, 1, 1), "S", "oxygen", 12.0), (D(2020, 1, 2), "S", "oxygen", 5.0),
         (D(2020, 1, 1), "S", "chla", 3.0), (D(2020, 1, 1), "S", "oxygen", None)],
        "time date, site_id string, variable string, observed double")
    out = mask_rules(df, masks)
    assert out.count() == 6
    assert sorted([r.observed for r in out.collect() if r.observed is not None]) == [3.0, 5.0]


def test_depth_correction_interval_edges_and_null_position(spark):     # JON-3, S15
    df = spark.createDataFrame(
        [("BARC", T(2021, 6, 7, 23, 30), 502, 9.9), ("BARC", T(2021, 6, 8, 0, 0), 502, 9.9),
         ("BARC", T(2022, 1, 7, 12, 0), 502, 9.9), ("BARC", T(2022, 1, 8, 0, 0), 502, 9.9),
         ("BARC", T(2030, 1, 1, 0, 0), 510, 9.9), ("BARC", T(2021, 1, 1, 0, 0), None, 9.9),
         ("CRAM", T(2020, 10, 31, 0, 0), 505, 9.9), ("CRAM", T(2020, 11, 1, 0, 0), 505, 9.9)],
        "site_id string, startDateTime timestamp_ntz, verticalPosition int, depth double")
    validate_corrections(rules.depth_corrections(spark))
    out = correct_depth(df, rules.depth_corrections(spark))
    got = [r.depth for r in out.orderBy("site_id", "startDateTime").collect()]
    assert got == [9.9, 0.55, 0.3, 0.3, 0.55, 3.05, 10.25, 9.9]


def test_overlapping_corrections_rejected(spark):
    bad = spark.createDataFrame([("X", 501, None, D(2020, 1, 5), 1.0),
                                 ("X", 501, D(2020, 1, 5), None, 2.0)], rules.CORRECTIONS_SCHEMA)
    with pytest.raises(ValueError):
        validate_corrections(bad)


def test_lookup_drops_unknown_sensors_and_zero_depth_is_surface(spark):  # JON-1, S17
    df = spark.createDataFrame([("BARC", "508"), ("BARC", "599"), ("ZZZZ", "501")],
                               "siteName string, verticalIndex string")
    out = lookup_depth(df, rules.depth_lookup(spark)).collect()
    assert [(r.verticalIndex, r.thermistorDepth) for r in out] == [("508", 0.0)]


def test_failed_flag_kept_after_cutoff(spark):                         # S14
    df = spark.createDataFrame([(0, T(2020, 1, 1)), (1, T(2020, 7, 1)), (1, T(2020, 7, 2)),
                                (None, T(2021, 1, 1))], "qf int, t timestamp_ntz")
    out = qf_or_after_date(df, "qf", "t", rules.ACCEPT_FAILED_AFTER)
    assert sorted(r.t for r in out.collect()) == [T(2020, 1, 1), T(2020, 7, 2)]


def test_hourly_depth_rounding_half_up(spark):                          # S4
    df = spark.createDataFrame([("s", T(2020, 1, 1, 0, 10), 0.15, 1.0),
                                ("s", T(2020, 1, 1, 0, 40), 0.2, 3.0),
                                ("s", T(2020, 1, 1, 0, 50), 1.05, 5.0)],
                               "site_id string, t timestamp_ntz, depth double, v double")
    out = {r.depth: r.observed for r in hourly_mean(df, ["site_id", "depth"], "t",
                                                    {"observed": "v"},
                                                    round_depth="depth").collect()}
    assert out == {0.2: 2.0, 1.1: 5.0}


def test_archive_wq_scan_coerces_text_and_depth_window(spark):        # S7, FLT-2
    rows = [("BARC", T(2020, 1, 1), "NA", "8.0", 0, "1.0", 0),
            ("BARC", T(2020, 1, 1), None, "9.0", 0, "1.0", 0),
            ("BARC", T(2020, 1, 1), "0.5", "x", 0, "1.0", 0),
            ("BARC", T(2020, 1, 1), "0", "7.0", 0, "1.0", 0),
            ("BARC", T(2020, 1, 1), "1.0", "7.0", 0, "1.0", 0),
            ("NOPE", T(2020, 1, 1), "0.5", "7.0", 0, "1.0", 0)]
    df = spark.createDataFrame(rows, "siteID string, startDateTime timestamp_ntz, "
                               "sensorDepth string, dissolvedOxygen string, "
                               "dissolvedOxygenFinalQF int, chlorophyll string, "
                               "chlorophyllFinalQF int")
    out = tg.archive_wq_scan(df, demo.sites(spark)).collect()
    # 'NA' and NULL depths count as surface; 0 and 1.0 are outside (0, 1); unknown site
    assert len(out) == 3
    assert sorted((r.dissolvedOxygen is None) for r in out) == [False, False, True]


def test_union_by_name_missing_columns(spark):                         # SET-1
    a = spark.createDataFrame([(1, "x")], "a int, b string")
    b = spark.createDataFrame([("y", 2.0)], "b string, c double")
    u = union_all(a, b)
    assert u.columns == ["a", "b", "c"] and u.count() == 2


def test_keep_existing_and_drop_matching(spark):                       # PRJ-6, PRJ-7
    df = spark.createDataFrame([(1, 2, 3)], "x int, flagged_spike int, temp_change int")
    assert keep_existing(df, ["temp_change", "missing", "x"]).columns == ["temp_change", "x"]
    assert drop_matching(df, "flag|temp_change").columns == ["x"]


def test_provisional_depths_rounding_option(spark):                     # S5
    from sensorflow.operators.provisional import provisional_tsd_profile_hourly
    recs = [("BARC", "tsdWaterTempMean", T(2024, 1, 1, 0, 0), 5.0, None, "501", "103", "030"),
            ("BARC", "tsdWaterTempFinalQF", T(2024, 1, 1, 0, 0), None, 0, "501", "103", "030")]
    from sensorflow.sources import schemas
    long = spark.createDataFrame(recs, schemas.PROVISIONAL)
    raw = provisional_tsd_profile_hourly(long, rules.depth_lookup(spark)).first()
    rnd = provisional_tsd_profile_hourly(long, rules.depth_lookup(spark), round_depth=True).first()
    assert (raw.depth, rnd.depth) == (0.05, 0.1)


def test_qc_by_source_uses_each_sources_parameters(spark):              # QC params table
    from sensorflow.operators.quality import qc_by_source
    vals = [10.0, 16.0, 16.5]
    rows = [(src, "S", D(2020, 1, i + 1), v) for src in ("strict", "lenient")
            for i, v in enumerate(vals)]
    df = spark.createDataFrame(rows, "source string, site_id string, time date, "
                                     "observed double")
    params = spark.createDataFrame([("strict", -5.0, 40.0, 5.0, False),
                                    ("lenient", -5.0, 40.0, 7.0, True)], rules.QC_SCHEMA)
    out = qc_by_source(df, params, ["source", "site_id"])
    got = {(r.source, r.time.day): r.observed for r in out.collect()}
    # strict: first row lost (unknown), 10->16 is a 6 jump > 5 removed, 16.5 kept
    assert [got[("strict", d)] for d in (1, 2, 3)] == [None, None, 16.5]
    # lenient: unknown kept, a 6 jump is within 7
    assert [got[("lenient", d)] for d in (1, 2, 3)] == [10.0, 16.0, 16.5]
    # a source without parameters, e.g. a misspelt one, is an error
    with pytest.raises(Exception, match="no QC parameters for source lenient"):
        qc_by_source(df, params.where("source = 'strict'"), ["source", "site_id"]).collect()


def test_incremental_qc_equals_full_history(spark):                     # daily refresh
    import random

    from sensorflow.operators.quality import qc_incremental
    rnd = random.Random(3)
    rows = [(s, D(2020, 1, 1) + dt.timedelta(days=i),
             None if rnd.random() < 0.1 else round(rnd.uniform(0, 20), 1))
            for s in ("A", "B") for i in range(120)]
    full = spark.createDataFrame(rows, "site_id string, time date, observed double")
    cut = F.lit(D(2020, 3, 15))
    hist, new = full.where(F.col("time") < cut), full.where(F.col("time") >= cut)
    for mode in ("keep", "reject"):
        want = qc_series(full, ["site_id"], "time", spike=6.0, unknown=mode) \
            .where(F.col("time") >= cut)
        got = qc_incremental(new, hist, ["site_id"], spike=6.0, unknown=mode)
        assert sorted(map(tuple, got.select("site_id", "time", "observed").collect()),
                      key=lambda t: (t[0], t[1])) == sorted(
            map(tuple, want.select("site_id", "time", "observed").collect()),
            key=lambda t: (t[0], t[1]))


def test_incremental_qc_with_new_rows_between_old_ones(spark):
    import random

    from sensorflow.operators.quality import qc_incremental
    rnd = random.Random(4)
    rows = [(s, D(2020, 1, 1) + dt.timedelta(days=i), round(rnd.uniform(0, 20), 1))
            for s in ("A", None) for i in range(60)]
    full = spark.createDataFrame(rows, "site_id string, time date, observed double")
    is_new = (F.dayofyear("time") % 2 == 0) & (F.col("time") >= F.lit(D(2020, 1, 20)))
    got = qc_incremental(full.where(is_new), full.where(~is_new), ["site_id"], spike=6.0)
    want = qc_series(full, ["site_id"], "time", spike=6.0).where(F.col("time") >= F.lit(D(2020, 1, 20)))
    cols = ["site_id", "time", "observed"]
    assert sorted(map(str, got.select(cols).collect())) == sorted(map(str, want.select(cols).collect()))


def test_repeated_rules_do_not_multiply_rows(spark):
    from sensorflow.operators.depth import correct_depth, lookup_depth, validate_corrections
    rule = ("S", 1, None, D(2021, 1, 1), 0.5)
    rules_twice = spark.createDataFrame([rule, rule, ("S", 1, D(2021, 1, 2), None, 0.7)], rules.CORRECTIONS_SCHEMA)
    validate_corrections(rules_twice)
    df = spark.createDataFrame([("S", 1, T(2020, 5, 1), 9.0), ("S", 1, T(2021, 1, 1, 23), 9.0),
                                ("S", 1, T(2021, 1, 2), 9.0), ("S", 2, T(2020, 5, 1), 9.0), (None, 1, T(2020, 5, 1), 9.0)],
                               "site_id string, verticalPosition int, startDateTime timestamp_ntz, depth double")
    got = correct_depth(df, rules_twice).collect()
    assert sorted(r.depth for r in got) == [0.5, 0.5, 0.7, 9.0, 9.0]
    lookup = spark.createDataFrame([("S", "1", 0.1), ("S", "1", 0.1)], rules.DEPTH_LOOKUP_SCHEMA)
    long = spark.createDataFrame([("S", "1")], "siteName string, verticalIndex string")
    assert lookup_depth(long, lookup).count() == 1


def test_values_on_thresholds_and_ties(spark):
    rows = [("S", D(2020, 1, i + 1), v) for i, v in enumerate([40.0, 35.0, 35.0 + 1e-12, 40.1, -5.0])]
    df = spark.createDataFrame(rows, "site_id string, time date, observed double")
    got = {r.time.day: r.observed for r in qc_series(df, ["site_id"], "time", spike=50.0).collect()}
    # the edges are inside; a change below the ninth place is none
    assert got == {1: 40.0, 2: 35.0, 3: None, 4: None, 5: -5.0}
    spike = {r.time.day: r.observed for r in qc_series(df, ["site_id"], "time", spike=5.0).collect()}
    assert spike[2] == 35.0 and spike[4] is None


def test_superseding_goes_by_the_values_that_enter(spark):
    """An archive that has only failed records of a month does not cover it, nor another site's."""
    from sensorflow.plans.targets import archive_wq_daily
    from sensorflow.sources import demo, schemas
    wq = spark.createDataFrame([
        ("BARC", T(2024, 1, 5), "0.5", "8", "0", 0, "1", "0", 0), ("BARC", T(2024, 2, 5), "0.5", "8", "0", 1, "1", "0", 1),
        ("FLNT", T(2024, 3, 5), "0.5", "8", "0", 0, "1", "0", 0)], schemas.ARCHIVE_WATER_QUALITY)
    from sensorflow.streaming.refresh import supersede
    entering = archive_wq_daily(wq, demo.sites(spark)).where("observed IS NOT NULL")
    prov = spark.createDataFrame([("BARC", T(2024, m, 9)) for m in (1, 2, 3)], "siteName string, startDate timestamp_ntz")
    kept = supersede(prov, entering, "startDate", "time", {"siteName": "site_id"}).collect()
    assert sorted(r.startDate.month for r in kept) == [2, 3]
