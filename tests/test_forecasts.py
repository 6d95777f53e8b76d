"""Climatology and random-walk forecasts on small series."""

import datetime as dt
import math

from sensorflow.operators.climatology import (
    climatology_forecast, climatology_window, doy_stats, forecast_band,
)
from sensorflow.operators.randomwalk import ensemble_summary, rw_analytic
from sensorflow.operators.series import densify, diff_sd, interpolate, obs_error_fill

D = dt.date


def _targets(spark, rows):
    return spark.createDataFrame(rows, "time date, site_id string, variable string, "
                                       "observed double")


def test_doy_stats_single_and_leap(spark):                             # AGG-8, S12
    t = _targets(spark, [(D(2020, 12, 31), "A", "temperature", 5.0),    # doy 366
                         (D(2021, 12, 31), "A", "temperature", 7.0),    # doy 365
                         (D(2019, 12, 31), "A", "temperature", 9.0)])   # doy 365
    s = {r.doy: (r.mean, r.sd) for r in doy_stats(t).collect()}
    assert s[366] == (5.0, None)                       # one value: sd NULL
    assert s[365][0] == 8.0 and abs(s[365][1] - math.sqrt(2)) < 1e-12


def test_window_crosses_new_year(spark):                               # B6, JON-7
    rows = [(D(2019, 1, 2), "A", "oxygen", 3.0), (D(2019, 12, 30), "A", "oxygen", 1.0)]
    f = climatology_window(_targets(spark, rows), "2020-12-28", 7).collect()
    # 30 Dec 2019 is doy 364, which in leap year 2020 is 29 Dec (the S12 shift); 2 Jan is
    # doy 2 and lands in the next year, not in 2020
    assert sorted(r.time for r in f) == [D(2020, 12, 29), D(2021, 1, 2)]


def test_climatology_forecast_interpolates_and_sigma_median(spark):    # FCT-5, WIN-7, AGG-9
    rows = []
    for y in (2017, 2018):
        rows += [(D(y, 3, 1), "A", "oxygen", 1.0 + y - 2017), (D(y, 3, 3), "A", "oxygen", 5.0),
                 (D(y, 3, 2), "A", "oxygen", None)]
    f = climatology_forecast(_targets(spark, rows), "2019-02-28", 3).collect()
    mu = {r.time: r.predicted for r in f if r.parameter == "mu"}
    sig = {r.predicted for r in f if r.parameter == "sigma"}
    assert mu == {D(2019, 3, 1): 1.5, D(2019, 3, 2): 3.25, D(2019, 3, 3): 5.0}
    assert len(sig) == 1 and abs(sig.pop() - math.sqrt(0.5) / 2) < 1e-12
    assert {r.start_time for r in f} == {D(2019, 2, 28)}
    band = forecast_band(climatology_forecast(_targets(spark, rows), "2019-02-28", 3))
    b = band.where("time = '2019-03-03'").first()
    assert abs(b.upper - b.lower - 2 * 1.96 * b.sigma) < 1e-12


def test_densify_interpolate_diff_sd(spark):                           # JON-4, WIN-8, AGG-16
    rows = [(D(2020, 1, 1), "A", "t", 1.0), (D(2020, 1, 4), "A", "t", 4.0),
            (D(2020, 1, 2), "B", "t", 2.0)]
    t = _targets(spark, rows)
    dn = densify(t, ["site_id", "variable"], "time", "2020-01-05", start_keys=["site_id"])
    assert dn.where("site_id = 'A'").count() == 5 and dn.where("site_id = 'B'").count() == 4
    by_time = {r.time: r.f for r in interpolate(dn.where("site_id = 'A'"), ["site_id"],
                                                "time", "observed", "f", by="time").collect()}
    assert by_time[D(2020, 1, 3)] == 3.0 and by_time[D(2020, 1, 5)] == 4.0
    inside = densify(t, ["site_id", "variable"], "time", "2020-01-02", start_keys=["site_id"])
    kept = {(r.site_id, r.time): r.observed for r in inside.collect()}
    # the row after the end stays, without a spine under it
    assert kept == {("A", D(2020, 1, 1)): 1.0, ("A", D(2020, 1, 2)): None, ("A", D(2020, 1, 4)): 4.0,
                    ("B", D(2020, 1, 2)): 2.0}
    late = _targets(spark, [(D(2021, 1, 1), None, "t", 7.0), (None, "A", "t", 8.0)])
    assert densify(late, ["site_id", "variable"], "time", "2020-01-02").count() == 2
    sd = {r.site_id: r.diff_sd for r in diff_sd(
        _targets(spark, rows + [(D(2020, 1, 9), "A", "t", 4.0)]), ["site_id", "variable"])
        .collect()}
    assert abs(sd["A"] - math.sqrt(4.5)) < 1e-12 and sd["B"] is None


def test_obs_error_fill(spark):                                        # AGG-17
    df = spark.createDataFrame([("A", 0.0), ("A", 0.0), ("A", 1.0), ("A", None),
                                ("B", float("inf")), ("B", 2.0)], "k string, p_sd double")
    out = sorted((r.k, r.p_sd) for r in obs_error_fill(df, ["k"]).collect())
    assert out == [("A", 1 / 3), ("A", 1 / 3), ("A", 1 / 3), ("A", 1.0),
                   ("B", 2.0), ("B", 2.0)]


def test_rw_analytic_sqrt_growth(spark):                               # FCT-8
    rows = [(D(2020, 1, d), "A", "t", v) for d, v in [(1, 1.0), (2, 2.0), (3, 1.0), (4, 2.0)]]
    f = rw_analytic(_targets(spark, rows), "2020-01-05", 4).collect()
    mu = {r.time: r.predicted for r in f if r.parameter == "mu"}
    sig = {r.time: r.predicted for r in f if r.parameter == "sigma"}
    assert set(mu.values()) == {2.0}
    base = sig[D(2020, 1, 6)] / math.sqrt(2)
    assert abs(sig[D(2020, 1, 9)] - base * math.sqrt(5)) < 1e-12


def test_climatology_ignores_what_comes_after_the_issue_date(spark):   # FCT-5
    rows = [(D(2018, 1, 5), "A", "oxygen", 4.0), (D(2019, 1, 5), "A", "oxygen", 6.0)]
    later = rows + [(D(2020, 1, 5), "A", "oxygen", 999.0), (D(2021, 1, 5), "A", "oxygen", 999.0)]
    a, b = (sorted(climatology_forecast(_targets(spark, r), "2020-01-01", 10).collect()) for r in (rows, later))
    assert a == b and len(a) == 2


def test_ensemble_summary_exact_and_sketch(spark):                     # AGG-10, AGG-11
    rows = [(D(2020, 1, 1), "A", "t", i, float(i)) for i in range(1, 101)]
    e = spark.createDataFrame(rows, "time date, site_id string, variable string, "
                                    "ensemble int, predicted double")
    ex = ensemble_summary(e).first()
    # type-7 quantiles: h = (n - 1) p + 1
    assert ex.mean == 50.5
    assert abs(ex.lower - 3.475) < 1e-9 and abs(ex.upper - 97.525) < 1e-9
    ap = ensemble_summary(e, exact=False).first()
    assert abs(ap.lower - 3.475) <= 1 and abs(ap.upper - 97.525) <= 1
