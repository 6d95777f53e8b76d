"""A refreshed targets table equals a full build, and reads only what new records change."""

import dataclasses
import datetime as dt
import random

import pytest

from sensorflow.plans import refresh_targets as rt
from sensorflow.plans.jobs import run_refresh, run_refresh_targets
from sensorflow.plans.queries import target_inputs
from sensorflow.sources import readers, rules, schemas
from tests.test_plans import plan

T = dt.datetime
TERMS = {"20288": [("dissolvedOxygen", 1), ("chlorophyll", 1), ("dissolvedOxygenFinalQF", 0), ("chlorophyllFinalQF", 0)],
         "20264": [("tsdWaterTempMean", 1), ("tsdWaterTempFinalQF", 0)],
         "20053": [("surfWaterTempMean", 1), ("finalQF", 0)]}


def records(rng, product, sites, times):
    out = []
    for site in sites:
        for t in times:
            flag = 1 if rng.random() < 0.1 else 0
            where = rng.choice(["501", "502", "503"])
            for term, number in TERMS[product]:
                v = rng.choice([5.0, 6.0, 7.0, 18.0, 50.0]) + rng.random()
                out.append((site, term, t, v if number else None, None if number else flag, where, "103", "030"))
    return out


@pytest.fixture()
def job(spark, tmp_path):
    base = target_inputs(spark, "/root/testdata/sf0.001")
    day = [T(2023, m, d, 3) for m in (1, 2, 4, 9) for d in (1, 2, 15, 28)]
    wq = [("BARC", t, "0.5", "8.0", "0.1", 0, "3.0", "0.1", 0) for t in day if t.month == 2]
    tsw = [("MAYF", t, "101", 6.0 + t.day / 10, 0.1, 0) for t in day if t.month in (1, 4)]
    tsd = [("BARC", t, 0.5, 501, 9.0 + t.day / 7, 0.1, 0) for t in day if t.month == 1]
    cur = [("BARC", t, 0.5, 11.0 + t.day / 9) for t in day if t.month in (1, 9)]
    base = dataclasses.replace(
        base, archive_wq=spark.createDataFrame(wq, schemas.ARCHIVE_WATER_QUALITY),
        archive_tsw=spark.createDataFrame(tsw, schemas.ARCHIVE_POINT_TEMPERATURE),
        archive_tsd=spark.createDataFrame(tsd, schemas.ARCHIVE_DEPTH_TEMPERATURE),
        curated_lake=spark.createDataFrame(cur, "siteID string, startDate timestamp_ntz, sensorDepth double, waterTemp double"),
        curated_river=base.curated_river.limit(0))

    def inputs():
        return dataclasses.replace(base, **{n: readers.read_provisional(spark, f"{tmp_path}/land", p, fmt="parquet")
                                            for n, p in (("provisional_wq", "20288"), ("provisional_tsd", "20264"),
                                                         ("provisional_prt", "20053"))})

    def arrive(product, rows):
        spark.createDataFrame(rows, schemas.PROVISIONAL).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in-{product}")
        run_refresh(spark, f"{tmp_path}/in-{product}", f"{tmp_path}/land", f"{tmp_path}/c-{product}", product)

    return inputs, arrive, f"{tmp_path}/land", f"{tmp_path}/out", f"{tmp_path}/full"


def rows(spark, out):
    return sorted((str(r.time), r.site_id, r.variable, None if r.observed is None else round(r.observed, 9))
                  for r in rt.read_refreshable(spark, out).collect())


def test_refreshed_equals_full_build(spark, job):
    inputs, arrive, land, out, full = job
    rng = random.Random(5)
    day = [T(2023, m, d, 3) for m in (1, 2, 3, 4, 6, 9) for d in (1, 2, 15, 28)]
    sites = {"20288": ["BARC", "MAYF"], "20264": ["BARC", "FLNT"], "20053": ["MAYF"]}
    for p in rules.PRODUCTS:
        arrive(p, records(rng, p, sites[p], [t for t in day if t.month not in (3, 6)]))
    assert run_refresh_targets(spark, inputs(), land, out) == []
    assert run_refresh_targets(spark, inputs(), land, out) == []
    before = rows(spark, out)
    steps = [{"20288": [t for t in day if t.month == 3], "20264": [t for t in day if t.month == 3], "20053": day[-4:]},
             {"20053": [t for t in day if t.month in (3, 4, 6)]}]
    for step in steps:
        for p, times in step.items():
            arrive(p, records(rng, p, sites[p], times))
        done = run_refresh_targets(spark, inputs(), land, out)
        rt.build_refreshable(spark, inputs(), land, full)
        now = rows(spark, out)
        assert done and now == rows(spark, full)
        changed = {(v, s, t[:7]) for t, s, v, _ in set(now) ^ set(before)}
        assert changed and changed <= set(done)
        assert not [x for x in done if x[0] == "temperature" and x[1:] == ("MAYF", "2023-04")]  # the archive holds it
        before = now


def test_partition_without_rows_goes(spark, job):
    inputs, arrive, land, out, full = job
    good = [("MAYF", "surfWaterTempMean", T(2023, 6, d, 1), 5.0 + d, None, "501", "103", "030") for d in (1, 2)]
    flag = [("MAYF", "finalQF", T(2023, 6, d, 1), None, q, "501", "103", "030") for d in (1, 2) for q in (0,)]
    other = [(p, records(random.Random(1), p, ["BARC"], [T(2023, 7, 1, 1)])) for p in ("20288", "20264")]
    for p, r in [("20053", good + flag), *other]:
        arrive(p, r)
    run_refresh_targets(spark, inputs(), land, out)
    assert [r for r in rows(spark, out) if r[0].startswith("2023-06")]
    arrive("20053", [(*r[:4], 1, *r[5:]) for r in flag])               # issued again, now failed
    done = run_refresh_targets(spark, inputs(), land, out)
    assert ("temperature", "MAYF", "2023-06") in done
    assert not [r for r in rows(spark, out) if r[0].startswith("2023-06")]
    rt.build_refreshable(spark, inputs(), land, full)
    assert rows(spark, out) == rows(spark, full)


def test_scans_read_only_dirty_months(spark, job):
    inputs, arrive, land, out, _ = job
    rng = random.Random(6)
    day = [T(2023, m, d, 3) for m in (3, 5, 6, 7, 8) for d in (1, 2)]
    for p in rules.PRODUCTS:
        arrive(p, records(rng, p, ["BARC", "FLNT", "MAYF"], day))
    run_refresh_targets(spark, inputs(), land, out)
    arrive("20053", records(rng, "20053", ["MAYF"], [T(2023, 6, 20, 3)]))
    p = rt.plan_refresh(spark, land, out)
    assert p["water"] == [] and p["affected"] == {("MAYF", "2023-06"), ("MAYF", "2023-07")}
    # May: the provisional series; April: the archive's last month before
    assert p["temperature"] == [("MAYF", m) for m in ("2023-04", "2023-05", "2023-06", "2023-07")]
    cut = rt.restricted(inputs(), p, rt._coverage(spark, out))
    text = plan(cut.provisional_prt)
    filters = [x for x in text.splitlines() if "PartitionFilters" in x and "product" in x]
    assert filters and all("MAYF" in x and "2023-06" in x for x in filters)
    assert {(r.site, r.ms) for r in cut.provisional_prt.select("site", "ms").distinct().collect()} == {
        ("MAYF", m) for m in ("2023-05", "2023-06", "2023-07")}
