"""Readers, sinks, month plan, superseding and incremental file-stream ingest."""

import datetime as dt
import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from sensorflow.operators.coverage import check_columns, geo_coverage, temporal_coverage
from sensorflow.operators.provisional import provisional_wq_daily, read_product
from sensorflow.sources import demo, readers, schemas
from sensorflow.sources.sinks import write_csv_gz, write_forecast
from sensorflow.streaming.coverage_map import coverage_map, covered_months, merge_coverage
from sensorflow.streaming.refresh import (
    combine_daily, daily_partials, month_plan, stream_ingest, supersede,
)

D = dt.date
T = dt.datetime


@pytest.fixture()
def tmp():
    return tempfile.mkdtemp(prefix="sensorflow-test-")


def test_read_curated_csv_na_and_site_subset(spark, tmp):              # SRC-8, FN-5
    for site, body in [("BARC", "BARC,2020-01-01 00:10,0.5,NA\nBARC,2020-01-01 00:40,0.5,4.0\n"),
                       ("CRAM", "CRAM,2020-01-01 01:00,1.0,5.0\n"),
                       ("TOOK", "TOOK,2020-01-01T02:00,x,6.0\n")]:
        with open(os.path.join(tmp, f"profile.{site}.20005.csv"), "w") as f:
            f.write("siteID,startDate,sensorDepth,waterTemp\n" + body)
    df = readers.read_curated_csv(spark, tmp, sites=["BARC", "TOOK"])
    rows = sorted(df.collect(), key=lambda r: r.startDate)
    assert [r.siteID for r in rows] == ["BARC", "BARC", "TOOK"]
    assert rows[0].waterTemp is None and rows[1].waterTemp == 4.0
    assert rows[2].startDate == T(2020, 1, 1, 2, 0) and rows[2].sensorDepth is None


def test_read_provisional_by_product_and_site(spark, tmp):             # SRC-5..7, UDF-3
    recs = [("BARC", "dissolvedOxygen", T(2024, 1, 1, 0, 0), 8.0, None, "501", "103", "030"),
            ("BARC", "dissolvedOxygenFinalQF", T(2024, 1, 1, 0, 0), None, 0, "501", "103", "030"),
            ("MAYF", "chlorophyll", T(2024, 1, 1, 0, 0), 3.0, None, "501", "101", "030")]
    df = spark.createDataFrame(recs, schemas.PROVISIONAL)
    for site in ("BARC", "MAYF"):
        df.where(F.col("siteName") == site).coalesce(1).write.parquet(
            f"{tmp}/product=20288/site={site}/ms=2024-01")
    spark.createDataFrame([recs[0]], schemas.PROVISIONAL).write.parquet(
        f"{tmp}/product=20053/site=BARC/ms=2024-01")
    long = readers.read_provisional(spark, tmp, "20288", fmt="parquet")
    assert long.count() == 3
    only = readers.read_provisional(spark, tmp, "20288", fmt="parquet", sites=["BARC"])
    assert only.count() == 2
    daily = provisional_wq_daily(long, demo.sites(spark))
    got = {(r.site_id, r.variable): r.observed for r in daily.collect()}
    # MAYF carries no flag term at all: a NULL flag never passes, so its row is dropped
    assert got == {("BARC", "oxygen"): 8.0, ("BARC", "chla"): None}
    with pytest.raises(ValueError):
        read_product(long, "99999")
    with pytest.raises(ValueError):
        readers.read_provisional(spark, tmp, "12345", fmt="parquet")


def place(code, name, lon, lat, low, high):
    return {"id": code, "geographicDescription": name,
            "boundingCoordinates": {"westBoundingCoordinate": lon, "eastBoundingCoordinate": lon,
                                    "northBoundingCoordinate": lat, "southBoundingCoordinate": lat,
                                    "boundingAltitudes": {"altitudeMinimum": low, "altitudeMaximum": high,
                                                          "altitudeUnits": "meter"}}}


def test_geo_json_and_coverage(spark, tmp):                            # SRC-12, MET-3
    geo = [place("QQ01", "Invented pond", "12.5", "47.25", 410, 415),
           place("QQ02", "Invented brook", "-3.75", "55.5", 88, 90)]
    p = os.path.join(tmp, "geo.json")
    with open(p, "w") as f:
        json.dump(geo, f)
    g = readers.read_geo(spark, p)
    sites = spark.createDataFrame([("QQ02",), ("QQ03",)], "site_id string")
    out = geo_coverage(g, sites).collect()
    assert [(r.id, r.west, r.altitude_max) for r in out] == [("QQ02", -3.75, 90.0)]


def test_contract_and_temporal_coverage(spark):                        # MET-1, MET-2
    df = spark.createDataFrame([(D(2020, 1, 2), "a"), (D(2020, 1, 5), "a")],
                               "time date, site_id string")
    check_columns(df, ["time", "site_id"])
    with pytest.raises(ValueError):
        check_columns(df, ["site_id", "time"])
    r = temporal_coverage(df).first()
    assert (r.begin_date, r.end_date, r.n) == (D(2020, 1, 2), D(2020, 1, 5), 2)


def test_month_plan_month_end_and_lag(spark):                          # INC-1
    arch = spark.createDataFrame([(D(2021, 1, 31),), (D(2020, 12, 1),)], "time date")
    plan = month_plan(arch, "time", "2021-03-01").collect()
    assert sorted((r.latest_month, r.fetch_month) for r in plan) == [
        ("2021-01", "2021-02")]
    plan2 = month_plan(arch, "time", "2021-04-10").collect()
    assert sorted(r.fetch_month for r in plan2) == ["2021-02", "2021-04"]


def test_supersede_by_site_and_month(spark):                          # INC-2, B3
    arch = spark.createDataFrame([("A", D(2021, 1, 31)), ("A", D(2021, 3, 1)), ("B", D(2020, 11, 3)),
                                  (None, D(2021, 5, 1))], "site string, day date")
    prov = spark.createDataFrame([("A", D(2021, 1, 15)), ("A", D(2021, 2, 1)), ("A", D(2021, 3, 31)),
                                  ("A", D(2021, 4, 1)), ("B", D(2020, 12, 5)), ("C", D(2019, 1, 1)),
                                  (None, D(2021, 5, 9)), (None, D(2021, 4, 1)), ("A", None)],
                                 "site_id string, time date")
    per = sorted((str(r.site_id), str(r.time)) for r in
                 supersede(prov, arch, "time", "day", {"site_id": "site"}).collect())
    assert per == [("A", "2021-02-01"), ("A", "2021-04-01"), ("A", "None"), ("B", "2020-12-05"),
                   ("C", "2019-01-01"), ("None", "2021-04-01")]
    with pytest.raises(ValueError):
        supersede(prov, arch, "time", "day", [])


def test_coverage_map_merges_and_lists_months(spark):
    rows = spark.createDataFrame([("A", "oxygen", D(2021, 1, 5), 1.0), ("A", "oxygen", D(2021, 3, 5), None),
                                  ("A", "chla", D(1999, 12, 31), 2.0), ("A", "oxygen", D(2021, 1, 9), 2.0),
                                  ("A", "oxygen", None, 2.0)], "site string, variable string, day date, v double")
    one = coverage_map(rows, ["site", "variable"], "day", "v")
    assert sorted(tuple(r) for r in covered_months(one).collect()) == [("A", "chla", "1999-12"), ("A", "oxygen", "2021-01")]
    more = coverage_map(spark.createDataFrame([("A", "oxygen", D(2021, 12, 1))], "site string, variable string, day date"),
                        ["site", "variable"], "day")
    both = covered_months(merge_coverage(one, more)).where("variable = 'oxygen'").collect()
    assert sorted(r.ms for r in both) == ["2021-01", "2021-12"]


def test_hole_and_variable_keep_their_provisional_rows(spark):        # INC-2
    import dataclasses

    from sensorflow.plans import targets as tg
    from sensorflow.plans.queries import target_inputs
    day = [T(2024, m, 3, 1) for m in (1, 2, 3, 4)]
    wq = spark.createDataFrame([("BARC", t, "0.5", "8.0", "0.1", 0, None, "0.1", 0) for t in (day[0], day[2])],
                               schemas.ARCHIVE_WATER_QUALITY)
    recs = [("BARC", term, t, v, q, "501", "103", "030") for t in day for term, v, q in (
        ("dissolvedOxygen", 9.0, None), ("chlorophyll", 3.0, None), ("dissolvedOxygenFinalQF", None, 0),
        ("chlorophyllFinalQF", None, 1))]
    none = {k: getattr(target_inputs(spark, "/root/testdata/sf0.001"), k).limit(0)
            for k in ("archive_tsd", "archive_tsw", "provisional_tsd", "provisional_prt", "curated_lake", "curated_river")}
    inp = dataclasses.replace(target_inputs(spark, "/root/testdata/sf0.001"), archive_wq=wq,
                              provisional_wq=spark.createDataFrame(recs, schemas.PROVISIONAL), **none)
    got = {(r.time.month, r.variable): r.observed for r in tg.build_targets(inp).where("observed IS NOT NULL").collect()}
    assert got == {(1, "oxygen"): 8.0, (2, "oxygen"): 9.0, (3, "oxygen"): 8.0, (4, "oxygen"): 9.0,
                   **{(m, "chla"): 3.0 for m in (1, 2, 3, 4)}}


def test_stream_ingest_reads_only_new_files(spark, tmp):              # INC-3, INC-4
    src, sink, ck = f"{tmp}/landing", f"{tmp}/sink", f"{tmp}/ck"
    schema = "site_id string, ts timestamp_ntz, v double"
    spark.createDataFrame([("A", T(2024, 1, 1, 1), 1.0), ("A", T(2024, 1, 1, 2), 3.0)],
                          schema).coalesce(1).write.parquet(f"{src}/part1")

    def batch(b):
        return daily_partials(b, ["site_id"], "ts", "v")

    stream_ingest(spark, src, schema, batch, sink=sink, checkpoint=ck)
    first = spark.read.parquet(sink).count()
    spark.createDataFrame([("A", T(2024, 1, 1, 3), 5.0), ("B", T(2024, 1, 2, 3), 7.0)],
                          schema).coalesce(1).write.parquet(f"{src}/part2")
    stream_ingest(spark, src, schema, batch, sink=sink, checkpoint=ck)
    parts = spark.read.parquet(sink)
    assert first == 1 and parts.count() == 3          # the second run saw only part2
    got = {(r.site_id, r.time): r.observed for r in combine_daily(parts, ["site_id"]).collect()}
    assert got == {("A", D(2024, 1, 1)): 3.0, ("B", D(2024, 1, 2)): 7.0}


def test_csv_sink_roundtrip_and_forecast_name(spark, tmp):            # SNK-1, SNK-3
    df = spark.createDataFrame([(D(2024, 2, 1), "A", "oxygen", None),
                                (D(2024, 2, 2), "A", "oxygen", 2.5)], schemas.TARGETS)
    p = write_csv_gz(df, f"{tmp}/t.csv.gz", sort_by=("time",))
    back = readers.read_targets(spark, p, fmt="csv")
    assert sorted(back.collect(), key=lambda r: r.time) == sorted(df.collect(),
                                                                   key=lambda r: r.time)
    fp = write_forecast(df, tmp, "aquatics", "climatology")
    assert fp.endswith("aquatics-2024-02-01-climatology.csv.gz")


def test_dimension_csv_readers(spark, tmp):                            # SRC-9, SRC-10
    with open(os.path.join(tmp, "sites.csv"), "w") as f:
        f.write("field_site_id,field_site_subtype,aquatics\nBARC,Lake,1\nHARV,,0\n")
    with open(os.path.join(tmp, "depths.csv"), "w") as f:
        f.write("siteName,verticalIndex,thermistorDepth\nBARC,0501,0.05\n")
    s = readers.read_sites(spark, os.path.join(tmp, "sites.csv")).collect()
    assert [(r.field_site_id, r.aquatics) for r in s] == [("BARC", 1), ("HARV", 0)]
    d = readers.read_depth_lookup(spark, os.path.join(tmp, "depths.csv")).first()
    assert (d.verticalIndex, d.thermistorDepth) == ("0501", 0.05)   # leading zero kept


def test_forecast_file_roundtrip(spark, tmp):                          # SRC-13, SNK-3
    from sensorflow.operators.climatology import climatology_forecast
    t = spark.createDataFrame([(D(2019, 3, 1), "A", "oxygen", 1.0),
                               (D(2018, 3, 1), "A", "oxygen", 2.0)],
                              "time date, site_id string, variable string, observed double")
    f = climatology_forecast(t, "2020-02-28", 2)
    path = write_forecast(f, tmp, "aquatics", "climatology")
    back = readers.read_forecast(spark, path)
    check_columns(back, schemas.CLIMATOLOGY_FORECAST.fieldNames())
    assert back.count() == f.count()


def test_late_records_add_up_exactly(spark, tmp):
    """A record of a day that later batches have long passed still reaches its day."""
    schema = "site_id string, ts timestamp_ntz, v double"
    args = (spark, f"{tmp}/in", schema, lambda b: daily_partials(b, ["site_id"], "ts", "v"), f"{tmp}/s", f"{tmp}/c")
    for i, rows in enumerate([[("A", T(2024, 1, 10, 6), 38.0)], [("A", T(2024, 3, 1, 6), 1.0)],
                              [("A", T(2024, 1, 10, 7), 39.0)]]):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp}/in/b{i}")
        stream_ingest(*args)
    got = {r.time: r.observed for r in combine_daily(spark.read.parquet(f"{tmp}/s"), ["site_id"]).collect()}
    assert got == {D(2024, 1, 10): 38.5, D(2024, 3, 1): 1.0}


def curated(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write("\n".join(lines) + "\n")


def test_csv_columns_go_by_name(spark, tmp):                           # SRC-8, SRC-9, SRC-11
    curated(f"{tmp}/c", "p.BARC.csv", ["note,waterTemp,sensorDepth,extra,startDate,siteID",
                                       "x,4.5,0.5,9,2020-01-01 00:10,BARC"])
    r = readers.read_curated_csv(spark, f"{tmp}/c").first()
    assert (r.siteID, r.startDate, r.sensorDepth, r.waterTemp) == ("BARC", T(2020, 1, 1, 0, 10), 0.5, 4.5)
    curated(tmp, "sites.csv", ["field_domain_id,aquatics,field_site_id,field_site_subtype", "D03,1,BARC,Lake"])
    assert tuple(readers.read_sites(spark, f"{tmp}/sites.csv").first()) == ("BARC", "Lake", 1)
    curated(tmp, "t.csv", ["observed,variable,site_id,time", "1.5,oxygen,BARC,2020-01-02"])
    assert tuple(readers.read_targets(spark, f"{tmp}/t.csv", "csv").first()) == (D(2020, 1, 2), "BARC", "oxygen", 1.5)
    # each path may have its own order; a missing column is an error
    curated(f"{tmp}/d", "p.CRAM.csv", ["siteID,startDate,sensorDepth,waterTemp", "CRAM,2020-01-01 01:00,1,5"])
    both = readers.read_curated_csv(spark, [f"{tmp}/c", f"{tmp}/d"])
    assert {r.siteID: r.waterTemp for r in both.collect()} == {"BARC": 4.5, "CRAM": 5.0}
    curated(f"{tmp}/e", "p.csv", ["siteID,startDate,sensorDepth", "CRAM,2020-01-01 01:00,1"])
    with pytest.raises(ValueError, match="waterTemp"):
        readers.read_curated_csv(spark, f"{tmp}/e")


def test_forecast_contract_is_checked_on_the_file(spark, tmp):         # MET-1, SRC-13
    curated(tmp, "ens.csv", ["time,start_time,site_id,variable,ensemble,predicted", "2020-01-02,2020-01-01,A,oxygen,1,2.5"])
    with pytest.raises(ValueError):
        readers.read_forecast(spark, f"{tmp}/ens.csv", schemas.CLIMATOLOGY_FORECAST)
    assert readers.read_forecast(spark, f"{tmp}/ens.csv").first()["ensemble"] == 1
    with pytest.raises(ValueError):
        check_columns(readers.forecast_columns(spark, f"{tmp}/ens.csv"), schemas.CLIMATOLOGY_FORECAST.fieldNames())
    curated(tmp, "odd.csv", ["a,b", "1,2"])
    with pytest.raises(ValueError, match="contract"):
        readers.read_forecast(spark, f"{tmp}/odd.csv")


def test_product_is_not_read_from_the_root(spark, tmp):                # SRC-6
    rec = [("BARC", "finalQF", T(2024, 1, 1), None, 0, "501", "101", "030")]
    root = f"{tmp}/load-20288/prov"
    spark.createDataFrame(rec, schemas.PROVISIONAL).write.parquet(f"{root}/product=20053/site=BARC/ms=2024-01")
    assert readers.read_provisional(spark, root, "20288", fmt="parquet").count() == 0
    assert readers.read_provisional(spark, root, "20053", fmt="parquet").count() == 1


def test_refresh_job_reads_only_new_files_and_prunes(spark, tmp):      # INC-1, INC-3, INC-5
    from sensorflow.plans.jobs import run_refresh
    from tests.test_plans import plan

    def arrive(name, site, day):
        rec = [(site, "finalQF", day, None, 0, "501", "101", "030")]
        spark.createDataFrame(rec, schemas.PROVISIONAL).coalesce(1).write.parquet(f"{tmp}/in/{name}")

    arrive("a", "BARC", T(2024, 1, 5))
    arrive("b", "MAYF", T(2024, 2, 5))
    args = (spark, f"{tmp}/in", f"{tmp}/land", f"{tmp}/ck", "20053")
    run_refresh(*args)
    assert readers.read_provisional(spark, f"{tmp}/land", "20053", fmt="parquet").count() == 2
    arrive("c", "MAYF", T(2024, 2, 6))
    run_refresh(*args)
    run_refresh(*args)
    landed = readers.read_provisional(spark, f"{tmp}/land", "20053", fmt="parquet", sites=["MAYF"], months=["2024-02"])
    assert sorted(r.startDate for r in landed.collect()) == [T(2024, 2, 5), T(2024, 2, 6)]
    filters = [x for x in plan(landed).splitlines() if "PartitionFilters" in x][0]
    assert all(c in filters for c in ("product", "site", "ms"))


def test_zoned_times_become_utc_days(spark, tmp):                      # FN-6, FN-7
    zone = spark.conf.get("spark.sql.session.timeZone")
    row = ("A", "0.5", "1.0", "0.1", 0, "1", "0.1", 0)
    spark.sql("SELECT timestamp'2024-01-01 02:00:00Z' AS t").selectExpr(
        f"'{row[0]}' AS siteID", "t AS startDateTime", "'0.5' AS sensorDepth", "'1.0' AS dissolvedOxygen",
        "'0.1' AS dissolvedOxygenExpUncert", "0 AS dissolvedOxygenFinalQF", "'1' AS chlorophyll",
        "'0.1' AS chlorophyllExpUncert", "0 AS chlorophyllFinalQF", "1 AS extra").write.parquet(f"{tmp}/wq")
    try:
        for z in ("UTC", "America/New_York", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", z)
            df = readers.read_archive(spark, f"{tmp}/wq", schemas.ARCHIVE_WATER_QUALITY)
            assert df.first()["startDateTime"] == T(2024, 1, 1, 2), z
            text = spark.createDataFrame([("2024-03-10 02:30",), ("2024-03-10T02:30:15Z",), ("x",)], "c string")
            from sensorflow.functions.timefmt import parse_timestamp
            assert [r[0] for r in text.select(parse_timestamp("c")).collect()] == [
                T(2024, 3, 10, 2, 30), T(2024, 3, 10, 2, 30, 15), None]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def issue(spark, folder, rows):
    spark.createDataFrame([("BARC", "surfWaterTempMean", t, v, None, "501", "101", "030") for t, v in rows],
                          schemas.PROVISIONAL).coalesce(1).write.mode("append").parquet(folder)


def values(spark, root):
    return sorted((r.startDate.day, r.doubleValue) for r in
                  readers.read_provisional(spark, root, "20053", fmt="parquet").collect())


def test_two_checkpoints_fill_one_landing(spark, tmp):                 # INC-3
    from sensorflow.plans.jobs import run_refresh
    issue(spark, f"{tmp}/a", [(T(2024, 1, k), 1.0) for k in (1, 2, 3)])
    issue(spark, f"{tmp}/b", [(T(2024, 1, k), 2.0) for k in (4, 5, 6, 7, 8)])
    for folder, checkpoint in (("a", "c1"), ("b", "c2"), ("a", "c3")):  # c3: the first one's is lost
        run_refresh(spark, f"{tmp}/{folder}", f"{tmp}/land", f"{tmp}/{checkpoint}", "20053")
    assert values(spark, f"{tmp}/land") == [(k, 1.0 if k < 4 else 2.0) for k in range(1, 9)]


def test_a_batch_counts_once_it_is_committed(spark, tmp, monkeypatch):  # INC-3
    from sensorflow.plans.jobs import run_refresh
    from sensorflow.sources import landing
    issue(spark, f"{tmp}/a", [(T(2024, 1, 1), 1.0)])
    args = (spark, f"{tmp}/a", f"{tmp}/land", f"{tmp}/ck", "20053")
    run_refresh(*args)
    issue(spark, f"{tmp}/a", [(T(2024, 1, 2), 1.0), (T(2024, 1, 3), 1.0)])
    commit = landing.commit

    def dies(*a):
        raise RuntimeError("killed between write and commit")

    monkeypatch.setattr(landing, "commit", dies)
    with pytest.raises(Exception, match="killed|Python exception|Error"):
        run_refresh(*args)
    assert values(spark, f"{tmp}/land") == [(1, 1.0)]                   # written, not committed
    monkeypatch.setattr(landing, "commit", commit)
    run_refresh(*args)
    assert values(spark, f"{tmp}/land") == [(1, 1.0), (2, 1.0), (3, 1.0)]
    run_refresh(spark, f"{tmp}/a", f"{tmp}/land", f"{tmp}/other", "20053")
    assert values(spark, f"{tmp}/land") == [(1, 1.0), (2, 1.0), (3, 1.0)]


def test_latest_issue_of_a_record_and_compaction(spark, tmp):          # INC-3, SRC-5
    from sensorflow.plans.jobs import run_refresh
    from sensorflow.sources import landing
    args = (spark, f"{tmp}/a", f"{tmp}/land", f"{tmp}/ck", "20053")
    for rows in ([(T(2024, 1, 1), 1.0), (T(2024, 1, 2), 1.0), (T(2024, 1, 2), 5.0), (T(2024, 2, 9), 1.0)],
                 [(T(2024, 1, 2), 2.0), (T(2024, 1, 3), 2.0)], [(T(2024, 1, 3), 3.0)]):
        issue(spark, f"{tmp}/a", rows)
        run_refresh(*args)
    want = [(1, 1.0), (2, 2.0), (3, 3.0), (9, 1.0)]
    assert values(spark, f"{tmp}/land") == want
    assert landing.compact(spark, f"{tmp}/land") == [("20053", "BARC", "2024-01")]
    assert values(spark, f"{tmp}/land") == want
    assert landing.compact(spark, f"{tmp}/land") == []
    live = landing.live_batches(landing.read_ledger(spark, f"{tmp}/land")).collect()
    assert sorted((r.ms, r.batch.startswith("compact")) for r in live) == [("2024-01", True), ("2024-02", False)]
    issue(spark, f"{tmp}/a", [(T(2024, 1, 1), 9.0)])                    # an issue after the compaction
    run_refresh(*args)
    assert values(spark, f"{tmp}/land") == [(1, 9.0), *want[1:]]
    landing.compact(spark, f"{tmp}/land")
    assert values(spark, f"{tmp}/land") == [(1, 9.0), *want[1:]]


def test_csv_gz_is_one_sorted_file(spark, tmp):                        # SNK-1..4, SRT-1
    import csv
    import gzip
    n = 5_000
    df = spark.range(n).select((F.col("id") * 7919 % n).alias("k"), F.when(F.col("id") % 3 > 0, F.lit('a "b", c')).alias("odd, name"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        path = write_csv_gz(df.repartition(7), f"{tmp}/out/t.csv.gz", sort_by=("k",))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert os.path.isfile(path) and {f for f in os.listdir(f"{tmp}/out") if not f.endswith(".crc")} == {"t.csv.gz"}
    data = open(path, "rb").read()
    assert data.count(bytes([31, 139, 8])) > 2                          # several members
    lines = gzip.decompress(data).decode().splitlines()
    assert lines[0] == 'k,"odd, name"' and len(lines) == n + 1
    assert [int(x.split(",")[0]) for x in lines[1:]] == list(range(n))
    assert {r[1] for r in csv.reader(lines[1:], escapechar="\\")} == {"NA", 'a "b", c'}
    assert spark.read.option("header", True).csv(path).count() == n
    write_csv_gz(df.limit(0), path)                                     # replaces; no rows: a header alone
    assert gzip.decompress(open(path, "rb").read()).decode() == 'k,"odd, name"\n'


def test_overlaps_by_sweep_line(spark):                                # JON-3
    from sensorflow.operators.depth import overlapping_intervals, validate_corrections
    schema = "site_id string, vertical_position int, valid_from date, valid_to date, depth double"
    good = [("A", 1, None, D(2020, 1, 5), 1.0), ("A", 1, D(2020, 1, 6), None, 2.0), ("A", 1, D(2020, 1, 6), None, 2.0),
            ("A", 2, D(2020, 1, 1), D(2020, 2, 1), 1.0), ("B", 1, None, None, 1.0), (None, 1, None, None, 1.0),
            (None, 1, None, None, 3.0)]
    validate_corrections(spark.createDataFrame(good, schema))
    long = [("A", 3, D(2020, 1, 1), D(2020, 12, 31), 1.0), ("A", 3, D(2020, 2, 1), D(2020, 2, 2), 2.0),
            ("A", 3, D(2020, 5, 1), D(2020, 5, 2), 2.0), ("A", 3, D(2021, 1, 1), None, 2.0)]
    found = overlapping_intervals(spark.createDataFrame(long, schema), ["site_id", "vertical_position"], "valid_from", "valid_to")
    assert sorted(r.valid_from for r in found.collect()) == [D(2020, 2, 1), D(2020, 5, 1)]
    for bad in (("A", 1, D(2019, 1, 1), D(2019, 1, 1), 1.0), ("B", 1, D(2020, 1, 1), None, 1.0), ("A", 1, D(2020, 1, 6), None, 9.0)):
        with pytest.raises(ValueError, match="overlap"):
            validate_corrections(spark.createDataFrame([*good, bad], schema))


def test_one_scan_per_header(spark, tmp):                              # SRC-8, INC-4
    import gzip

    from tests.test_plans import plan
    heads = [(0, 1, 2, 3), (3, 2, 1, 0), (1, 0, 3, 2)]
    names = ("siteID", "startDate", "sensorDepth", "waterTemp")
    for i in range(60):
        row = ("BARC", f"2020-01-01 {i % 24:02d}:{i % 60:02d}", "0.5", str(i))
        order = heads[i % 3]
        lines = [",".join(names[k] for k in order), ",".join(row[k] for k in order)]
        if i % 7:
            curated(f"{tmp}/all/d{i % 2}", f"p{i}.csv", lines)
        else:
            os.makedirs(f"{tmp}/all/d{i % 2}", exist_ok=True)
            with gzip.open(f"{tmp}/all/d{i % 2}/p{i}.csv.gz", "wt") as f:
                f.write("\n".join(lines))
    open(f"{tmp}/all/empty.csv", "w").close()
    open(f"{tmp}/all/_hidden.csv", "w").write("x")
    df = readers.read_curated_csv(spark, f"{tmp}/all")
    assert sorted(r.waterTemp for r in df.collect()) == list(map(float, range(60)))
    assert plan(df, "simple").count("FileScan csv") == 3
    assert readers.read_curated_csv(spark, f"{tmp}/all/*/p1*.csv").count() > 3
    with pytest.raises(ValueError, match="no files"):
        readers.read_curated_csv(spark, f"{tmp}/nothing")
