"""End-to-end: synthetic source files -> command-line targets job -> hand-computed values."""

import datetime as dt
import json
import os
import tempfile

from sensorflow.__main__ import main
from sensorflow.sources import schemas

T = dt.datetime
D = dt.date


def _write(spark, rows, schema, path):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(path)


def test_targets_job_from_files(spark):
    root = tempfile.mkdtemp(prefix="sensorflow-e2e-")
    with open(f"{root}/sites.csv", "w") as f:
        f.write("domain,aquatics,field_site_id,field_site_subtype\n"
                "D1,1,BARC,Lake\nD2,1,FLNT,Non-wadeable River\nD3,1,MAYF,Wadeable Stream\n")
    # water quality: BARC oxygen mean(8, 10) = 9 (the 2 m row is outside the surface
    # window), chla 10 (the second value failed its flag); MAYF oxygen 6, no chla (stream)
    _write(spark, [
        ("BARC", T(2024, 1, 1, 0, 0), "0.5", "8.0", "0.1", 0, "10", "0.1", 0),
        ("BARC", T(2024, 1, 1, 0, 30), "NA", "10.0", "0.1", 0, "20", "0.1", 1),
        ("BARC", T(2024, 1, 1, 1, 0), "2.0", "5.0", "0.1", 0, "30", "0.1", 0),
        ("MAYF", T(2024, 1, 1, 0, 0), None, "6", "0.1", 0, "3", "0.1", 0),
    ], schemas.ARCHIVE_WATER_QUALITY, f"{root}/wq")
    # thermistors: BARC 502 is corrected to 0.55 m (rounded 0.6); FLNT is a river whose
    # only day is the first of its series, which strict QC removes
    _write(spark, [
        ("BARC", T(2023, 12, 31, 10, 0), 0.3, 502, 20.0, 0.1, 0),
        ("BARC", T(2023, 12, 31, 10, 30), 0.3, 502, 22.0, 0.1, 0),
        ("FLNT", T(2023, 12, 31, 10, 0), 0.05, 501, 15.0, 0.1, 0),
        ("FLNT", T(2023, 12, 31, 10, 30), 0.05, 501, 17.0, 0.1, 0),
    ], schemas.ARCHIVE_DEPTH_TEMPERATURE, f"{root}/tsd")
    # stream point temperature: first day removed by strict QC, second kept
    _write(spark, [
        ("MAYF", T(2023, 12, 31, 12, 0), "101", 12.0, 0.1, 0),
        ("MAYF", T(2024, 1, 1, 12, 0), "101", 12.5, 0.1, 0),
        ("MAYF", T(2024, 1, 1, 13, 0), "102", 30.0, 0.1, 0),
    ], schemas.ARCHIVE_POINT_TEMPERATURE, f"{root}/tsw")
    # provisional thermistor records at BARC in February (after the archive's month)
    _write(spark, [
        ("BARC", "tsdWaterTempMean", T(2024, 2, 1, 6, 0), 5.0, None, "501", "103", "030"),
        ("BARC", "tsdWaterTempFinalQF", T(2024, 2, 1, 6, 0), None, 0, "501", "103", "030"),
    ], schemas.PROVISIONAL, f"{root}/prov/product=20264/site=BARC/ms=2024-02")
    os.makedirs(f"{root}/curated_lake")
    with open(f"{root}/curated_lake/profile.BARC.20005.csv", "w") as f:
        f.write("depthFlag,waterTemp,startDate,siteID,sensorDepth\n0,23.0,2023-12-31 10:15,BARC,0.6\n")
    os.makedirs(f"{root}/curated_river")
    with open(f"{root}/curated_river/profile.FLNT.20005.csv", "w") as f:
        f.write("siteID,startDate,sensorDepth,waterTemp\nFLNT,2023-12-31 10:15,0.5,NA\n")
    cfg = {"sites": f"{root}/sites.csv", "archive_wq": f"{root}/wq",
           "archive_tsd": f"{root}/tsd", "archive_tsw": f"{root}/tsw",
           "provisional_root": f"{root}/prov", "provisional_format": "parquet",
           "curated_lake": f"{root}/curated_lake", "curated_river": f"{root}/curated_river"}
    # rules as inputs: no mask, and the depth corrections of the package as a file
    with open(f"{root}/masks.csv", "w") as f:
        f.write("site_id,variable,date_from,date_to,bad_below,bad_above\n")
        f.write("NONE,oxygen,NA,NA,NA,NA\n")
    cfg |= {"masks": f"{root}/masks.csv", "accept_failed_after": "2020-07-01", "stream_positions": ["101", "111"]}
    with open(f"{root}/inputs.json", "w") as f:
        json.dump(cfg, f)

    main(["targets", "--config", f"{root}/inputs.json", "--out", f"{root}/out", "--local"])

    t = spark.read.parquet(f"{root}/out/targets")
    got = {(r.site_id, r.time, r.variable): r.observed for r in t.collect()}
    assert got == {
        ("BARC", D(2024, 1, 1), "oxygen"): 9.0,
        ("BARC", D(2024, 1, 1), "chla"): 10.0,
        ("MAYF", D(2024, 1, 1), "oxygen"): 6.0,
        # lake surface: mean of the archive hour (21) and the curated hour (23)
        ("BARC", D(2023, 12, 31), "temperature"): 22.0,
        ("BARC", D(2024, 2, 1), "temperature"): 5.0,
        ("FLNT", D(2023, 12, 31), "temperature"): None,
        ("MAYF", D(2023, 12, 31), "temperature"): None,
        ("MAYF", D(2024, 1, 1), "temperature"): 12.5,
    }
    prof = {(r.site_id, r.depth): r.observed
            for r in spark.read.parquet(f"{root}/out/expanded_profile").collect()}
    assert prof == {("BARC", 0.6): 22.0, ("BARC", 0.05): 5.0}
    # the days do not depend on the session's zone
    from sensorflow.__main__ import _inputs
    from sensorflow.plans.jobs import run_targets
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        paths = run_targets(spark, _inputs(spark, cfg), f"{root}/out2", csv=False)
        assert {(r.site_id, r.time, r.variable): r.observed
                for r in spark.read.parquet(paths["targets"]).collect()} == got
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    csv = spark.read.option("header", True).csv(f"{root}/out/aquatics-targets.csv.gz")
    assert csv.count() == len(got) and csv.where("observed = 'NA'").count() == 2
