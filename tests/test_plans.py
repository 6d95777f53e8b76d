"""Plan shape: the physical plans have the properties the scale design relies on."""

import contextlib
import datetime as dt
import io
import tempfile

import pytest

from sensorflow.operators.quality import gross_range, mask_rules, qc_series
from sensorflow.plans.queries import QUERIES
from sensorflow.sources import readers, rules, schemas

SMALL = "/root/testdata/sf0.001"
EXECUTES_AT_BUILD = {"stream_ingest_daily", "refresh_landing", "curated_csv_hourly",
                     "targets_csv_roundtrip", "forecast_file_roundtrip"}


def plan(df, mode="formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


@pytest.mark.parametrize("key", sorted(k for k in QUERIES if k not in EXECUTES_AT_BUILD))
def test_no_cross_or_nested_loop_join(spark, key):
    p = plan(QUERIES[key](spark, SMALL))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_series_scan_partitions_by_series_and_bucket(spark):
    rows = [("A", dt.date(2020, 1, 1) + dt.timedelta(days=i), float(i)) for i in range(90)]
    df = spark.createDataFrame(rows, "site_id string, time date, observed double")
    p = plan(qc_series(df, ["site_id"], "time"), "simple")
    # the row-level window is keyed by (series, bucket): a hot series spreads over months
    assert "hashpartitioning(__series" in p and "__bucket" in p
    # the bucket summary is a partial hash aggregate (map-side combine)
    assert "HashAggregate" in p and "partial_max_by" in p


def test_rule_joins_are_broadcast_hash_joins(spark):
    df = spark.createDataFrame([(dt.date(2020, 1, 1), "BARC", "oxygen", 3.0)],
                               "time date, site_id string, variable string, observed double")
    p = plan(mask_rules(gross_range(df, rules.ranges(spark)), rules.masks(spark)))
    assert p.count("BroadcastHashJoin") >= 2


def test_provisional_filters_reach_the_scan(spark):
    root = tempfile.mkdtemp(prefix="sensorflow-plan-")
    recs = [("BARC", "tsdWaterTempMean", dt.datetime(2024, 1, 1), 5.0, None, "501", "103",
             "030")]
    spark.createDataFrame(recs, schemas.PROVISIONAL).write.parquet(
        f"{root}/product=20264/site=BARC")
    from sensorflow.operators.provisional import provisional_tsd_surface_daily
    long = readers.read_provisional(spark, root, "20264", fmt="parquet")
    p = plan(provisional_tsd_surface_daily(long, rules.depth_lookup(spark)))
    scan = [ln for ln in p.splitlines() if "PushedFilters" in ln]
    assert scan and "termName" in scan[0] and "horizontalIndex" in scan[0]
    assert "temporalIndex" in scan[0]


def test_wq_scan_prunes_columns(spark):
    p = plan(QUERIES["qf_mask_daily"](spark, SMALL))
    read = [ln for ln in p.splitlines() if "ReadSchema" in ln][0]
    # event_type is not needed by the water-quality view, so it is never read
    assert "event_type" not in read and "value" in read


def test_building_the_targets_runs_no_job(spark):
    from sensorflow.plans.queries import target_inputs
    from sensorflow.plans.targets import build_targets
    tracker, group = spark.sparkContext.statusTracker(), "build-only"
    inputs = target_inputs(spark, SMALL)
    spark.sparkContext.setJobGroup(group, "composing a plan")
    build_targets(inputs)
    assert list(tracker.getJobIdsForGroup(group)) == []
    spark.sparkContext.setJobGroup("", "")


def test_every_branch_of_the_targets_has_rows(spark):
    from pyspark.sql import functions as F

    from sensorflow.operators.provisional import provisional_wq_daily
    from sensorflow.plans import targets as tg
    from sensorflow.plans.queries import target_inputs
    inp = target_inputs(spark, "/root/testdata/sf0.01")
    whole_wq = provisional_wq_daily(inp.provisional_wq, inp.sites)
    wq = tg.archive_wq_daily(inp.archive_wq, inp.sites)
    branches = {
        "lake": inp.lake_hourly(), "river": inp.river_daily(), "stream": inp.stream_daily(), "wq": wq,
        "new wq": inp.fresh("20288", whole_wq, "time", "site_id"),
        "new prt": inp.fresh("20053", inp.provisional_prt, "startDate", "siteName", F.lit("temperature")),
        "new tsd": inp.fresh("20264", inp.provisional_tsd, "startDate", "siteName", F.lit("temperature"))}
    assert all(df.limit(1).count() for df in branches.values())
    # and superseding takes some of the provisional records, not all
    for name, whole in (("new wq", whole_wq), ("new prt", inp.provisional_prt)):
        assert 0 < branches[name].count() < whole.count()


def test_climatology_needs_few_shuffles(spark):
    from sensorflow.operators.climatology import climatology_forecast
    from sensorflow.sources import demo
    p = plan(climatology_forecast(demo.daily_series(spark, SMALL), "2000-12-15"), "simple")
    assert p.count("Exchange hashpartitioning") <= 4
