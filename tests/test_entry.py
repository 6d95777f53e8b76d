"""Driver contract and the end-to-end targets job on the smallest tables."""

import tempfile

import __spark_entry__ as entry_mod
from sensorflow.plans.jobs import run_climatology, run_targets
from sensorflow.plans.queries import target_inputs


def test_entry_runs_on_sf0001(spark):
    df = entry_mod.entry(spark)
    assert df.columns == ["time", "site_id", "variable", "observed"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    from sensorflow.plans.queries import QUERIES
    q, o = entry_mod.queries(), entry_mod.oracle_sql()
    assert set(o) <= set(q) and set(QUERIES) <= set(o)


def test_targets_job_writes_and_forecasts(spark):
    out = tempfile.mkdtemp(prefix="sensorflow-job-")
    paths = run_targets(spark, target_inputs(spark, "/root/testdata/sf0.001"), out)
    t = spark.read.parquet(paths["targets"])
    assert t.count() > 0 and set(t.columns) == {"time", "site_id", "observed", "variable"}
    assert spark.read.parquet(paths["expanded_profile"]).count() > 0
    fp = run_climatology(spark, paths["targets"], out, "2024-01-20", horizon=7)
    assert "aquatics-2024-01-21-climatology.csv.gz" in fp


def test_metadata_job(spark):
    import json
    import os

    from sensorflow.plans.jobs import run_metadata
    out = tempfile.mkdtemp(prefix="sensorflow-meta-")
    paths = run_targets(spark, target_inputs(spark, "/root/testdata/sf0.001"), out, csv=False)
    fp = run_climatology(spark, paths["targets"], out, "2024-01-20", horizon=5)
    box = {"westBoundingCoordinate": "8.5", "eastBoundingCoordinate": "8.5",
           "northBoundingCoordinate": "50.25", "southBoundingCoordinate": "50.25",
           "boundingAltitudes": {"altitudeMinimum": 120, "altitudeMaximum": 121, "altitudeUnits": "meter"}}
    geo = [{"id": "MAYF", "geographicDescription": "Invented stream", "boundingCoordinates": box}]
    gp = os.path.join(out, "geo.json")
    with open(gp, "w") as f:
        json.dump(geo, f)
    m = run_metadata(spark, fp, gp, sites=["MAYF", "QQ01"])
    assert (m["theme"], m["team"]) == ("aquatics", "climatology")
    assert m["begin_date"] == "2024-01-21" and m["end_date"] <= "2024-01-25"
    assert [g["id"] for g in m["geographic_coverage"]] == ["MAYF"]
    yml = os.path.join(out, "run.yml")
    with open(yml, "w") as f:
        f.write("team_name: t\nsites: [MAYF]\nmetadata:\n  forecast:\n"
                "    timestep: 1 day\n    forecast_horizon: 5 days\n")
    from sensorflow.__main__ import load_config
    m2 = run_metadata(spark, fp, gp, metadata=load_config(yml), issue_time="2024-01-20",
                      iteration_id="it-1")
    assert [g["id"] for g in m2["geographic_coverage"]] == ["MAYF"]
    assert m2["forecast"]["forecast_project_id"] == "climatology"
    assert m2["forecast"]["timestep"] == "1 day"
