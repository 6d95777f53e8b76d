"""End-to-end batch jobs: raw sources -> targets files -> forecast files.

Each job writes its outputs by path (overwrite), so rerunning after a failure is safe.
The hourly lake profile feeds two outputs; it is written once to the output folder and
read back, which also cuts the lineage before the targets are built.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from sensorflow.operators.climatology import climatology_forecast
from sensorflow.operators.randomwalk import rw_analytic
from sensorflow.plans.targets import TargetInputs, build_expanded_profile, build_targets
from sensorflow.sources.readers import read_targets
from sensorflow.sources.rules import EXPANDED_FILE, TARGETS_FILE, THEME
from sensorflow.sources.schemas import CLIMATOLOGY_FORECAST, EXPANDED_PROFILE, PROVISIONAL
from sensorflow.sources.sinks import write_csv_gz, write_forecast, write_parquet


def run_targets(spark: SparkSession, inputs: TargetInputs, out_dir: str,
                csv: bool = True) -> dict[str, str]:
    """Build and write the expanded profile and the targets table.

    The depth-correction rules are validated first (no overlapping intervals per sensor).  What
    months the archives hold is written once, so no archive is scanned again to supersede.
    """
    import dataclasses

    from sensorflow.operators.depth import validate_corrections
    from sensorflow.plans.targets import archive_coverage

    validate_corrections(inputs.corrections)
    out = out_dir.rstrip("/")
    if inputs.coverage is None and inputs.supersede:
        held = write_parquet(archive_coverage(inputs), f"{out}/coverage")
        inputs = dataclasses.replace(inputs, coverage=spark.read.parquet(held))
    profile_path = write_parquet(build_expanded_profile(inputs), f"{out}/expanded_profile",
                                 partition_by=("site_id",), sort_within=("depth", "time"),
                                 cluster_by=("site_id", F.date_format("time", "yyyy-MM")))
    profile = spark.read.schema(EXPANDED_PROFILE).parquet(profile_path)
    targets = build_targets(inputs, profile=profile.select(*EXPANDED_PROFILE.fieldNames()))
    targets_path = write_parquet(targets, f"{out}/targets", partition_by=("variable",),
                                 sort_within=("site_id", "time"),
                                 cluster_by=("variable", "site_id", F.year("time")))
    paths = {"expanded_profile": profile_path, "targets": targets_path}
    if csv:
        t = spark.read.parquet(targets_path).select("time", "site_id", "variable", "observed")
        paths["targets_csv"] = write_csv_gz(t, f"{out}/{TARGETS_FILE}",
                                            sort_by=("site_id", "time", "variable"))
        paths["expanded_csv"] = write_csv_gz(
            profile.select("time", "site_id", "depth", "variable", "observed"),
            f"{out}/{EXPANDED_FILE}",
            sort_by=("time", "site_id", "depth"))
    return paths


def run_refresh(spark: SparkSession, incoming: str, landing: str, checkpoint: str, product: str,
                fmt: str = "parquet", name_glob: str | None = None,
                max_files_per_trigger: int | None = None) -> str:
    """Lands the provisional files of one product that arrived since the last run.

    The file stream's checkpoint remembers the files read, so a second run with the same
    ``checkpoint`` reads only new ones.  Records go to ``product=/site=/ms=`` directories,
    which later runs of the targets job prune by.  A batch is named by the stream's own id and
    its number, so streams with checkpoints of their own may fill one landing.  Returns the
    landing.
    """
    from sensorflow.sources.landing import land, with_origin
    from sensorflow.streaming.refresh import stream_id

    reader = spark.readStream.format(fmt).schema(PROVISIONAL).option("recursiveFileLookup", "true")
    if name_glob:
        reader = reader.option("pathGlobFilter", name_glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)

    def write_batch(batch, batch_id: int) -> None:
        land(batch, landing, f"{product}-{stream_id(spark, checkpoint)}-{batch_id}", product)

    q = (with_origin(reader.load(incoming)).writeStream.foreachBatch(write_batch)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return landing


def run_refresh_targets(spark: SparkSession, inputs: TargetInputs, landing: str, out_dir: str,
                        full: bool = False) -> list[tuple]:
    """Brings the refreshable targets in ``out_dir`` up to what is landed: a full build where there is
    none (or with ``full``), otherwise only what new batches change.  Returns what was computed again."""
    from pyspark.errors import AnalysisException

    from sensorflow.plans.refresh_targets import build_refreshable, refresh_targets

    try:
        built = not full and spark.read.schema("batch string").parquet(f"{out_dir.rstrip('/')}/applied") is not None
    except AnalysisException:
        built = False
    if not built:
        build_refreshable(spark, inputs, landing, out_dir)
        return []
    return sorted(refresh_targets(spark, inputs, landing, out_dir))


def run_month_plan(spark: SparkSession, targets_path: str, as_of: str, lag_days: int = 2,
                   fmt: str = "parquet") -> list[dict]:
    """Months to fetch next per variable: the one after the latest archived day and the current
    one.  One row per variable and month reaches the driver."""
    from sensorflow.streaming.refresh import month_plan

    targets = read_targets(spark, targets_path, fmt).where(F.col("observed").isNotNull())
    plan = month_plan(targets, "time", as_of, lag_days, keys=["variable"])
    return [r.asDict() for r in plan.orderBy("variable", "fetch_month").collect()]


def run_climatology(spark: SparkSession, targets_path: str, out_dir: str, as_of: str,
                    horizon: int = 35, team: str = "climatology", fmt: str = "parquet") -> str:
    """Day-of-year climatology forecast file for the ``horizon`` days after ``as_of``."""
    f = climatology_forecast(read_targets(spark, targets_path, fmt), as_of, horizon)
    return write_forecast(f, out_dir, THEME, team)


def run_persistence(spark: SparkSession, targets_path: str, out_dir: str, as_of: str,
                    horizon: int = 35, team: str = "persistence",
                    fmt: str = "parquet") -> str:
    """Closed-form persistence forecast file (mu and sigma per series and day)."""
    f = rw_analytic(read_targets(spark, targets_path, fmt), as_of, horizon)
    f = f.select(*CLIMATOLOGY_FORECAST.fieldNames())
    return write_forecast(f, out_dir, THEME, team)


def run_metadata(spark: SparkSession, forecast_path: str, geo_path: str,
                 sites: list[str] | None = None,
                 required_columns: list[str] | None = None,
                 metadata: dict | None = None, issue_time: str | None = None,
                 iteration_id: str | None = None) -> dict:
    """Coverage summary of a forecast file: theme/team from its name, column contract,
    first/last forecast day and the geographic coverage of the listed (or all) sites.

    ``metadata`` is the run's metadata document (e.g. loaded from YAML): its ``sites``
    list is the default site list and its ``metadata.forecast`` block is returned with
    the issue time, iteration id and project (team) filled in.  Only small results reach
    the driver: two dates and one row per listed site.
    """
    if sites is None and metadata and metadata.get("sites"):
        sites = list(metadata["sites"])
    from pyspark.sql import functions as F

    from sensorflow.functions.names import parse_forecast_name
    from sensorflow.operators.coverage import check_columns, geo_coverage, temporal_coverage
    from sensorflow.sources.readers import forecast_columns, read_forecast, read_geo

    if required_columns is not None:
        check_columns(forecast_columns(spark, forecast_path), required_columns)
    f = read_forecast(spark, forecast_path)
    name = spark.range(1).select(parse_forecast_name(F.lit(forecast_path)).alias("p")) \
        .first()["p"]
    cov = temporal_coverage(f, "time").first()
    listed = (spark.createDataFrame([(s,) for s in sites], "site_id string") if sites
              else f.select("site_id").distinct())
    geo = [r.asDict() for r in geo_coverage(read_geo(spark, geo_path), listed).collect()]
    out = {"theme": name["theme"], "team": name["team"],
           "begin_date": str(cov["begin_date"]), "end_date": str(cov["end_date"]),
           "geographic_coverage": geo}
    if metadata is not None:
        forecast = dict((metadata.get("metadata") or {}).get("forecast") or {})
        forecast["forecast_issue_time"] = issue_time
        forecast["forecast_iteration_id"] = iteration_id
        forecast["forecast_project_id"] = name["team"]
        out["forecast"] = forecast
    return out
