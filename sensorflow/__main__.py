"""Command line: ``python -m sensorflow <job> ...`` (the scheduled scripts' equivalents).

  targets      --config inputs.json --out DIR      raw sources -> targets + expanded profile
  refresh      --incoming DIR --landing DIR --checkpoint DIR --product CODE [--format avro]
  update       --config inputs.json --out DIR [--full]    targets table, only what new records change
  months       --targets PATH --as-of YYYY-MM-DD   months to fetch next
  climatology  --targets PATH --as-of YYYY-MM-DD --out DIR [--horizon 35]
  persistence  --targets PATH --as-of YYYY-MM-DD --out DIR [--horizon 35]
  metadata     --forecast PATH --geo PATH [--sites A,B] [--columns a,b] [--metadata run.yml]

``inputs.json`` (or .yml) names the source paths (formats in parentheses):
  archive_wq, archive_tsd, archive_tsw (parquet), provisional_root (+ provisional_format),
  curated_lake, curated_river (csv), sites (csv).
Optional rule tables (csv): depth_lookup, corrections, ranges, masks, qc_params; optional
values: accept_failed_after (date), stream_positions (list).  They default to
``sources.rules``.  The session is the cluster's own (``spark-submit``), with its time zone
set to UTC; ``--local`` starts a local one.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json

from pyspark.sql import SparkSession


def load_config(path: str) -> dict:
    """JSON, or YAML when the file ends in .yml/.yaml (needs PyYAML)."""
    with open(path) as f:
        if path.endswith((".yml", ".yaml")):
            try:
                import yaml
            except ImportError as e:  # pragma: no cover - optional dependency
                raise SystemExit("YAML configuration needs PyYAML") from e
            return yaml.safe_load(f)
        return json.load(f)


def _session(local: bool) -> SparkSession:
    if local:
        from sensorflow.session import local_session
        return local_session()
    return (SparkSession.builder.appName("sensorflow")
            .config("spark.sql.session.timeZone", "UTC").getOrCreate())


def _inputs(spark: SparkSession, cfg: dict):
    from sensorflow.plans.targets import TargetInputs
    from sensorflow.sources import readers, rules, schemas

    def rule(key: str, schema: str, default):
        return readers.read_rules(spark, cfg[key], schema) if cfg.get(key) else default(spark)

    options = {}
    if cfg.get("accept_failed_after"):
        options["accept_failed_after"] = dt.date.fromisoformat(str(cfg["accept_failed_after"]))
    if cfg.get("stream_positions"):
        options["stream_positions"] = tuple(map(str, cfg["stream_positions"]))
    fmt = cfg.get("provisional_format", "avro")
    root = cfg["provisional_root"]
    return TargetInputs(
        sites=readers.read_sites(spark, cfg["sites"]),
        archive_wq=readers.read_archive(spark, cfg["archive_wq"],
                                        schemas.ARCHIVE_WATER_QUALITY),
        archive_tsd=readers.read_archive(spark, cfg["archive_tsd"],
                                         schemas.ARCHIVE_DEPTH_TEMPERATURE),
        archive_tsw=readers.read_archive(spark, cfg["archive_tsw"],
                                         schemas.ARCHIVE_POINT_TEMPERATURE),
        provisional_wq=readers.read_provisional(spark, root, "20288", fmt),
        provisional_tsd=readers.read_provisional(spark, root, "20264", fmt),
        provisional_prt=readers.read_provisional(spark, root, "20053", fmt),
        curated_lake=readers.read_curated_csv(spark, cfg["curated_lake"]),
        curated_river=readers.read_curated_csv(spark, cfg["curated_river"]),
        depth_lookup=rule("depth_lookup", rules.DEPTH_LOOKUP_SCHEMA, rules.depth_lookup),
        corrections=rule("corrections", rules.CORRECTIONS_SCHEMA, rules.depth_corrections),
        ranges=rule("ranges", rules.RANGES_SCHEMA, rules.ranges),
        masks=rule("masks", rules.MASKS_SCHEMA, rules.masks),
        qc_params=rule("qc_params", rules.QC_SCHEMA, rules.qc_params), **options)


def main(argv=None) -> None:
    from sensorflow.plans import jobs

    p = argparse.ArgumentParser(prog="sensorflow")
    p.add_argument("job", choices=["targets", "refresh", "update", "months", "climatology", "persistence",
                                "metadata"])
    p.add_argument("--config")
    p.add_argument("--out")
    p.add_argument("--targets")
    p.add_argument("--as-of")
    p.add_argument("--horizon", type=int, default=35)
    p.add_argument("--incoming")
    p.add_argument("--landing")
    p.add_argument("--checkpoint")
    p.add_argument("--product")
    p.add_argument("--format", default="avro")
    p.add_argument("--columns", help="required columns of the forecast file, in order")
    p.add_argument("--forecast")
    p.add_argument("--geo")
    p.add_argument("--sites")
    p.add_argument("--metadata", help="run metadata document (.yml/.yaml or .json)")
    p.add_argument("--issue-time")
    p.add_argument("--iteration-id")
    p.add_argument("--full", action="store_true")
    p.add_argument("--local", action="store_true")
    a = p.parse_args(argv)
    spark = _session(a.local)
    if a.job == "targets":
        cfg = load_config(a.config)
        print(json.dumps(jobs.run_targets(spark, _inputs(spark, cfg), a.out)))
    elif a.job == "refresh":
        print(jobs.run_refresh(spark, a.incoming, a.landing, a.checkpoint, a.product, a.format))
    elif a.job == "update":
        cfg = load_config(a.config)
        print(json.dumps(jobs.run_refresh_targets(spark, _inputs(spark, cfg), cfg["provisional_root"], a.out, a.full)))
    elif a.job == "months":
        print(json.dumps(jobs.run_month_plan(spark, a.targets, a.as_of)))
    elif a.job == "climatology":
        print(jobs.run_climatology(spark, a.targets, a.out, a.as_of, a.horizon))
    elif a.job == "persistence":
        print(jobs.run_persistence(spark, a.targets, a.out, a.as_of, a.horizon))
    else:
        sites = a.sites.split(",") if a.sites else None
        meta = load_config(a.metadata) if a.metadata else None
        columns = a.columns.split(",") if a.columns else None
        print(json.dumps(jobs.run_metadata(spark, a.forecast, a.geo, sites, columns, metadata=meta,
                                           issue_time=a.issue_time,
                                           iteration_id=a.iteration_id), default=str))


if __name__ == "__main__":
    main()
