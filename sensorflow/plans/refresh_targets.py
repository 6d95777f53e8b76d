"""Targets that refresh: what newly landed records change is computed again, nothing else.

A refreshable table lies in one folder:

* ``targets``   the targets, partitioned by variable, site and month
* ``coverage``  the months that the archives hold (``targets.archive_coverage``)
* ``series``    the months in which each temperature series (source, site, depth) has rows before QC
* ``applied``   the landed batches that the targets reflect

New batches name the (product, site, month)s they touch, without a look at their data.  Months
that the archive holds are superseded and change nothing.  A daily water-quality value depends on
its day alone, so its month is all that is dirty.  A temperature value is tested against the
row before it, so the next month in which a provisional series has rows is dirty, too, and the
month before a dirty one in which a series has rows is read as context.  The sources are cut to
those months, the dirty partitions are computed as a full build would and replace the old ones.

New archive data is for a full build, as it supersedes.
"""

from __future__ import annotations

import dataclasses
import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorflow.plans.targets import (
    TargetInputs, archive_coverage, build_targets, lake_sources, surface_sources,
)
from sensorflow.session import shared_path
from sensorflow.sources.landing import read_ledger
from sensorflow.sources.rules import PRODUCT_VARIABLES
from sensorflow.streaming.coverage_map import not_covered

PARTS = ("variable", "site_id", "ms")
PROVISIONAL_SOURCES = ("lake_provisional", "stream_provisional", "river_provisional")


def _ms(time: str) -> Column:
    return F.date_format(time, "yyyy-MM")


def _stored(spark: SparkSession, out: str, name: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(f"{out}/{name}")


def read_refreshable(spark: SparkSession, out: str) -> DataFrame:
    """The targets (time, site_id, variable, observed)."""
    d = _stored(spark, out, "targets", "time date, observed double, variable string, site_id string, ms string")
    return d.select("time", "site_id", "variable", "observed")


def _coverage(spark: SparkSession, out: str) -> DataFrame:
    return _stored(spark, out, "coverage", "product string, site_id string, variable string, month_bucket long, months binary")


def series_months(inp: TargetInputs) -> DataFrame:
    """(source, site_id, depth, ms) of the temperature rows before QC."""
    lake = lake_sources(inp).select("source", "site_id", F.col("depth").cast("double").alias("depth"), _ms("time").alias("ms"))
    other = surface_sources(inp).select("source", "site_id", F.lit(None).cast("double").alias("depth"), _ms("time").alias("ms"))
    return lake.unionByName(other).distinct()


def _replace(rows: DataFrame, path: str, parts: tuple[str, ...], dirty: set[tuple]) -> None:
    """Rows of the dirty partitions replace what ``path`` has there; partitions left without a row go."""
    spark = rows.sparkSession
    once = shared_path(spark, "refreshed", uuid.uuid4().hex)
    rows.write.parquet(once)
    new = spark.read.schema(rows.schema).parquet(once)
    (new.hint("rebalance", *parts).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*parts).parquet(path))
    left = dirty - {tuple(r) for r in new.select(*parts).distinct().collect()}
    jvm = spark._jvm
    escape = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString
    for values in sorted(left, key=str):
        p = jvm.org.apache.hadoop.fs.Path("/".join([path, *(escape(c, v) for c, v in zip(parts, values))]))
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def _batches(spark: SparkSession, landing: str) -> DataFrame:
    """(batch, product, site, ms) of the landed records; a compaction lands none."""
    ledger = read_ledger(spark, landing)
    if ledger is None:
        raise ValueError(f"{landing} has no ledger of batches")
    return ledger.where(F.col("replaces").isNull()).select("batch", "product", "site", "ms").distinct()


def _apply(spark: SparkSession, out: str, batches: DataFrame) -> None:
    batches.select("batch").distinct().coalesce(1).write.mode("append").parquet(f"{out}/applied")


def build_refreshable(spark: SparkSession, inp: TargetInputs, landing: str, out: str) -> str:
    """A full build of the table from all sources; ``inp`` has the landing's provisional records."""
    out = out.rstrip("/")
    batches = _batches(spark, landing).select("batch").distinct().collect()  # what is landed now
    archive_coverage(inp).write.mode("overwrite").parquet(f"{out}/coverage")
    inp = dataclasses.replace(inp, coverage=_coverage(spark, out))
    rows = build_targets(inp).withColumn("ms", _ms("time"))
    (rows.hint("rebalance", *PARTS).write.mode("overwrite").option("partitionOverwriteMode", "static")
     .partitionBy(*PARTS).parquet(f"{out}/targets"))
    (series_months(inp).write.mode("overwrite").option("partitionOverwriteMode", "static")
     .partitionBy("site_id", "ms").parquet(f"{out}/series"))
    (spark.createDataFrame(batches, "batch string").coalesce(1).write.mode("overwrite").parquet(f"{out}/applied"))
    return out


def only_months(df: DataFrame, pairs: list[tuple], time: str, site: str) -> DataFrame:
    """Rows of the listed (site, yyyy-MM)s.

    Sites and the range of months are plain filters, which reach the scan, as do those on the
    partition columns of landed records; the exact pairs are a join with the list.
    """
    if not pairs:
        return df.limit(0)
    spark = df.sparkSession
    sites, months = sorted({p[0] for p in pairs}), sorted({p[1] for p in pairs})
    year, month = map(int, months[-1].split("-"))
    end = dt.datetime(year + month // 12, month % 12 + 1, 1)
    first = dt.datetime(*map(int, months[0].split("-")), 1)
    kept = df.where(F.col(site).isin(sites) & (F.col(time) >= F.lit(first).cast("timestamp_ntz"))
                    & (F.col(time) < F.lit(end).cast("timestamp_ntz")))
    if {"site", "ms"} <= set(df.columns):
        kept = kept.where(F.col("site").isin(sites) & F.col("ms").isin(months))
    listed = spark.createDataFrame(pairs, "__site string, __ms string")
    return kept.join(listed, (F.col(site) == F.col("__site")) & (_ms(time) == F.col("__ms")), "left_semi")


def plan_refresh(spark: SparkSession, landing: str, out: str) -> dict:
    """What the batches landed since the last run change: ``batches``; ``dirty`` (variable, site, ms); the
    (site, ms)s to read for water quality (``water``) and for temperature (``temperature``).

    One row per touched site and month reaches the driver.
    """
    applied = _stored(spark, out, "applied", "batch string")
    new = _batches(spark, landing).join(applied, "batch", "left_anti").where("site IS NOT NULL AND ms IS NOT NULL")
    names = [r.batch for r in new.select("batch").distinct().collect()]
    kinds = F.create_map(*[x for p, vs in PRODUCT_VARIABLES.items()
                           for x in (F.lit(p), F.array(*[F.lit(v) for v in vs]))])
    touched = new.select("product", "site", "ms", F.explode(F.element_at(kinds, F.col("product"))).alias("variable")).distinct()
    touched = not_covered(touched.withColumn("day", F.to_date(F.concat("ms", F.lit("-01")))), _coverage(spark, out), "day",
                          {"product": "product", "site_id": "site", "variable": "variable"})
    rows = [tuple(r) for r in touched.select("variable", "site", "ms").distinct().collect()]
    water = {r for r in rows if r[0] != "temperature"}
    warm = {r[1:] for r in rows if r[0] == "temperature"}
    affected, context = set(warm), set()
    if warm:
        series = _stored(spark, out, "series", "source string, depth double, site_id string, ms string").where(
            F.col("site_id").isin(sorted({s for s, _ in warm})))

        def neighbours(of: set[tuple], rows: DataFrame, later: bool) -> set[tuple]:
            """The nearest month of each series after (or before) each listed one."""
            at = spark.createDataFrame(sorted(of), "site_id string, at string")
            j = rows.join(at, "site_id").where(F.col("ms") > F.col("at") if later else F.col("ms") < F.col("at"))
            near = j.groupBy("source", "site_id", "depth", "at").agg((F.min if later else F.max)("ms").alias("ms"))
            return {tuple(r) for r in near.select("site_id", "ms").distinct().collect()}

        affected |= neighbours(warm, series.where(F.col("source").isin(*PROVISIONAL_SOURCES)), True)
        context = neighbours(affected, series, False)
    return {"batches": names, "dirty": water | {("temperature", *p) for p in affected},
            "water": sorted({r[1:] for r in water}), "temperature": sorted(affected | context),
            "affected": affected}


def restricted(inp: TargetInputs, plan: dict, coverage: DataFrame) -> TargetInputs:
    """The inputs cut to the months that a refresh reads."""
    w, t = plan["water"], plan["temperature"]
    return dataclasses.replace(
        inp, coverage=coverage,
        archive_wq=only_months(inp.archive_wq, w, "startDateTime", "siteID"),
        provisional_wq=only_months(inp.provisional_wq, w, "startDate", "siteName"),
        archive_tsd=only_months(inp.archive_tsd, t, "startDateTime", "siteID"),
        archive_tsw=only_months(inp.archive_tsw, t, "startDateTime", "siteID"),
        provisional_tsd=only_months(inp.provisional_tsd, t, "startDate", "siteName"),
        provisional_prt=only_months(inp.provisional_prt, t, "startDate", "siteName"),
        curated_lake=only_months(inp.curated_lake, t, "startDate", "siteID"),
        curated_river=only_months(inp.curated_river, t, "startDate", "siteID"))


def refresh_targets(spark: SparkSession, inp: TargetInputs, landing: str, out: str) -> set[tuple]:
    """Brings the table up to what is landed; returns the (variable, site, month)s computed again.

    Batches count as applied last, so a run that dies is simply repeated.
    """
    out = out.rstrip("/")
    plan = plan_refresh(spark, landing, out)
    if plan["dirty"]:
        cut = restricted(inp, plan, _coverage(spark, out))
        listed = spark.createDataFrame(sorted(plan["dirty"]), "variable string, site_id string, ms string")
        rows = build_targets(cut).withColumn("ms", _ms("time")).join(listed, list(PARTS), "left_semi")
        _replace(rows.select("time", "observed", *PARTS), f"{out}/targets", PARTS, plan["dirty"])
    if plan["affected"]:
        months = spark.createDataFrame(sorted(plan["affected"]), "site_id string, ms string")
        rows = series_months(cut).join(months, ["site_id", "ms"], "left_semi")
        _replace(rows.select("source", "depth", "site_id", "ms"), f"{out}/series", ("site_id", "ms"), plan["affected"])
    if plan["batches"]:
        _apply(spark, out, spark.createDataFrame([(b,) for b in plan["batches"]], "batch string"))
    return plan["dirty"]
