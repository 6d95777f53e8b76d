"""Raw sources -> tidy targets and the expanded hourly lake profile.

Every function returns a lazy DataFrame; nothing is collected.  QC runs per source
before a merge, the gross range and manual masks after it.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorflow.functions.missing import nan_to_null
from sensorflow.operators.depth import correct_depth, in_depth_window, surface_only
from sensorflow.operators.provisional import (
    drop_variable_for_class, provisional_point_daily, provisional_tsd_profile_hourly,
    provisional_tsd_surface_daily, provisional_wq_daily,
)
from sensorflow.operators.quality import (
    gross_range, mask_rules, qc_by_source, qc_series, qf_mask, qf_or_after_date,
)
from sensorflow.operators.reshape import to_long, union_all
from sensorflow.operators.rollup import daily_mean, hourly_mean, merge_sources
from sensorflow.sources.rules import (
    ACCEPT_FAILED_AFTER, STREAM_POSITIONS, qc_params, qc_setting,
)
from sensorflow.streaming.coverage_map import coverage_map, not_covered

LAKE = "Lake"
RIVER = "Non-wadeable River"
STREAM = "Wadeable Stream"

# Pass ``qc=RAW`` to a source builder to get its rows before the series QC (the targets
# build QCs all sources of a merge in one pass with ``qc_by_source``).
RAW = False


def _qc(df: DataFrame, keys: list[str], qc, source: str) -> DataFrame:
    if qc is RAW:
        return df
    return qc_series(df, keys, "time", "observed", **(qc or qc_setting(source)))


def sites_of(sites: DataFrame, subtype: str) -> DataFrame:
    return sites.where(F.col("field_site_subtype") == F.lit(subtype)).select(
        F.col("field_site_id").alias("__site"))


def in_sites(df: DataFrame, sites: DataFrame, subtype: str | None, col: str) -> DataFrame:
    """Semi join on the site dimension (all aquatic sites, or one class of them)."""
    s = (sites_of(sites, subtype) if subtype else
         sites.select(F.col("field_site_id").alias("__site")))
    return df.join(s, F.col(col) == F.col("__site"), "left_semi")


# --- water quality ----------------------------------------------------------------------

def archive_wq_scan(wq: DataFrame, sites: DataFrame) -> DataFrame:
    """Archive water quality rows of known sites, typed, within the surface depth window.

    Numeric coercion uses ``try_cast`` (text such as 'NA' becomes NULL) and NaN becomes
    NULL; the depth window is (0, 1) m or unknown.
    """
    d = in_sites(wq, sites, None, "siteID")
    d = d.select(
        F.col("siteID").alias("site_id"), "startDateTime",
        nan_to_null(F.col("sensorDepth").try_cast("double")).alias("sensorDepth"),
        nan_to_null(F.col("dissolvedOxygen").try_cast("double")).alias("dissolvedOxygen"),
        nan_to_null(F.col("chlorophyll").try_cast("double")).alias("chla"),
        "dissolvedOxygenFinalQF", "chlorophyllFinalQF")
    return in_depth_window(d, "sensorDepth", 0.0, 1.0)


def archive_wq_daily(wq: DataFrame, sites: DataFrame,
                     drop_stream_chla: bool = True) -> DataFrame:
    """Archive water quality -> daily (time, site_id, variable, observed).

    Per-value flag mask, daily skip-missing mean, long form, no chlorophyll at streams.
    """
    d = archive_wq_scan(wq, sites)
    d = (d.withColumn("dissolvedOxygen", qf_mask("dissolvedOxygen", "dissolvedOxygenFinalQF"))
         .withColumn("chla", qf_mask("chla", "chlorophyllFinalQF")))
    daily = daily_mean(d, ["site_id"], "startDateTime",
                       {"oxygen": "dissolvedOxygen", "chla": "chla"})
    out = to_long(daily, ["time", "site_id"], ["oxygen", "chla"])
    if drop_stream_chla:
        out = drop_variable_for_class(out, sites, STREAM, ["chla"])
    return out


def wq_targets(wq_archive_daily: DataFrame, wq_provisional_daily: DataFrame | None,
               ranges: DataFrame, masks: DataFrame) -> DataFrame:
    """Union archive and provisional daily rows, then gross range and manual masks."""
    u = merge_sources(*[d for d in (wq_archive_daily, wq_provisional_daily) if d is not None],
                      keys=["time", "site_id", "variable"], mode="union")
    return mask_rules(gross_range(u, ranges), masks)


# --- lake profiles ----------------------------------------------------------------------

def archive_lake_hourly(tsd: DataFrame, sites: DataFrame, corrections: DataFrame,
                        qc: dict | None = None,
                        accept_failed_after=ACCEPT_FAILED_AFTER) -> DataFrame:
    """Archive thermistor chain at lakes -> QC'd hourly profile (time, site_id, depth, ...)."""
    d = in_sites(tsd, sites, LAKE, "siteID")
    d = d.select(F.col("siteID").alias("site_id"), "startDateTime",
                 F.col("thermistorDepth").alias("depth"), "verticalPosition",
                 nan_to_null(F.col("tsdWaterTempMean")).alias("tsdWaterTempMean"),
                 "tsdWaterTempFinalQF")
    d = correct_depth(d, corrections, "site_id", "verticalPosition", "startDateTime", "depth")
    d = qf_or_after_date(d, "tsdWaterTempFinalQF", "startDateTime", accept_failed_after)
    h = hourly_mean(d, ["site_id", "depth"], "startDateTime", {"observed": "tsdWaterTempMean"},
                    round_depth="depth")
    h = _qc(h, ["site_id", "depth"], qc, "lake_portal")
    return h.withColumn("variable", F.lit("temperature"))


def curated_lake_hourly(curated: DataFrame, sites: DataFrame, qc: dict | None = None,
                        subtype: str = LAKE) -> DataFrame:
    """Curated profile -> hourly strict mean per rounded depth, QC'd."""
    d = in_sites(curated, sites, subtype, "siteID")
    d = d.select(F.col("siteID").alias("site_id"), "startDate",
                 F.col("sensorDepth").alias("depth"),
                 nan_to_null(F.col("waterTemp")).alias("waterTemp"))
    h = hourly_mean(d, ["site_id", "depth"], "startDate", {"observed": "waterTemp"},
                    strict=True, round_depth="depth")
    h = _qc(h, ["site_id", "depth"], qc, "lake_curated")
    return h.withColumn("variable", F.lit("temperature"))


def provisional_lake_hourly(long: DataFrame, sites: DataFrame, lookup: DataFrame,
                            qc: dict | None = None) -> DataFrame:
    d = in_sites(long, sites, LAKE, "siteName")
    h = provisional_tsd_profile_hourly(d, lookup)
    return _qc(h, ["site_id", "depth"], qc, "lake_provisional")


def profile_merge(*hourly: DataFrame) -> DataFrame:
    """Mean of the per-source hourly means per (time, site_id, depth)."""
    m = merge_sources(*hourly, keys=["time", "site_id", "depth"], mode="mean")
    return m.withColumn("variable", F.lit("temperature")).select(
        "time", "site_id", "depth", "variable", "observed")


def surface_daily(profile: DataFrame, max_depth: float = 1.0) -> DataFrame:
    """Daily surface mean from the hourly profile (unweighted over depth x hour)."""
    d = surface_only(profile, "depth", max_depth)
    daily = daily_mean(d, ["site_id"], "time", {"observed": "observed"})
    return daily.withColumn("variable", F.lit("temperature")).select(
        "time", "site_id", "variable", "observed")


# --- streams and rivers -----------------------------------------------------------------

def archive_stream_daily(tsw: DataFrame, qc: dict | None = None,
                         positions: Sequence[str] = STREAM_POSITIONS) -> DataFrame:
    """Point surface temperature (upstream positions, passed flags) -> QC'd daily mean."""
    d = tsw.where(F.col("horizontalPosition").isin(*positions) & (F.col("finalQF") == 0))
    d = d.select(F.col("siteID").alias("site_id"), "startDateTime",
                 nan_to_null(F.col("surfWaterTempMean")).alias("surfWaterTempMean"))
    daily = daily_mean(d, ["site_id"], "startDateTime", {"observed": "surfWaterTempMean"})
    daily = _qc(daily, ["site_id"], qc, "stream_portal")
    return daily.withColumn("variable", F.lit("temperature"))


def archive_river_daily(tsd: DataFrame, sites: DataFrame, qc: dict | None = None) -> DataFrame:
    """Thermistor chain at rivers (whole water column, passed flags) -> QC'd daily mean."""
    d = in_sites(tsd, sites, RIVER, "siteID").where(F.col("tsdWaterTempFinalQF") == 0)
    d = d.select(F.col("siteID").alias("site_id"), "startDateTime",
                 nan_to_null(F.col("tsdWaterTempMean")).alias("tsdWaterTempMean"))
    daily = daily_mean(d, ["site_id"], "startDateTime", {"observed": "tsdWaterTempMean"})
    daily = _qc(daily, ["site_id"], qc, "river_portal")
    return daily.withColumn("variable", F.lit("temperature"))


def curated_river_daily(curated: DataFrame, sites: DataFrame, qc: dict | None = None):
    """Curated river profile -> daily strict mean over the whole column, QC'd."""
    d = in_sites(curated, sites, RIVER, "siteID")
    d = d.select(F.col("siteID").alias("site_id"), "startDate",
                 nan_to_null(F.col("waterTemp")).alias("waterTemp"))
    daily = daily_mean(d, ["site_id"], "startDate", {"observed": "waterTemp"}, strict=True)
    daily = _qc(daily, ["site_id"], qc, "river_curated")
    return daily.withColumn("variable", F.lit("temperature"))


def provisional_stream_daily(long: DataFrame, qc: dict | None = None) -> DataFrame:
    d = provisional_point_daily(long)
    return _qc(d, ["site_id"], qc, "stream_provisional")


def provisional_river_daily(long: DataFrame, sites: DataFrame, lookup: DataFrame,
                            qc: dict | None = None) -> DataFrame:
    d = provisional_tsd_surface_daily(in_sites(long, sites, RIVER, "siteName"), lookup)
    return _qc(d, ["site_id"], qc, "river_provisional")


def temperature_targets(daily_sources: list[DataFrame], ranges: DataFrame,
                        masks: DataFrame) -> DataFrame:
    """Mean of the daily temperature sources per (site, day), gross range, masks.

    ``variable`` stays a merge key taken from the sources, so the gross-range lookup is
    an equi-join on it (a literal column would be folded into a keyless join).
    """
    src = [d.withColumn("variable", F.lit("temperature")) if "variable" not in d.columns
           else d for d in daily_sources]
    m = merge_sources(*src, keys=["site_id", "time", "variable"], mode="mean")
    return mask_rules(gross_range(m, ranges), masks)


def finalize_targets(*parts: DataFrame) -> DataFrame:
    """Union the target parts, NaN -> NULL, fixed column order."""
    u = union_all(*[p.select("time", "site_id", "variable", "observed") for p in parts])
    return u.withColumn("observed", nan_to_null("observed"))


@dataclass
class TargetInputs:
    """The raw inputs of one targets run (all lazy DataFrames)."""

    sites: DataFrame
    archive_wq: DataFrame
    archive_tsd: DataFrame
    archive_tsw: DataFrame
    provisional_wq: DataFrame
    provisional_tsd: DataFrame
    provisional_prt: DataFrame
    curated_lake: DataFrame
    curated_river: DataFrame
    depth_lookup: DataFrame
    corrections: DataFrame
    ranges: DataFrame
    masks: DataFrame
    supersede: bool = True
    qc_params: DataFrame | None = None
    accept_failed_after: dt.date = ACCEPT_FAILED_AFTER
    stream_positions: Sequence[str] = STREAM_POSITIONS
    coverage: DataFrame | None = None

    def qc(self) -> DataFrame:
        """Per-source QC parameters (source, lo, hi, spike, by_depth)."""
        if self.qc_params is not None:
            return self.qc_params
        return qc_params(self.sites.sparkSession)

    def lake_hourly(self) -> DataFrame:
        return archive_lake_hourly(self.archive_tsd, self.sites, self.corrections, qc=RAW,
                                   accept_failed_after=self.accept_failed_after)

    def river_daily(self) -> DataFrame:
        return archive_river_daily(self.archive_tsd, self.sites, qc=RAW)

    def stream_daily(self) -> DataFrame:
        return archive_stream_daily(self.archive_tsw, qc=RAW, positions=self.stream_positions)

    def fresh(self, product: str, provisional: DataFrame, time: str, site: str,
              variable: str | Column = "variable") -> DataFrame:
        """Provisional rows of the (site, variable, month)s that the product's archive does not hold."""
        if not self.supersede:
            return provisional
        held = (self.coverage if self.coverage is not None else archive_coverage(self)).where(
            F.col("product") == product)
        return not_covered(provisional, held, time, {"site_id": site, "variable": variable})


def archive_coverage(inp: TargetInputs) -> DataFrame:
    """(product, site_id, variable, month_bucket, months): the months that the archives fill.

    From the rows that enter the target, before any aggregation: one map-side aggregate over a
    few columns.  A run that keeps it as a table and passes it as ``TargetInputs.coverage`` scans
    each archive once.
    """
    wq = archive_wq_scan(inp.archive_wq, inp.sites).select(
        "site_id", "startDateTime", qf_mask("dissolvedOxygen", "dissolvedOxygenFinalQF").alias("oxygen"),
        qf_mask("chla", "chlorophyllFinalQF").alias("chla"))
    wq = to_long(wq, ["site_id", "startDateTime"], ["oxygen", "chla"])
    wq = drop_variable_for_class(wq, inp.sites, STREAM, ["chla"])

    def rows(d: DataFrame, product: str, variable: str | None, value: str, site: str = "siteID") -> DataFrame:
        kept = d.select(F.lit(product).alias("product"), F.col(site).alias("site_id"),
                        (F.lit(variable) if variable else F.col("variable")).alias("variable"), "startDateTime",
                        nan_to_null(F.col(value)).alias("v"))
        return coverage_map(kept, ["product", "site_id", "variable"], "startDateTime", "v")

    lake = qf_or_after_date(in_sites(inp.archive_tsd, inp.sites, LAKE, "siteID"), "tsdWaterTempFinalQF",
                            "startDateTime", inp.accept_failed_after)
    river = in_sites(inp.archive_tsd, inp.sites, RIVER, "siteID").where(F.col("tsdWaterTempFinalQF") == 0)
    stream = inp.archive_tsw.where(F.col("horizontalPosition").isin(*inp.stream_positions) & (F.col("finalQF") == 0))
    return union_all(rows(wq, "20288", None, "observed", "site_id"),
                     rows(lake, "20264", "temperature", "tsdWaterTempMean"),
                     rows(river, "20264", "temperature", "tsdWaterTempMean"),
                     rows(stream, "20053", "temperature", "surfWaterTempMean"))


def _tag(df: DataFrame, source: str, cols: list[str]) -> DataFrame:
    return df.select(*cols).withColumn("source", F.lit(source))


def lake_sources(inp: TargetInputs) -> DataFrame:
    """Hourly lake rows (source, time, site_id, depth, observed) of the three sources, before QC."""
    cols = ["time", "site_id", "depth", "observed"]
    fresh = inp.fresh("20264", inp.provisional_tsd, "startDate", "siteName", F.lit("temperature"))
    return union_all(
        _tag(inp.lake_hourly(), "lake_portal", cols),
        _tag(curated_lake_hourly(inp.curated_lake, inp.sites, qc=RAW), "lake_curated", cols),
        _tag(provisional_lake_hourly(fresh, inp.sites, inp.depth_lookup, qc=RAW), "lake_provisional", cols))


def surface_sources(inp: TargetInputs) -> DataFrame:
    """Daily stream and river rows (source, time, site_id, variable, observed) of the five sources,
    before QC."""
    cols = ["time", "site_id", "variable", "observed"]
    streams, rivers = (inp.fresh(p, d, "startDate", "siteName", F.lit("temperature"))
                       for p, d in (("20053", inp.provisional_prt), ("20264", inp.provisional_tsd)))
    return union_all(
        _tag(inp.stream_daily(), "stream_portal", cols),
        _tag(provisional_stream_daily(streams, qc=RAW), "stream_provisional", cols),
        _tag(inp.river_daily(), "river_portal", cols),
        _tag(curated_river_daily(inp.curated_river, inp.sites, qc=RAW), "river_curated", cols),
        _tag(provisional_river_daily(rivers, inp.sites, inp.depth_lookup, qc=RAW), "river_provisional", cols))


def build_expanded_profile(inp: TargetInputs) -> DataFrame:
    """Hourly lake profile: three sources QC'd in one pass (each its own series), then
    the mean of the source means per (time, site, depth)."""
    q = qc_by_source(lake_sources(inp), inp.qc(), ["source", "site_id", "depth"])
    return profile_merge(q.select("time", "site_id", "depth", "observed"))


def build_temperature(inp: TargetInputs, profile: DataFrame | None = None) -> DataFrame:
    """Daily surface temperature of lakes, streams and rivers, merged and cleaned.

    The five stream/river sources are QC'd in one pass with their own thresholds, then
    merged with the lake surface means."""
    prof = profile if profile is not None else build_expanded_profile(inp)
    cols = ["time", "site_id", "variable", "observed"]
    q = qc_by_source(surface_sources(inp), inp.qc(), ["source", "site_id"])
    return temperature_targets([surface_daily(prof), q.select(*cols)], inp.ranges,
                               inp.masks).select(*cols)


def build_targets(inp: TargetInputs, profile: DataFrame | None = None) -> DataFrame:
    """The whole targets table.  Pass ``profile`` to reuse a materialised hourly profile."""
    archived = archive_wq_daily(inp.archive_wq, inp.sites)
    # days are superseded, not records: a row's flags decide for both of its variables
    fresh = inp.fresh("20288", provisional_wq_daily(inp.provisional_wq, inp.sites), "time", "site_id")
    wq = wq_targets(archived, fresh, inp.ranges, inp.masks)
    return finalize_targets(wq, build_temperature(inp, profile))
