"""Provisional (low-latency) long term records -> daily / hourly target rows.

All four readers share one shape: keep the product's terms and positions, combine the
value fields, pivot terms to columns, keep rows where any flag passes, roll up, go long.
They take the long records as a DataFrame (any format, read once over all files by
``sources.readers.read_provisional``) and stay one Spark plan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorflow.operators.depth import lookup_depth, surface_only
from sensorflow.operators.quality import any_flag_passes
from sensorflow.operators.reshape import coalesce_value, terms_to_columns, to_long
from sensorflow.operators.rollup import daily_mean, hourly_mean
from sensorflow.sources.rules import HORIZONTAL_KEEP, PRODUCTS, TEMPORAL_30MIN


def _select_terms(long: DataFrame, product: str, thirty_minute: bool) -> DataFrame:
    cond = (F.col("termName").isin(PRODUCTS[product])
            & F.col("horizontalIndex").isin(HORIZONTAL_KEEP))
    if thirty_minute:
        cond = cond & (F.col("temporalIndex") == F.lit(TEMPORAL_30MIN))
    return coalesce_value(long.where(cond))


def _pivot(d: DataFrame, ids: Sequence[str], product: str) -> DataFrame:
    terms = [t for t in PRODUCTS[product] if t not in ids]
    return any_flag_passes(terms_to_columns(d, ids, terms))


def drop_variable_for_class(df: DataFrame, sites: DataFrame, subtype: str,
                            variables: Sequence[str], site: str = "site_id",
                            variable: str = "variable") -> DataFrame:
    """Remove ``variables`` at sites of one class (e.g. no chlorophyll for streams).

    The (site, variable) rule rows come from the site dimension; a left-anti join drops
    the matching data rows.
    """
    rules = (sites.where(F.col("field_site_subtype") == F.lit(subtype))
             .select(F.col("field_site_id").alias(site),
                     F.explode(F.array(*[F.lit(v) for v in variables])).alias(variable)))
    return df.join(rules, [site, variable], "left_anti")


def provisional_wq_daily(long: DataFrame, sites: DataFrame | None = None) -> DataFrame:
    """Daily oxygen and chlorophyll per site (product 20288); streams keep oxygen only."""
    d = _select_terms(long, "20288", thirty_minute=False)
    wide = _pivot(d, ["siteName", "startDate"], "20288")
    daily = daily_mean(wide, ["siteName"], "startDate",
                       {"oxygen": "dissolvedOxygen", "chla": "chlorophyll"})
    out = to_long(daily.withColumnRenamed("siteName", "site_id"), ["time", "site_id"],
                  ["oxygen", "chla"])
    if sites is not None:
        out = drop_variable_for_class(out, sites, "Wadeable Stream", ["chla"])
    return out


def provisional_tsd_surface_daily(long: DataFrame, lookup: DataFrame,
                                  max_depth: float = 1.0) -> DataFrame:
    """Daily mean temperature of sensors at or above ``max_depth`` m (product 20264)."""
    d = _select_terms(long, "20264", thirty_minute=True)
    d = surface_only(lookup_depth(d, lookup), "thermistorDepth", max_depth)
    wide = _pivot(d, ["siteName", "startDate", "verticalIndex", "thermistorDepth"], "20264")
    daily = daily_mean(wide, ["siteName"], "startDate", {"observed": "tsdWaterTempMean"})
    return (daily.withColumnRenamed("siteName", "site_id")
            .withColumn("variable", F.lit("temperature"))
            .select("time", "site_id", "variable", "observed"))


def provisional_tsd_profile_hourly(long: DataFrame, lookup: DataFrame,
                                   round_depth: bool = False) -> DataFrame:
    """Hourly mean temperature per sensor depth (product 20264).

    Depths are kept as looked up by default (so 0.05 m and a rounded archive 0.1 m stay
    separate cells in the merge, as published); ``round_depth=True`` rounds them to 0.1 m
    like the archive and curated sources.
    """
    d = _select_terms(long, "20264", thirty_minute=True)
    d = lookup_depth(d, lookup)
    wide = _pivot(d, ["siteName", "startDate", "verticalIndex", "thermistorDepth"], "20264")
    hourly = hourly_mean(wide, ["siteName", "thermistorDepth"], "startDate",
                         {"observed": "tsdWaterTempMean"},
                         round_depth="thermistorDepth" if round_depth else None)
    return (hourly.withColumnRenamed("siteName", "site_id")
            .withColumnRenamed("thermistorDepth", "depth")
            .withColumn("variable", F.lit("temperature"))
            .select("time", "site_id", "depth", "variable", "observed"))


def provisional_point_daily(long: DataFrame) -> DataFrame:
    """Daily mean surface temperature of a single-point sensor (product 20053)."""
    d = _select_terms(long, "20053", thirty_minute=True)
    wide = _pivot(d, ["siteName", "startDate"], "20053")
    daily = daily_mean(wide, ["siteName"], "startDate", {"observed": "surfWaterTempMean"})
    return (daily.withColumnRenamed("siteName", "site_id")
            .withColumn("variable", F.lit("temperature"))
            .select("time", "site_id", "variable", "observed"))


def read_product(long: DataFrame, product: str, lookup: DataFrame | None = None,
                 sites: DataFrame | None = None) -> DataFrame:
    """Dispatch on the product code; unknown codes raise."""
    if product not in PRODUCTS:
        raise ValueError(f"no provisional reader for product {product!r}")
    if product == "20288":
        return provisional_wq_daily(long, sites)
    if product == "20264":
        if lookup is None:
            raise ValueError("product 20264 needs the thermistor depth lookup")
        return provisional_tsd_surface_daily(long, lookup)
    return provisional_point_daily(long)
