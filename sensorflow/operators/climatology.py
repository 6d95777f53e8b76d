"""Day-of-year climatology and the climatology forecast (normal mu / sigma per day)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sensorflow.functions.missing import nan_to_null
from sensorflow.operators.moments import mean_and_sd
from sensorflow.operators.reshape import to_long
from sensorflow.operators.series import date_range


def _d(v):
    return v if not isinstance(v, str) else F.to_date(F.lit(v))


def doy_stats(targets: DataFrame, time: str = "time", keys=("site_id", "variable"),
              value: str = "observed", as_of=None) -> DataFrame:
    """Mean and sample sd per (day of year, site, variable), missing values skipped.

    Only rows up to ``as_of`` count when it is given.  Algebraic aggregates only: partial
    aggregation on the map side, one small shuffle.
    """
    d = targets if as_of is None else targets.where(F.col(time) <= _d(as_of))
    d = d.withColumn("doy", F.dayofyear(F.col(time)))
    return d.groupBy("doy", *keys).agg(nan_to_null(F.avg(value)).alias("mean"),
                                       F.stddev_samp(value).alias("sd"))


def forecast_days(spark, as_of, horizon: int) -> DataFrame:
    """The forecast dates ``as_of + 1 .. as_of + horizon`` with their day of year."""
    days = date_range(spark, F.date_add(_d(as_of), 1), horizon)
    return days.withColumn("doy", F.dayofyear("time"))


def forecast_grid(series_sites: DataFrame, as_of, horizon: int,
                  variables: Sequence[str]) -> DataFrame:
    """Every forecast date x site x variable (generated per site row, no join)."""
    start = F.date_add(_d(as_of), 1)
    end = F.date_add(_d(as_of), horizon)
    s = series_sites.select("site_id").distinct()
    s = s.select("site_id", F.explode(F.array(*[F.lit(v) for v in variables])).alias("variable"))
    return s.select("site_id", "variable",
                    F.explode(F.sequence(start, end, F.expr("INTERVAL 1 DAY"))).alias("time"))


def climatology_window(targets: DataFrame, as_of, horizon: int = 35) -> DataFrame:
    """Day-of-year mean and sd of the history up to ``as_of`` for each forecast date.

    Rows meet the forecast dates by ``dayofyear`` before they are aggregated, so days of
    year outside the window never reach the shuffle, and a window that crosses New Year gets
    January dates of the next year.  The date side has ``horizon`` rows (a parameter) and is
    broadcast.
    """
    days = forecast_days(targets.sparkSession, as_of, horizon).withColumnRenamed("time", "__day")
    hist = targets.where(F.col("time") <= _d(as_of))
    d = hist.withColumn("doy", F.dayofyear("time")).join(F.broadcast(days), "doy")
    return (d.groupBy(F.col("__day").alias("time"), "site_id", "variable")
            .agg(nan_to_null(F.avg("observed")).alias("mean"),
                 F.stddev_samp("observed").alias("sd")))


def densify_forecast(targets: DataFrame, as_of, horizon: int = 35,
                     variables: Sequence[str] = ("temperature", "oxygen", "chla")) -> DataFrame:
    """The full date x site x variable grid, left-joined with the climatology rows."""
    f = climatology_window(targets, as_of, horizon)
    grid = forecast_grid(f, as_of, horizon, variables)
    return grid.join(f, ["time", "site_id", "variable"], "left")


def climatology_forecast(targets: DataFrame, as_of, horizon: int = 35,
                         densify: bool = False,
                         variables: Sequence[str] = ("temperature", "oxygen", "chla"),
                         family: str = "normal") -> DataFrame:
    """Normal forecast per (site, variable, date): mu from the day-of-year mean (linearly
    interpolated over the window rows), sigma the median day-of-year sd of the window.

    Output (time, start_time, site_id, variable, family, parameter, predicted), where
    ``start_time`` is the day before the series' first forecast date.  ``densify=True``
    fills window dates that have no climatology row (by interpolation) first.
    """
    f = (densify_forecast(targets, as_of, horizon, variables) if densify
         else climatology_window(targets, as_of, horizon))
    return normal_forecast(f, family)


def forecast_from_state(state: DataFrame, as_of, horizon: int = 35, family: str = "normal") -> DataFrame:
    """``climatology_forecast`` from kept moments (``moments.update_climatology``) of the days up
    to ``as_of``; it reads one row per day of year and series, whatever the length of the history."""
    days = forecast_days(state.sparkSession, as_of, horizon)
    f = mean_and_sd(state.join(F.broadcast(days), "doy"), ["time", "site_id", "variable"])
    return normal_forecast(f, family)


def normal_forecast(f: DataFrame, family: str = "normal") -> DataFrame:
    """Forecast rows from the mean and sd of each (site, variable, forecast date)."""
    # a series has ``horizon`` rows at most here, so plain windows over it are bounded
    whole = Window.partitionBy("site_id", "variable")
    ordered = whole.orderBy("time")
    upto = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    onward = ordered.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    f = f.withColumn("__i", F.row_number().over(ordered))
    known = F.when(F.col("mean").isNotNull(), F.struct("mean", "__i"))
    f = f.withColumns({"__p": F.last(known, ignorenulls=True).over(upto),
                       "__n": F.first(known, ignorenulls=True).over(onward),
                       "sigma": F.median("sd").over(whole),
                       "start_time": F.date_sub(F.min("time").over(whole), 1)})
    p, n = F.col("__p"), F.col("__n")
    line = p["mean"] + (n["mean"] - p["mean"]) * (F.col("__i") - p["__i"]).cast("double") / (
        n["__i"] - p["__i"]).cast("double")
    f = f.withColumn("mu", F.when(F.col("mean").isNotNull(), F.col("mean"))
                     .when(p.isNotNull() & n.isNotNull(), line)
                     .otherwise(F.coalesce(p["mean"], n["mean"])))
    long = to_long(f.select("time", "start_time", "site_id", "variable", "mu", "sigma"),
                   ["time", "start_time", "site_id", "variable"], ["mu", "sigma"],
                   "parameter", "predicted")
    return long.withColumn("family", F.lit(family)).select(
        "time", "start_time", "site_id", "variable", "family", "parameter", "predicted")


def forecast_band(forecast: DataFrame, z: float = 1.96) -> DataFrame:
    """Long mu/sigma rows -> one row per (site, variable, date) with the normal band."""
    keys = ["time", "site_id", "variable"]
    w = forecast.groupBy(*keys).agg(
        F.max(F.when(F.col("parameter") == "mu", F.col("predicted"))).alias("mu"),
        F.max(F.when(F.col("parameter") == "sigma", F.col("predicted"))).alias("sigma"))
    return (w.withColumn("lower", F.col("mu") - F.lit(z) * F.col("sigma"))
            .withColumn("upper", F.col("mu") + F.lit(z) * F.col("sigma")))
