"""Persistence forecast in closed form, and summaries of forecast ensembles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorflow.operators.differences import differences_of
from sensorflow.operators.reshape import to_long
from sensorflow.operators.seriesscan import lag_columns
from sensorflow.sources.rules import HORIZON_DAYS


def _d(v):
    return v if not isinstance(v, str) else F.to_date(F.lit(v))


def rw_analytic(targets: DataFrame, as_of, horizon: int = HORIZON_DAYS,
                keys=("site_id", "variable"), time: str = "time",
                value: str = "observed") -> DataFrame:
    """Closed-form persistence forecast in long mu/sigma form.

    mu = last known value up to ``as_of``; sigma = sd of successive differences of the
    known values x sqrt(days since that value).  Series without data are skipped.  Last value,
    its day and the sd come from one aggregate over the lagged rows.
    """
    keys = list(keys)
    known = targets.where((F.col(time) <= _d(as_of)) & F.col(value).isNotNull())
    lagged = lag_columns(known, keys, [time], [value], prefix="__p_")
    b = lagged.groupBy(*keys).agg(
        F.max(time).alias("__t"), F.max_by(value, time).alias("__v"),
        F.stddev_samp(F.col(value) - F.col("__p_" + value)).alias("diff_sd"))
    return _bands(b, as_of, horizon, keys)


def rw_from_state(state: DataFrame, as_of, horizon: int = HORIZON_DAYS, keys=("site_id", "variable")) -> DataFrame:
    """``rw_analytic`` from kept differences (``differences.update_differences``) of the days up to ``as_of``:
    one row per series and month instead of the history."""
    b = differences_of(state, keys).withColumnsRenamed({"last_time": "__t", "last_value": "__v"})
    return _bands(b, as_of, horizon, list(keys))


def _bands(b: DataFrame, as_of, horizon: int, keys: list[str]) -> DataFrame:
    """mu and sigma per day of the horizon from (keys, last day, last value, diff_sd)."""
    start, end = F.date_add(_d(as_of), 1), F.date_add(_d(as_of), horizon)
    f = b.select(*keys, "__t", "__v", "diff_sd",
                 F.explode(F.sequence(start, end, F.expr("INTERVAL 1 DAY"))).alias("time"))
    lead = F.datediff(F.col("time"), F.col("__t")).cast("double")
    f = f.select("time", _d(as_of).alias("start_time"), *keys,
                 F.col("__v").alias("mu"), (F.col("diff_sd") * F.sqrt(lead)).alias("sigma"))
    long = to_long(f, ["time", "start_time", *keys], ["mu", "sigma"], "parameter", "predicted")
    return long.withColumn("family", F.lit("normal")).select(
        "time", "start_time", *keys, "family", "parameter", "predicted")


def ensemble_summary(ensemble: DataFrame, keys=("time", "site_id", "variable"),
                     value: str = "predicted", exact: bool = True,
                     accuracy: int = 10000) -> DataFrame:
    """Mean and 95 % interval (type-7 quantiles) per forecast key.

    A group holds the members of one forecast key, bounded by the ensemble size, so the
    exact ``percentile`` is safe here.  ``exact=False`` uses ``percentile_approx`` (a
    mergeable sketch of bounded size) for groups without such a bound.
    """
    probs = F.array(F.lit(0.025), F.lit(0.975))
    q = (F.percentile(F.col(value), probs) if exact
         else F.percentile_approx(F.col(value), probs, accuracy))
    return (ensemble.groupBy(*keys).agg(F.avg(value).alias("mean"), q.alias("__q"))
            .select(*keys, "mean", F.col("__q")[1].alias("upper"),
                    F.col("__q")[0].alias("lower")))
