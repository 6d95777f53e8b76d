"""Daily series utilities: spines, densifying, interpolation, difference statistics."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorflow.functions.missing import is_finite
from sensorflow.operators.seriesscan import lag_columns, linear_fill


def _d(v) -> Column:
    if isinstance(v, Column):
        return v
    return F.to_date(F.lit(str(v)))


def date_range(spark: SparkSession, start, days: int, name: str = "time") -> DataFrame:
    """``days`` consecutive dates from ``start`` (a parameter-sized spine, e.g. a horizon)."""
    return spark.range(0, days).select(F.date_add(_d(start), F.col("id").cast("int")).alias(name))


def _same(left: str, right: str, keys: Sequence[str]) -> Column:
    """Null-safe equality of ``keys``, so that NULL keys form series, too."""
    return reduce(lambda a, b: a & b,
                  [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys])


def series_spine(df: DataFrame, keys: Sequence[str], time: str, end,
                 start_keys: Sequence[str] | None = None, name: str = "time") -> DataFrame:
    """One row per day of each series, from its first date to ``end`` inclusive.

    The first date is the minimum over ``start_keys`` (default: the series keys), so a
    spine can start where the site's earliest record of any variable starts.  Each series
    expands from one bounds row, so the spine size is series x calendar days.
    """
    start_keys = list(start_keys) if start_keys is not None else list(keys)
    series = df.select(*keys).distinct().alias("s")
    starts = df.groupBy(*start_keys).agg(F.min(time).alias("__start")).alias("b")
    b = series.join(starts, _same("s", "b", start_keys)).where(F.col("__start") <= _d(end))
    return b.select(*[F.col(f"s.{k}") for k in keys],
                    F.explode(F.sequence(F.col("__start"), _d(end),
                                         F.expr("INTERVAL 1 DAY"))).alias(name))


def densify(df: DataFrame, keys: Sequence[str], time: str, end,
            start_keys: Sequence[str] | None = None) -> DataFrame:
    """Each series on its daily spine: missing days up to ``end`` become NULL rows, and every
    row of ``df`` stays, later ones and undated ones too."""
    keys = list(keys)
    others = [c for c in df.columns if c not in (*keys, time)]
    spine = series_spine(df, keys, time, end, start_keys, name=time).alias("p")
    dense = spine.join(df.alias("d"), _same("p", "d", [*keys, time]), "left").select(
        *[F.col(f"p.{c}") for c in (*keys, time)], *[F.col(f"d.{c}") for c in others])
    beyond = df.where(F.col(time).isNull() | (F.col(time) > _d(end)))
    return dense.unionByName(beyond.select(*dense.columns))


def series_with_data(df: DataFrame, keys: Sequence[str], value: str = "observed") -> DataFrame:
    """Series keys having at least one non-missing value, with their counts."""
    return (df.groupBy(*keys).agg(F.count(value).alias("n_obs"),
                                  F.count(F.lit(1)).alias("n_rows"))
            .where(F.col("n_obs") > 0))


def interpolate(df: DataFrame, keys: Sequence[str], time: str, value: str, out: str,
                by: str = "index") -> DataFrame:
    """Linear gap filling per series, ends held constant.

    ``by='index'`` interpolates on the row position in time order (spacing ignored);
    ``by='time'`` on the day number, so uneven spacing is respected.
    """
    if by == "index":
        return linear_fill(df, keys, [time], value, None, out)
    if by == "time":
        x = F.datediff(F.col(time), F.to_date(F.lit("1970-01-01")))
        return linear_fill(df, keys, [time], value, x, out)
    raise ValueError("by must be 'index' or 'time'")


def diff_sd(df: DataFrame, keys: Sequence[str], time: str = "time",
            value: str = "observed") -> DataFrame:
    """Sample sd of successive differences of the non-missing values of each series."""
    known = df.where(F.col(value).isNotNull())
    d = lag_columns(known, keys, [time], [value], prefix="__p_")
    diff = F.col(value) - F.col("__p_" + value)
    return d.groupBy(*keys).agg(F.stddev_samp(diff).alias("diff_sd"),
                                F.count(diff).alias("n_diff"))


def obs_error_fill(df: DataFrame, keys: Sequence[str], sd: str = "p_sd") -> DataFrame:
    """Gap-fill an observation-error column per series.

    Non-finite -> missing; missing -> the series mean; zero -> the smallest non-zero value
    after that fill.  Series statistics come from one aggregation joined back on the keys.
    """
    fin = F.when(is_finite(F.col(sd)), F.col(sd))
    stats = df.groupBy(*keys).agg(
        F.avg(fin).alias("__m"),
        F.min(F.when(fin != 0, fin)).alias("__mn0"),
        F.max(F.when(fin.isNull(), F.lit(1))).alias("__has_na"))
    d = df.join(stats, list(keys), "left")
    filled = F.coalesce(fin, F.col("__m"))
    fill_min = F.least(F.col("__mn0"),
                       F.when((F.col("__has_na") == 1) & (F.col("__m") != 0), F.col("__m")))
    d = d.withColumn(sd, F.when(filled == 0, fill_min).otherwise(filled))
    return d.drop("__m", "__mn0", "__has_na")
