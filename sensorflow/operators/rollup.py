"""Temporal rollups (hourly, daily) and source merging."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorflow.functions.missing import mean_skip, mean_strict
from sensorflow.functions.timefmt import hour_floor
from sensorflow.operators.reshape import union_all


def _mean(strict: bool):
    return mean_strict if strict else mean_skip


def hourly_mean(df: DataFrame, keys: Sequence[str], time: str, values: Mapping[str, str],
                strict: bool = False, out_time: str = "time",
                round_depth: str | None = None, digits: int = 1) -> DataFrame:
    """Mean per (keys, hour).  ``values`` maps output name -> input column.

    ``round_depth`` names a depth column rounded to ``digits`` before grouping (HALF_UP).
    """
    d = df.withColumn(out_time, hour_floor(F.col(time)))
    if round_depth:
        d = d.withColumn(round_depth, F.round(F.col(round_depth), digits))
    m = _mean(strict)
    return d.groupBy(*keys, out_time).agg(*[m(src).alias(o) for o, src in values.items()])


def daily_mean(df: DataFrame, keys: Sequence[str], time: str, values: Mapping[str, str],
               strict: bool = False, out_time: str = "time") -> DataFrame:
    """Mean per (keys, calendar day).  ``values`` maps output name -> input column."""
    d = df.withColumn(out_time, F.to_date(F.col(time)))
    m = _mean(strict)
    return d.groupBy(*keys, out_time).agg(*[m(src).alias(o) for o, src in values.items()])


def merge_sources(*sources: DataFrame, keys: Sequence[str], value: str = "observed",
                  mode: str = "mean") -> DataFrame:
    """Combine per-source tables.

    ``mode='mean'``: unweighted mean of the source values per key (a mean of means).
    ``mode='union'``: plain union by name, no re-aggregation.
    """
    u = union_all(*[s.select(*keys, value) for s in sources])
    if mode == "union":
        return u
    if mode != "mean":
        raise ValueError("mode must be 'mean' or 'union'")
    return u.groupBy(*keys).agg(F.avg(value).alias(value))
