"""Successive differences kept between runs: per series and month the first and last known value and the
moments of the differences between them.

Two months, or two spans of one month, are joined by one more difference: from the last value of the earlier
to the first of the later.  So the sd of a series' differences and its last value come from one row per month, and a
run reads new days only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorflow.functions.missing import nan_to_null
from sensorflow.operators.moments import kept_state, mean_and_sd, merge_states, moments_merged
from sensorflow.operators.seriesscan import month_bucket

SERIES = ("site_id", "variable")
SPAN = ("first_time", "first_value", "last_time", "last_value", "n", "mean", "m2")


def difference_state(df: DataFrame, keys: Sequence[str] = SERIES, time: str = "time",
                     value: str = "observed") -> DataFrame:
    """(keys, month, first_time, first_value, last_time, last_value, n, mean, m2) of the known values.

    ``n``, ``mean`` and ``m2`` are of the differences inside the month.  Rows are ordered within
    (series, month) only.  Rows without a time or a value count for nothing; rows of one time
    are taken in the order of their values.
    """
    known = df.select(*keys, F.col(time).alias("__t"), nan_to_null(F.col(value).cast("double")).alias("__v")).dropna(
        subset=["__t", "__v"]).withColumn("month", month_bucket("__t").cast("long"))
    before = F.lag("__v").over(Window.partitionBy(*keys, "month").orderBy("__t", "__v"))
    d, at = F.col("__v") - F.col("__before"), F.struct("__t", "__v")
    return known.withColumn("__before", before).groupBy(*keys, "month").agg(
        F.min(at).alias("__first"), F.max(at).alias("__last"), F.count(d).alias("n"), F.avg(d).alias("mean"),
        (F.var_pop(d) * F.count(d)).alias("m2")).select(
        *keys, "month", F.col("__first.__t").alias("first_time"), F.col("__first.__v").alias("first_value"),
        F.col("__last.__t").alias("last_time"), F.col("__last.__v").alias("last_value"), "n", "mean", "m2")


def _moments(span: Column) -> Column:
    return F.struct(*[span[c].alias(c) for c in ("n", "mean", "m2")])


def _one(difference: Column) -> Column:
    """Moments of a single difference; none where it is NULL."""
    return F.struct(difference.isNotNull().cast("long").alias("n"), difference.alias("mean"),
                    F.when(difference.isNotNull(), 0.0).alias("m2"))


def _chained(a: Column, b: Column) -> Column:
    """The span that ``a`` and the later ``b`` make up."""
    m = moments_merged(F.array(_moments(a), _one(b["first_value"] - a["last_value"]), _moments(b)))
    late = F.raise_error(F.concat(F.lit("rows of "), b["first_time"].cast("string"), F.lit(
        " come after rows of "), a["last_time"].cast("string"), F.lit(" were counted: build the state anew")))
    # a lambda's argument is computed once
    both = F.get(F.transform(F.array(m), lambda x: F.struct(
        a["first_time"].alias("first_time"), a["first_value"].alias("first_value"), b["last_time"].alias("last_time"),
        b["last_value"].alias("last_value"), *[x[c].alias(c) for c in ("n", "mean", "m2")])), F.lit(0))
    return F.when(b["first_time"] > a["last_time"], both).otherwise(late)


def merge_difference_states(states: DataFrame, keys: Sequence[str] = SERIES) -> DataFrame:
    """One row per series and month from the unioned rows of several states, as many of a month as states.

    Of a month that two states share the rows of one have to come after the other's; rows between
    those already counted are an error when the state is written, never miscounted.
    """
    spans = F.array_sort(F.collect_list(F.struct(*SPAN)))
    d = states.groupBy(*keys, "month").agg(spans.alias("__s"))
    rest = F.slice("__s", F.lit(2), F.size("__s"))
    return d.select(*keys, "month", F.aggregate(rest, F.get("__s", F.lit(0)), _chained).alias("__m")).select(
        *keys, "month", *[F.col(f"__m.{c}").alias(c) for c in SPAN])


def update_differences(new_rows: DataFrame, folder: str, batch: int, keys: Sequence[str] = SERIES,
                       time: str = "time", value: str = "observed") -> DataFrame:
    """The state after the new days of ``batch``; the days before them are not read again."""
    return kept_state(difference_state(new_rows, keys, time, value), lambda s: merge_difference_states(s, keys),
                      folder, batch)


def differences_of(state: DataFrame, keys: Sequence[str] = SERIES) -> DataFrame:
    """(keys, last_time, last_value, n_diff, diff_sd) of each series, from its months."""
    months = Window.partitionBy(*keys).orderBy("month")
    edge = state.withColumn("__edge", F.col("first_value") - F.lag("last_value").over(months))
    whole = edge.withColumn("__m", moments_merged(F.array(F.struct("n", "mean", "m2"), _one(F.col("__edge")))))
    moments = merge_states(whole.select(*keys, "__m.n", "__m.mean", "__m.m2"), keys)
    row = F.struct("last_time", "last_value")
    last = state.groupBy(*keys).agg(F.max(row).alias("__l"))
    sd = mean_and_sd(moments, [*keys, "n"]).withColumnRenamed("n", "n_diff").withColumnRenamed("sd", "diff_sd")
    same = [F.col(f"l.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys]
    return last.alias("l").join(sd.alias("s"), same).select(
        *[F.col(f"l.{k}") for k in keys], "l.__l.last_time", "l.__l.last_value", "s.n_diff", "s.diff_sd")
