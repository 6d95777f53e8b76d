"""Mergeable moments: count, mean and sum of squared deviations per key, kept between runs."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorflow.functions.missing import nan_to_null

CLIMATOLOGY_KEYS = ("doy", "site_id", "variable")


def moment_state(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """(keys, n, mean, m2) of the values, missing ones skipped; a key without values has n = 0."""
    known = nan_to_null(F.col(value))
    return df.groupBy(*keys).agg(F.count(known).alias("n"), F.avg(known).alias("mean"),
                                 (F.var_pop(known) * F.count(known)).alias("m2"))


def _merge(a: Column, b: Column) -> Column:
    """Moments of two disjoint sets together, by the pairwise formula."""
    n, d = a["n"] + b["n"], b["mean"] - a["mean"]
    both = F.struct(n.alias("n"), (a["mean"] + d * b["n"] / n).alias("mean"),
                    (a["m2"] + b["m2"] + d * d * a["n"] * b["n"] / n).alias("m2"))
    return F.when(b["n"] == 0, a).when(a["n"] == 0, b).otherwise(both)


def moments_merged(sets: Column) -> Column:
    """Moments of all sets of an array of structs (n, mean, m2)."""
    none = F.struct(F.lit(0).cast("long").alias("n"), F.lit(None).cast("double").alias("mean"),
                    F.lit(None).cast("double").alias("m2"))
    return F.aggregate(sets, none, _merge)


def merge_states(states: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One state row per key from several; each key has as many rows as states were unioned."""
    merged = moments_merged(F.array_sort(F.collect_list(F.struct("n", "mean", "m2"))))
    return states.groupBy(*keys).agg(merged.alias("__m")).select(*keys, "__m.n", "__m.mean", "__m.m2")


def mean_and_sd(state: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, mean, sd): the sample standard deviation, NULL below two values."""
    return state.select(*keys, "mean", F.when(F.col("n") > 1, F.sqrt(F.col("m2") / (F.col("n") - 1))).alias("sd"))


def state_path(folder: str, batch: int) -> str:
    return f"{folder.rstrip('/')}/state-{batch:012d}"


def _complete(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def read_state(spark: SparkSession, folder: str, batch: int) -> DataFrame:
    path = state_path(folder, batch)
    if not _complete(spark, path):
        raise ValueError(f"{path} is not there or was not completed")
    return spark.read.parquet(path)


def kept_state(state: DataFrame, merge: Callable[[DataFrame], DataFrame], folder: str, batch: int) -> DataFrame:
    """The state after ``batch``: ``state`` of its rows, merged with the one kept after the batch before.

    Batches are numbered from 0.  A batch that is complete is not counted again, and one that
    failed is written anew from the state before it, so each counts once.
    """
    spark = state.sparkSession
    path = state_path(folder, batch)
    if not _complete(spark, path):
        if batch:
            state = merge(read_state(spark, folder, batch - 1).unionByName(state))
        state.write.mode("overwrite").parquet(path)
    return read_state(spark, folder, batch)


def update_state(new_rows: DataFrame, keys: Sequence[str], value: str, folder: str, batch: int) -> DataFrame:
    """Moments per key after ``batch``, which counts ``new_rows`` besides the state after the batch before."""
    return kept_state(moment_state(new_rows, keys, value), lambda s: merge_states(s, keys), folder, batch)


def update_climatology(new_rows: DataFrame, folder: str, batch: int, time: str = "time",
                       value: str = "observed") -> DataFrame:
    """Moments per (day of year, site, variable) after the new days of ``batch``; the days before
    them are not read again."""
    days = new_rows.withColumn("doy", F.dayofyear(F.col(time)))
    return update_state(days, CLIMATOLOGY_KEYS, value, folder, batch)
