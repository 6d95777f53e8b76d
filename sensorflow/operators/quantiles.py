"""Exact quantiles (type 7) of groups of any size, by distributed selection."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sensorflow.session import shared_path

#: Places of the sketch that a range is cut by, and its accuracy: its error is far below one step.
STEPS = 128
ACCURACY = 10_000
MOST_PASSES = 40


def _written(d: DataFrame) -> DataFrame:
    path = shared_path(d.sparkSession, "quantiles", uuid.uuid4().hex)
    d.write.parquet(path)
    return d.sparkSession.read.schema(d.schema).parquet(path)


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str, probs: Sequence[float],
                    gather: int = 10_000) -> DataFrame:
    """(keys, prob, quantile): interpolated between the two order statistics around (n - 1) * prob.

    Each pass cuts the range of values that holds a quantile's order statistics by a mergeable
    sketch, counts exactly what lies below and inside, and keeps a narrower range; it ends when
    no range has more than ``gather`` values strictly inside.  Then the few distinct values of a
    range are counted and the order statistics read off.  No group is ever held in one buffer
    or shuffled to one task: the ranges that rows meet are written first, so that Spark knows
    how few they are.  Copies of one value count as one.  NULL and NaN are no values; groups
    without values have no row.
    """
    v = F.col("v")
    rows = df.select(F.struct(*[F.col(k) for k in keys]).alias("k"), F.col(value).cast("double").alias("v")).where(
        v.isNotNull() & ~F.isnan(v))
    place = (F.col("n") - 1) * F.col("prob")
    state = (rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
             .withColumn("prob", F.explode(F.array(*[F.lit(float(p)) for p in probs])))
             .withColumns({"first": F.floor(place), "below": F.lit(0).cast("long"), "inside": F.col("n")})
             .withColumn("second", F.least(F.col("first") + 1, F.col("n") - 1)))
    state = _written(state)
    grid = F.percentile_approx("v", [i / STEPS for i in range(STEPS + 1)], ACCURACY)
    for _ in range(MOST_PASSES):
        wide = F.count(F.when((v > F.col("low")) & (v < F.col("high")), 1))
        open_ = rows.join(state, "k").where((v >= F.col("low")) & (v <= F.col("high")))
        cut = open_.groupBy("k", "prob").agg(wide.alias("strictly"), grid.alias("grid")).where(F.col("strictly") > gather)

        def at(rank: str, shift: int):
            i = F.floor((F.col(rank) - F.col("below")) * F.lit(STEPS) / F.col("inside")) + shift
            return F.get("grid", F.least(F.greatest(i, F.lit(0)), F.lit(STEPS)).cast("int"))

        cut = cut.join(state, ["k", "prob"]).select("k", "prob", F.col("low").alias("old_low"), F.col("high").alias("old_high"),
                                                    F.col("below").alias("old_below"), "first", "second",
                                                    at("first", -1).alias("low"), at("second", 2).alias("high"))
        cut = _written(cut)
        if not cut.limit(1).count():
            break
        narrow = (rows.join(cut, "k").where((v >= F.col("old_low")) & (v <= F.col("old_high")))
                  .groupBy("k", "prob", "low", "high", "old_below", "first", "second")
                  .agg(F.count(F.when(v < F.col("low"), 1)).alias("under"),
                       F.count(F.when((v >= F.col("low")) & (v <= F.col("high")), 1)).alias("now")))
        narrow = narrow.withColumn("under", F.col("under") + F.col("old_below"))
        holds = (F.col("first") >= F.col("under")) & (F.col("second") < F.col("under") + F.col("now"))
        narrow = narrow.where(holds).select("k", "prob", F.struct("low", "high", F.col("under").alias("below"),
                                                                  F.col("now").alias("inside")).alias("new"))
        state = _written(state.join(narrow, ["k", "prob"], "left").select("k", "n", "prob", "first", "second", *[
            F.coalesce(F.col(f"new.{c}"), F.col(c)).alias(c) for c in ("low", "high", "below", "inside")]))
    counts = (rows.join(state, "k").where((v >= F.col("low")) & (v <= F.col("high")))
              .groupBy("k", "prob", "v").agg(F.count(F.lit(1)).alias("c")))
    upto = Window.partitionBy("k", "prob").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = counts.withColumn("upto", F.sum("c").over(upto)).join(state, ["k", "prob"])
    ranked = ranked.withColumn("upto", F.col("upto") + F.col("below"))

    def statistic(rank: str):
        return F.min(F.when(F.col("upto") > F.col(rank), v))

    out = ranked.groupBy("k", "prob", "n").agg(statistic("first").alias("a"), statistic("second").alias("b"))
    part = place - F.floor(place)
    q = F.when(F.col("a") == F.col("b"), F.col("a")).otherwise(F.col("a") + part * (F.col("b") - F.col("a")))
    return out.select(*[F.col(f"k.{k}").alias(k) for k in keys], "prob", q.alias("quantile"))
