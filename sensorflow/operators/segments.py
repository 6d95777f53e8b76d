"""Dated rules of any number: overlapping rules become disjoint segments, which rows join by time bin.

Of the rules that cover a day the one that starts last counts.  No step gathers the rules of a key
or lets two rules meet, and none is sent whole through the driver.  The days on which any rule of the
key begins or has just ended open the segments.  The best rule that begins on such a day counts there;
for a day on which none begins, rules are cut into aligned blocks of 2^k days (two a size at most), and
its rule is the best one among the blocks that hold the day, one of each size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorflow.operators.seriesscan import lag_columns

#: Days are counted from 0001-01-01, so that 9999-12-31 is below 2^LEVELS.
ORIGIN = "0001-01-01"
LAST_DAY = 3_652_058
LEVELS = 22
#: Days of one bin of the join; a bin holds that many segments of a key at most.
BIN_DAYS = 366
#: Segments are laid out over the bins between these dates; whatever lies outside shares the outer bins.
BINS_FROM, BINS_TO = "1900-01-01", "2100-01-01"


def _day(c: Column) -> Column:
    return F.datediff(F.to_date(c), F.to_date(F.lit(ORIGIN)))


def _date(day: Column) -> Column:
    return F.date_add(F.to_date(F.lit(ORIGIN)), day)


def _blocks(first: Column, last: Column) -> Column:
    """The aligned blocks (level, number) that make up the days from ``first`` to ``last``."""
    def at(level: Column) -> Column:
        size = F.pow(F.lit(2.0), level)
        lo, hi = F.ceil(first / size), F.floor((last + 1) / size)
        left = F.when((lo < hi) & (lo % 2 == 1), lo)
        right = F.when((lo < hi) & (hi % 2 == 1), hi - 1)
        return F.transform(F.filter(F.array(left, right), lambda n: n.isNotNull()),
                           lambda n: F.struct(level.alias("level"), n.cast("long").alias("number")))
    return F.flatten(F.transform(F.sequence(F.lit(0), F.lit(LEVELS)), at))


def rule_segments(rules: DataFrame, keys: Sequence[str], start: str, end: str,
                  values: Sequence[str]) -> DataFrame:
    """(keys, segment_from, segment_to, values): disjoint spans of days, both ends inclusive, and the
    values of the rule that counts there.

    A NULL ``start`` or ``end`` is open, and so is a ``segment_from`` or ``segment_to`` of
    0001-01-01 or 9999-12-31.  Of rules that start on one day the one that ends last counts (an open
    end comes before any date, as NULL sorts), then the one with the greatest values.  Rules
    that are repeated count once; those with a NULL key or an end before their start cover nothing;
    days without a rule are in no segment.
    """
    values = list(values)
    r = rules.dropna(subset=list(keys)).select(
        *keys, F.coalesce(_day(F.col(start)), F.lit(0)).alias("__open"),
        F.coalesce(_day(F.col(end)), F.lit(LAST_DAY)).alias("__last"),
        F.struct(F.col(start), F.col(end), *values).alias("__rule")).where("__open <= __last")
    none = F.lit(None).cast(r.schema["__rule"].dataType)
    # of rules with one start only two can count: the one that ends last and the best open one
    best = (r.groupBy(*keys, F.col("__rule")[start].alias("__start"), F.col("__rule")[end].isNull().alias("__endless"))
            .agg(F.max("__rule").alias("__rule"), F.max("__open").alias("__open"), F.max("__last").alias("__last"))
            .select(*keys, F.col("__rule").alias("__best"), F.explode(_blocks(F.col("__open"), F.col("__last"))).alias("__block"))
            .groupBy(*keys, "__block").agg(F.max("__best").alias("__best")))
    opens = (r.select(*keys, F.explode(F.array(F.struct(F.col("__open").alias("day"), F.col("__rule").alias("rule")),
                                               F.struct((F.col("__last") + 1).alias("day"), none.alias("rule")))).alias("__at"))
             .where(F.col("__at.day") <= LAST_DAY)
             .groupBy(*keys, F.col("__at.day").alias("__open")).agg(F.max("__at.rule").alias("__rule")))
    # the next opening day: a lag in falling order, by buckets
    ends = lag_columns(opens.withColumn("__back", -F.col("__open")), keys, ["__back"], ["__open"],
                       bucket=F.floor(F.col("__back") / 4096), prefix="__next")
    ends = ends.withColumn("__last", F.coalesce(F.col("__next__open") - 1, F.lit(LAST_DAY)))
    # a rule that starts on the day counts there (level -1 has no blocks); other days look theirs up
    holds = F.transform(F.sequence(F.lit(0), F.lit(LEVELS)), lambda level: F.struct(
        level.alias("level"), F.floor(F.col("__open") / F.pow(F.lit(2.0), level)).cast("long").alias("number")))
    own = F.array(F.struct(F.lit(-1).alias("level"), F.col("__open").cast("long").alias("number")))
    # merged by hint: Spark expects an explode to add no rows, and would send a side through the driver
    found = (ends.select(*keys, "__open", "__last", "__rule",
                         F.explode(F.when(F.col("__rule").isNotNull(), own).otherwise(holds)).alias("__block"))
             .join(best.hint("merge"), [*keys, "__block"], "left")
             .withColumn("__rule", F.coalesce("__rule", "__best")).where(F.col("__rule").isNotNull())
             .groupBy(*keys, "__open", "__last").agg(F.max("__rule").alias("__rule")))
    return found.select(*keys, _date(F.col("__open")).alias("segment_from"), _date(F.col("__last")).alias("segment_to"),
                        *[F.col("__rule")[v].alias(v) for v in values])


def _bin(day: Column, bin_days: int) -> Column:
    inside = F.least(F.greatest(day, _day(F.lit(BINS_FROM))), _day(F.lit(BINS_TO)))
    return F.floor(inside / bin_days).cast("int")


def apply_segments(df: DataFrame, segments: DataFrame, on: dict[str, str], time: str, column: str,
                   value: str, bin_days: int = BIN_DAYS) -> DataFrame:
    """Replaces ``column`` by the segments' ``value`` where one covers the row's key and day.

    ``on`` maps columns of ``df`` to the segments' keys.  Segments of one key and bin are one row,
    which holds ``bin_days`` of them at most between BINS_FROM and BINS_TO, so the merge join never
    multiplies rows, and a key with most rows spreads over its bins.  Rows without a key, a time
    or a segment, and those whose segment has a NULL value, keep what they have.
    """
    keys = list(on.values())
    first, last = _day(F.col("segment_from")), _day(F.col("segment_to"))
    packed = (segments.withColumn("__bin", F.explode(F.sequence(_bin(first, bin_days), _bin(last, bin_days))))
              .groupBy(*[F.col(k).alias(f"__k_{k}") for k in keys], "__bin")
              .agg(F.collect_list(F.struct("segment_from", "segment_to", F.col(value).alias("v"))).alias("__segments")))
    day = F.to_date(F.col(time))
    d = df.withColumn("__day_bin", _bin(_day(F.col(time)), bin_days))
    # merged by hint: Spark expects short lists, and would send all segments through the driver
    d = d.join(packed.hint("merge"), [F.col(c) == F.col(f"__k_{k}") for c, k in on.items()]
               + [F.col("__day_bin") == F.col("__bin")], "left")
    covering = F.filter("__segments", lambda s: (day >= s["segment_from"]) & (day <= s["segment_to"]))
    d = d.withColumn(column, F.coalesce(F.get(covering, F.lit(0))["v"], F.col(column)))
    return d.drop("__bin", "__day_bin", "__segments", *[f"__k_{k}" for k in keys])
