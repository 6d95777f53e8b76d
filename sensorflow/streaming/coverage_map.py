"""Coverage maps: which months a source really fills, as one bitmap per series.

A map has one row per series key (and per 32,768 months): ``month_bucket`` and ``months``, a
bitmap of month numbers.  It is an aggregate that combines on the map side and merges with
``or``, so it can be kept as a table and extended by new data alone.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def month_number(time: Column | str) -> Column:
    """Months since the year 0, as long: 12 * year + month."""
    return (F.year(time) * 12 + F.month(time)).cast("long")


def coverage_map(rows: DataFrame, keys: Sequence[str], time: str, value: str | None = None) -> DataFrame:
    """The months in which each series has a row, or with ``value`` a row whose value is known."""
    d = rows if value is None else rows.where(F.col(value).isNotNull())
    n = month_number(time)
    d = d.select(*keys, F.bitmap_bucket_number(n).alias("month_bucket"), F.bitmap_bit_position(n).alias("__bit"))
    return (d.where(F.col("__bit").isNotNull()).groupBy(*keys, "month_bucket")
            .agg(F.bitmap_construct_agg("__bit").alias("months")))


def merge_coverage(*maps: DataFrame) -> DataFrame:
    """One map that covers what any of ``maps`` does."""
    u = reduce(lambda a, b: a.unionByName(b), maps)
    keys = [c for c in u.columns if c != "months"]
    return u.groupBy(*keys).agg(F.bitmap_or_agg("months").alias("months"))


def _has(months: Column, position: Column) -> Column:
    byte = F.conv(F.hex(F.substring(months, (position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.call_function("shiftright", byte, (position % 8).cast("int")).bitwiseAND(F.lit(1)) == 1


def covered_months(coverage: DataFrame) -> DataFrame:
    """The map as rows: keys and ``ms`` (yyyy-MM)."""
    bits = F.filter(F.sequence(F.lit(0), F.lit(32767)), lambda p: _has(F.col("months"), p))
    d = coverage.withColumn("__n", F.explode(bits))
    d = d.withColumn("__n", F.col("__n") + (F.col("month_bucket") - 1) * 32768 + 1)
    year, month = ((F.col("__n") - 1) / 12).cast("int"), ((F.col("__n") - 1) % 12 + 1).cast("int")
    ms = F.concat(F.lpad(year.cast("string"), 4, "0"), F.lit("-"), F.lpad(month.cast("string"), 2, "0"))
    return d.withColumn("ms", ms).drop("__n", "months", "month_bucket")


def not_covered(rows: DataFrame, coverage: DataFrame, time: str, keys: Mapping[str, str | Column]) -> DataFrame:
    """Rows whose (key, month) the map does not hold; ``keys`` maps map columns to row columns.

    One equi-join on the key, and a look at one bit: a series with a hole keeps its rows of the
    hole, whatever later months the map holds.  NULL keys meet NULL keys; rows without a time stay.
    """
    if not keys:
        raise ValueError("a coverage map needs a key: one series must not decide for all")
    n = month_number(time)
    d = rows.withColumns({"__bucket": F.bitmap_bucket_number(n), "__position": F.bitmap_bit_position(n)}
                         | {f"__r_{k}": (F.col(c) if isinstance(c, str) else c) for k, c in keys.items()})
    m = coverage.select(*[F.col(k).alias(f"__m_{k}") for k in keys], F.col("month_bucket").alias("__m_bucket"),
                        F.col("months").alias("__months"))
    same = reduce(lambda a, b: a & b, [F.col(f"__r_{k}").eqNullSafe(F.col(f"__m_{k}")) for k in keys])
    d = d.join(m, same & (F.col("__bucket") == F.col("__m_bucket")), "left")
    held = F.coalesce(_has(F.col("__months"), F.col("__position")), F.lit(False))
    return d.where(~held).select(*rows.columns)
