"""Missing-value semantics.

R has two missing markers (NA and NaN); both are skipped by ``na.rm`` and both test true
with ``is.na``.  Spark propagates NaN through ``avg`` and compares NaN as the largest
double, so every source normalises NaN to NULL and NULL is the only missing value after.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def nan_to_null(col) -> Column:
    """NaN -> NULL, everything else unchanged."""
    c = _c(col)
    return F.when(~F.isnan(c), c)


def nan_to_null_all(df: DataFrame) -> DataFrame:
    """Apply :func:`nan_to_null` to every float/double column of ``df``."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out.append(nan_to_null(f.name).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def is_finite(col) -> Column:
    """True for a non-null, non-NaN, non-infinite number."""
    c = _c(col)
    return (c.isNotNull() & ~F.isnan(c)
            & (c != F.lit(float("inf"))) & (c != F.lit(float("-inf"))))


def mean_skip(col) -> Column:
    """Mean that skips missing values (``mean(x, na.rm=TRUE)``); NULL when none is present."""
    return F.avg(_c(col))


def mean_strict(col) -> Column:
    """Mean that is missing as soon as one value of the group is missing (``mean(x)``)."""
    c = _c(col)
    return F.when(F.count(c) == F.count(F.lit(1)), F.avg(c))


def standard_error(col) -> Column:
    """Standard error of the mean over non-missing values: sd / sqrt(n)."""
    c = _c(col)
    return F.stddev_samp(c) / F.sqrt(F.count(c))
