"""Reshaping: value coalescing, long <-> wide, union by name, column selection by name."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def coalesce_value(df: DataFrame, double_col: str = "doubleValue", int_col: str = "intValue",
                   out: str = "Value") -> DataFrame:
    """One numeric value per record: the double field, else the integer field."""
    return df.withColumn(out, F.coalesce(F.col(double_col),
                                         F.col(int_col).cast("double")))


def terms_to_columns(df: DataFrame, ids: Sequence[str], terms: Sequence[str],
                     term_col: str = "termName", value_col: str = "Value",
                     flag_suffix: str = "QF") -> DataFrame:
    """Long term records -> one column per term (``pivot_wider``).

    The column list is explicit, so a term absent from the data is a NULL column.
    Duplicate records of one (ids, term) are averaged; flag terms take the maximum,
    so one failing duplicate fails the row.  Conditional aggregation keeps the
    aggregation partial (map-side) and needs no distinct-value pass.
    """
    aggs = []
    for t in terms:
        v = F.when(F.col(term_col) == F.lit(t), F.col(value_col))
        aggs.append((F.max(v) if t.endswith(flag_suffix) else F.avg(v)).alias(t))
    return df.groupBy(*ids).agg(*aggs)


def to_long(df: DataFrame, ids: Sequence[str], measures: Sequence[str],
            variable: str = "variable", value: str = "observed") -> DataFrame:
    """Wide measures -> (ids, variable, value) rows; NULL measures are kept."""
    return df.unpivot(list(ids), list(measures), variable, value)


def union_all(*dfs: DataFrame) -> DataFrame:
    """Union by column name; columns missing from one input are NULL (``bind_rows``)."""
    dfs = [d for d in dfs if d is not None]
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d, allowMissingColumns=True)
    return out


def keep_existing(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Select those of ``cols`` that exist, in the given order (``any_of``)."""
    have = set(df.columns)
    return df.select(*[c for c in cols if c in have])


def drop_matching(df: DataFrame, pattern: str) -> DataFrame:
    """Drop every column whose name matches the regular expression ``pattern``."""
    rx = re.compile(pattern, re.IGNORECASE)
    return df.drop(*[c for c in df.columns if rx.search(c)])


def empty_frame(spark: SparkSession, schema: T.StructType | str) -> DataFrame:
    """A typed empty frame for a source that yields nothing."""
    return spark.createDataFrame([], schema)
