"""Forecast metadata checks: column contract, temporal and geographic coverage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


GEO_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("geographicDescription", T.StringType()),
    T.StructField("boundingCoordinates", T.StructType([
        T.StructField("westBoundingCoordinate", T.StringType()),
        T.StructField("eastBoundingCoordinate", T.StringType()),
        T.StructField("northBoundingCoordinate", T.StringType()),
        T.StructField("southBoundingCoordinate", T.StringType()),
        T.StructField("boundingAltitudes", T.StructType([
            T.StructField("altitudeMinimum", T.DoubleType()),
            T.StructField("altitudeMaximum", T.DoubleType()),
            T.StructField("altitudeUnits", T.StringType()),
        ])),
    ])),
])


def check_columns(df: DataFrame | Sequence[str], required: Sequence[str],
                  ordered: bool = True) -> None:
    """Raise ValueError unless the columns equal ``required`` (in order when ``ordered``).

    ``df`` may be the names themselves, e.g. a file's header.
    """
    have = list(df.columns if isinstance(df, DataFrame) else df)
    ok = have == list(required) if ordered else sorted(have) == sorted(required)
    if not ok:
        raise ValueError(f"column names {have} do not match required {list(required)}")


def temporal_coverage(df: DataFrame, time: str = "time",
                      keys: Sequence[str] = ()) -> DataFrame:
    """First and last date (and row count), overall or per ``keys``."""
    aggs = [F.min(time).alias("begin_date"), F.max(time).alias("end_date"),
            F.count(F.lit(1)).alias("n")]
    return df.groupBy(*keys).agg(*aggs) if keys else df.agg(*aggs)


def flatten_geo(geo: DataFrame) -> DataFrame:
    """Nested geographic coverage rows -> flat, coordinates cast to double."""
    b = "boundingCoordinates"
    return geo.select(
        "id", "geographicDescription",
        F.col(f"{b}.westBoundingCoordinate").try_cast("double").alias("west"),
        F.col(f"{b}.eastBoundingCoordinate").try_cast("double").alias("east"),
        F.col(f"{b}.northBoundingCoordinate").try_cast("double").alias("north"),
        F.col(f"{b}.southBoundingCoordinate").try_cast("double").alias("south"),
        F.col(f"{b}.boundingAltitudes.altitudeMinimum").alias("altitude_min"),
        F.col(f"{b}.boundingAltitudes.altitudeMaximum").alias("altitude_max"),
        F.col(f"{b}.boundingAltitudes.altitudeUnits").alias("altitude_units"))


def geo_coverage(geo: DataFrame, sites: DataFrame, site_col: str = "site_id") -> DataFrame:
    """Geographic coverage rows of the sites present in ``sites`` (semi join).

    ``sites`` may be derived from a forecast file, so no size pre-check (it would scan
    the file twice); the planner picks the join from run-time sizes.
    """
    s = sites.select(F.col(site_col).alias("id")).distinct()
    return flatten_geo(geo).join(s, "id", "left_semi")
