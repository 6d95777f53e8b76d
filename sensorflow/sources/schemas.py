"""Fixed schemas of the sensor sources and outputs (FIXTURES.md)."""

from pyspark.sql import types as T

S, D, I, TS, DT = (T.StringType(), T.DoubleType(), T.IntegerType(), T.TimestampNTZType(),
                   T.DateType())


def _st(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


ARCHIVE_WATER_QUALITY = _st(
    ("siteID", S), ("startDateTime", TS), ("sensorDepth", S), ("dissolvedOxygen", S),
    ("dissolvedOxygenExpUncert", S), ("dissolvedOxygenFinalQF", I), ("chlorophyll", S),
    ("chlorophyllExpUncert", S), ("chlorophyllFinalQF", I))

ARCHIVE_DEPTH_TEMPERATURE = _st(
    ("siteID", S), ("startDateTime", TS), ("thermistorDepth", D), ("verticalPosition", I),
    ("tsdWaterTempMean", D), ("tsdWaterTempExpUncert", D), ("tsdWaterTempFinalQF", I))

ARCHIVE_POINT_TEMPERATURE = _st(
    ("siteID", S), ("startDateTime", TS), ("horizontalPosition", S),
    ("surfWaterTempMean", D), ("surfWaterTempExpUncert", D), ("finalQF", I))

PROVISIONAL = _st(
    ("siteName", S), ("termName", S), ("startDate", TS), ("doubleValue", D),
    ("intValue", I), ("verticalIndex", S), ("horizontalIndex", S), ("temporalIndex", S))

CURATED_PROFILE_TEXT = _st(("siteID", S), ("startDate", S), ("sensorDepth", S),
                           ("waterTemp", S))

SITES_TEXT = _st(("field_site_id", S), ("field_site_subtype", S), ("aquatics", S))

TARGETS = _st(("time", DT), ("site_id", S), ("variable", S), ("observed", D))

EXPANDED_PROFILE = _st(("time", TS), ("site_id", S), ("depth", D), ("variable", S),
                       ("observed", D))

CLIMATOLOGY_FORECAST = _st(("time", DT), ("start_time", DT), ("site_id", S),
                           ("variable", S), ("family", S), ("parameter", S),
                           ("predicted", D))

ENSEMBLE_FORECAST = _st(("time", DT), ("start_time", DT), ("site_id", S), ("variable", S),
                        ("ensemble", I), ("predicted", D))
