"""Rule and dimension tables.

The processing never hard-codes a site name, threshold or sensor depth: every rule is a row
of one of these small tables and enters the plan as a join, which the planner broadcasts
by its known size.  The
values below are the defaults that reproduce the published targets; callers pass their own
tables to change them.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from sensorflow.sources.tables import inline_table

D = dt.date

# ---------------------------------------------------------------------------------------
# Thermistor depth (m) by site and vertical index (siteName, verticalIndex,
# thermistorDepth), in the published order.
# ---------------------------------------------------------------------------------------
THERMISTOR_DEPTHS = [
    ("BARC", "501", 0.05), ("BARC", "502", 0.3), ("BARC", "503", 0.55), ("BARC", "504", 0.8),
    ("BARC", "505", 1.05), ("BARC", "506", 1.3), ("BARC", "507", 1.55), ("BARC", "508", 0.0),
    ("FLNT", "501", 0.05),
    ("SUGG", "501", 0.05), ("SUGG", "502", 0.3), ("SUGG", "503", 0.55), ("SUGG", "504", 0.8),
    ("SUGG", "505", 1.05),
    ("CRAM", "501", 0.05), ("CRAM", "502", 0.75), ("CRAM", "503", 1.75), ("CRAM", "504", 2.5),
    ("CRAM", "505", 3.45), ("CRAM", "506", 4.25), ("CRAM", "507", 5.15), ("CRAM", "508", 6.85),
    ("CRAM", "509", 8.55), ("CRAM", "510", 10.25),
    ("LIRO", "501", 0.05), ("LIRO", "502", 0.5), ("LIRO", "503", 1.0), ("LIRO", "504", 1.5),
    ("LIRO", "505", 2.0), ("LIRO", "506", 2.5), ("LIRO", "507", 3.0), ("LIRO", "508", 3.5),
    ("LIRO", "509", 4.0), ("LIRO", "510", 4.5),
    ("BLWA", "501", 0.05), ("BLWA", "502", 0.5), ("BLWA", "503", 1.0), ("BLWA", "504", 1.5),
    ("BLWA", "505", 2.0), ("BLWA", "506", 2.5), ("BLWA", "507", 3.0), ("BLWA", "508", 3.5),
    ("BLWA", "509", 4.0), ("BLWA", "510", 5.0),
    ("TOMB", "501", 0.05),
    ("PRLA", "501", 0.05), ("PRLA", "502", 0.3), ("PRLA", "503", 0.55), ("PRLA", "504", 0.8),
    ("PRLA", "505", 1.05), ("PRLA", "506", 1.3), ("PRLA", "507", 1.55), ("PRLA", "508", 1.8),
    ("PRLA", "509", 2.05),
    ("PRPO", "501", 0.05), ("PRPO", "502", 0.3), ("PRPO", "503", 0.55), ("PRPO", "504", 0.8),
    ("PRPO", "505", 1.05),
    ("TOOK", "501", 0.05), ("TOOK", "502", 1.75), ("TOOK", "503", 3.5), ("TOOK", "504", 5.25),
    ("TOOK", "505", 7.0), ("TOOK", "506", 8.75), ("TOOK", "507", 10.5), ("TOOK", "508", 12.25),
    ("TOOK", "509", 14.0), ("TOOK", "510", 15.75),
]

# ---------------------------------------------------------------------------------------
# Sensor depth corrections (site_id, vertical_position, valid_from, valid_to,
# depth); bounds inclusive, None = open.  This is the effective content of the published
# correction list after its later assignments win.
# ---------------------------------------------------------------------------------------
DEPTH_CORRECTIONS = [
    ("CRAM", 502, None, D(2020, 10, 31), 1.75),
    ("CRAM", 503, None, D(2020, 10, 31), 3.45),
    ("CRAM", 504, None, D(2020, 10, 31), 5.15),
    ("CRAM", 505, None, D(2020, 10, 31), 10.25),
    ("CRAM", 506, None, D(2020, 10, 31), 8.55),
    ("BARC", 502, None, D(2021, 6, 7), 0.55),
    ("BARC", 503, None, D(2021, 6, 7), 1.05),
    ("BARC", 504, None, D(2021, 6, 7), 1.55),
    ("BARC", 505, None, D(2021, 6, 7), 2.05),
    ("BARC", 506, None, D(2021, 6, 7), 2.55),
    ("BARC", 507, None, D(2021, 6, 7), 3.05),
    ("BARC", 502, D(2022, 1, 8), None, 0.55),
    ("BARC", 503, D(2022, 1, 8), None, 1.05),
    ("BARC", 504, D(2022, 1, 8), None, 1.55),
    ("BARC", 505, D(2022, 1, 8), None, 2.05),
    ("BARC", 506, D(2022, 1, 8), None, 2.55),
    ("BARC", 507, D(2022, 1, 8), None, 3.05),
    ("BARC", 502, D(2021, 6, 8), D(2022, 1, 7), 0.3),
    ("BARC", 503, D(2021, 6, 8), D(2022, 1, 7), 0.55),
    ("BARC", 504, D(2021, 6, 8), D(2022, 1, 7), 0.8),
    ("BARC", 505, D(2021, 6, 8), D(2022, 1, 7), 1.05),
    ("BARC", 506, D(2021, 6, 8), D(2022, 1, 7), 1.3),
    ("BARC", 507, D(2021, 6, 8), D(2022, 1, 7), 1.55),
    ("BARC", 508, D(2021, 6, 8), D(2022, 1, 7), 2.05),
    ("BARC", 509, D(2021, 6, 8), D(2022, 1, 7), 2.55),
    ("BARC", 510, None, None, 3.05),
]

# Gross ranges (variable, lo, hi), inclusive.
RANGES = [
    ("oxygen", 2.0, 15.0),
    ("chla", 0.0, 200.0),
    ("temperature", -2.0, 32.0),
]

# Manual masks (site_id, variable, date_from, date_to, bad_below, bad_above).
# Inside the (inclusive, None = open) date interval a value is removed when it is below
# bad_below or above bad_above; with both bounds None every value in the interval goes.
MASKS = [
    ("MAYF", "oxygen", D(2019, 1, 20), D(2019, 2, 5), None, None),
    ("WLOU", "oxygen", None, None, 7.5, 11.0),
    ("BARC", "oxygen", None, None, 4.0, None),
    ("PRLA", "temperature", None, D(2018, 12, 31), None, None),
]

# Per-source series QC (source, lo, hi, spike, by_depth).
QC_PARAMS = [
    ("lake_portal", -5.0, 40.0, 5.0, True),
    ("lake_curated", -5.0, 40.0, 5.0, True),
    ("lake_provisional", -5.0, 40.0, 5.0, True),
    ("stream_portal", -5.0, 40.0, 7.0, False),
    ("stream_provisional", -5.0, 40.0, 7.0, False),
    ("river_portal", -5.0, 40.0, 7.0, False),
    ("river_curated", -5.0, 40.0, 5.0, False),
    ("river_provisional", -5.0, 40.0, 5.0, False),
]

# The cut-off after which failed-flag lake thermistor rows are kept.
ACCEPT_FAILED_AFTER = D(2020, 7, 1)

# Provisional data products and the term names each one keeps.
PRODUCTS = {
    "20288": ["dissolvedOxygen", "dissolvedOxygenExpUncert", "dissolvedOxygenFinalQF",
              "chlorophyll", "chlorophyllExpUncert", "chlorophyllFinalQF"],
    "20264": ["tsdWaterTempMean", "thermistorDepth", "tsdWaterTempExpUncert",
              "tsdWaterTempFinalQF"],
    "20053": ["surfWaterTempMean", "surfWaterTempExpUncert", "finalQF"],
}
# The target variables that a product's records enter.
PRODUCT_VARIABLES = {"20288": ("oxygen", "chla"), "20264": ("temperature",), "20053": ("temperature",)}
# Horizontal positions kept (upstream 101/111, lake and river 103) and the
# 30-minute temporal index.
HORIZONTAL_KEEP = ["101", "111", "103"]
STREAM_POSITIONS = ("101", "111")
TEMPORAL_30MIN = "030"

# Target variables, forecast horizon and ensemble size.
TARGET_VARIABLES = ["temperature", "oxygen", "chla"]
HORIZON_DAYS = 35
ENSEMBLE_SIZE = 2000

# Forecast theme and the published output file names.
THEME = "aquatics"
TARGETS_FILE = "aquatics-targets.csv.gz"
EXPANDED_FILE = "aquatics-expanded-observations.csv.gz"

DEPTH_LOOKUP_SCHEMA = "siteName string, verticalIndex string, thermistorDepth double"
CORRECTIONS_SCHEMA = ("site_id string, vertical_position int, valid_from date, "
                      "valid_to date, depth double")
RANGES_SCHEMA = "variable string, lo double, hi double"
MASKS_SCHEMA = ("site_id string, variable string, date_from date, date_to date, "
                "bad_below double, bad_above double")
QC_SCHEMA = "source string, lo double, hi double, spike double, by_depth boolean"


def depth_lookup(spark: SparkSession) -> DataFrame:
    return inline_table(spark, THERMISTOR_DEPTHS, DEPTH_LOOKUP_SCHEMA)


def depth_corrections(spark: SparkSession) -> DataFrame:
    return inline_table(spark, DEPTH_CORRECTIONS, CORRECTIONS_SCHEMA)


def ranges(spark: SparkSession) -> DataFrame:
    return inline_table(spark, RANGES, RANGES_SCHEMA)


def masks(spark: SparkSession) -> DataFrame:
    return inline_table(spark, MASKS, MASKS_SCHEMA)


def qc_params(spark: SparkSession) -> DataFrame:
    return inline_table(spark, QC_PARAMS, QC_SCHEMA)


def qc_setting(source: str) -> dict:
    """The QC parameters of one source as keyword arguments of ``qc_series``."""
    for s, lo, hi, spike, by_depth in QC_PARAMS:
        if s == source:
            return {"lo": lo, "hi": hi, "spike": spike,
                    "unknown": "keep" if by_depth else "reject"}
    raise KeyError(source)
