"""Sensor-shaped views over the driver's benchmark tables.

The registered queries run the sensor operators on these views, so their work grows with
the benchmark tables.  Each view has the schema of one sensor source (FIXTURES.md):

* ``archive_wq``        water quality, wide, instantaneous          <- events
* ``archive_tsd``       thermistor chain, 30-minute, multi-year     <- lineitem
* ``archive_tsw``       point surface temperature                    <- events
* ``provisional(p)``    long term records of product ``p``          <- events
* ``curated_profile``   curated depth profile (with missing values) <- events
* ``daily_series``      daily (time, site_id, variable, observed)   <- orders

Site codes come from a fixed 12-entry list indexed by a key of the source row; missing
values are injected by rules on the ``k`` property of an event.  Measurements are scaled
by multipliers whose binary mantissas are long and odd, so no mean can sit exactly on a
threshold (spike, range) or on a 6-place rounding tie; comparisons with the oracle then do
not depend on summation order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorflow.functions.timefmt import hour_floor
from sensorflow.sources.tables import inline_table

# The stand-in site list (index = key % 12) and the site dimension.
SITES = ["BARC", "CRAM", "LIRO", "PRLA", "PRPO", "SUGG", "TOOK",
         "FLNT", "BLWA", "TOMB", "MAYF", "WLOU"]
SITE_DIMENSION = [
    ("BARC", "Lake", 1), ("CRAM", "Lake", 1), ("LIRO", "Lake", 1), ("PRLA", "Lake", 1),
    ("PRPO", "Lake", 1), ("SUGG", "Lake", 1), ("TOOK", "Lake", 1),
    ("FLNT", "Non-wadeable River", 1), ("BLWA", "Non-wadeable River", 1),
    ("TOMB", "Non-wadeable River", 1),
    ("MAYF", "Wadeable Stream", 1), ("WLOU", "Wadeable Stream", 1),
    ("POSE", "Wadeable Stream", 1), ("HARV", None, 0),
]
SITE_SCHEMA = "field_site_id string, field_site_subtype string, aquatics int"

# Stand-in scale factors (close to 1/19.3, 1/2.1, 1/2.3, 1/9.7, 1/9973).
OXYGEN_SCALE = 0.0518134715
CHLA_SCALE = 0.4761904762
QUANTITY_SCALE = 0.4347826087
VALUE_SCALE = 0.1030927835
PRICE_SCALE = 0.0001002707

# The thermistor stand-in is moved by this many years, so that its seven years hold every
# dated depth correction and the flag cut-off.
TSD_YEARS = 21

# event_type -> term name, per provisional product (stand-in choice).
TERM_MAP = {
    "20288": {"view": "dissolvedOxygen", "click": "chlorophyll",
              "signup": "dissolvedOxygenFinalQF", "purchase": "chlorophyllFinalQF",
              "error": "dissolvedOxygenExpUncert"},
    "20264": {"view": "tsdWaterTempMean", "click": "tsdWaterTempMean",
              "signup": "tsdWaterTempFinalQF", "purchase": "tsdWaterTempExpUncert",
              "error": "otherTerm"},
    "20053": {"view": "surfWaterTempMean", "click": "surfWaterTempMean",
              "signup": "finalQF", "purchase": "surfWaterTempExpUncert",
              "error": "otherTerm"},
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def site_of(key: Column) -> Column:
    return F.element_at(F.array(*[F.lit(s) for s in SITES]), (key % 12 + 1).cast("int"))


def sites(spark: SparkSession) -> DataFrame:
    return inline_table(spark, SITE_DIMENSION, SITE_SCHEMA)


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.withColumn("k", F.get_json_object("props", "$.k").try_cast("int"))


def archived(ts: Column, key: Column) -> Column:
    """The time that an event has in an archive: archives lag behind the provisional records,
    by a month at one site of four (the provisional month is then new), by five years at
    another (so that dated rules apply), and not at all at the others (the month is covered)."""
    days = F.when(key % 4 == 0, -31).when(key % 4 == 2, -1826).otherwise(0)
    return F.timestamp_add("DAY", days, ts)


def _hpos(k: Column) -> Column:
    return (F.when(k % 4 == 0, "101").when(k % 4 == 1, "102").when(k % 4 == 2, "103")
            .otherwise("111"))


def archive_wq(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _events(spark, sf_dir)
    k = F.col("k")
    return e.select(
        "event_id",
        site_of(F.col("user_id")).alias("siteID"),
        archived(F.col("ts"), F.col("user_id") % 12).alias("startDateTime"),
        F.when(k % 10 == 0, F.lit(None).cast("double"))
        .otherwise((k % 12).cast("double") / 8).alias("sensorDepth"),
        (F.col("value") * OXYGEN_SCALE).alias("dissolvedOxygen"),
        (F.col("value") / 100).alias("dissolvedOxygenExpUncert"),
        F.when(k % 13 == 0, F.lit(None).cast("int")).when(k % 7 == 0, 1).otherwise(0)
        .alias("dissolvedOxygenFinalQF"),
        (F.col("value") * CHLA_SCALE).alias("chlorophyll"),
        (F.col("value") / 200).alias("chlorophyllExpUncert"),
        F.when(k % 5 == 0, 1).otherwise(0).alias("chlorophyllFinalQF"),
    )


def archive_tsd(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        "l_orderkey", "l_linenumber",
        site_of(F.col("l_suppkey")).alias("siteID"),
        F.timestamp_add("MINUTE", (F.col("l_orderkey") % 48) * 30,
                        F.timestamp_add("YEAR", F.lit(TSD_YEARS), F.col("l_shipdate")))
        .alias("startDateTime"),
        F.when(F.col("l_partkey") % 50 == 0, F.lit(None).cast("int"))
        .otherwise(F.col("l_linenumber") + 501).alias("verticalPosition"),
        (F.col("l_linenumber").cast("double") / 4).alias("thermistorDepth"),
        (F.col("l_quantity") * QUANTITY_SCALE - 2).alias("tsdWaterTempMean"),
        F.col("l_tax").alias("tsdWaterTempExpUncert"),
        F.when(F.col("l_discount") > 0.085, 1).otherwise(0).alias("tsdWaterTempFinalQF"),
    )


def archive_tsw(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _events(spark, sf_dir)
    k = F.col("k")
    return e.select(
        "event_id",
        site_of(F.col("user_id")).alias("siteID"),
        archived(F.col("ts"), F.col("user_id") % 12).alias("startDateTime"),
        _hpos(k).alias("horizontalPosition"),
        (F.col("value") * VALUE_SCALE - 5).alias("surfWaterTempMean"),
        (F.col("value") / 100).alias("surfWaterTempExpUncert"),
        F.when(k % 7 == 0, 1).otherwise(0).alias("finalQF"),
    )


def provisional(spark: SparkSession, sf_dir: str, product: str) -> DataFrame:
    """Long provisional term records of one product (F5 schema, plus ``product``)."""
    e = _events(spark, sf_dir)
    k = F.col("k")
    mapping = TERM_MAP[product]
    term = F.element_at(F.create_map(*[x for kv in mapping.items() for x in map(F.lit, kv)]),
                        F.col("event_type"))
    is_flag = term.endswith("QF")
    return e.select(
        site_of(F.col("user_id")).alias("siteName"),
        term.alias("termName"),
        hour_floor(F.col("ts")).alias("startDate"),
        F.when(is_flag, F.lit(None).cast("double")).otherwise(F.col("value") * VALUE_SCALE)
        .alias("doubleValue"),
        F.when(is_flag, F.when(k % 3 == 0, 1).otherwise(0)).alias("intValue"),
        (k % 8 + 501).cast("string").alias("verticalIndex"),
        _hpos(k).alias("horizontalIndex"),
        F.when(k % 9 == 0, "001").otherwise("030").alias("temporalIndex"),
        F.lit(product).alias("product"),
    )


def curated_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _events(spark, sf_dir)
    k = F.col("k")
    return e.select(
        site_of(F.col("user_id")).alias("siteID"),
        F.col("ts").alias("startDate"),
        ((k % 12).cast("double") / 8).alias("sensorDepth"),
        F.when(k % 11 == 0, F.lit(None).cast("double")).otherwise(
            F.col("value") * VALUE_SCALE - 5)
        .alias("waterTemp"),
    )


def daily_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily targets-shaped series (time, site_id, variable, observed) from orders."""
    o = table(spark, sf_dir, "orders")
    var = (F.when(F.col("o_orderstatus") == "F", "temperature")
           .when(F.col("o_orderstatus") == "O", "oxygen").otherwise("chla"))
    rows = o.select(F.to_date("o_orderdate").alias("time"),
                    site_of(F.col("o_custkey")).alias("site_id"), var.alias("variable"),
                    (F.col("o_totalprice") * PRICE_SCALE).alias("observed"))
    mean = F.avg("observed")
    # the first of a month sits on a range's edge, the next two days repeat a value
    return rows.groupBy("time", "site_id", "variable").agg(
        F.when(F.dayofmonth("time") == 1, F.lit(15.0))
        .when(F.dayofmonth("time").isin(2, 3), F.lit(5.0)).otherwise(mean).alias("observed"))


def geo_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested geographic-coverage rows (SRC-12 schema) built from nation x region."""
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    j = n.join(r, F.col("n_regionkey") == F.col("r_regionkey"))
    lon = (F.col("n_nationkey") * 7.3 - 90).cast("string")
    lat = (F.col("n_nationkey") * 2.9 - 30).cast("string")
    return j.select(
        F.col("n_name").alias("id"),
        F.concat_ws(", ", "n_name", "r_name").alias("geographicDescription"),
        F.struct(lon.alias("westBoundingCoordinate"), lon.alias("eastBoundingCoordinate"),
                 lat.alias("northBoundingCoordinate"), lat.alias("southBoundingCoordinate"),
                 F.struct((F.col("n_regionkey") * 100.0).alias("altitudeMinimum"),
                          (F.col("n_regionkey") * 100.0 + 50).alias("altitudeMaximum"),
                          F.lit("meter").alias("altitudeUnits")).alias("boundingAltitudes"))
        .alias("boundingCoordinates"))
