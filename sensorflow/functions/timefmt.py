"""Time helpers that keep zone-free timestamps zone-free.

``date_trunc`` returns a zoned timestamp; flooring with ``make_timestamp_ntz`` avoids a
round trip through the session time zone (and its daylight-saving gaps).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted text layouts of the curated/archive time strings: date, space or T, minutes or
# seconds, and Z after the T form.
TIMESTAMP_TEXT = r"^\d{4}-\d{2}-\d{2}( \d{2}:\d{2}(:\d{2})?|T\d{2}:\d{2}(:\d{2})?Z?)$"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def hour_floor(col) -> Column:
    """Floor a zone-free timestamp to the hour (``ymd_h(format(x, '%Y-%m-%d %H'))``)."""
    c = _c(col)
    return F.make_timestamp_ntz(F.year(c), F.month(c), F.dayofmonth(c), F.hour(c),
                                F.lit(0), F.lit(0))


def day_of(col) -> Column:
    """Calendar date of a timestamp (``as_date``)."""
    return F.to_date(_c(col))


def month_key(col) -> Column:
    """``YYYY-MM`` month key of a date or timestamp."""
    return F.date_format(_c(col), "yyyy-MM")


def parse_timestamp(col) -> Column:
    """Parse text to a zone-free timestamp whatever the session zone; NULL where no layout
    fits."""
    c = _c(col)
    return F.when(c.rlike(TIMESTAMP_TEXT), F.regexp_replace(c, "Z$", "").try_cast("timestamp_ntz"))


def utc_wall_clock(col) -> Column:
    """Zoned timestamp -> zone-free timestamp of its UTC wall clock (no session zone in it)."""
    seconds = (F.unix_micros(_c(col)).cast("decimal(18,0)") / 1_000_000).cast("decimal(18,6)")
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), seconds)
