"""Sensor depth: data-driven corrections (interval join) and lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def overlapping_intervals(rules: DataFrame, keys: Sequence[str], start: str, end: str) -> DataFrame:
    """Rules that begin before an earlier rule of their key has ended (both ends inclusive, NULL = open).

    A sweep line: in order of their starts, a rule overlaps an earlier one exactly if its start
    is not after the latest end so far, a running maximum; no rule meets another.  Rows that
    are repeated as they are count once.
    """
    lo, hi = F.to_date(F.lit("0001-01-01")), F.to_date(F.lit("9999-12-31"))
    d = rules.withColumns({"__from": F.coalesce(start, lo), "__to": F.coalesce(end, hi)})
    rest = [c for c in rules.columns if c not in (start, end)]
    d = d.dropDuplicates([*rest, "__from", "__to"])
    before = Window.partitionBy(*keys).orderBy("__from", "__to", *[c for c in rest if c not in keys]).rowsBetween(
        Window.unboundedPreceding, -1)
    return (d.withColumn("__latest", F.max("__to").over(before)).where(F.col("__from") <= F.col("__latest"))
            .select(*rules.columns))


def validate_corrections(corrections: DataFrame) -> None:
    """Raise if two different correction rows of one (site, position) overlap in time.

    A row that is repeated as it is counts once; rows without site or position apply to none.
    """
    known = corrections.select("site_id", "vertical_position", "valid_from", "valid_to", "depth").dropna(
        subset=["site_id", "vertical_position"])
    found = overlapping_intervals(known, ["site_id", "vertical_position"], "valid_from", "valid_to").first()
    if found is not None:
        raise ValueError("depth corrections overlap for one (site_id, vertical_position): "
                         f"{found['site_id']}, {found['vertical_position']}")


def correct_depth(df: DataFrame, corrections: DataFrame, site: str = "site_id",
                  position: str = "verticalPosition", time: str = "startDateTime",
                  depth: str = "depth") -> DataFrame:
    """Replace ``depth`` where a correction row covers (site, position, date); NULL bound = open.

    The distinct rules of one sensor are packed into one row, so the join on (site, position)
    never multiplies data rows.  Of several rules that cover a date the one that starts last
    counts (``validate_corrections`` rejects such tables).  Other rows keep their depth.
    """
    packed = corrections.groupBy(F.col("site_id").alias("__c_site"),
                                 F.col("vertical_position").alias("__c_pos")).agg(
        F.sort_array(F.collect_set(F.struct("valid_from", "valid_to", "depth")), asc=False)
        .alias("__c_rules"))
    day = F.to_date(F.col(time))

    def covers(r):
        return ((r["valid_from"].isNull() | (day >= r["valid_from"]))
                & (r["valid_to"].isNull() | (day <= r["valid_to"])))

    d = df.join(packed, (F.col(site) == F.col("__c_site"))
                & (F.col(position).cast("int") == F.col("__c_pos")), "left")
    rule = F.get(F.filter("__c_rules", covers), F.lit(0))
    d = d.withColumn(depth, F.coalesce(rule["depth"], F.col(depth)))
    return d.drop("__c_site", "__c_pos", "__c_rules")


def lookup_depth(df: DataFrame, lookup: DataFrame,
                 keys=("siteName", "verticalIndex")) -> DataFrame:
    """Attach the sensor depth; sensors missing from the lookup are dropped (inner join).

    A sensor that the lookup repeats counts once."""
    lk = lookup.dropDuplicates(list(keys))
    for k in keys:
        lk = lk.withColumn(k, F.col(k).cast("string"))
    d = df
    for k in keys:
        d = d.withColumn(k, F.col(k).cast("string"))
    return d.join(lk, list(keys), "inner")


def surface_only(df: DataFrame, depth: str = "depth", max_depth: float = 1.0) -> DataFrame:
    """Rows at or above ``max_depth`` metres."""
    return df.where(F.col(depth) <= F.lit(max_depth))


def in_depth_window(df: DataFrame, depth: str = "sensorDepth", lo: float = 0.0,
                    hi: float = 1.0) -> DataFrame:
    """``lo < depth < hi``, or depth unknown (an unknown sensor depth means surface)."""
    d = F.col(depth)
    return df.where(((d > F.lit(lo)) & (d < F.lit(hi))) | d.isNull())
