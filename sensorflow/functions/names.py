"""Forecast file names: ``<theme>-<YYYY-MM-DD>-<team>.csv[.gz]``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def parse_forecast_name(col) -> Column:
    """Struct(theme, issue_date, team) parsed from a forecast file name (path allowed).

    The theme is the text before the first ``-``; the team is the fifth ``-`` field up to
    ``.csv``, as the metadata builder reads it.
    """
    base = F.regexp_extract(_c(col), r"([^/]+)$", 1)
    parts = F.split(base, "-")
    team = F.regexp_replace(F.element_at(parts, 5), r"\.csv.*$", "")
    issue = F.try_to_date(F.concat_ws("-", F.element_at(parts, 2), F.element_at(parts, 3),
                                      F.element_at(parts, 4)), "yyyy-MM-dd")
    return F.struct(F.element_at(parts, 1).alias("theme"), issue.alias("issue_date"),
                    team.alias("team"))


def forecast_file_name(theme: str, first_day: Column, team: str,
                       suffix: str = "csv.gz") -> Column:
    """``paste(theme, min(time), team.suffix, sep='-')`` as a column expression."""
    return F.concat_ws("-", F.lit(theme), F.date_format(first_day, "yyyy-MM-dd"),
                       F.lit(f"{team}.{suffix}"))
