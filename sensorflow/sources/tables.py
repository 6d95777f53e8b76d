"""Small in-plan tables for rules and dimensions.

``createDataFrame(list)`` ships rows as an RDD, which the planner cannot see through;
an inline ``VALUES`` table is a local relation: its rows are part of the plan, its size
is known to the optimizer, it has a stable identity (size checks are remembered) and it
is built with a single call to the JVM.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def _literal(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, int):
        return str(v)
    if isinstance(v, float):
        return repr(v) + "D"
    if isinstance(v, dt.datetime):
        return f"TIMESTAMP_NTZ '{v.isoformat(sep=' ')}'"
    if isinstance(v, dt.date):
        return f"DATE '{v.isoformat()}'"
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


def inline_table(spark: SparkSession, rows: Sequence[Sequence], schema: str | T.StructType
                 ) -> DataFrame:
    """A DataFrame whose rows are literals of the plan (for small fixed tables)."""
    st = schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)
    if not rows:
        return spark.createDataFrame([], st)
    values = ", ".join("(" + ", ".join(_literal(v) for v in r) + ")" for r in rows)
    cols = ", ".join(f"CAST(col{i + 1} AS {f.dataType.simpleString()}) AS `{f.name}`"
                     for i, f in enumerate(st.fields))
    return spark.sql(f"SELECT {cols} FROM VALUES {values}")
