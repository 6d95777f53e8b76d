"""Writers.  Outputs are written by path with ``overwrite`` so a retried job (or a lost
executor's recomputed task) leaves exactly one copy."""

from __future__ import annotations

import csv
import gzip
import io
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorflow.functions.names import forecast_file_name
from sensorflow.session import shared_path


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = (),
                  sort_within: Sequence[str] = (), cluster_by: Sequence = ()) -> str:
    """Main form of every output: Parquet, optionally partitioned and locally sorted.

    ``cluster_by`` hash-distributes rows first (e.g. partition column + month), so each
    output partition is written by few tasks instead of every task writing a small file
    for every partition value, while a hot partition value still spreads over months.
    """
    d = df.repartition(*cluster_by) if cluster_by else df
    d = d.sortWithinPartitions(*sort_within) if sort_within else d
    w = d.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def write_csv_gz(df: DataFrame, path: str, sort_by: Sequence[str] = ()) -> str:
    """One gzip file of header CSV, ``NA`` for missing (the published targets format).

    A range-partitioned sort gives parts in total order, written by tasks as gzip members
    without a header.  A header member and the parts' bytes follow each other in one file,
    which is a valid gzip file; it grows under a temporary name, copied as a stream, and is
    renamed when complete.  A file already there is replaced.
    """
    spark = df.sparkSession
    parts = shared_path(spark, "csv", uuid.uuid4().hex)
    d = df.orderBy(*sort_by) if sort_by else df
    (d.write.option("header", False).option("nullValue", "NA").option("compression", "gzip").csv(parts))
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    hadoop = jvm.org.apache.hadoop
    folder, final = hadoop.fs.Path(parts), hadoop.fs.Path(path)
    temporary = hadoop.fs.Path(final.getParent(), f"_{uuid.uuid4().hex}.tmp")
    source, target = folder.getFileSystem(conf), final.getFileSystem(conf)
    files = [f.getPath() for f in source.listStatus(folder) if f.getPath().getName().startswith("part-")]
    line = io.StringIO()
    csv.writer(line, lineterminator="\n").writerow(df.columns)
    out = target.create(temporary, True)
    try:
        out.write(bytearray(gzip.compress(line.getvalue().encode(), mtime=0)))
        for f in sorted(files, key=lambda f: int(f.getName().split("-")[1])):
            part = source.open(f)
            try:
                hadoop.io.IOUtils.copyBytes(part, out, 1 << 20, False)
            finally:
                part.close()
    finally:
        out.close()
    target.delete(final, True)
    if not target.rename(temporary, final):
        raise OSError(f"cannot rename {temporary} to {path}")
    source.delete(folder, True)
    return path


def forecast_path(df: DataFrame, base: str, theme: str, team: str,
                  time: str = "time") -> str:
    """``<base>/<theme>-<first forecast day>-<team>.csv.gz`` from the data's first day.

    An empty forecast has no first day and is rejected rather than written unnamed.  ``df``
    is read for its first day, so pass a written forecast.
    """
    first = df.select(F.min(time).alias("d")).first()["d"]
    if first is None:
        raise ValueError("empty forecast: no forecast day to name the file after")
    name = df.sparkSession.range(1).select(
        forecast_file_name(theme, F.lit(first), team).alias("n")).first()["n"]
    return f"{base.rstrip('/')}/{name}"


def write_forecast(df: DataFrame, base: str, theme: str, team: str) -> str:
    """Write a forecast under its standard file name; returns the path.

    The forecast is computed once: it is written to the shared folder as Parquet, and the
    name and the sorted file come from that.
    """
    spark = df.sparkSession
    once = shared_path(spark, "forecasts", uuid.uuid4().hex)
    df.write.parquet(once)
    stored = spark.read.schema(df.schema).parquet(once)
    path = forecast_path(stored, base, theme, team)
    return write_csv_gz(stored, path, sort_by=("site_id", "variable", "time"))
