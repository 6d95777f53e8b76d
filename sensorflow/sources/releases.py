"""Parquet archives whose files differ in schema from one release to the next."""

from __future__ import annotations

import functools
import json
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorflow.functions.timefmt import utc_wall_clock
from sensorflow.sources.files import data_files

#: Footers that one task reads.
FILES_PER_TASK = 256
#: Integer types from narrow to wide, with their greatest number of digits.
INTEGERS = {T.ByteType(): 3, T.ShortType(): 5, T.IntegerType(): 10, T.LongType(): 19}


def _open(uri: str):
    """The Arrow file system of a Hadoop path, and the path in it."""
    from pyarrow import fs

    scheme, _, rest = uri.partition(":")
    if not rest or scheme == "file":
        return fs.LocalFileSystem(), "/" + (rest or uri).lstrip("/")
    authority, _, path = rest.removeprefix("//").partition("/")
    system, base = fs.FileSystem.from_uri(f"{'s3' if scheme in ('s3a', 's3n') else scheme}://{authority}/")
    return system, f"{base.rstrip('/')}/{path}"


def _footers(columns: Sequence[str] | None):
    """Reads each file's footer: the stored types of the columns, as text."""
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pyarrow.parquet as pq

        for batch in batches:
            out = []
            for uri in batch["path"]:
                system, path = _open(uri)
                leaves = pq.read_metadata(path, filesystem=system).schema
                found = [(c.path, c.physical_type, str(c.logical_type)) for c in map(leaves.column, range(len(leaves)))]
                out.append(json.dumps(sorted(c for c in found if columns is None or any(
                    c[0] == name or c[0].startswith(f"{name}.") for name in columns))))
            yield pd.DataFrame({"path": batch["path"], "stored": out})
    return read


def files_by_schema(spark: SparkSession, files: Sequence[str],
                    columns: Sequence[str] | None = None) -> list[list[str]]:
    """The files, grouped by the stored types of ``columns`` (all where it is None).

    Tasks read the footers; a path and a hash of each file reach the driver, which lists the
    files for the scans anyway.
    """
    paths = spark.createDataFrame([(f,) for f in files], "path string")
    paths = paths.repartition(-(-len(files) // FILES_PER_TASK), "path")
    kinds = paths.mapInPandas(_footers(columns), "path string, stored string")
    groups: dict[str, list[str]] = {}
    for r in kinds.select("path", F.sha2("stored", 256).alias("kind")).collect():
        groups.setdefault(r["kind"], []).append(r["path"])
    return sorted(sorted(g) for g in groups.values())


def common_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """The type that holds the values of both: the wider number, the longer time, else text."""
    if a == b:
        return a
    numbers = (T.FloatType, T.DoubleType)
    if a in INTEGERS and b in INTEGERS:
        return max(a, b, key=INTEGERS.__getitem__)
    if isinstance(a, T.NumericType) and isinstance(b, T.NumericType):
        if isinstance(a, numbers) or isinstance(b, numbers):
            return T.DoubleType()
        digits = [(INTEGERS[t], 0) if t in INTEGERS else (t.precision - t.scale, t.scale) for t in (a, b)]
        scale = max(s for _, s in digits)
        return T.DecimalType(min(38, max(d for d, _ in digits) + scale), scale)
    times = (T.DateType, T.TimestampType, T.TimestampNTZType)
    if isinstance(a, times) and isinstance(b, times):
        return T.TimestampNTZType()
    if isinstance(a, T.AtomicType) and isinstance(b, T.AtomicType):
        return T.StringType()
    raise ValueError(f"no common type of {a.simpleString()} and {b.simpleString()}")


def _converted(column: Column, stored: T.DataType, wanted: T.DataType) -> Column:
    if stored == wanted:
        return column
    if isinstance(stored, T.TimestampType) and isinstance(wanted, T.TimestampNTZType):
        return utc_wall_clock(column)
    return column.cast(wanted)


def read_releases(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """All Parquet files at or below ``path`` as one table, columns by name.

    Files of equal schema are one scan, however many folders they lie in, and only the wanted
    columns count for that, so a release that changes another column needs no scan of its own.
    A column has the type that holds the values of all releases (``common_type``) and is NULL
    where a release lacks it.  ``columns`` that no release has are left out.  Partition folders
    below ``path`` give columns.
    """
    files = data_files(spark, path)
    if not files:
        raise ValueError(f"{path} has no files")
    groups = [(spark.read.parquet(g[0]).schema, g) for g in files_by_schema(spark, files, columns)]
    kinds: dict[str, list[T.DataType]] = {}
    for stored, _ in groups:
        for f in stored.fields:
            if columns is None or f.name in columns:
                kinds.setdefault(f.name, []).append(f.dataType)
    wanted = {name: functools.reduce(common_type, found) for name, found in kinds.items()}
    parts = []
    for stored, group in groups:
        fields = [f for f in stored.fields if f.name in wanted]
        have = {f.name: f.dataType for f in fields}
        reader = spark.read.schema(T.StructType(fields or stored.fields[:1]))
        if not any(c in path for c in "*?[{"):
            reader = reader.option("basePath", path)
        df = reader.parquet(*group)
        folders = [c for c in df.columns if c not in stored.fieldNames()]
        parts.append(df.select(
            *[(_converted(F.col(f"`{name}`"), have[name], kind) if name in have
               else F.lit(None).cast(kind)).alias(name) for name, kind in wanted.items()],
            *[F.col(f"`{c}`") for c in folders if columns is None or c in columns]))
    return functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
