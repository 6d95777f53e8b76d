"""Multi-file reads: one scan over every matching file, never a per-file loop."""

from __future__ import annotations

import re

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_files(spark: SparkSession, root: str, fmt: str = "parquet",
               schema: T.StructType | str | None = None, name_glob: str | None = None,
               name_codes: Sequence[str] | None = None, recursive: bool = True,
               **options) -> DataFrame:
    """Read all files under ``root`` as one DataFrame with a ``source_file`` column.

    ``name_glob`` keeps files whose name matches; ``name_codes`` keeps files whose name has
    one of the codes (e.g. site codes) as a part of its own, by a filter on the file-name
    metadata column, which skips whole files.
    """
    r = spark.read.format(fmt)
    if schema is not None:
        r = r.schema(schema)
    if recursive:
        r = r.option("recursiveFileLookup", "true")
    if name_glob:
        r = r.option("pathGlobFilter", name_glob)
    for k, v in options.items():
        r = r.option(k, v)
    df = r.load(root)
    df = df.withColumn("source_file", F.col("_metadata.file_name"))
    return df.where(has_code("source_file", name_codes)) if name_codes else df


def has_code(column: str, codes: Sequence[str]) -> Column:
    """True where the text has one of ``codes`` between other characters than letters and
    digits."""
    alternatives = "|".join(re.escape(c) for c in sorted(set(codes)))
    return F.col(column).rlike(f"(^|[^0-9A-Za-z])({alternatives})([^0-9A-Za-z]|$)")


def data_files(spark: SparkSession, path: str) -> list[str]:
    """The files at or below ``path`` (a file, a folder or a glob); names with _ or . are hidden."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    top = hadoop.Path(path)
    fs = top.getFileSystem(spark._jsc.hadoopConfiguration())
    out = []
    for found in fs.globStatus(top) or []:
        root = found.getPath().toString()
        files = fs.listFiles(found.getPath(), True)
        while files.hasNext():
            name = files.next().getPath().toString()
            if not any(part.startswith(("_", ".")) for part in name[len(root):].split("/")):
                out.append(name)
    return sorted(out)


def first_line(spark: SparkSession, path: str) -> str | None:
    """The first line of a text file, compressed or not; None of an empty one.  Reads one buffer."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    stream = p.getFileSystem(conf).open(p)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(p)
        inner = codec.createInputStream(stream) if codec is not None else stream
        return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(inner, "UTF-8")).readLine()
    finally:
        stream.close()


def read_csv_by_name(spark: SparkSession, paths: str | Sequence[str],
                     schema: T.StructType) -> DataFrame:
    """CSV files with a header, ``NA`` = missing, columns chosen by their names.

    Files are grouped by their header line, and each distinct header is one scan over all its
    files, wherever they lie.  All columns are read as text under the header's names, in whatever
    order; the schema's columns are selected and cast (text that does not fit becomes NULL), others
    are left out.  A column that a header lacks is an error.  Empty files have no rows.
    """
    groups: dict[str, list[str]] = {}
    for p in [paths] if isinstance(paths, str) else list(paths):
        files = data_files(spark, p)
        if not files:
            raise ValueError(f"{p} has no files")
        for f in files:
            header = first_line(spark, f)
            if header is not None:
                groups.setdefault(header, []).append(f)
    out = None
    for header, files in sorted(groups.items()):
        df = spark.read.option("header", True).option("nullValue", "NA").option("enforceSchema", False).csv(files)
        missing = [c for c in schema.fieldNames() if c not in df.columns]
        if missing:
            raise ValueError(f"{files[0]} has no column {', '.join(missing)}; its header is {', '.join(df.columns)}")
        part = df.select(*[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in schema.fields],
                         F.col("_metadata.file_name").alias("source_file"))
        out = part if out is None else out.unionByName(part)
    if out is None:
        return spark.createDataFrame([], T.StructType([*schema.fields, T.StructField("source_file", T.StringType())]))
    return out
