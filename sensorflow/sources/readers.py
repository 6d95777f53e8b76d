"""Readers for the sensor sources.  Every reader returns a lazy DataFrame over *all* files
of a source (one multi-file scan); filters and column selections are pushed to the scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorflow.functions.missing import nan_to_null
from sensorflow.functions.timefmt import parse_timestamp, utc_wall_clock
from sensorflow.operators.coverage import GEO_SCHEMA
from sensorflow.sources import landing, schemas
from sensorflow.sources.files import has_code, read_csv_by_name
from sensorflow.sources.releases import read_releases
from sensorflow.sources.rules import DEPTH_LOOKUP_SCHEMA, PRODUCTS


def read_archive(spark: SparkSession, path: str, schema: T.StructType | None = None,
                 fmt: str = "parquet", columns: Sequence[str] | None = None) -> DataFrame:
    """Archived product table (Parquet dataset by default, Hive partitions discovered).

    Zoned timestamps become their UTC wall clock, so days do not move with the session zone.
    Parquet releases may differ in schema: a column that some lack is NULL there, and one that
    all lack is an error.
    """
    names = schema.fieldNames() if schema is not None else None
    stored = read_releases(spark, path, names) if fmt == "parquet" else spark.read.format(fmt).load(path)
    if schema is not None:
        missing = [f.name for f in schema.fields if f.name not in stored.columns]
        if missing:
            raise ValueError(f"{path} has no column {', '.join(missing)}")
    kinds = {f.name: f.dataType for f in stored.schema.fields}
    wanted = schema.fields if schema is not None else stored.schema.fields

    def column(f: T.StructField) -> Column:
        c = F.col(f.name)
        if isinstance(kinds[f.name], T.TimestampType):
            return utc_wall_clock(c).alias(f.name)
        return c.alias(f.name) if kinds[f.name] == f.dataType else c.try_cast(f.dataType).alias(f.name)

    df = stored.select(*[column(f) for f in wanted])
    return df.select(*columns) if columns else df


def read_curated_csv(spark: SparkSession, paths: str | Sequence[str],
                     schema: T.StructType = schemas.CURATED_PROFILE_TEXT,
                     sites: Sequence[str] | None = None) -> DataFrame:
    """Curated profile CSV files (header, ``NA`` = missing), columns by name, in one scan.

    ``startDate`` text is parsed to a zone-free timestamp; numeric text that is not a
    number becomes NULL.  ``sites`` keeps only files whose name has a site code as a part.
    """
    df = read_csv_by_name(spark, paths, schema)
    if sites:
        df = df.where(has_code("source_file", sites))
    out = df.withColumn("startDate", parse_timestamp(F.col("startDate")))
    for c in ("sensorDepth", "waterTemp"):
        if c in out.columns:
            out = out.withColumn(c, nan_to_null(F.col(c).try_cast("double")))
    return out


def read_provisional(spark: SparkSession, root: str, product: str | None = None,
                     fmt: str = "avro", schema: T.StructType = schemas.PROVISIONAL,
                     sites: Sequence[str] | None = None,
                     months: Sequence[str] | None = None) -> DataFrame:
    """Low-latency long records under ``root``, in one scan over all its files.

    Files lie under ``product=/site=/ms=`` (as ``landing.land`` writes them), any of these
    left out; what the directories carry prunes them before files are listed.  Where the
    product is no directory, the file name has to have it as a part of its own.  A site is
    the directory's or, without one, the record's.  Of a landing with a ledger only committed
    batches are read, and of several issues of a record the latest.  ``fmt`` is ``avro`` in production (needs
    the spark-avro package) and ``parquet``/``json`` elsewhere.
    """
    if product is not None and product not in PRODUCTS:
        raise ValueError(f"no provisional reader for product {product!r}")
    ledger = landing.read_ledger(spark, root)
    if ledger is not None:
        df = landing.landed(spark, root)
        for c, wanted in (("product", [product] if product else None), ("site", sites), ("ms", months)):
            if wanted:
                df = df.where(F.col(c).isin(list(wanted)))
                ledger = ledger.where(F.col(c).isin(list(wanted)))
        return landing.latest_records(landing.committed(df, ledger), ledger).drop("batch", "source_length", "arrived")
    df = spark.read.format(fmt).schema(schema).load(root)
    found = [c for c in landing.PARTITIONS if c in df.columns]
    if found:  # as text, whatever their values look like
        text = [T.StructField(c, T.StringType()) for c in found]
        df = spark.read.format(fmt).schema(T.StructType(schema.fields + text)).load(root)
    df = df.withColumn("source_path", F.col("_metadata.file_path"))
    if product and "product" in df.columns:
        df = df.where(F.col("product") == product)
    elif product:
        df = df.withColumn("__name", F.col("_metadata.file_name"))
        df = df.where(has_code("__name", [product])).drop("__name")
    if sites:
        df = df.where(F.col("site" if "site" in df.columns else "siteName").isin(list(sites)))
    if months and "ms" in df.columns:
        df = df.where(F.col("ms").isin(list(months)))
    elif months:
        df = df.where(F.date_format("startDate", "yyyy-MM").isin(list(months)))
    return df


def read_sites(spark: SparkSession, path: str) -> DataFrame:
    """Site dimension CSV (field_site_id, field_site_subtype, aquatics, among others)."""
    return (read_csv_by_name(spark, path, schemas.SITES_TEXT).drop("source_file")
            .withColumn("aquatics", F.col("aquatics").try_cast("int")))


def read_rules(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """A rule table CSV (depth lookup or corrections, ranges, masks, QC parameters)."""
    kind = schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)
    return read_csv_by_name(spark, path, kind).drop("source_file")


def read_depth_lookup(spark: SparkSession, path: str) -> DataFrame:
    """Thermistor depth lookup CSV with declared types (string, string, double)."""
    return read_rules(spark, path, DEPTH_LOOKUP_SCHEMA)


def read_geo(spark: SparkSession, path: str) -> DataFrame:
    """Geographic coverage JSON: one array of nested site objects (multi-line)."""
    return spark.read.option("multiLine", True).schema(GEO_SCHEMA).json(path)


def read_targets(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The targets table (Parquet, or the gz CSV with ``NA`` for missing)."""
    if fmt == "csv":
        return read_csv_by_name(spark, path, schemas.TARGETS).drop("source_file")
    return spark.read.schema(schemas.TARGETS).parquet(path)


def forecast_columns(spark: SparkSession, path: str) -> list[str]:
    """The column names of a forecast file, as its header has them."""
    return spark.read.option("header", True).csv(path).columns


def read_forecast(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A forecast file written by ``sinks.write_forecast`` (header CSV, ``NA`` missing).

    Without ``schema`` it is the contract whose columns the header has; another header is an
    error.
    """
    have = forecast_columns(spark, path)
    known = [schema] if schema is not None else [schemas.CLIMATOLOGY_FORECAST, schemas.ENSEMBLE_FORECAST]
    fits = [s for s in known if sorted(s.fieldNames()) == sorted(have)]
    if not fits:
        raise ValueError(f"column names {have} of {path} fit no forecast contract")
    return read_csv_by_name(spark, path, fits[0]).drop("source_file")
