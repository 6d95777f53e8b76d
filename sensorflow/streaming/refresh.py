"""Incremental refresh: month plan, superseding provisional rows, file-stream ingest."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorflow.streaming.coverage_map import coverage_map, not_covered


def _d(v):
    return v if not isinstance(v, str) else F.to_date(F.lit(v))


def month_plan(archive: DataFrame, time: str, as_of, lag_days: int = 2,
               keys: Sequence[str] = ()) -> DataFrame:
    """Latest archived month and the months to fetch (overall or per ``keys``).

    Months to fetch = distinct {month after the latest archived date, month of
    ``as_of - lag_days``}; month keys are ``yyyy-MM`` text.
    """
    latest = F.max(F.col(time))
    agg = archive.groupBy(*keys).agg(latest.alias("__max")) if keys else archive.agg(
        latest.alias("__max"))
    nxt = F.date_format(F.add_months(F.col("__max"), 1), "yyyy-MM")
    now = F.date_format(F.date_sub(_d(as_of), lag_days), "yyyy-MM")
    return agg.select(*keys, F.date_format("__max", "yyyy-MM").alias("latest_month"),
                      F.explode(F.array_distinct(F.array(nxt, now))).alias("fetch_month"))


def supersede(provisional: DataFrame, archive: DataFrame, prov_time: str, arch_time: str,
              keys: Mapping[str, str] | Sequence[str]) -> DataFrame:
    """Drop provisional rows of the months that the archive holds for their series.

    ``keys`` maps provisional columns to archive columns (or lists names that both share),
    e.g. site and variable.  Only a month that the archive holds itself is superseded: a hole
    before its latest month keeps its provisional rows.  Nothing is deleted; superseded rows
    are just not read.  Pass the archive rows that really enter the target.
    """
    pairs = dict(keys) if isinstance(keys, Mapping) else {k: k for k in keys}
    return not_covered(provisional, coverage_map(archive, list(pairs.values()), arch_time), prov_time,
                       {a: p for p, a in pairs.items()})


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that a stream keeps in its checkpoint over all its runs."""
    return json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0])["id"]


def stream_ingest(spark: SparkSession, source: str, schema: T.StructType | str,
                  batch_fn: Callable[[DataFrame], DataFrame], sink: str, checkpoint: str,
                  fmt: str = "parquet", name_glob: str | None = None,
                  max_files_per_trigger: int | None = None) -> str:
    """Ingest new files under ``source`` once (``availableNow``) and add them to ``sink``.

    The checkpoint remembers which files were processed, so a rerun with the same
    ``checkpoint`` reads only files that arrived since.  ``batch_fn`` turns one micro-batch
    into rows to add (e.g. partial daily sums and counts, which stay exact however late a
    record is).  ``max_files_per_trigger`` bounds a micro-batch so a large backlog is
    processed in several batches.  Returns the sink path.
    """
    reader = spark.readStream.format(fmt).schema(schema).option("recursiveFileLookup", "true")
    if name_glob:
        reader = reader.option("pathGlobFilter", name_glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.load(source)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        # one directory per stream and micro-batch, overwritten on a retry: at-least-once
        # delivery of a batch still leaves exactly one copy of its rows
        name = f"{stream_id(spark, checkpoint)}-{batch_id}"
        batch_fn(batch).write.mode("overwrite").parquet(f"{sink}/batch_id={name}")

    q = (stream.writeStream.foreachBatch(write_batch)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return sink


def daily_partials(batch: DataFrame, keys: Sequence[str], time: str, value: str) -> DataFrame:
    """Per-batch partial daily sums and counts (combine across batches with ``sum``)."""
    return batch.groupBy(*keys, F.to_date(time).alias("time")).agg(
        F.sum(value).alias("sum"), F.count(value).alias("count"),
        F.count(F.lit(1)).alias("rows"))


def combine_daily(partials: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Exact daily means from partial sums/counts of any number of batches."""
    s = partials.groupBy(*keys, "time").agg(F.sum("sum").alias("s"),
                                            F.sum("count").alias("c"))
    return s.select(*keys, "time", F.when(F.col("c") > 0, F.col("s") / F.col("c"))
                    .alias("observed"))
