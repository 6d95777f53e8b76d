"""sensorflow: Spark-native operators for quality-flagged environmental sensor data.

Layout
------
functions/  column expressions (missing values, time parsing, name parsing)
sources/    readers and writers (archive tables, curated CSV, provisional records,
            dimension tables, forecast files) plus the driver-table stand-in views
operators/  DataFrame -> DataFrame transforms (reshape, quality control, depth,
            rollups, time-series scans, climatology, random walk, coverage)
streaming/  incremental refresh (month plan, superseding, file-stream ingest)
plans/      end-to-end jobs (targets, forecasts) and the query registry
"""

__version__ = "0.1.0"
