"""Incremental refresh: month_plan, supersede, stream_ingest + daily_partials +
combine_daily (exact for any lateness)."""
