"""Operators of a training-data pipeline: deduplication, filters, scans, tokens and archives.

Nothing outside this subpackage imports it; ``queries.py`` registers one query per operator.
"""
