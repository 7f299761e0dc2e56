"""Sinks: tables of a zone and Parquet exports."""
