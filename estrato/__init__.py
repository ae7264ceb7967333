"""Layered lakehouse analytics on PySpark: typed ingest, star schema, quality gates, profiling, metrics."""

__version__ = "0.1.0"
