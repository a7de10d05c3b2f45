"""Sluice: Spark-native file ingestion with error-threshold gates and operational analytics."""

__version__ = "0.1.0"
