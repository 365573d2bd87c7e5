"""Gleanmill: Spark-first triage of web corpora that have already been fetched."""

__version__ = "0.1.0"
