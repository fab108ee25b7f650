"""Spark-first analytics over append-only corpora of dated answers and result pages."""

__version__ = "0.1.0"
