"""Incremental ingestion and streaming forms of the operators."""
