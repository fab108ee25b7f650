"""Scans and sinks of observation corpora, and connectors."""
