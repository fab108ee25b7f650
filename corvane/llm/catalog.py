"""Queries and oracles of this subpackage, for ``__spark_entry__``."""

from __future__ import annotations

from . import bpe, embedding_dedup, license_scan, packing, simhash, span_hash, suffix_dedup, toxicity, url_filter, warc

_OPS = {
    "op1_toxicity": toxicity,
    "op2_bpe": bpe,
    "op3_packing": packing,
    "op4_suffix_dedup": suffix_dedup,
    "op5_url_filter": url_filter,
    "op6_simhash": simhash,
    "op7_license_scan": license_scan,
    "op8_span_hash": span_hash,
    "op9_warc": warc,
    "op10_embedding_dedup": embedding_dedup,
}


def queries() -> dict:
    return {name: m.query for name, m in _OPS.items()}


def oracle_sql() -> dict:
    return {name: m.ORACLE for name, m in _OPS.items() if getattr(m, "ORACLE", None)}
