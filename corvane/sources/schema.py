"""Schemas and enumerations of the corpus."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _L, _B, _A = T.StringType(), T.LongType(), T.BooleanType(), T.ArrayType(T.StringType())


def _struct(**fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields.items()])


DIAGNOSTICS = _struct(html_bytes=_L, href_total=_L, redirect_hrefs=_L, looks_like_consent_wall=_B, looks_like_captcha=_B, extraction_ok=_B, zero_reason=_S)

PAIR = _struct(
    terser_names=_A, verbose_names=_A, extraction_suspect=_B, suspect_note=_S, engine_a=_S, engine_b=_S, named_by_a=_B, named_by_b=_B,
    naming_disagreement=_B, terser_engine=_S, terser_entity_count=_L, verbose_entity_count=_L, containment_pct=T.DoubleType(), shared_count=_L,
    answer_chars_a=_L, answer_chars_b=_L, zero_shared=_B,
)

#: One wide schema for every kind of row; never inferred, fields that a kind lacks are null.
OBSERVATION = _struct(
    check_id=_S, date_utc=_S, business=_S, niche=_S, market=_S, row_type=_S, prompt_variant=_L, run=_L, prompt_text=_S, engine=_S, run_channel=_S,
    schema_version=_S, run_status=_S, business_mentioned=_B, competitors_mentioned=_A, engine_stated_criteria=_A, sources_cited=_A, factor_scores=_S,
    answer_verbatim=_S, session_note=_S, organic_top_results=_A, ai_overview_detected=_B, serp_diagnostics=DIAGNOSTICS, engines_compared=_A,
    engines_usable=_L, method_note=_S, pairs=T.ArrayType(PAIR),
)

ROSTER = _struct(roster=T.ArrayType(_struct(business=_S, niche=_S, market=_S, row_type=_S, active=_B, prompt_1=_S, variants_business_name_forms=_A)))

INDEX_ROW = _struct(check_id=_S, date_utc=_S, engine=_S, prompt_variant=_S, business_mentioned=_B, competitors_mentioned=_A, note=_S)

INDEX = _struct(
    schema_version=_S, spec=_S, doctrine=_S, subject=_S, category=_S, started_utc=_S,
    rows=T.ArrayType(INDEX_ROW),
    pending=T.ArrayType(_struct(engine=_S, status=_S, note=_S)),
)

# Fixed values of the data.
OK, FAILED, QUOTA_BLOCKED, EXTRACTION_FAILED = "OK", "FAILED", "QUOTA_BLOCKED", "EXTRACTION_FAILED"
COLD, WARM, HOT = "cold", "warm", "hot"
ENGINES = ("perplexity", "gemini", "openai", "anthropic")
PAGE_ENGINE = "google_serp"
SCHEMA_VERSION = "v4"
