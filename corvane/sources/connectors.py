"""Connectors of engines and result pages, without a network of their own.

A connector turns (prompt) into ``(ok, text, sources, error)``. What it sends is
left to an injected ``transport(engine, prompt) -> (status, body)``, so that
keys and the network stay out of the engine; requests are made (``request``),
responses parsed and errors classified here. ``collect`` runs connectors in
``mapInPandas``, ``replay`` reads stored responses instead.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.functions.web import quote_url

from .schema import ENGINES

Transport = Callable[[str, str], tuple[int, str]]
Answer = tuple[bool, str, list[str], str]

#: Path to the answer's text in each engine's response.
TEXT_PATHS: dict[str, tuple] = {
    "perplexity": ("choices", 0, "message", "content"),
    "gemini": ("candidates", 0, "content", "parts", 0, "text"),
    "openai": ("choices", 0, "message", "content"),
    "anthropic": ("content", 0, "text"),
}
CITATIONS = {"perplexity": "citations"}
PAGE_ATTEMPTS, LEAST_PAGE, DETAIL = 3, 2000, 300
# Fixed values of requests.
URLS = {
    "perplexity": "https://api.perplexity.ai/chat/completions",
    "gemini": "https://generativelanguage.googleapis.com/v1beta/models/{model}:generateContent",
    "openai": "https://api.openai.com/v1/chat/completions",
    "anthropic": "https://api.anthropic.com/v1/messages",
}
SEARCH_URL = "https://www.google.com/search?q="
TEMPERATURE, MOST_TOKENS = 0.2, 2048


def request(engine: Column, prompt: Column, models: dict[str, str]) -> Column:
    """(url, body) of the request that asks an engine; nulls for an unknown one. Keys travel in headers, which the transport adds.

    ``models`` names each engine's model. One engine takes no temperature, one needs a bound on tokens.
    """
    said = F.array(F.struct(F.lit("user").alias("role"), prompt.alias("content"))).alias("messages")
    model = lambda e: F.lit(models.get(e, "")).alias("model")
    heat = F.lit(TEMPERATURE).alias("temperature")
    bodies = {
        "perplexity": F.struct(model("perplexity"), heat, said),
        "gemini": F.struct(F.array(F.struct(F.array(F.struct(prompt.alias("text"))).alias("parts"))).alias("contents")),
        "openai": F.struct(model("openai"), said),
        "anthropic": F.struct(model("anthropic"), F.lit(MOST_TOKENS).alias("max_tokens"), heat, said),
    }
    url = body = F.lit(None).cast("string")
    for e, b in bodies.items():
        url, body = F.when(engine == e, URLS[e].format(model=models.get(e, ""))).otherwise(url), F.when(engine == e, F.to_json(b)).otherwise(body)
    return F.struct(url.alias("url"), body.alias("body"))


def page_request(query: Column, zone: str) -> Column:
    """The body that asks for a page of search results."""
    return F.to_json(F.struct(F.lit(zone).alias("zone"), F.concat(F.lit(SEARCH_URL), quote_url(query)).alias("url"), F.lit("raw").alias("format")))


def http_error(engine: str, status: int, body: str) -> str:
    return f"{'QUOTA: ' if status == 429 else ''}{engine} HTTP {status}: {body[:DETAIL]}"


def parse(engine: str, status: int, body: str) -> Answer:
    """The 4-tuple of a response; any unexpected shape is an error, never an exception."""
    if status != 200:
        return False, "", [], http_error(engine, status, body)
    try:
        doc = value = json.loads(body)
        for step in TEXT_PATHS[engine]:
            value = value[step]
        if not isinstance(value, str):
            raise TypeError("text")
    except (ValueError, KeyError, IndexError, TypeError) as e:
        return False, "", [], f"{engine} unexpected response shape: {type(e).__name__}"
    cited = doc.get(CITATIONS.get(engine, ""), []) if isinstance(doc, dict) else []
    return True, value, [str(c) for c in cited] if isinstance(cited, list) else [], ""


def ask(engine: str, prompt: str, transport: Transport) -> Answer:
    try:
        return parse(engine, *transport(engine, prompt))
    except Exception as e:  # a connector never ends the run
        return False, "", [], f"{engine} request failed: {e}"


def fetch_page(query: str, transport: Transport, pause: Callable[[int], None] = lambda seconds: None) -> tuple[bool, str, str]:
    """(ok, html, error); exceptions and very short pages are tried again, with pauses of 3 and 6 seconds."""
    html = ""
    for attempt in range(PAGE_ATTEMPTS):
        last = attempt == PAGE_ATTEMPTS - 1
        try:
            status, html = transport("google_serp", query)
        except Exception as e:
            if last:
                return False, "", f"page request failed: {e}"
        else:
            if status != 200:
                return False, "", http_error("page", status, html)
            if len(html) >= LEAST_PAGE or last:
                break
        pause(3 * (attempt + 1))
    return True, html, ""


#: Connectors by engine; adding an entry (and its text path) adds an engine.
REGISTRY: dict[str, Callable[[str, Transport], Answer]] = {e: (lambda prompt, transport, e=e: ask(e, prompt, transport)) for e in ENGINES}

ANSWER_SCHEMA = "ok boolean, answer string, sources_cited array<string>, error string"


def collect(prompts: DataFrame, transport: Transport, engine_col: str = "engine", prompt_col: str = "prompt_text") -> DataFrame:
    """Adds ok, answer, sources_cited and error to each prompt, asking its engine."""
    schema = ", ".join(f"`{n}` {t}" for n, t in prompts.dtypes) + ", " + ANSWER_SCHEMA

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            found = [REGISTRY[e](q, transport) if e in REGISTRY else (False, "", [], f"{e} unknown engine") for e, q in zip(p[engine_col], p[prompt_col], strict=True)]
            yield p.assign(ok=[a[0] for a in found], answer=[a[1] for a in found], sources_cited=[a[2] for a in found], error=[a[3] for a in found])

    return prompts.mapInPandas(run, schema)


def replay(responses: DataFrame, engine_col: str = "engine", status_col: str = "status", body_col: str = "body") -> DataFrame:
    """Adds ok, answer, sources_cited and error to each stored response, as its engine's connector reads it."""
    schema = ", ".join(f"`{n}` {t}" for n, t in responses.dtypes) + ", " + ANSWER_SCHEMA

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            found = [parse(e, int(s), b or "") if e in REGISTRY else (False, "", [], f"{e} unknown engine") for e, s, b in zip(p[engine_col], p[status_col], p[body_col], strict=True)]
            yield p.assign(ok=[a[0] for a in found], answer=[a[1] for a in found], sources_cited=[a[2] for a in found], error=[a[3] for a in found])

    return responses.mapInPandas(run, schema)


def available(engines: DataFrame, configured: dict[str, str]) -> DataFrame:
    """Engines whose ``<ENGINE>_API_KEY`` is set and not blank."""
    have = [e for e in (k.removesuffix("_API_KEY").lower() for k, v in configured.items() if k.endswith("_API_KEY") and v.strip())]
    return engines.filter(F.col("engine").isin(have) if have else F.lit(False))
