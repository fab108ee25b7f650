"""Functions over result pages and URLs.

HTML unescaping and URL cleaning follow the standard library to the letter, so
those two run as Arrow-batched Python; everything else is Column expressions.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import or_empty

# ---- fixed values ----
SKIPPED = [
    "google.", "gstatic.", "googleusercontent.", "googleadservices.", "youtube.com/redirect", "accounts.google", "policies.google",
    "support.google", "webcache.", "schema.org", "w3.org",
]
TRACKING_PARAMS = ["sa", "ved", "usg", "source", "cd", "cad", "uact", "opi", "sca_esv", "gs_lcp", "ei", "oq", "sclient", "bih", "biw"]
OVERVIEW_MARKERS = ["AI Overview", "AI overview", "aiOverview", 'data-attrid="AIOverview"']
CONSENT = ["before you continue", "consent.google"]
CAPTCHA = ["unusual traffic", "recaptcha"]
LEAST_PAGE, RENDERED_PAGE = 2000, 20000
REDIRECT_HREF = r"""href=["'](?:https?://[^"'/]*google\.[^"'/]*)?/url\?([^"']+)"""
DIRECT_HREF = r"""href=["'](https?://[^"']+)["']"""
DATA_HREF = r"""data-(?:href|url)=["'](https?://[^"']+)["']"""
# ---- end of fixed values ----


@F.pandas_udf(T.StringType())
def unescape(pages: pd.Series) -> pd.Series:
    import html

    return pages.map(html.unescape, na_action="ignore")


def clean_url_value(url: str | None) -> str | None:
    """http(s) URL without fragment, tracking parameters and parameters without a value; null if it isn't one."""
    from urllib.parse import parse_qsl, urlencode, urlsplit, urlunsplit

    try:
        u = urlsplit(url or "")
        if u.scheme in ("http", "https") and u.netloc:
            query = urlencode([kv for kv in parse_qsl(u.query) if kv[0] not in TRACKING_PARAMS])
            return urlunsplit((u.scheme, u.netloc, u.path, query, ""))
    except ValueError:
        pass
    return None


def redirect_target(query: str) -> str | None:
    from urllib.parse import parse_qs

    found = parse_qs(query)
    return next((found[k][0] for k in ("q", "url") if found.get(k)), None)


def first_of_each(urls) -> list[str]:
    """The first URL of each host (in lower case) and path (without trailing slashes)."""
    from urllib.parse import urlsplit

    first = {}
    for u in urls:
        parts = urlsplit(u)
        first.setdefault((parts.netloc.lower(), parts.path.rstrip("/")), u)
    return list(first.values())


@F.pandas_udf(T.ArrayType(T.StringType()))
def clean_links(redirects: pd.Series, direct: pd.Series, data: pd.Series) -> pd.Series:
    """Cleaned URLs in order of the passes, each once; those of the last pass only where the others give none."""

    def one(r, d, x):
        usable = lambda urls: [c for u in urls if (c := clean_url_value(u)) and not any(s in c for s in SKIPPED)]
        found = usable(t for q in r if (t := redirect_target(q))) + usable(d)
        return first_of_each(found or usable(x))

    return pd.Series([one(*row) for row in zip(redirects, direct, data, strict=True)])


def organic_urls(page: Column, top_n: int = 10) -> Column:
    """Result links of a page, at most ``top_n``; ``page`` must be unescaped."""
    text = or_empty(page)
    every = lambda p: F.regexp_extract_all(text, F.lit(p), F.lit(1))
    return F.slice(clean_links(every(REDIRECT_HREF), every(DIRECT_HREF), every(DATA_HREF)), 1, top_n)


def quote_url(c: Column) -> Column:
    """Percent-encoded for a URL path: as query encoding, but spaces as %20 and slashes and tildes kept."""
    out = F.replace(F.url_encode(or_empty(c)), F.lit("+"), F.lit("%20"))
    for code, char in (("%2F", "/"), ("%7E", "~"), ("*", "%2A")):
        out = F.replace(out, F.lit(code), F.lit(char))
    return out


def unescape_basic(page: Column) -> Column:
    """The five basic entities alone, without Python."""
    out = or_empty(page)
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        out = F.replace(out, F.lit(entity), F.lit(char))
    return out


def diagnostics(html: Column, unescaped: Column, organic: Column) -> Column:
    """Why a page gave what it gave."""
    text, low = or_empty(unescaped), F.lower(or_empty(unescaped))
    has = lambda words: F.contains(low, F.lit(words[0])) | F.contains(low, F.lit(words[1]))
    ok = F.coalesce(F.size(organic) > 0, F.lit(False))
    reason = F.when(ok, None).when(F.length(or_empty(html)) < LEAST_PAGE, "empty response").otherwise("no parsable result links found in a non-empty page")
    return F.struct(
        F.length(or_empty(html)).cast("long").alias("html_bytes"),
        F.regexp_count(text, F.lit("href=")).cast("long").alias("href_total"),
        F.regexp_count(text, F.lit(r"""href=["'][^"']*?/url\?""")).cast("long").alias("redirect_hrefs"),
        has(CONSENT).alias("looks_like_consent_wall"),
        has(CAPTCHA).alias("looks_like_captcha"),
        ok.alias("extraction_ok"),
        reason.alias("zero_reason"),
    )


def overview_detected(html: Column) -> Column:
    """True, false, or null where it can't be told."""
    marked = F.lit(False)
    for m in OVERVIEW_MARKERS:
        marked = marked | F.contains(html, F.lit(m))
    return F.when(or_empty(html) == "", None).when(marked, True).when(F.contains(html, F.lit("search?q=")) & (F.length(html) > RENDERED_PAGE), False)
