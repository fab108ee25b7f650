"""Text functions as Column expressions; none runs Python."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Marks sentence starts; a control character that no text uses.
MARK = "\u0003"

# ---- fixed values: word lists and patterns that results depend on ----
STOP_WORDS = [
    "the", "a", "an", "this", "that", "these", "those", "there", "here", "it", "its", "he", "she", "they", "we", "you", "i", "if", "when",
    "while", "for", "and", "but", "or", "so", "because", "however", "several", "many", "most", "some", "both", "each", "every", "all",
    "based", "given", "considering", "depending", "according", "overall", "generally", "typically", "usually", "often", "note",
    "important", "best", "top", "other", "another", "first", "second", "third", "finally", "additionally", "furthermore", "moreover",
    "meanwhile", "therefore", "unfortunately", "fortunately", "ultimately", "although", "determining", "choosing", "finding", "looking",
    "using", "here's", "what", "which", "who", "how", "why", "where", "yes", "no", "do", "does", "did", "can", "should", "would", "will",
    "are", "is",
]
GENERIC_RUNS = [
    "ai", "seo", "aeo", "geo", "llm", "faq", "usa", "us", "uk", "google", "chatgpt", "perplexity", "gemini", "claude", "copilot", "grok",
    "google ai overview", "ai overview", "bing", "yandex", "january", "february", "march", "april", "may", "june", "july", "august",
    "september", "october", "november", "december", "monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday", "bbb",
    "better business bureau",
]
GENERIC_SPANS = [
    "small business", "small businesses", "ai", "seo", "aeo", "geo", "chatgpt", "perplexity", "gemini", "claude", "copilot",
    "google", "google ai overview", "bing", "experience", "reviews", "pricing", "cost", "free tier",
    "bbb accreditation", "bbb status", "bbb", "local address/phone", "aca subsidies", "licensed", "insured",
]
LABEL_STARTS = [
    "best", "lowest[- ]cost", "free", "broader", "cheapest", "top", "most", "ideal", "recommended", "why", "how", "what", "who", "when",
    "if", "want", "need", "note", "important", "summary", "bottom line", "key takeaway", "tip", "single", "ongoing", "practical", "choose",
    "consider", "avoid", "overall", "verdict",
]
LABEL_WHOLE = ["pros?", "cons?"]
CLAUSE_WORDS = ["are", "is", "was", "were", "they", "you", "your", "their", "its", "has", "have"]
CONNECTORS = ["of", "the", "and", "for", "de", "la"]
LEGAL_SUFFIXES = ["llc", "inc", "incorporated", "corp", "corporation", "co", "company", "ltd", "limited", "plc", "llp", "lp", "pllc", "pc", "gmbh"]
ARTICLES = ["the", "a", "an"]
REDACTED_PARAMS = ["key", "api_key", "apikey", "token"]
SENTENCE_START = r"(?Umd)(?<=[.!?:;])\s+|\n+|^\s*[-*•]\s*"
URL_HOST = r"https?://([^/]+)"
LAST_LABEL, SECOND_LEVEL, HOST_PARTS = r"\.[^.]*$", r"\.(co|com|org|net|gov|edu|ac)$", r"[.\-]"
DETAIL_CHARS, WORKER_CHARS, SHOWN_CHARS = 300, 500, 110
# ---- end of fixed values ----

_RUN_CHAR = r"[A-Za-z0-9&'’.\-]"
LABEL_PATTERN = "^(?:(?:" + "|".join(LABEL_STARTS) + r")\b|(?:" + "|".join(LABEL_WHOLE) + r")\b$)"


def strip_ws(c: Column) -> Column:
    """Without leading and trailing white space of any kind."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def or_empty(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def set_or_default(c: Column, default: str) -> Column:
    """The trimmed value, or the default for null and blank ones."""
    return F.coalesce(F.nullif(strip_ws(c), F.lit("")), F.lit(default))


def slugify(c: Column) -> Column:
    return F.btrim(F.regexp_replace(F.lower(or_empty(c)), "[^a-z0-9]+", "_"), F.lit("_"))


def flat(c: Column) -> Column:
    return F.regexp_replace(F.lower(c), "[^a-z0-9]+", "")


def canonical(c: Column) -> Column:
    """What identifies a company in its name; empty if nothing does."""
    s = F.regexp_replace(F.lower(or_empty(c)), "[‘’“”']", "")
    s = F.trim(F.regexp_replace(s, "[^a-z0-9]+", " "))
    s = F.regexp_replace(s, "^(?:(?:" + "|".join(ARTICLES) + ")(?: |$))+", "")
    s = F.regexp_replace(s, "(?:(?:^| )(?:" + "|".join(LEGAL_SUFFIXES) + "))+$", "")
    return F.trim(s)


def bold_spans(text: Column) -> Column:
    return F.regexp_extract_all(or_empty(text), F.lit(r"(?s)\*\*(.+?)\*\*"), F.lit(1))


def _words_in(low: Column, words: Sequence[str]) -> Column:
    return low.rlike(r"(?U)\b(?:" + "|".join(words) + r")\b")


def named_entities(text: Column, subject: Column | None = None, variants: Column | None = None) -> Column:
    """Bold spans that name an entity, in order, each once."""
    forms = _subject_forms(subject, variants, lambda s: F.lower(strip_ws(s)))

    def clean(raw: Column) -> Column:
        s = strip_ws(F.btrim(strip_ws(raw), F.lit(":;,.")))
        s = F.btrim(F.btrim(s, F.lit('"')), F.lit("'"))
        return strip_ws(F.regexp_replace(s, "[“”]", ""))

    def keep(s: Column) -> Column:
        low = F.lower(s)
        ok = F.length(s).between(3, 60) & (F.length(s) - F.length(F.replace(s, F.lit(" "), F.lit(""))) <= 6)
        ok = ok & ~s.endswith("?") & s.rlike(r"^\p{Lu}") & s.rlike("[A-Za-z]")
        ok = ok & ~low.contains(" or ") & ~low.contains(" and/or ") & ~_words_in(low, CLAUSE_WORDS)
        ok = ok & ~low.rlike("(?U)" + LABEL_PATTERN) & ~low.isin(GENERIC_SPANS)
        if forms is not None:
            ok = ok & ~F.array_contains(forms, low) & ~F.exists(forms, lambda f: (F.length(f) > 4) & F.contains(low, f))
        return ok

    return F.array_distinct(F.filter(F.transform(bold_spans(text), clean), keep))


def stated_criteria(text: Column) -> Column:
    """Bold spans that read like a clause, in order, each once."""
    spans = F.transform(bold_spans(text), lambda raw: strip_ws(F.btrim(strip_ws(raw), F.lit(":;,."))))
    keep = lambda s: (s != "") & (F.length(s) <= 80) & _words_in(F.lower(s), [*CLAUSE_WORDS, "whether"])
    return F.array_distinct(F.filter(spans, keep))


def _subject_forms(subject: Column | None, variants: Column | None, form) -> Column | None:
    if subject is None and variants is None:
        return None
    one = F.array(subject) if subject is not None else F.array().cast("array<string>")
    more = F.coalesce(variants, F.array().cast("array<string>")) if variants is not None else F.array().cast("array<string>")
    return F.array_distinct(F.transform(F.filter(F.concat(one, more), lambda s: s.isNotNull() & (s != "")), form))


def mark_sentences(text: Column) -> Column:
    """The text with a mark at every place where a sentence, line or list item begins."""
    return F.concat(F.lit(MARK), F.regexp_replace(text, SENTENCE_START, "$0" + MARK))


def capital_runs(text: Column) -> Column:
    """Array of (span, key, initial): runs of capitalised words, and whether a sentence begins with them."""
    space = rf"[\s{MARK}]+"
    word = f"[A-Z]{_RUN_CHAR}*"
    run = rf"(?U){MARK}?\b{word}(?:{space}(?:{'|'.join(CONNECTORS)}){space}{word}|{space}{word}){{0,5}}"
    runs = F.regexp_extract_all(mark_sentences(or_empty(text)), F.lit(run), F.lit(0))

    def parts(r: Column) -> Column:
        span = F.btrim(strip_ws(F.replace(r, F.lit(MARK), F.lit(""))), F.lit(".,;:"))
        return F.struct(span.alias("span"), F.lower(span).alias("key"), r.startswith(MARK).alias("initial"))

    return F.filter(F.transform(runs, parts), lambda r: r["span"] != "")


def domain_tokens(sources: Column) -> Column:
    """Name parts of the cited domains, sorted."""

    def of_url(u: Column) -> Column:
        host = F.replace(F.lower(F.regexp_extract(or_empty(u), URL_HOST, 1)), F.lit("www."), F.lit(""))
        core = F.regexp_replace(F.regexp_replace(host, LAST_LABEL, ""), SECOND_LEVEL, "")
        return F.filter(F.split(core, HOST_PARTS), lambda p: F.length(p) >= 4)

    return F.array_sort(F.array_distinct(F.flatten(F.transform(F.coalesce(sources, F.array().cast("array<string>")), of_url))))


def _first_at_least(items: Column, x: Column) -> Column:
    """Position of the first of sorted ``items`` that isn't smaller than ``x``, by binary search."""
    steps = F.sequence(F.lit(0), F.ceil(F.log2(F.size(items) + 1)).cast("int"))

    def halve(s: Column, _: Column) -> Column:
        mid = F.floor((s["low"] + s["high"]) / 2).cast("int")
        less = F.coalesce(F.get(items, mid) < x, F.lit(False)) & (s["low"] < s["high"])
        return F.struct(F.when(less, mid + 1).otherwise(s["low"]).alias("low"), F.when(less, s["high"]).otherwise(mid).alias("high"))

    return F.aggregate(steps, F.struct(F.lit(0).alias("low"), F.size(items).alias("high")), halve, lambda s: s["low"])


def entities_from_runs(runs: Column, subject: Column | None = None, variants: Column | None = None, sources: Column | None = None) -> Column:
    """Names among ``capital_runs``; give the runs as a column of their own, so that they are found once.

    What all runs are compared with is made once for each text and bound to a
    variable; keys are looked up in it by binary search, so that the time grows
    with the runs, times the logarithm of their number.
    """
    later = F.array_sort(F.transform(F.filter(runs, lambda r: ~r["initial"]), lambda r: r["key"]))
    none = F.array().cast("array<string>")
    domains = F.filter(domain_tokens(sources), lambda t: F.length(t) >= 5) if sources is not None else none
    forms = _subject_forms(subject, variants, flat)
    text = F.struct(runs.alias("runs"), later.alias("later"), domains.alias("domains"), (none if forms is None else forms).alias("forms"))

    def names(t: Column) -> Column:
        def keep(r: Column) -> Column:
            span, key, initial = r["span"], r["key"], r["initial"]
            words = F.split(key, r"(?U)\s+")
            first, n, f = words[0], F.size(words), flat(key)
            stop = first.isin(STOP_WORDS)
            ok = (f != "") & ~key.isin(GENERIC_RUNS) & ~((n == 1) & stop) & (F.length(span) >= 3) & (n <= 6)
            ok = ok & ~F.array_contains(t["forms"], f) & ~((F.length(f) > 4) & F.exists(t["forms"], lambda s: F.contains(s, f)))
            times = lambda k: F.coalesce(F.get(t["later"], _first_at_least(t["later"], key) + (k - 1)) == key, F.lit(False))
            acronym = ~span.rlike("[a-z]") & (F.length(span) <= 4)
            brand = (n == 1) & ~initial & ~acronym
            bars = ((n >= 2) & ~initial & ~stop) | (brand & (span.rlike("^[A-Z][a-z0-9]*[A-Z]") | span.rlike(r"[.\d]")))
            bars = bars | (initial & times(1)) | (brand & times(2)) | F.exists(t["domains"], lambda d: F.contains(f, d))
            return ok & bars

        return F.array_distinct(F.transform(F.filter(t["runs"], keep), lambda r: r["span"]))

    return F.get(F.transform(F.array(text), names), 0)


def mentioned(text: Column, names: Column) -> Column:
    """Whether the text holds any of the names, in any case; never null."""
    hit = F.exists(names, lambda n: n.isNotNull() & (n != "") & F.contains(F.lower(or_empty(text)), F.lower(n)))
    return F.coalesce(hit, F.lit(False)) & (or_empty(text) != "")


def redact(text: Column, secrets: dict[str, str] | None = None, template: str = "[REDACTED:%s]", least: int = 6, params: bool = True) -> Column:
    """Without the given secret values (name to value), nor the values of secret URL parameters."""
    out = or_empty(text)
    for name, value in (secrets or {}).items():
        if (value := value.strip()) and len(value) >= least:
            out = F.replace(out, F.lit(value), F.lit(template % name))
    if params:
        out = F.regexp_replace(out, r"""(?i)([?&](?:""" + "|".join(REDACTED_PARAMS) + r""")=)[^&\s"']+""", "$1[REDACTED]")
    return out


def redact_worker(text: Column, secrets: dict[str, str]) -> Column:
    return redact(text, secrets, "[REDACTED_%s]", 1, params=False)


def error_text(engine: Column, code: Column, detail: Column) -> Column:
    """The note of a refused call; code 429 is a matter of quota."""
    return F.concat(F.when(code == 429, "QUOTA: ").otherwise(""), engine, F.lit(" HTTP "), code.cast("string"), F.lit(": "), F.left(or_empty(detail), F.lit(DETAIL_CHARS)))


def worker_text(answer: Column, error: Column, secrets: dict[str, str]) -> Column:
    """What a worker writes: its answer, or its error, without secrets and cut."""
    return F.when(error.isNull(), answer).otherwise(F.concat(F.lit("WORKER_FAILED: "), F.left(redact_worker(error, secrets), F.lit(WORKER_CHARS))))


def plan_line(cadence: Column, business: Column, reason: Column, signals: Column) -> Column:
    """A printed plan's lines for one subject; signals are cut."""
    shown = F.transform(signals, lambda s: F.concat(F.lit("\n         ! "), F.left(s, F.lit(SHOWN_CHARS))))
    name = F.concat(business, F.repeat(F.lit(" "), F.greatest(F.lit(0), 28 - F.length(business))))
    return F.concat(F.lit("["), F.rpad(F.upper(cadence), 4, " "), F.lit("] "), name, F.lit(" "), reason, F.array_join(shown, ""))


def utc_date(at: Column) -> Column:
    """The UTC day of a timestamp as text, whatever the session's zone."""
    return F.date_from_unix_date(F.floor(F.unix_seconds(at) / 86400).cast("int")).cast("string")


def parse_error(note: Column) -> Column:
    """(quota, engine, code) of such a note; nulls where it has another form."""
    pattern = r"(QUOTA: )?(\w+) HTTP (\d+)"
    part = lambda i: F.nullif(F.regexp_extract(note, pattern, i), F.lit(""))
    return F.struct((part(1).isNotNull() & part(3).isNotNull()).alias("quota"), part(2).alias("engine"), part(3).cast("long").alias("code"))


def tag_list(c: Column) -> Column:
    """A comma list as an array, trimmed, without empty items."""
    return F.filter(F.transform(F.split(or_empty(c), ","), strip_ws), lambda x: x != "")


def tri_state(c: Column) -> Column:
    """``true`` and ``false`` as booleans; anything else is unknown."""
    return F.when(c == "true", True).when(c == "false", False)
