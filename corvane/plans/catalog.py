"""Every registered query of the core engine, with its SQL oracle.

Queries run over whole driver tables; where a table lacks what an operator works
on (names with legal suffixes, error notes, result pages), it is derived from the
table's columns in the query and in the oracle alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.functions import text as tx
from corvane.functions import web
from corvane.operators import agreement, cadence, identifiers, match, metrics
from corvane.sources import connectors, corpus
from corvane.sources.schema import ENGINES
from corvane.sources.shared import shared_path
from corvane.streaming import ingest

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return register


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def joined(c) -> Column:
    return F.array_join(c, "|")


# ---- SQL fragments shared by oracles ----
CANON = (
    r"trim(regexp_replace(regexp_replace(trim(regexp_replace(regexp_replace(lower({0}), '[‘’“”'']', '', 'g'), '[^a-z0-9]+', ' ', 'g')),"
    r" '^(?:(?:the|a|an)(?: |$))+', ''), '(?:(?:^| )(?:" + "|".join(tx.LEGAL_SUFFIXES) + r"))+$', ''))"
)
SAME = (
    "({0} <> '' AND {1} <> '' AND ({0} = {1} OR (least(length({0}), length({1})) >= 6 AND "
    "CASE WHEN length({0}) <= length({1}) THEN contains(' ' || {1} || ' ', ' ' || {0} || ' ') ELSE contains(' ' || {0} || ' ', ' ' || {1} || ' ') END)))"
)


def sql_list(words) -> str:
    return "(" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + ")"


def _not_word(words) -> str:
    return r"(?:^|[^\p{L}\p{N}_])(?:" + "|".join(words) + r")(?:[^\p{L}\p{N}_]|$)"


def _distinct(items: str) -> str:
    """Distinct items of a list in the order of their first place."""
    return f"list_filter({items}, lambda x, i: list_position({items}, x) = i)"


_STRIP = r"regexp_replace({0}, '^\s+|\s+$', '', 'g')"

def _runs_sql(text: str) -> str:
    """Runs of capitalised words of a text, each with the character before it (CHAR_3 where a sentence begins)."""
    marked = rf"(chr(3) || regexp_replace({text}, '(?m)[.!?:;]\s+|\n+|^\s*[-*•]\s*', '\0' || chr(3), 'g'))"
    word, space = r"[A-Z][A-Za-z0-9&''’.\-]*", r"[\s\x03]+"
    run = rf"((?:^|[^\p{{L}}\p{{N}}_]){word}(?:{space}(?:of|the|and|for|de|la){space}{word}|{space}{word}){{0,5}})"
    return f"regexp_extract_all({marked}, '{run}', 1)"


def runs_sql(text: str) -> str:
    return "list_filter(" + "list_transform(" + _runs_sql(text) + r", lambda r: {'initial': starts_with(r, chr(3)), 'span': trim(regexp_replace(replace(regexp_replace(r, '^[^A-Z]', ''), chr(3), ''), '^\s+|\s+$', '', 'g'), '.,;:')})" + ", lambda r: r.span <> '')"


def entities_sql(source: str, keys: str, domains: bool = False) -> str:
    """CTEs that end in ``entities(keys..., names)``: names of ``source(keys..., text, subject)``, with ``domains`` also of ``host``, a cited domain's name."""
    evidence = "OR (length(host) >= 5 AND contains(flat, host))" if domains else ""
    host = ", host" if domains else ""
    flat = "regexp_replace(lower({0}), '[^a-z0-9]+', '', 'g')"
    return rf"""
r0 AS (SELECT {keys}, subject{host}, {runs_sql("text")} AS runs FROM {source}),
r1 AS (SELECT {keys}, subject{host}, unnest(runs) AS r, unnest(range(len(runs))) AS i FROM r0),
r2 AS (SELECT {keys}, subject{host}, i, r.span AS span, lower(r.span) AS key, r.initial AS initial, {flat.format("r.span")} AS flat, {flat.format("subject")} AS flat_subject,
       len(regexp_extract_all(r.span, '\S+')) AS n, regexp_extract(lower(r.span), '^\S+') AS w FROM r1),
r3 AS (SELECT *, count(*) FILTER (WHERE NOT initial) OVER (PARTITION BY {keys}, key) AS later FROM r2),
r4 AS (SELECT {keys}, span, min(i) AS i FROM r3
  WHERE flat <> '' AND NOT (flat_subject <> '' AND (flat = flat_subject OR (length(flat) > 4 AND contains(flat_subject, flat))))
    AND key NOT IN {sql_list(tx.GENERIC_RUNS)} AND NOT (n = 1 AND w IN {sql_list(tx.STOP_WORDS)}) AND length(span) >= 3 AND n <= 6
    AND ((n >= 2 AND NOT initial AND w NOT IN {sql_list(tx.STOP_WORDS)}) OR (initial AND later > 0)
      OR (n = 1 AND NOT initial AND (regexp_matches(span, '^[A-Z][a-z0-9]*[A-Z]') OR regexp_matches(span, '[.\d]') OR later >= 2)
          AND NOT (NOT regexp_matches(span, '[a-z]') AND length(span) <= 4)) {evidence})
  GROUP BY {keys}, span),
r5 AS (SELECT {keys}, list(span ORDER BY i) AS names FROM r4 GROUP BY {keys}),
entities AS (SELECT {", ".join("s." + k.strip() for k in keys.split(","))}, coalesce(r5.names, []::VARCHAR[]) AS names FROM {source} s LEFT JOIN r5 USING ({keys}))"""


# ---- extraction from texts ----
@query(rf"""
WITH s AS (SELECT doc_id, list_transform(regexp_extract_all(text, '(?s)\*\*(.+?)\*\*', 1), lambda r:
  {_STRIP.format("regexp_replace(trim(trim(" + _STRIP.format("trim(" + _STRIP.format("r") + ", ':;,.')") + ", '\"'), ''''), '[“”]', '', 'g')")}) AS spans FROM documents),
k AS (SELECT doc_id, list_filter(spans, lambda s: length(s) BETWEEN 3 AND 60 AND length(s) - length(replace(s, ' ', '')) <= 6 AND NOT ends_with(s, '?')
  AND regexp_matches(s, '^\p{{Lu}}') AND regexp_matches(s, '[A-Za-z]') AND NOT contains(lower(s), ' or ') AND NOT contains(lower(s), ' and/or ')
  AND NOT regexp_matches(lower(s), '{_not_word(tx.CLAUSE_WORDS)}') AND NOT regexp_matches(lower(s), '{tx.LABEL_PATTERN}')
  AND lower(s) NOT IN {sql_list(tx.GENERIC_SPANS)}) AS spans FROM s)
SELECT doc_id, len({_distinct("spans")})::BIGINT AS n_entities, array_to_string({_distinct("spans")}, '|') AS entities FROM k
""")
def bold_entities(spark, sf_dir):
    """Entities that documents name in bold."""
    found = read(spark, sf_dir, "documents").select("doc_id", tx.named_entities(F.col("text")).alias("e"))
    return found.select("doc_id", F.size("e").cast("long").alias("n_entities"), joined("e").alias("entities"))


@query(rf"""
WITH s AS (SELECT doc_id, list_transform(regexp_extract_all(text, '(?s)\*\*(.+?)\*\*', 1), lambda r: {_STRIP.format("trim(" + _STRIP.format("r") + ", ':;,.')")}) AS spans FROM documents),
k AS (SELECT doc_id, list_filter(spans, lambda s: s <> '' AND length(s) <= 80 AND regexp_matches(lower(s), '{_not_word([*tx.CLAUSE_WORDS, "whether"])}')) AS spans FROM s)
SELECT doc_id, array_to_string({_distinct("spans")}, '|') AS criteria FROM k
""")
def stated_criteria(spark, sf_dir):
    """Clauses that documents state in bold."""
    return read(spark, sf_dir, "documents").select("doc_id", joined(tx.stated_criteria(F.col("text"))).alias("criteria"))


@query(rf"""
SELECT doc_id, len(runs)::BIGINT AS n_runs, len(list_filter(runs, lambda r: r.initial))::BIGINT AS n_initial,
  array_to_string(list_transform(runs, lambda r: r.span), '|') AS spans
FROM (SELECT doc_id, {runs_sql("text")} AS runs FROM documents)
""")
def cap_runs(spark, sf_dir):
    """Runs of capitalised words, and how many begin sentences."""
    runs = read(spark, sf_dir, "documents").select("doc_id", tx.capital_runs(F.col("text")).alias("r"))
    return runs.select("doc_id", F.size("r").cast("long").alias("n_runs"), F.size(F.filter("r", lambda r: r["initial"])).cast("long").alias("n_initial"), joined(F.transform("r", lambda r: r["span"])).alias("spans"))


@query(f"""
WITH src AS (SELECT doc_id, text, source AS subject FROM documents), {entities_sql("src", "doc_id")}
SELECT doc_id, len(names)::BIGINT AS n_names, array_to_string(names, '|') AS names FROM entities
""")
def ortho_entities(spark, sf_dir):
    """Names found by capitalisation; the document's source plays the subject."""
    runs = read(spark, sf_dir, "documents").select("doc_id", "source", tx.capital_runs(F.col("text")).alias("runs"))
    found = runs.select("doc_id", tx.entities_from_runs(F.col("runs"), F.col("source")).alias("names"))
    return found.select("doc_id", F.size("names").cast("long").alias("n_names"), joined("names").alias("names"))


_CITED = r"regexp_extract(text, '[A-Z][a-z]{{4,}}')"


@query(f"""
WITH src AS (SELECT doc_id, text, source AS subject, lower({_CITED.format()}) AS host FROM documents), {entities_sql("src", "doc_id", domains=True)}
SELECT doc_id, len(names)::BIGINT AS n_names, array_to_string(names, '|') AS names FROM entities
""")
def ortho_entities_cited(spark, sf_dir):
    """Names found by capitalisation or by the domains of sources; each document cites a site named like its first long word."""
    site = F.concat(F.lit("https://www."), F.lower(F.regexp_extract("text", "[A-Z][a-z]{4,}", 0)), F.lit(".com/about?x=1"))
    runs = read(spark, sf_dir, "documents").select("doc_id", "source", F.array(site, F.lit("no url"), F.lit(None).cast("string")).alias("cited"), tx.capital_runs(F.col("text")).alias("runs"))
    found = runs.select("doc_id", tx.entities_from_runs(F.col("runs"), F.col("source"), None, F.col("cited")).alias("names"))
    return found.select("doc_id", F.size("names").cast("long").alias("n_names"), joined("names").alias("names"))


_NAMES = ["License", "THE", "que la", "zzz"]


@query(f"""
SELECT doc_id, text <> '' AND len(list_filter({_NAMES!r}, lambda n: contains(lower(text), lower(n)))) > 0 AS mentioned FROM documents
""")
def mentions(spark, sf_dir):
    """Documents that hold one of some names, in any case."""
    return read(spark, sf_dir, "documents").select("doc_id", tx.mentioned(F.col("text"), F.lit(_NAMES)).alias("mentioned"))


# ---- names ----
@query("""
SELECT 'p' || p_partkey AS id, trim(regexp_replace(lower(p_name || ' & ' || p_brand || '!'), '[^a-z0-9]+', '_', 'g'), '_') AS slug FROM part
UNION ALL SELECT 'c' || c_custkey, trim(regexp_replace(lower(c_name), '[^a-z0-9]+', '_', 'g'), '_') FROM customer
""")
def slugify_names(spark, sf_dir):
    """Slugs of part and customer names."""
    parts = read(spark, sf_dir, "part").select(F.concat(F.lit("p"), "p_partkey").alias("id"), F.concat_ws("", "p_name", F.lit(" & "), "p_brand", F.lit("!")).alias("n"))
    customers = read(spark, sf_dir, "customer").select(F.concat(F.lit("c"), "c_custkey").alias("id"), F.col("c_name").alias("n"))
    return parts.unionByName(customers).select("id", tx.slugify(F.col("n")).alias("slug"))


_DECORATED = "CASE p_partkey % 4 WHEN 0 THEN 'The ' || p_name || ', Inc.' WHEN 1 THEN p_name || '’s L.L.C' WHEN 2 THEN 'A ' || upper(p_name) || ' Co Ltd' ELSE p_name END"


def _decorated() -> Column:
    name, k = F.col("p_name"), F.col("p_partkey") % 4
    return F.when(k == 0, F.concat(F.lit("The "), name, F.lit(", Inc."))).when(k == 1, F.concat(name, F.lit("’s L.L.C"))).when(k == 2, F.concat(F.lit("A "), F.upper(name), F.lit(" Co Ltd"))).otherwise(name)


@query(f"SELECT p_partkey, {CANON.format('n')} AS canonical FROM (SELECT p_partkey, {_DECORATED} AS n FROM part)")
def canonical_names(spark, sf_dir):
    """Canonical forms of part names under company decorations."""
    return read(spark, sf_dir, "part").select("p_partkey", tx.canonical(_decorated()).alias("canonical"))


_VARIANTS = f"""a AS (SELECT DISTINCT {CANON.format("n")} AS ca, n AS name_a FROM (SELECT DISTINCT p_name || ' ' || p_type AS n FROM part)),
b AS (SELECT DISTINCT {CANON.format("n")} AS cb, n AS name_b FROM (SELECT DISTINCT 'The ' || p_name || CASE WHEN p_partkey % 2 = 0 THEN ' LLC' ELSE '' END AS n FROM part))"""


@query(f"WITH {_VARIANTS} SELECT name_a, name_b FROM a JOIN b ON {SAME.format('ca', 'cb')}")
def entity_match_join(spark, sf_dir):
    """Fuzzy join of two lists of names, by blocks of words."""
    part = read(spark, sf_dir, "part")
    a = part.select(F.concat_ws(" ", "p_name", "p_type").alias("name_a")).distinct()
    b = part.select(F.concat(F.lit("The "), "p_name", F.when(F.col("p_partkey") % 2 == 0, " LLC").otherwise("")).alias("name_b")).distinct()
    return match.entity_join(a, b, "name_a", "name_b", ["name_a"], ["name_b"])


# ---- agreement ----
def _answers(spark, sf_dir) -> DataFrame:
    c = read(spark, sf_dir, "conversations")
    return c.select("conv_id", "turn", F.col("role").alias("engine"), F.col("text").alias("answer_verbatim"), F.lit("Aichan").alias("business"), F.contains(F.lower("text"), F.lit("que")).alias("business_mentioned"), F.array().cast("array<string>").alias("sources_cited"), F.when(F.col("role") == "system", "FAILED").otherwise("OK").alias("run_status"))


_ANSWERS = f"""
WITH src AS (SELECT conv_id, turn, text, 'Aichan' AS subject FROM conversations WHERE role <> 'system' AND text <> ''),
{entities_sql("src", "conv_id, turn")},
named AS (SELECT e.conv_id, e.turn, c.role AS engine, contains(lower(c.text), 'que') AS named, e.names, length(c.text) AS chars,
  list_transform(e.names, lambda x: {CANON.format("x")}) AS canon FROM entities e JOIN conversations c USING (conv_id, turn)),
pairs AS (SELECT a.conv_id, a.turn AS turn_a, b.turn AS turn_b, a.engine AS engine_a, b.engine AS engine_b, a.named AS named_by_a, b.named AS named_by_b,
  a.chars AS chars_a, b.chars AS chars_b,
  CASE WHEN len(a.names) <= len(b.names) THEN a.engine ELSE b.engine END AS terser_engine,
  CASE WHEN len(a.names) <= len(b.names) THEN a.names ELSE b.names END AS tn, CASE WHEN len(a.names) <= len(b.names) THEN b.names ELSE a.names END AS vn,
  CASE WHEN len(a.names) <= len(b.names) THEN a.canon ELSE b.canon END AS tc, CASE WHEN len(a.names) <= len(b.names) THEN b.canon ELSE a.canon END AS vc
  FROM named a JOIN named b ON a.conv_id = b.conv_id AND a.turn < b.turn AND a.engine <> b.engine),
scored AS (SELECT *, len(list_filter(tc, lambda x: len(list_filter(vc, lambda y: {SAME.format("x", "y")})) > 0)) AS hits FROM pairs)
"""


@query(_ANSWERS + """
SELECT conv_id, turn_a, turn_b, terser_engine, len(tn)::BIGINT AS n_terser, hits::BIGINT AS shared_count,
  CASE WHEN len(tn) > 0 THEN round_even(100.0::DOUBLE * hits / len(tn), 1) END AS containment_pct FROM scored
""")
def containment_pct(spark, sf_dir):
    """Share of the terser answer's names that the other answer has too."""
    found = agreement.pair_agreement(_answers(spark, sf_dir), ["conv_id"], "turn")
    return found.select("conv_id", F.col("order_a").alias("turn_a"), F.col("order_b").alias("turn_b"), "terser_engine", F.col("terser_entity_count").alias("n_terser"), "shared_count", "containment_pct")


@query(_ANSWERS + f"""
SELECT conv_id, turn_a, turn_b, engine_a, engine_b, named_by_a, named_by_b, named_by_a <> named_by_b AS naming_disagreement, terser_engine,
  array_to_string(tn, '|') AS terser_names, array_to_string(vn, '|') AS verbose_names, len(tn)::BIGINT AS terser_entity_count, len(vn)::BIGINT AS verbose_entity_count,
  CASE WHEN len(tn) > 0 THEN round_even(100.0::DOUBLE * hits / len(tn), 1) END AS containment_pct, hits::BIGINT AS shared_count, chars_a::BIGINT AS answer_chars_a, chars_b::BIGINT AS answer_chars_b,
  hits = 0 AND len(tn) > 0 AS zero_shared, hits = 0 AND len(tn) > 0 AND len(vn) > 0 AS extraction_suspect,
  CASE WHEN hits = 0 AND len(tn) > 0 AND len(vn) > 0 THEN '{agreement.SUSPECT_NOTE}' ELSE '' END AS suspect_note FROM scored
""")
def pair_agreement(spark, sf_dir):
    """All fields of each pair of answers in a conversation; roles play the engines."""
    found = agreement.pair_agreement(_answers(spark, sf_dir), ["conv_id"], "turn").withColumnsRenamed({"order_a": "turn_a", "order_b": "turn_b"})
    return found.withColumns({"terser_names": joined("terser_names"), "verbose_names": joined("verbose_names")})


@query(_ANSWERS + f""",
p AS (SELECT conv_id, string_agg(engine_a || '>' || engine_b || ':' || hits || '/' || len(tn), ';' ORDER BY turn_a, turn_b) AS pairs FROM scored GROUP BY conv_id)
SELECT conv_id, 'NB-CZ-AGREE_2026-08-05_conv_' || conv_id AS check_id, 'agreement' AS row_type, 'what about ' || conv_id || '?' AS prompt_text, array_to_string(list_sort(list(DISTINCT engine)), '|') AS engines_compared,
  count(*)::BIGINT AS engines_usable, coalesce(any_value(pairs), '') AS pairs, '{agreement.METHOD_NOTE}' AS method_note
FROM named LEFT JOIN p USING (conv_id) GROUP BY conv_id
""")
def agreement_rows(spark, sf_dir):
    """One row per conversation with its engines and pairs, question and identifier."""
    answers = _answers(spark, sf_dir).withColumn("prompt_text", F.concat(F.lit("what about "), "conv_id", F.lit("?")))
    base = identifiers.agreement_base(F.lit("2026-08-05"), F.concat(F.lit("Conv. "), "conv_id"))
    rows = agreement.agreement_rows(answers, ["conv_id"], "turn", "prompt_text", base)
    pair = lambda p: F.concat(p["engine_a"], F.lit(">"), p["engine_b"], F.lit(":"), p["shared_count"].cast("string"), F.lit("/"), p["terser_entity_count"].cast("string"))
    return rows.select("conv_id", "check_id", "row_type", "prompt_text", joined("engines_compared").alias("engines_compared"), "engines_usable", F.array_join(F.transform("pairs", pair), ";").alias("pairs"), "method_note")


@query(f"""
WITH RECURSIVE src AS (SELECT conv_id, turn, text, 'Aichan' AS subject FROM conversations WHERE role <> 'system' AND text <> ''),
{entities_sql("src", "conv_id, turn")},
n AS (SELECT conv_id, turn, role, unnest(names) AS name, unnest(range(len(names))) AS i FROM entities JOIN conversations USING (conv_id, turn)),
c AS (SELECT conv_id, role, name, {CANON.format("name")} AS canon, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn, i) AS k FROM n WHERE {CANON.format("name")} <> ''),
a AS (SELECT * FROM c WHERE role = 'user'),
b AS (SELECT conv_id, list(name ORDER BY k) AS names, list(canon ORDER BY k) AS canons FROM c WHERE role = 'assistant' GROUP BY conv_id),
every AS (SELECT DISTINCT conv_id FROM src),
step AS (
  SELECT conv_id, 0::BIGINT AS k, []::VARCHAR[] AS shared, []::BIGINT[] AS used FROM every
  UNION ALL
  SELECT conv_id, k, CASE WHEN hit IS NULL THEN shared ELSE list_append(shared, name) END, CASE WHEN hit IS NULL THEN used ELSE list_append(used, hit) END
  FROM (SELECT s.conv_id, a.k, s.shared, s.used, a.name, list_filter(range(1, len(coalesce(b.canons, [])) + 1), lambda j: NOT list_contains(s.used, j) AND {SAME.format("a.canon", "b.canons[j]")})[1] AS hit
        FROM step s JOIN a ON a.conv_id = s.conv_id AND a.k = s.k + 1 LEFT JOIN b ON b.conv_id = s.conv_id)),
done AS (SELECT conv_id, arg_max(shared, k) AS shared, arg_max(used, k) AS used FROM step GROUP BY conv_id),
names_a AS (SELECT conv_id, list(name ORDER BY k) AS names FROM a GROUP BY conv_id)
SELECT d.conv_id, array_to_string(d.shared, '|') AS shared, array_to_string(list_filter(coalesce(names_a.names, []), lambda x: NOT list_contains(d.shared, x)), '|') AS only_a,
  array_to_string(list_filter(coalesce(b.names, []), lambda x, j: NOT list_contains(d.used, j)), '|') AS only_b
FROM done d LEFT JOIN names_a USING (conv_id) LEFT JOIN b USING (conv_id)
""")
def overlap_greedy(spark, sf_dir):
    """Names of each conversation's users and assistants, matched one to one."""
    named = agreement.with_names(agreement.usable(_answers(spark, sf_dir)))
    side = lambda role: F.flatten(F.transform(F.array_sort(F.collect_list(F.when(F.col("engine") == role, F.struct("turn", "names")))), lambda r: r["names"]))
    both = named.groupBy("conv_id").agg(side("user").alias("a"), side("assistant").alias("b"))
    o = both.select("conv_id", match.overlap(F.col("a"), F.col("b")).alias("o"))
    return o.select("conv_id", joined("o.shared").alias("shared"), joined("o.only_a").alias("only_a"), joined("o.only_b").alias("only_b"))


# ---- cadence ----
def _observations(spark, sf_dir) -> DataFrame:
    e = read(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("long")
    return e.select(
        F.col("user_id").cast("string").alias("business"),
        F.date_format("ts", "yyyy-MM-dd").alias("date_utc"),
        F.lpad(F.col("event_id").cast("string"), 12, "0").alias("file_name"),
        (F.col("value") > 20).alias("business_mentioned"),
        F.transform(F.sequence(F.lit(0).cast("long"), k % 7), lambda i: F.concat(F.lit("s"), ((k + i) % 5).cast("string"))).alias("sources_cited"),
        F.when(F.col("event_type") == "signup", F.array(F.lit("rival"))).when(F.col("event_type") == "error", F.array(F.lit("rival"), F.lit("other"))).otherwise(F.array().cast("array<string>")).alias("competitors_mentioned"),
        F.lit("OK").alias("run_status"),
        F.col("event_type").alias("engine"),
    )


_CADENCE = """
WITH o AS (SELECT user_id::VARCHAR AS business, strftime(ts, '%Y-%m-%d') AS date_utc, lpad(event_id::VARCHAR, 12, '0') AS file_name, value > 20 AS named,
  list_distinct(list_transform(range((props->>'$.k')::BIGINT % 7 + 1), lambda i: 's' || (((props->>'$.k')::BIGINT + i) % 5))) AS src,
  CASE event_type WHEN 'signup' THEN ['rival'] WHEN 'error' THEN ['rival', 'other'] ELSE []::VARCHAR[] END AS comp FROM events),
r AS (SELECT *, row_number() OVER (PARTITION BY business ORDER BY date_utc DESC, file_name DESC) AS k, count(*) OVER (PARTITION BY business) AS n FROM o),
t AS (SELECT c.business, c.n, c.date_utc AS latest_date, p.date_utc AS prev_date, c.named AND NOT p.named AS crossed, p.named AND NOT c.named AS lost,
  list_sort(list_filter(p.src, lambda x: NOT list_contains(c.src, x))) AS dropped, list_sort(list_filter(c.src, lambda x: NOT list_contains(p.src, x))) AS added,
  list_sort(list_filter(c.comp, lambda x: NOT list_contains(p.comp, x))) AS rivals, list_sort(list_filter(p.comp, lambda x: NOT list_contains(c.comp, x))) AS gone
  FROM r c LEFT JOIN r p ON p.business = c.business AND p.k = 2 WHERE c.k = 1)
"""


@query(_CADENCE + """
SELECT business, latest_date, CASE WHEN n < 2 THEN 'warm' WHEN NOT crossed AND NOT lost AND len(dropped) + len(added) + len(rivals) + len(gone) = 0 THEN 'cold'
  WHEN crossed OR lost OR len(rivals) + len(gone) > 0 OR len(dropped) + len(added) >= 5 THEN 'hot' ELSE 'warm' END AS cadence,
 CASE WHEN n < 2 THEN 'only ' || n || ' dated row(s); no baseline to compare against, so no buzz on ignorance'
  WHEN NOT crossed AND NOT lost AND len(dropped) + len(added) + len(rivals) + len(gone) = 0 THEN 'nothing moved; stay silent and save the spend'
  WHEN crossed OR lost THEN 'the business crossed the naming line, which is the event the whole instrument exists to catch'
  WHEN len(rivals) + len(gone) > 0 THEN 'the competitive set in the answer changed'
  WHEN len(dropped) + len(added) >= 5 THEN 'large source churn (' || (len(dropped) + len(added)) || ') suggests the answer is being rebuilt'
  ELSE 'small movement (' || (len(dropped) + len(added)) || ' source changes); normal cadence' END AS reason FROM t
""")
def cadence_plan(spark, sf_dir):
    """How soon to ask about each user again."""
    return cadence.plan(_observations(spark, sf_dir)).select("business", "latest_date", "cadence", "reason")


@query(_CADENCE + """
SELECT business, coalesce(prev_date, '') AS prev_date, CASE WHEN n < 2 THEN '' ELSE array_to_string(list_filter([
  CASE WHEN crossed THEN 'CROSSED TO NAMED: engine now names this business' END, CASE WHEN lost THEN 'LOST THE NAMING: engine named this business before and does not now' END,
  CASE WHEN len(dropped) > 0 THEN 'SOURCES DROPPED (' || len(dropped) || '): ' || array_to_string(dropped[1:3], ', ') END,
  CASE WHEN len(added) > 0 THEN 'NEW SOURCES (' || len(added) || '): ' || array_to_string(added[1:3], ', ') END,
  CASE WHEN len(rivals) > 0 THEN 'NEW COMPETITOR NAMED: ' || array_to_string(rivals[1:3], ', ') END,
  CASE WHEN len(gone) > 0 THEN 'COMPETITOR DROPPED OUT: ' || array_to_string(gone[1:3], ', ') END], lambda x: x IS NOT NULL), ' ## ') END AS signals FROM t
""")
def cadence_signals(spark, sf_dir):
    """What changed between the two latest events of each user."""
    found = cadence.plan(_observations(spark, sf_dir))
    return found.select("business", F.coalesce(F.get("compared", 0), F.lit("")).alias("prev_date"), F.array_join("signals", " ## ").alias("signals"))


@query("""
WITH o AS (SELECT user_id::VARCHAR AS business, event_type AS engine, strftime(ts, '%Y-%m-%d') AS date_utc, lpad(event_id::VARCHAR, 12, '0') AS file_name, value > 20 AS named FROM events),
r AS (SELECT *, row_number() OVER (PARTITION BY business, engine ORDER BY date_utc DESC, file_name DESC) AS k FROM o)
SELECT c.business, c.engine, c.date_utc AS latest_date, CASE WHEN p.named IS NULL THEN 'new' WHEN c.named AND NOT p.named THEN 'crossed' WHEN p.named AND NOT c.named THEN 'lost' ELSE 'same' END AS naming
FROM r c LEFT JOIN r p ON p.business = c.business AND p.engine = c.engine AND p.k = 2 WHERE c.k = 1
""")
def cadence_strict(spark, sf_dir):
    """Naming changes with each engine for itself."""
    found = cadence.plan(_observations(spark, sf_dir), strict=True)
    has = lambda t: F.exists("signals", lambda s: s.startswith(t))
    return found.select("business", "engine", "latest_date", F.when(F.col("compared").isNull(), "new").when(has("CROSSED"), "crossed").when(has("LOST"), "lost").otherwise("same").alias("naming"))


@query(_CADENCE + """
SELECT count(*)::BIGINT AS businesses, count_if(n >= 2 AND (crossed OR lost OR len(rivals) + len(gone) > 0 OR len(dropped) + len(added) >= 5))::BIGINT AS hot FROM t
""")
def cadence_tiers(spark, sf_dir):
    """How many subjects a plan has, and how many are hot."""
    return cadence.tier_counts(cadence.plan(_observations(spark, sf_dir)))


@query("""
WITH u AS (SELECT DISTINCT user_id::VARCHAR AS b, event_type AS t FROM events)
SELECT b || '/' || t AS id, '[' || rpad(CASE t WHEN 'signup' THEN 'HOT' ELSE 'WARM' END, 4, ' ') || '] ' || b || '-' || t || repeat(' ', greatest(0, 28 - length(b || '-' || t))::INT) || ' because ' || t
  || chr(10) || '         ! ' || left(repeat(t, 30), 110) || chr(10) || '         ! ' || t AS line FROM u
""")
def plan_lines(spark, sf_dir):
    """Printed lines of a plan: padded, signals cut."""
    u = read(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("b"), F.col("event_type").alias("t")).distinct()
    tier = F.when(F.col("t") == "signup", "hot").otherwise("warm")
    line = tx.plan_line(tier, F.concat_ws("-", "b", "t"), F.concat(F.lit("because "), "t"), F.array(F.repeat("t", F.lit(30)), F.col("t")))
    return u.select(F.concat_ws("/", "b", "t").alias("id"), line.alias("line"))


# ---- identifiers, rosters, statuses ----
@query("""
SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey, o_orderdate::DATE ORDER BY o_orderkey)::BIGINT AS run,
  'NB_' || o_custkey || '_' || strftime(o_orderdate, '%Y-%m-%d') || CASE WHEN row_number() OVER (PARTITION BY o_custkey, o_orderdate::DATE ORDER BY o_orderkey) = 1 THEN ''
  ELSE '_r' || row_number() OVER (PARTITION BY o_custkey, o_orderdate::DATE ORDER BY o_orderkey) END AS check_id FROM orders
""")
def run_index(spark, sf_dir):
    """Run numbers and identifiers of orders of one customer and day."""
    o = read(spark, sf_dir, "orders").withColumn("day", F.date_format("o_orderdate", "yyyy-MM-dd"))
    o = identifiers.run_index(o, ["o_custkey", "day"], ["o_orderkey"])
    return o.select("o_orderkey", "run", identifiers.suffixed(F.concat(F.lit("NB_"), "o_custkey", F.lit("_"), "day"), F.col("run")).alias("check_id"))


@query("""
WITH taken AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'F'),
new AS (SELECT o_orderkey, o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) + CASE WHEN o_custkey IN (SELECT o_custkey FROM taken) THEN 1 ELSE 0 END AS run FROM orders WHERE o_orderstatus <> 'F')
SELECT o_orderkey, run::BIGINT AS run, 'NB_' || o_custkey || CASE WHEN run = 1 THEN '' ELSE '_r' || run END AS check_id FROM new
""")
def run_index_existing(spark, sf_dir):
    """Identifiers for new rows beside those already taken."""
    o = read(spark, sf_dir, "orders").withColumn("base", F.concat(F.lit("NB_"), "o_custkey"))
    existing = o.filter("o_orderstatus = 'F'").select(F.col("base").alias("check_id")).distinct()
    return identifiers.assign_ids(o.filter("o_orderstatus <> 'F'"), existing, "base", ["o_orderkey"]).select("o_orderkey", "run", "check_id")


_DATE = "2026-08-05"


@query(f"""
WITH n AS (SELECT n_nationkey, n_name, row_number() OVER (ORDER BY n_nationkey) - 1 AS p, count(*) OVER () AS n FROM nation)
SELECT n_nationkey, n_name, ((p - {sum(map(ord, _DATE))} % n + n) % n)::BIGINT AS position FROM n
""")
def roster_rotation(spark, sf_dir):
    """The roster turned by the date."""
    return identifiers.rotate(read(spark, sf_dir, "nation"), ["n_nationkey"], F.lit(_DATE)).select("n_nationkey", "n_name", "position")


def _roster(spark, sf_dir) -> DataFrame:
    n = read(spark, sf_dir, "nation")
    return n.select(F.col("n_name").alias("business"), F.lit(None).cast("string").alias("niche"), F.when(F.col("n_regionkey") > 1, F.col("n_regionkey").cast("string")).alias("market"), F.lit(None).cast("string").alias("row_type"), F.concat(F.lit("who about "), "n_name").alias("prompt_1"), F.when(F.col("n_nationkey") % 5 == 0, None).otherwise(F.col("n_nationkey") % 2 == 0).alias("active"))


@query("""
SELECT 'NB-CZ-API_2026-08-05_' || trim(regexp_replace(lower(n_name), '[^a-z0-9]+', '_', 'g'), '_') || '_' || engine AS check_id, '2026-08-05' AS date_utc,
  n_name AS business, '' AS niche, CASE WHEN n_regionkey > 1 THEN n_regionkey::VARCHAR ELSE '' END AS market, 'business' AS row_type, 1::BIGINT AS prompt_variant, 1::BIGINT AS run,
  'who about ' || n_name AS prompt_text, engine, 'api' AS run_channel, 'v4' AS schema_version FROM nation CROSS JOIN (SELECT unnest(['perplexity', 'gemini', 'openai', 'anthropic']) AS engine)
WHERE n_nationkey % 5 <> 0 AND n_nationkey % 2 = 0
""")
def roster_engine_cross(spark, sf_dir):
    """The base rows of every active subject with every engine."""
    engines = spark.createDataFrame([(e,) for e in ENGINES], "engine string")
    asked = identifiers.probes(_roster(spark, sf_dir), engines)
    return asked.select(*identifiers.base_row(F.lit(_DATE), identifiers.engine_base(F.lit(_DATE), F.col("business"), F.col("engine")), F.col("engine")))


@query("""
WITH taken AS (SELECT o_custkey, count(*) AS k FROM orders WHERE o_orderstatus = 'F' GROUP BY o_custkey),
free AS (SELECT o_orderkey, o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS i FROM orders WHERE o_orderstatus <> 'F'),
-- of k rows that are taken every other number is, from the first
new AS (SELECT o_orderkey, o_custkey, CASE WHEN i < coalesce(k, 0) THEN 2 * i ELSE i + coalesce(k, 0) END AS n FROM free LEFT JOIN taken USING (o_custkey))
SELECT o_orderkey, 1::BIGINT AS run, 'NB-CZ-SERP_2026-08-05_customer_' || o_custkey || CASE WHEN n = 1 THEN '' ELSE '_r' || n END AS check_id FROM new
""")
def page_row_ids(spark, sf_dir):
    """Identifiers of result-page rows, gaps filled; their run number stays 1."""
    o = read(spark, sf_dir, "orders").withColumn("base", identifiers.page_base(F.lit(_DATE), F.concat(F.lit("Customer #"), "o_custkey")))
    done = identifiers.run_index(o.filter("o_orderstatus = 'F'"), ["base"], ["o_orderkey"])
    existing = done.select(identifiers.suffixed(F.col("base"), 2 * F.col("run") - 1).alias("check_id"))
    return identifiers.guard_ids(o.filter("o_orderstatus <> 'F'"), existing, "base", ["o_orderkey"]).select("o_orderkey", "run", "check_id")


@query("""
SELECT page_id, CASE WHEN page_id % 3 = 0 THEN 'FAILED' WHEN page_id % 2 = 0 THEN 'OK' ELSE 'EXTRACTION_FAILED' END AS page,
  CASE WHEN page_id % 3 > 0 THEN 'OK' WHEN page_id % 2 = 0 THEN 'QUOTA_BLOCKED' ELSE 'FAILED' END AS call FROM pages
""")
def row_statuses(spark, sf_dir):
    """Statuses of fetched pages and of calls: quota counts for calls alone."""
    p, even = read(spark, sf_dir, "pages"), F.col("page_id") % 2 == 0
    ok = F.when(F.col("page_id") % 3 > 0, True).when(even, False)  # false, or null
    links = F.when(even, F.array("url")).otherwise(F.array().cast("array<string>"))
    return p.select("page_id", identifiers.page_status(ok, links).alias("page"), identifiers.call_status(F.coalesce(ok, F.lit(False)), F.when(even, "QUOTA: x HTTP 429: no").otherwise("x HTTP 500: no")).alias("call"))


@query("SELECT lower(r_name) AS engine FROM region WHERE r_name IN ('ASIA', 'AFRICA')")
def engines_available(spark, sf_dir):
    """Engines whose key is set and not blank; regions play the engines."""
    engines = read(spark, sf_dir, "region").select(F.lower("r_name").alias("engine"))
    return connectors.available(engines, {"ASIA_API_KEY": "k", "AFRICA_API_KEY": " k ", "EUROPE_API_KEY": "  ", "AMERICA_KEY": "k", "NOBODY_API_KEY": "k"})


def _calls(spark, sf_dir) -> DataFrame:
    e, code = read(spark, sf_dir, "events"), F.element_at(F.lit([429, 500, 503, 400]), (F.col("event_id") % 4 + 1).cast("int"))
    engine = F.element_at(F.lit(["gemini", "openai", "perplexity"]), (F.col("user_id") % 3 + 1).cast("int"))
    error = F.when(F.col("event_type") == "error", tx.error_text(engine, code, F.col("props")))
    return e.select("event_id", error.alias("error"), F.concat(F.lit("error detail: "), error).alias("session_note"), identifiers.call_status(F.col("event_type") != "error", error).alias("run_status"), (F.col("value") > 20).alias("business_mentioned"), "event_type")


@query("""
WITH c AS (SELECT [429, 500, 503, 400][event_id % 4 + 1] AS code, ['gemini', 'openai', 'perplexity'][user_id % 3 + 1] AS engine FROM events WHERE event_type = 'error')
SELECT CASE WHEN code = 429 THEN 'QUOTA_BLOCKED' ELSE 'FAILED' END AS status, engine, code::BIGINT AS code, count(*)::BIGINT AS n FROM c GROUP BY ALL
""")
def failure_taxonomy(spark, sf_dir):
    """Failed calls by status, engine and code, read back from their notes."""
    return metrics.failure_taxonomy(_calls(spark, sf_dir))


@query("""
SELECT d.source, count(*)::BIGINT AS n_rows, count(l.doc_id)::BIGINT AS n_ok, count_if(l.toxic = 1)::BIGINT AS n_hits, count_if(l.toxic = 1)::BIGINT AS n_naive,
  CASE WHEN count(l.doc_id) > 0 THEN round_even(100.0::DOUBLE * count_if(l.toxic = 1) / count(l.doc_id), 1) END AS rate_pct, round_even(100.0::DOUBLE * count_if(l.toxic = 1) / count(*), 1) AS naive_pct
FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY d.source
""")
def status_aware_rate(spark, sf_dir):
    """Share of toxic documents among labelled ones, beside the share among all."""
    labels = read(spark, sf_dir, "labels").select("doc_id", (F.col("toxic") == 1).alias("business_mentioned"), F.lit("OK").alias("run_status"))
    rows = read(spark, sf_dir, "documents").select("doc_id", "source").join(labels, "doc_id", "left")
    return metrics.rate(rows, ["source"])


@query("SELECT count(*)::BIGINT AS written, count_if(event_type <> 'error')::BIGINT AS ok, count_if(event_type = 'error')::BIGINT AS failed FROM events")
def run_totals(spark, sf_dir):
    """Rows written by a run, and how many are OK."""
    return metrics.totals(_calls(spark, sf_dir))


@query("SELECT count(*)::BIGINT AS n_rows, 'NB-CZ-' || lpad((count(*) + 1)::VARCHAR, greatest(4, length((count(*) + 1)::VARCHAR))::INT, '0') AS next_id FROM orders WHERE o_orderpriority <> '5-LOW'")
def index_append_id(spark, sf_dir):
    """The identifier that the next index row gets; low-priority orders play the corrections."""
    ids = read(spark, sf_dir, "orders").select(F.concat(F.when(F.col("o_orderpriority") == "5-LOW", "NB-CZ-FIX-").otherwise("NB-CZ-"), F.col("o_orderkey").cast("string")).alias("check_id"))
    return identifiers.next_index_id(ids)


@query("""
WITH old AS (SELECT CASE WHEN n_nationkey % 6 = 5 THEN 'NB-CZ-FIX-' || n_nationkey ELSE 'NB-CZ-' || lpad((1 + n_nationkey - (n_nationkey + 1) // 6)::VARCHAR, 4, '0') END AS check_id, n_name AS engine, '' AS competitors, n_nationkey % 2 = 0 AS mentioned, 'old' AS note FROM nation),
n AS (SELECT count(*) AS n FROM old WHERE check_id NOT LIKE '%FIX%')
SELECT * FROM old UNION ALL
SELECT 'NB-CZ-' || lpad((n + row_number() OVER (ORDER BY r_regionkey))::VARCHAR, 4, '0'), r_name, r_name || '|x', CASE r_regionkey % 3 WHEN 0 THEN true WHEN 1 THEN false END, 'new' FROM region, n
""")
def index_append(spark, sf_dir):
    """Rows appended to an index that has corrections, and all of it read back."""
    n, r, path = read(spark, sf_dir, "nation"), read(spark, sf_dir, "region"), shared_path(spark, "index")
    number = 1 + F.col("n_nationkey") - F.floor((F.col("n_nationkey") + 1) / 6)
    old = F.when(F.col("n_nationkey") % 6 == 5, F.concat(F.lit("NB-CZ-FIX-"), "n_nationkey")).otherwise(identifiers.index_id(number))
    n.select(old.alias("check_id"), F.col("n_name").alias("engine"), (F.col("n_nationkey") % 2 == 0).alias("business_mentioned"), F.array().cast("array<string>").alias("competitors_mentioned"), F.lit("old").alias("note")).write.json(path)
    said = F.element_at(F.lit(["true", "false", "null"]), (F.col("r_regionkey") % 3 + 1).cast("int"))
    new = r.select("r_regionkey", F.col("r_name").alias("engine"), tx.tri_state(said).alias("business_mentioned"), tx.tag_list(F.concat(F.lit(" , "), "r_name", F.lit(",, x "))).alias("competitors_mentioned"), F.lit("new").alias("note"))
    corpus.append_index(new, path, ["r_regionkey"])
    rows = spark.read.schema("check_id string, engine string, business_mentioned boolean, competitors_mentioned array<string>, note string").json(path)
    return rows.select("check_id", "engine", joined("competitors_mentioned").alias("competitors"), F.col("business_mentioned").alias("mentioned"), "note")


@query("SELECT event_id, strftime(ts, '%Y-%m-%d') AS day FROM events")
def utc_days(spark, sf_dir):
    """The UTC day of each event."""
    return read(spark, sf_dir, "events").select("event_id", tx.utc_date(F.col("ts").cast("timestamp")).alias("day"))


@query("""
WITH d AS (SELECT DISTINCT ts::DATE AS d FROM events WHERE value > 330)
SELECT d::VARCHAR AS day, p::VARCHAR AS before, (d - p)::BIGINT AS gap_days FROM (SELECT d, lag(d) OVER (ORDER BY d) AS p FROM d) WHERE d - p > 1
""")
def heartbeat_gaps(spark, sf_dir):
    """Gaps between the days of a sparse heartbeat (an event of very high value is one)."""
    beats = read(spark, sf_dir, "events").filter("value > 330")
    gaps = metrics.date_gaps(beats, "ts", 1)
    return gaps.select(F.col("day").cast("string"), F.col("before").cast("string"), "gap_days")


@query(r"""
SELECT p_partkey, array_to_string(list_filter(list_transform(string_split(replace(p_name, ' ', ' , ,') || ', ' || p_brand, ','), lambda x: trim(x)), lambda x: x <> ''), '|') AS tags,
  CASE p_partkey % 3 WHEN 0 THEN true WHEN 1 THEN false END AS mentioned, CASE WHEN p_size > 25 THEN p_type ELSE 'none' END AS zone FROM part
""")
def tag_list_parse(spark, sf_dir):
    """Comma lists, tri-state choices and set-but-blank defaults of a command line."""
    p = read(spark, sf_dir, "part")
    raw = F.concat(F.replace("p_name", F.lit(" "), F.lit(" , ,")), F.lit(", "), "p_brand")
    choice = F.element_at(F.lit(["true", "false", "null"]), (F.col("p_partkey") % 3 + 1).cast("int"))
    zone = tx.set_or_default(F.when(F.col("p_size") > 25, F.concat(F.lit(" "), "p_type", F.lit("\t"))).otherwise("  "), "none")
    return p.select("p_partkey", joined(tx.tag_list(raw)).alias("tags"), tx.tri_state(choice).alias("mentioned"), zone.alias("zone"))


# ---- files, written to the shared folder and read back ----
def _files(rows: DataFrame, key: str, content: Column, what: str) -> str:
    """Writes a text file per row, below a folder of its key."""
    path = shared_path(rows.sparkSession, what)
    rows.select(key, content.alias("value")).write.partitionBy(key).option("lineSep", "\n").text(path)
    return path


@query("""
SELECT n_nationkey::BIGINT AS k, CASE WHEN n_nationkey % 7 = 3 THEN 'corrupt' ELSE 'row' END AS kind, CASE WHEN n_nationkey % 7 <> 3 THEN 'NB_' || n_nationkey END AS check_id, CASE WHEN n_nationkey % 7 <> 3 THEN n_name END AS business,
  CASE WHEN n_nationkey % 7 <> 3 THEN n_nationkey::BIGINT END AS run, CASE WHEN n_nationkey % 7 <> 3 AND n_nationkey % 2 = 0 THEN true END AS mentioned, CASE WHEN n_nationkey % 7 <> 3 THEN 'a|b' END AS sources
FROM nation WHERE n_nationkey % 7 = 3 OR n_nationkey % 5 > 1
""")
def corpus_scan(spark, sf_dir):
    """A corpus of one JSON object per file, corrupt files apart; rows without a business are dropped."""
    n, k = read(spark, sf_dir, "nation"), F.col("n_nationkey")
    row = F.struct(F.concat(F.lit("NB_"), k).alias("check_id"), F.when(k % 5 == 0, F.lit("")).when(k % 5 > 1, F.col("n_name")).alias("business"), k.alias("run"), F.when(k % 2 == 0, True).alias("business_mentioned"), F.lit(["a", "b"]).alias("sources_cited"), F.lit("x").alias("unknown_field"))
    content = F.when(k % 7 == 3, '{"check_id": "NB').otherwise(F.to_json(row, {"pretty": "true"}))
    rows, corrupt = corpus.scan(spark, _files(n, "n_nationkey", content, "corpus"), "*.txt")
    nothing = lambda t: F.lit(None).cast(t)
    good = rows.select(F.col("n_nationkey").cast("long").alias("k"), F.lit("row").alias("kind"), "check_id", "business", "run", F.col("business_mentioned").alias("mentioned"), joined("sources_cited").alias("sources"))
    bad = corrupt.select(F.regexp_extract("file_path", r"n_nationkey=(\d+)", 1).cast("long").alias("k"), F.lit("corrupt").alias("kind"), nothing("string").alias("check_id"), nothing("string").alias("business"), nothing("long").alias("run"), nothing("boolean").alias("mentioned"), nothing("string").alias("sources"))
    return good.unionByName(bad)


@query("""
SELECT n_name AS business, CASE WHEN n_regionkey > 1 THEN n_regionkey::VARCHAR END AS market, 'who about ' || n_name AS prompt_1 FROM nation WHERE n_nationkey % 5 <> 0 AND n_nationkey % 2 = 0
""")
def roster_scan(spark, sf_dir):
    """The active subjects of a roster document; unknown isn't active."""
    path = shared_path(spark, "roster")
    _roster(spark, sf_dir).agg(F.to_json(F.struct(F.collect_list(F.struct("*")).alias("roster"))).alias("value")).coalesce(1).write.text(path)
    return corpus.roster(spark, path).select("business", "market", "prompt_1")


@query("""
SELECT n_nationkey::BIGINT AS k, n_nationkey % 3 = 0 AS failed, CASE WHEN n_nationkey % 3 = 0 AND n_nationkey % 2 = 0 THEN (400 + n_nationkey)::BIGINT END AS http_code,
  CASE WHEN n_nationkey % 3 > 0 THEN 'answer of ' || n_name || chr(10) || 'k-1' WHEN n_nationkey % 2 = 0 THEN 'WORKER_FAILED: ' || left('HTTP Error ' || (400 + n_nationkey) || ': [REDACTED_A_KEY] ' || repeat('x', 600), 500)
    ELSE 'WORKER_FAILED: timed out' END AS text FROM nation
""")
def worker_outputs(spark, sf_dir):
    """Texts that workers left, one per file, and what failed; errors without secrets, and cut."""
    n, k = read(spark, sf_dir, "nation"), F.col("n_nationkey")
    error = F.when(k % 3 > 0, None).when(k % 2 == 0, F.concat(F.lit("HTTP Error "), 400 + k, F.lit(": k-1 "), F.repeat(F.lit("x"), F.lit(600)))).otherwise("timed out")
    path = _files(n, "n_nationkey", tx.worker_text(F.concat(F.lit("answer of "), "n_name", F.lit("\nk-1")), error, {"A_KEY": "k-1", "EMPTY_KEY": ""}), "jobs")
    found = corpus.worker_outputs(spark, path)
    return found.select(F.regexp_extract("file_path", r"n_nationkey=(\d+)", 1).cast("long").alias("k"), "failed", "http_code", F.rtrim(F.col("text"), F.lit("\n")).alias("text"))


@query("""
WITH d AS (SELECT DISTINCT ts::DATE AS d FROM events WHERE event_type = 'signup')
SELECT d::VARCHAR AS day, 'weekly re-check due: ' || strftime(d, '%d') AS message, coalesce((d - lag(d) OVER (ORDER BY d))::BIGINT, 0) AS since FROM d
""")
def heartbeat_log(spark, sf_dir):
    """A log of dated lines, others dropped, with the days since the line before."""
    days = read(spark, sf_dir, "events").filter("event_type = 'signup'").select(F.to_date("ts").alias("d")).distinct()
    lines = F.array(F.concat(F.col("d").cast("string"), F.lit(" weekly re-check due: "), F.date_format("d", "dd")), F.lit("no date here"), F.lit(""))
    days.select(F.explode(lines).alias("value")).write.text(path := shared_path(spark, "heartbeat"))
    beats = corpus.heartbeat(spark, path)
    gaps = metrics.date_gaps(beats, "at", 0)
    out = beats.join(gaps, beats["at"] == gaps["day"], "left")
    return out.select(F.col("at").cast("string").alias("day"), "message", F.coalesce("gap_days", F.lit(0)).cast("long").alias("since"))


@query(f"""
SELECT n_nationkey::BIGINT AS k, n_name AS business, CASE WHEN n_nationkey % 4 = 1 THEN '2026-08-01' ELSE '2026-08-0' || (5 + n_nationkey % 3) END AS date_utc, CASE WHEN n_nationkey % 4 = 1 THEN 'late' ELSE 'kept' END AS place FROM nation
UNION ALL SELECT -1, 'first', '2026-08-04', 'kept'
""")
def stream_ingest(spark, sf_dir):
    """Files taken in as a stream, twice; back-dated rows go to a table of their own."""
    n, k = read(spark, sf_dir, "nation"), F.col("n_nationkey")
    date = F.when(k % 4 == 1, "2026-08-01").otherwise(F.concat(F.lit("2026-08-0"), 5 + k % 3))
    rows = n.select(F.concat(F.lit("NB_"), k).alias("check_id"), date.alias("date_utc"), F.col("n_name").alias("business"), k.cast("long").alias("run"))
    source, out, late, mark = (shared_path(spark, f"stream-{x}") for x in ("in", "out", "late", "mark"))
    first = spark.createDataFrame([("NB_first", "2026-08-04", "first", -1)], "check_id string, date_utc string, business string, run long")
    ingest.append_batch(first, out)
    rows.write.json(source, lineSep="\n\n")
    for _ in range(2):
        ingest.ingest(spark, source, out, mark, late_path=late, multi_line=False)
    ingest.append_batch(rows.filter(k % 4 != 1), out)  # again
    kept = ingest.stored(spark, out).select(F.col("run").alias("k"), "business", "date_utc", F.lit("kept").alias("place"))
    return kept.unionByName(ingest.stored(spark, late).select(F.col("run").alias("k"), "business", "date_utc", F.lit("late").alias("place")))


# ---- connectors ----
_MODELS = {"perplexity": "m-1", "gemini": "m-2", "openai": "m-3", "anthropic": "m-4"}


@query(r"""
WITH c AS (SELECT conv_id, turn, ['perplexity', 'gemini', 'openai', 'anthropic', 'nobody'][(conv_id + turn) % 5 + 1] AS engine, replace(replace(text, chr(10), '\n'), '"', '\"') AS t FROM conversations)
SELECT conv_id, turn, CASE engine WHEN 'perplexity' THEN 'https://api.perplexity.ai/chat/completions' WHEN 'gemini' THEN 'https://generativelanguage.googleapis.com/v1beta/models/m-2:generateContent'
    WHEN 'openai' THEN 'https://api.openai.com/v1/chat/completions' WHEN 'anthropic' THEN 'https://api.anthropic.com/v1/messages' END AS url,
  CASE engine WHEN 'perplexity' THEN '{"model":"m-1","temperature":0.2,"messages":[{"role":"user","content":"' || t || '"}]}' WHEN 'gemini' THEN '{"contents":[{"parts":[{"text":"' || t || '"}]}]}'
    WHEN 'openai' THEN '{"model":"m-3","messages":[{"role":"user","content":"' || t || '"}]}'
    WHEN 'anthropic' THEN '{"model":"m-4","max_tokens":2048,"temperature":0.2,"messages":[{"role":"user","content":"' || t || '"}]}' END AS body FROM c
""")
def engine_requests(spark, sf_dir):
    """What each engine is sent; turns play the prompts."""
    c = read(spark, sf_dir, "conversations").withColumn("engine", F.element_at(F.lit([*ENGINES, "nobody"]), ((F.col("conv_id") + F.col("turn")) % 5 + 1).cast("int")))
    return c.select("conv_id", "turn", connectors.request(F.col("engine"), F.col("text"), _MODELS).alias("r")).select("conv_id", "turn", "r.*")


@query("""
WITH c AS (SELECT conv_id, turn, text, ['perplexity', 'gemini', 'openai', 'anthropic', 'nobody'][(conv_id + turn) % 5 + 1] AS engine, (conv_id * 7 + turn) % 6 AS v FROM conversations),
s AS (SELECT *, engine <> 'nobody' AND v IN (0, 1) AS ok FROM c)
SELECT conv_id, turn, ok, CASE WHEN ok THEN text ELSE '' END AS answer, CASE WHEN ok AND engine = 'perplexity' AND v = 0 THEN 'https://a.org/|b' ELSE '' END AS cited,
  CASE WHEN ok THEN '' WHEN engine = 'nobody' THEN 'nobody unknown engine' WHEN v = 2 THEN 'QUOTA: ' || engine || ' HTTP 429: ' || left(repeat(text, 2), 300) WHEN v = 3 THEN engine || ' HTTP 503: '
    ELSE engine || ' unexpected response shape' END AS error FROM s
""")
def engine_replies(spark, sf_dir):
    """Stored responses read as each engine's connector does: answers, citations, quota, errors and unexpected shapes."""
    c = read(spark, sf_dir, "conversations").withColumns({"engine": F.element_at(F.lit([*ENGINES, "nobody"]), ((F.col("conv_id") + F.col("turn")) % 5 + 1).cast("int")), "v": (F.col("conv_id") * 7 + F.col("turn")) % 6})
    text = F.col("text")
    choice = F.array(F.struct(F.struct(text.alias("content")).alias("message"))).alias("choices")
    body = F.when(F.col("engine") == "gemini", F.to_json(F.struct(F.array(F.struct(F.struct(F.array(F.struct(text.alias("text"))).alias("parts")).alias("content"))).alias("candidates"))))
    body = body.when(F.col("engine") == "anthropic", F.to_json(F.struct(F.array(F.struct(text.alias("text"))).alias("content"))))
    body = body.when(F.col("v") == 0, F.to_json(F.struct(choice, F.lit(["https://a.org/", "b"]).alias("citations")))).otherwise(F.to_json(F.struct(choice, F.lit("none").alias("citations"))))
    stored = F.when(F.col("v") < 2, body).when(F.col("v") == 2, F.repeat(text, F.lit(2))).when(F.col("v") == 4, '{"choices": []}').when(F.col("v") == 5, "[1")
    status = F.when(F.col("v") == 2, 429).when(F.col("v") == 3, 503).otherwise(200)
    found = connectors.replay(c.select("conv_id", "turn", "engine", status.alias("status"), stored.alias("body")))
    return found.select("conv_id", "turn", "ok", "answer", joined("sources_cited").alias("cited"), F.regexp_replace("error", "(unexpected response shape).*", "$1").alias("error"))


@query("SELECT page_id, '{\"zone\":\"z\",\"url\":\"https://www.google.com/search?q=' || replace(url_encode(url || ' é~*'), '%2F', '/') || '\",\"format\":\"raw\"}' AS body FROM pages")
def page_requests(spark, sf_dir):
    """What asks for a page of results: the query percent-encoded, slashes kept."""
    return read(spark, sf_dir, "pages").select("page_id", connectors.page_request(F.concat("url", F.lit(" é~*")), "z").alias("body"))


# ---- pages ----
_BASIC_SQL = "replace(replace(replace(replace(replace({0}, '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', ''''), '&amp;', '&')"


_LINKS = """CASE page_id % 5
  WHEN 0 THEN '<a href="/url?sa=t&amp;q=' || url_encode(url) || '&amp;ved=1">x</a> <a href=''https://www.google.com/x''>g</a> <a href="' || url || '">same</a><a href="https://Other.example/a/?cd=3&b=&k=v-1&ved=9#f">o</a><a href="https://other.example/a">again</a>'
  WHEN 1 THEN '<a href="/url?url=https://first.example/' || page_id || '&amp;usg=2">r</a><a href="https://support.google.com/' || page_id || '">s</a><div data-href="https://never.example/">d</div>'
  WHEN 2 THEN '<a href="ftp://a/b"><a href="https://schema.org/x">n</a><div data-href="' || url || '">d</div><div data-url=''https://w3.org/x''>w</div><p data-url="https://last.example/?ei=1&amp;q=2">'
  WHEN 3 THEN array_to_string(list_transform(range(14), lambda i: '<a href="https://h' || i % 12 || '.example/p/' || page_id || '">l</a>'), ' ')
  ELSE 'nothing ' || repeat('x', 2500) END"""
# hosts and paths that count as one, the tracking parameters, and what is skipped: written out in SQL
_ORGANIC = rf"""
WITH h AS (SELECT page_id, {_LINKS} AS html FROM pages),
t AS (SELECT page_id, html, {_BASIC_SQL.format("html")} AS t FROM h),
x AS (SELECT page_id, html, t,
  list_transform(regexp_extract_all(t, 'href=["''](?:https?://[^"''/]*google\.[^"''/]*)?/url\?([^"'']+)', 1), lambda q: url_decode(coalesce(nullif(regexp_extract(q, '(?:^|&)q=([^&]*)', 1), ''), regexp_extract(q, '(?:^|&)url=([^&]*)', 1)))) AS redirects,
  regexp_extract_all(t, 'href=["''](https?://[^"'']+)["'']', 1) AS direct, regexp_extract_all(t, 'data-(?:href|url)=["''](https?://[^"'']+)["'']', 1) AS data FROM t),
l AS (SELECT page_id, 1 AS pass, unnest(list_concat(redirects, direct)) AS u, unnest(range(len(redirects) + len(direct))) AS i FROM x UNION ALL SELECT page_id, 2, unnest(data), unnest(range(len(data))) FROM x),
c AS (SELECT page_id, pass, i, regexp_extract(u, '^(https?://[^/?#]+[^?#]*)', 1) || coalesce('?' || nullif(array_to_string(list_filter(string_split(regexp_extract(u, '\?([^#]*)', 1), '&'),
    lambda kv: regexp_matches(kv, '=.') AND NOT regexp_matches(kv, '^(?:sa|ved|usg|source|cd|cad|uact|opi|sca_esv|gs_lcp|ei|oq|sclient|bih|biw)=')), '&'), ''), '') AS u FROM l WHERE regexp_matches(u, '^https?://[^/?#]')),
k AS (SELECT *, lower(regexp_extract(u, '^https?://([^/?#]+)', 1)) || ' ' || rtrim(regexp_extract(u, '^https?://[^/?#]+([^?#]*)', 1), '/') AS same FROM c
  WHERE NOT regexp_matches(u, 'google\.|gstatic\.|googleusercontent\.|googleadservices\.|youtube\.com/redirect|accounts\.google|policies\.google|support\.google|webcache\.|schema\.org|w3\.org')),
f AS (SELECT page_id, u, i, row_number() OVER (PARTITION BY page_id, same ORDER BY i) AS nth FROM k WHERE pass = 1 OR page_id NOT IN (SELECT page_id FROM k WHERE pass = 1)),
o AS (SELECT page_id, list(u ORDER BY i)[1:10] AS links FROM f WHERE nth = 1 GROUP BY page_id)
"""


def _result_pages(spark, sf_dir) -> DataFrame:
    """Pages of result links made of each page's URL: redirects, repeated, skipped and tracked links, many, none, and last-resort ones."""
    sql = _LINKS.replace("list_transform(range(14), lambda i: ", "transform(sequence(0, 13), i -> ").replace("array_to_string(", "array_join(").replace("\'\'", "\\'")
    p = read(spark, sf_dir, "pages").withColumn("made", F.expr(sql))
    p = p.withColumn("unescaped", web.unescape(F.col("made")))
    return p.withColumn("links", web.organic_urls(F.col("unescaped")))


@query(_ORGANIC + rf"""
SELECT page_id, length(html)::BIGINT AS html_bytes, len(regexp_extract_all(t, 'href='))::BIGINT AS href_total, len(regexp_extract_all(t, 'href=["''][^"'']*?/url\?'))::BIGINT AS redirect_hrefs,
  contains(lower(t), 'before you continue') OR contains(lower(t), 'consent.google') AS looks_like_consent_wall, contains(lower(t), 'unusual traffic') OR contains(lower(t), 'recaptcha') AS looks_like_captcha,
  o.links IS NOT NULL AS extraction_ok, CASE WHEN o.links IS NOT NULL THEN NULL WHEN length(html) < 2000 THEN 'empty response' ELSE 'no parsable result links found in a non-empty page' END AS zero_reason
FROM t LEFT JOIN o USING (page_id)
""")
def page_diagnostics(spark, sf_dir):
    """Why result pages gave what they gave."""
    p = _result_pages(spark, sf_dir)
    return p.select("page_id", web.diagnostics(F.col("made"), F.col("unescaped"), F.col("links")).alias("d")).select("page_id", "d.*")


@query(rf"""
WITH p AS (SELECT page_id, html, {_BASIC_SQL.format("html")} AS t FROM pages)
SELECT page_id, length(html)::BIGINT AS html_bytes, len(regexp_extract_all(t, 'href='))::BIGINT AS href_total, len(regexp_extract_all(t, 'href=["''][^"'']*?/url\?'))::BIGINT AS redirect_hrefs,
  contains(lower(t), 'before you continue') OR contains(lower(t), 'consent.google') AS looks_like_consent_wall, contains(lower(t), 'unusual traffic') OR contains(lower(t), 'recaptcha') AS looks_like_captcha,
  CASE WHEN length(html) < 2000 THEN 'empty response' ELSE 'no parsable result links found in a non-empty page' END AS zero_reason FROM p
""")
def page_diagnostics_raw(spark, sf_dir):
    """The same of pages as they are, which aren't result pages and give no links."""
    p = read(spark, sf_dir, "pages").withColumn("t", web.unescape_basic(F.col("html")))
    return p.select("page_id", web.diagnostics(F.col("html"), F.col("t"), F.array().cast("array<string>")).alias("d")).select("page_id", "d.*").drop("extraction_ok")


_OVERVIEW = "CASE page_id % 5 WHEN 0 THEN html || ' AI Overview' WHEN 1 THEN html || '<a href=\"/search?q=x\">' || repeat('x', 20000) WHEN 2 THEN '' ELSE html END"


@query(f"""
SELECT page_id, CASE WHEN h = '' THEN NULL WHEN contains(h, 'AI Overview') OR contains(h, 'AI overview') OR contains(h, 'aiOverview') OR contains(h, 'data-attrid="AIOverview"') THEN true
  WHEN contains(h, 'search?q=') AND length(h) > 20000 THEN false END AS overview FROM (SELECT page_id, {_OVERVIEW} AS h FROM pages)
""")
def overview_tristate(spark, sf_dir):
    """Whether pages show an overview: true, false or unknown."""
    p = read(spark, sf_dir, "pages").select("page_id", F.expr(_OVERVIEW.replace('\\"', '"')).alias("h"))
    return p.select("page_id", web.overview_detected(F.col("h")).alias("overview"))


@query(_ORGANIC + "SELECT page_id, len(coalesce(o.links, []))::BIGINT AS n_links, array_to_string(coalesce(o.links, []), '|') AS links FROM t LEFT JOIN o USING (page_id)")
def organic_urls(spark, sf_dir):
    """Result links of pages made of each page's URL."""
    return _result_pages(spark, sf_dir).select("page_id", F.size("links").cast("long").alias("n_links"), joined("links").alias("links"))


@query("SELECT page_id, replace(url_encode(url || ' a+b~c*' || page_id), '%2F', '/') AS quoted FROM pages")
def quoted_urls(spark, sf_dir):
    """Percent-encoded texts, slashes and tildes kept."""
    return read(spark, sf_dir, "pages").select("page_id", web.quote_url(F.concat("url", F.lit(" a+b~c*"), F.col("page_id").cast("string"))).alias("quoted"))


@query(r"""
WITH h AS (SELECT page_id, replace(lower(regexp_extract(url, 'https?://([^/]+)', 1)), 'www.', '') AS host FROM pages),
c AS (SELECT page_id, regexp_replace(regexp_replace(host, '\.[^.]*$', ''), '\.(co|com|org|net|gov|edu|ac)$', '') AS core FROM h)
SELECT page_id, array_to_string(list_sort(list_distinct(list_filter(string_split_regex(core, '[.\-]'), lambda p: length(p) >= 4))), '|') AS tokens FROM c
""")
def domain_tokens(spark, sf_dir):
    """Name parts of each page's host."""
    return read(spark, sf_dir, "pages").select("page_id", joined(tx.domain_tokens(F.array("url"))).alias("tokens"))


@query(r"""
SELECT page_id, regexp_replace(replace(url || '?x=1&Key=abc' || page_id || '&token=t"&api_key=&k=sec-ret', 'sec-ret', '[REDACTED:DEMO_KEY]'), '([?&](?:key|api_key|apikey|token)=)[^&\s"'']+', '\1[REDACTED]', 'gi') AS safe FROM pages
""")
def redact_text(spark, sf_dir):
    """Secret values and parameters taken out of texts."""
    raw = F.concat("url", F.lit("?x=1&Key=abc"), F.col("page_id").cast("string"), F.lit('&token=t"&api_key=&k=sec-ret'))
    return read(spark, sf_dir, "pages").select("page_id", tx.redact(raw, {"DEMO_KEY": "sec-ret", "SHORT": "k"}).alias("safe"))


# ---- beyond the corpus' own figures ----
@query("""
WITH o AS (SELECT user_id, event_id, ts, value > 20 AS m, props AS a FROM events),
l AS (SELECT *, lag(m) OVER w AS pm, lag(a) OVER w AS pa FROM o WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT count(*)::BIGINT AS n_pairs, count_if(m <> pm)::BIGINT AS n_flips, count_if(a = pa)::BIGINT AS n_identical FROM l WHERE pm IS NOT NULL
""")
def flip_rate(spark, sf_dir):
    """How often consecutive observations differ, and how often they are the same bytes."""
    e = read(spark, sf_dir, "events").select("user_id", "ts", "event_id", (F.col("value") > 20).alias("business_mentioned"), F.col("props").alias("answer_verbatim"))
    return metrics.flip_rate(e, ["user_id"], ["ts", "event_id"])


@query("""
SELECT user_id::VARCHAR AS business, event_type AS source, min(ts::DATE)::VARCHAR AS first_date, max(ts::DATE)::VARCHAR AS last_date, count(*)::BIGINT AS n_cited, (max(ts::DATE) - min(ts::DATE))::INT AS days FROM events GROUP BY ALL
""")
def citation_spans(spark, sf_dir):
    """First and last day on which each source was cited."""
    e = read(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("business"), F.date_format("ts", "yyyy-MM-dd").alias("date_utc"), F.array("event_type").alias("sources_cited"))
    return metrics.citation_spans(e).withColumns({c: F.col(c).cast("string") for c in ("first_date", "last_date")})


@query(r"""
WITH p AS (SELECT page_id, page_id % 10 AS q, url, lower(regexp_extract(url, 'https?://([^/]+)', 1)) AS host FROM pages),
tok AS (SELECT page_id, q, url, list_filter(string_split_regex(regexp_replace(regexp_replace(replace(host, 'www.', ''), '\.[^.]*$', ''), '\.(co|com|org|net|gov|edu|ac)$', ''), '[.\-]'), lambda t: length(t) >= 5) AS tokens FROM p),
a AS (SELECT (page_id // 2) % 10 AS q, page_id, regexp_replace(lower(split_part(host, '.', 1) || ' & Sons'), '[^a-z0-9]+', '', 'g') AS name FROM p)
SELECT t.page_id, t.q, 1 AS rank, t.url, (SELECT count(*) FROM a WHERE a.q = t.q AND len(list_filter(t.tokens, lambda x: contains(a.name, x))) > 0)::BIGINT AS n_answers FROM tok t
""")
def rank_to_citation(spark, sf_dir):
    """Each ranked result, and how many answers to its question name its domain; pages play both."""
    p = read(spark, sf_dir, "pages")
    host = F.lower(F.regexp_extract("url", "https?://([^/]+)", 1))
    answers = p.select(F.floor(F.col("page_id") / 2).alias("h"), F.array(F.concat(F.substring_index(host, ".", 1), F.lit(" & Sons"))).alias("names")).select((F.col("h") % 10).alias("q"), "names")
    ranked = p.select((F.col("page_id") % 10).alias("q"), "page_id", F.array("url").alias("organic_top_results"))
    return metrics.rank_to_citation(ranked, answers, ["q"], ["page_id"])
