"""Agreement between engines that answered one question: directional containment."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.functions.text import canonical, capital_runs, entities_from_runs
from corvane.sources.schema import OK

from .match import containment_pct, hits

# Fixed texts of the rows.
SUSPECT_NOTE = (
    "Zero shared entities while BOTH engines named several. That is more often an extraction defect than real disagreement. "
    "Do not publish this pair until the name lists above have been read."
)
METHOD_NOTE = (
    "Directional containment, NOT set overlap. Set overlap has a ceiling set by verbosity: if one engine names 27 companies and the other "
    "names 8, perfect agreement still caps Jaccard near 30 percent. Entities are extracted ORTHOGRAPHICALLY (capitalisation), not from "
    "bolding, because engines bold to their own taste. Matching is mechanical and reproducible; errors run toward under-counting "
    "agreement, so the true figure is more likely higher than reported than lower."
)


def usable(rows: DataFrame) -> DataFrame:
    return rows.filter((F.col("run_status") == OK) & (F.coalesce("answer_verbatim", F.lit("")) != ""))


def with_names(rows: DataFrame) -> DataFrame:
    """Adds ``names`` and their canonical forms, extracted once per row."""
    runs = rows.withColumn("__runs", capital_runs(F.col("answer_verbatim")))
    named = runs.withColumn("names", entities_from_runs(F.col("__runs"), F.col("business"), None, F.col("sources_cited"))).drop("__runs")
    return named.withColumn("canonical_names", F.transform("names", canonical))


def pairs(rows: DataFrame, by: list[str], order: str) -> DataFrame:
    """One row for each two usable answers of different engines in a group, the earlier first.

    Names are extracted once per answer, before answers of a group meet by an
    equality join on ``by``. Pairs are emitted one by one, so neither a group nor
    its pairs are gathered in a row, and a large group can be split.
    """
    fields = [order, "engine", "business_mentioned", "names", "canonical_names", F.length("answer_verbatim").cast("long").alias("chars")]
    named = with_names(usable(rows)).select(*by, F.struct(*fields).alias("r"))
    # both sides are made alike, so that one exchange, and one extraction, serves both
    a, b = (named.select(*[F.col(c).alias(f"__{x}_{c}") for c in by], F.col("r").alias(x)) for x in "ab")
    same = reduce(and_, [F.col(f"__a_{c}").eqNullSafe(F.col(f"__b_{c}")) for c in by])
    met = a.join(b, same & (F.col("a") < F.col("b")) & ~F.col("a.engine").eqNullSafe(F.col("b.engine")))
    return met.select(*[F.col(f"__a_{c}").alias(c) for c in by], "a", "b")


def scored(found: DataFrame) -> DataFrame:
    """Adds the terser answer (fewer names, on ties the first), the other one, and how many names they share.

    Columns of their own, so that the names are compared once for all the fields that depend on it.
    """
    first = F.size("a.names") <= F.size("b.names")
    sided = found.withColumns({"terser": F.when(first, F.col("a")).otherwise(F.col("b")), "verbose": F.when(first, F.col("b")).otherwise(F.col("a"))})
    return sided.withColumn("shared", hits(F.col("terser.canonical_names"), F.col("verbose.canonical_names")))


def pair_fields() -> dict[str, Column]:
    """The fields of a scored pair."""
    a, b, terser, verbose, shared = (F.col(c) for c in ("a", "b", "terser", "verbose", "shared"))
    n_t, n_v = F.size(terser["names"]).cast("long"), F.size(verbose["names"]).cast("long")
    suspect = (shared == 0) & (n_t > 0) & (n_v > 0)
    named = [F.coalesce(x["business_mentioned"], F.lit(False)) for x in (a, b)]
    return {
        "terser_names": terser["names"],
        "verbose_names": verbose["names"],
        "extraction_suspect": suspect,
        "suspect_note": F.when(suspect, SUSPECT_NOTE).otherwise(""),
        "engine_a": a["engine"],
        "engine_b": b["engine"],
        "named_by_a": named[0],
        "named_by_b": named[1],
        "naming_disagreement": named[0] != named[1],
        "terser_engine": terser["engine"],
        "terser_entity_count": n_t,
        "verbose_entity_count": n_v,
        "containment_pct": containment_pct(shared, n_t),
        "shared_count": shared,
        "answer_chars_a": a["chars"],
        "answer_chars_b": b["chars"],
        "zero_shared": (shared == 0) & (n_t > 0),
    }


def pair_agreement(rows: DataFrame, by: list[str], order: str) -> DataFrame:
    fields = [c.alias(n) for n, c in pair_fields().items()]
    return scored(pairs(rows, by, order)).select(*by, F.col("a")[order].alias("order_a"), F.col("b")[order].alias("order_b"), *fields)


def agreement_rows(rows: DataFrame, by: list[str], order: str, prompt: str | None = None, check_id: Column | None = None) -> DataFrame:
    """A row per group with its engines, number of usable answers and array of pairs, in order.

    ``prompt`` names the column of the question, the same in a group; ``check_id``
    makes the row's first identifier of the columns ``by``.
    """
    found = scored(pairs(rows, by, order)).select(*by, F.struct(F.col("a")[order].alias("i"), F.col("b")[order].alias("j"), F.struct(*[c.alias(n) for n, c in pair_fields().items()]).alias("pair")).alias("p"))
    listed = found.groupBy(*by).agg(F.transform(F.array_sort(F.collect_list("p")), lambda p: p["pair"]).alias("pairs"))
    asked = [F.min(prompt).alias("prompt_text")] if prompt else []
    groups = usable(rows).groupBy(*by).agg(F.array_sort(F.collect_set("engine")).alias("engines_compared"), F.count("*").alias("engines_usable"), *asked)
    out = groups.join(listed, by, "left").withColumns({"pairs": F.coalesce("pairs", F.array().cast(listed.schema["pairs"].dataType)), "row_type": F.lit("agreement"), "method_note": F.lit(METHOD_NOTE)})
    return out if check_id is None else out.withColumn("check_id", check_id)
