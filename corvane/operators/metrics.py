"""Rates and counts that tell refusals and unknowns from negatives."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corvane.functions.text import domain_tokens, flat, parse_error
from corvane.sources.schema import OK


def rate(rows: DataFrame, by: list[str], status: str = "run_status", hit: str = "business_mentioned") -> DataFrame:
    """Share of hits among OK rows, beside the naive share of all rows."""
    good = F.col(status).eqNullSafe(OK)
    found = F.coalesce(F.col(hit), F.lit(False))
    counts = rows.groupBy(*by).agg(F.count("*").alias("n_rows"), F.count_if(good).alias("n_ok"), F.count_if(good & found).alias("n_hits"), F.count_if(found).alias("n_naive"))
    return counts.withColumns({"rate_pct": F.when(F.col("n_ok") > 0, F.bround(100.0 * F.col("n_hits") / F.col("n_ok"), 1)), "naive_pct": F.bround(100.0 * F.col("n_naive") / F.col("n_rows"), 1)})


def totals(rows: DataFrame) -> DataFrame:
    """Rows written, of these OK and not."""
    good = F.col("run_status").eqNullSafe(OK)
    return rows.agg(F.count("*").alias("written"), F.count_if(good).alias("ok"), F.count_if(~good).alias("failed"))


def failure_taxonomy(rows: DataFrame, note: str = "session_note", status: str = "run_status") -> DataFrame:
    """Refused and failed rows by status, engine and HTTP code of their note."""
    e = parse_error(F.col(note))
    return rows.filter(~F.col(status).eqNullSafe(OK)).groupBy(F.col(status).alias("status"), F.coalesce(e["engine"], F.lit("")).alias("engine"), F.coalesce(e["code"], F.lit(0).cast("long")).alias("code")).agg(F.count("*").alias("n"))


def flip_rate(rows: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """Beyond the observed corpus' own figures: share of consecutive runs whose known mentions differ, and whose answers are the same bytes."""
    w = Window.partitionBy(*key).orderBy(*order)
    seen = rows.withColumns({"__m": F.lag("business_mentioned").over(w), "__a": F.lag("answer_verbatim").over(w)}).filter("__m is not null and business_mentioned is not null")
    return seen.agg(F.count("*").alias("n_pairs"), F.count_if(F.col("__m") != F.col("business_mentioned")).alias("n_flips"), F.count_if(F.col("__a") == F.col("answer_verbatim")).alias("n_identical"))


def citation_spans(rows: DataFrame, key: str = "business", date: str = "date_utc", sources: str = "sources_cited") -> DataFrame:
    """Beyond the observed corpus' own figures: first and last date on which each source was cited."""
    cited = rows.select(key, F.to_date(date).alias("d"), F.explode(sources).alias("source"))
    return cited.groupBy(key, "source").agg(F.min("d").alias("first_date"), F.max("d").alias("last_date"), F.count("*").alias("n_cited")).withColumn("days", F.date_diff("last_date", "first_date"))


def rank_to_citation(pages: DataFrame, answers: DataFrame, by: list[str], keep: Sequence[str] = ()) -> DataFrame:
    """Beyond the observed corpus' own figures: each ranked result of a page, and how many answers to the same question name its domain.

    ``pages`` has ``organic_top_results``, ``answers`` has ``names``. Answers are
    counted by distinct squashed names of a question; a domain's names meet them
    by equality of the question, and are compared by containment.
    """
    ranked = pages.select(*by, *keep, F.posexplode("organic_top_results").alias("at", "url")).withColumns({"rank": F.col("at") + 1, "tokens": F.filter(domain_tokens(F.array("url")), lambda t: F.length(t) >= 5)})
    named = answers.select(*by, F.array_sort(F.array_distinct(F.transform("names", flat))).alias("names")).groupBy(*by, "names").agg(F.count("*").alias("n"))
    lists = named.groupBy(*by).agg(F.collect_list(F.struct("names", "n")).alias("lists"))
    hit = lambda x: F.exists(x["names"], lambda n: F.exists(F.col("tokens"), lambda t: F.contains(n, t)))
    found = F.aggregate(F.filter("lists", hit), F.lit(0).cast("long"), lambda acc, x: acc + x["n"])
    return ranked.join(lists, by, "left").select(*by, *keep, "rank", "url", F.coalesce(found, F.lit(0).cast("long")).alias("n_answers"))


def date_gaps(dates: DataFrame, date: str, step_days: int) -> DataFrame:
    """Dates that follow the one before by more than ``step_days``. Distinct days, some hundred a year, are ordered in one task."""
    seen = dates.select(F.col(date).cast("date").alias("day")).distinct()
    return seen.withColumn("before", F.lag("day").over(Window.orderBy("day"))).withColumn("gap_days", F.date_diff("day", "before").cast("long")).filter(F.col("gap_days") > step_days)
