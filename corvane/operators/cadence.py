"""How soon each subject should be asked about again, from its two latest observations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvane.sources.schema import COLD, HOT, OK, WARM

# Messages, reasons, and the number of changes that counts as large.
LARGE_CHURN = 5
CROSSED = "CROSSED TO NAMED: engine now names this business"
LOST = "LOST THE NAMING: engine named this business before and does not now"
SOURCES_DROPPED, SOURCES_NEW = "SOURCES DROPPED", "NEW SOURCES"
RIVAL_NEW, RIVAL_GONE = "NEW COMPETITOR NAMED: ", "COMPETITOR DROPPED OUT: "
FEW_ROWS = ("only ", " dated row(s); no baseline to compare against, so no buzz on ignorance")
SILENT = "nothing moved; stay silent and save the spend"
CROSSING = "the business crossed the naming line, which is the event the whole instrument exists to catch"
RIVALS = "the competitive set in the answer changed"
REBUILT = ("large source churn (", ") suggests the answer is being rebuilt")
SMALL = ("small movement (", " source changes); normal cadence")


def _items(c: Column) -> Column:
    return F.array_distinct(F.filter(F.coalesce(c, F.array().cast("array<string>")), lambda x: x.isNotNull()))


def _first_three(c: Column) -> Column:
    return F.array_join(F.slice(F.array_sort(c), 1, 3), ", ")


def latest_two(rows: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """A row per key: the latest and the previous row as structs, and how many of these there are.

    As only the first two ranks are kept, each task drops all but two rows of a
    subject before the shuffle, however many rows a subject has.
    """
    fields = ["date_utc", *[c for c in order if c != "date_utc"], "business_mentioned", "sources_cited", "competitors_mentioned"]
    row = F.struct(*[F.coalesce(F.col(c), F.lit("")).alias(c) if c == "date_utc" else F.col(c) for c in fields])
    w = Window.partitionBy(*key).orderBy(*[F.col("r")[c].desc() for c in order])
    ranked = rows.select(*key, row.alias("r")).withColumn("rank", F.row_number().over(w)).filter("rank <= 2")
    pick = lambda k: F.max(F.when(F.col("rank") == k, F.col("r")))
    return ranked.groupBy(*key).agg(F.count("*").alias("n_rows"), pick(1).alias("curr"), pick(2).alias("prev"))


def compare(two: DataFrame) -> DataFrame:
    """Adds what changed between ``prev`` and ``curr``."""
    named = lambda r: F.coalesce(F.col(r)["business_mentioned"], F.lit(False))
    was, now = (_items(F.col(r)["sources_cited"]) for r in ("prev", "curr"))
    had, has = (_items(F.col(r)["competitors_mentioned"]) for r in ("prev", "curr"))
    return two.withColumns({
        "crossed": named("curr") & ~named("prev"),
        "lost": named("prev") & ~named("curr"),
        "sources_dropped": F.array_except(was, now),
        "sources_new": F.array_except(now, was),
        "competitors_new": F.array_except(has, had),
        "competitors_gone": F.array_except(had, has),
    })


def signals() -> Column:
    """The messages of what changed, in their fixed order."""
    some = lambda c: F.size(c) > 0
    counted = lambda text, c: F.when(some(c), F.concat(F.lit(text + " ("), F.size(c).cast("string"), F.lit("): "), _first_three(F.col(c))))
    return F.array_compact(F.array(
        F.when(F.col("crossed"), CROSSED),
        F.when(F.col("lost"), LOST),
        counted(SOURCES_DROPPED, "sources_dropped"),
        counted(SOURCES_NEW, "sources_new"),
        F.when(some("competitors_new"), F.concat(F.lit(RIVAL_NEW), _first_three(F.col("competitors_new")))),
        F.when(some("competitors_gone"), F.concat(F.lit(RIVAL_GONE), _first_three(F.col("competitors_gone")))),
    ))


def tier_counts(planned: DataFrame) -> DataFrame:
    """One row: subjects of a plan, and how many are hot."""
    return planned.agg(F.count("*").alias("businesses"), F.count_if(F.col("cadence") == HOT).alias("hot"))


def plan(rows: DataFrame, key: list[str] | None = None, order: list[str] | None = None, strict: bool = False) -> DataFrame:
    """The cadence of each subject, with its reason and signals.

    All statuses and engines form one sequence and an unknown mention counts as
    none; ``strict`` takes rows of status OK alone, each engine for itself, and
    lets only known mentions cross.
    """
    key, order = key or ["business"], order or ["date_utc", "file_name"]
    rows = rows.filter(F.coalesce(F.col(key[0]).cast("string"), F.lit("")) != "")
    if strict:
        rows, key = rows.filter(F.col("run_status") == OK), [*key, "engine"]
    out = compare(latest_two(rows, key, order))
    if strict:
        known = F.col("prev")["business_mentioned"].isNotNull() & F.col("curr")["business_mentioned"].isNotNull()
        out = out.withColumns({"crossed": F.col("crossed") & known, "lost": F.col("lost") & known})
    churn = F.size("sources_dropped") + F.size("sources_new")
    rivals = (F.size("competitors_new") > 0) | (F.size("competitors_gone") > 0)
    crossing, moved = F.col("crossed") | F.col("lost"), F.col("crossed") | F.col("lost") | rivals | (churn > 0)
    new = F.col("n_rows") < 2
    case = lambda *x: F.when(new, x[0]).when(~moved, x[1]).when(crossing, x[2]).when(rivals, x[3]).when(churn >= LARGE_CHURN, x[4]).otherwise(x[5])
    text = lambda around, n: F.concat(F.lit(around[0]), n.cast("string"), F.lit(around[1]))
    return out.select(
        *key,
        case(*map(F.lit, (WARM, COLD, HOT, HOT, HOT, WARM))).alias("cadence"),
        case(
            text(FEW_ROWS, F.col("n_rows")),
            F.lit(SILENT),
            F.lit(CROSSING),
            F.lit(RIVALS),
            text(REBUILT, churn),
            text(SMALL, churn),
        ).alias("reason"),
        F.when(new, F.array().cast("array<string>")).otherwise(signals()).alias("signals"),
        F.when(~new, F.array(F.col("prev")["date_utc"], F.col("curr")["date_utc"])).alias("compared"),
        F.col("curr")["date_utc"].alias("latest_date"),
    )
