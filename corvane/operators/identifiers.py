"""Run indices, row identifiers, rotation and the rows that a run is to write."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvane.functions.text import or_empty, slugify
from corvane.sources.schema import FAILED, OK, QUOTA_BLOCKED, EXTRACTION_FAILED, SCHEMA_VERSION


def suffixed(base: Column, n: Column) -> Column:
    """The bare identifier of the first run, ``_rN`` of later ones."""
    return F.when(n == 1, base).otherwise(F.concat(base, F.lit("_r"), n.cast("string")))


def run_index(rows: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """Adds ``run``: 1, 2, ... within each key, in the order of arrival."""
    return rows.withColumn("run", F.row_number().over(Window.partitionBy(*key).orderBy(*order)).cast("long"))


def assign_ids(new: DataFrame, existing: DataFrame, base: str, order: list[str]) -> DataFrame:
    """Adds ``run`` and ``check_id`` to new rows, never one that ``existing.check_id`` has; gaps are filled.

    The ``j``-th taken number ``t`` has ``t - 1 - j`` free ones before it, so the
    ``i``-th new row gets ``i`` plus how many taken numbers have fewer than ``i``
    free ones before them: a running count in one pass over each base's rows.
    """
    taken = existing.select(F.regexp_replace("check_id", r"_r\d+$", "").alias("__base"), F.coalesce(F.nullif(F.regexp_extract("check_id", r"_r(\d+)$", 1), F.lit("")).cast("long"), F.lit(1)).alias("__n")).distinct()
    free = F.col("__n") - F.row_number().over(Window.partitionBy("__base").orderBy("__n"))
    at = F.row_number().over(Window.partitionBy(base).orderBy(*order)).cast("long")
    arrived = new.select(F.col(base).cast("string").alias("__base"), at.alias("__at"), F.lit(0).alias("__taken"), F.struct(*[F.col(f"`{c}`") for c in new.columns]).alias("__row"))
    both = arrived.unionByName(taken.select("__base", free.alias("__at"), F.lit(1).alias("__taken")), allowMissingColumns=True)
    before = F.sum("__taken").over(Window.partitionBy("__base").orderBy("__at", "__taken").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    numbered = both.withColumn("run", F.col("__at") + before).filter("__taken = 0").select("__row.*", "run")
    return numbered.withColumn("check_id", suffixed(F.col(base), F.col("run")))


def guard_ids(new: DataFrame, existing: DataFrame, base: str, order: list[str]) -> DataFrame:
    """Adds ``check_id`` as ``assign_ids`` does; ``run`` stays 1, as result pages and agreement rows are not numbered by it."""
    return assign_ids(new, existing, base, order).withColumn("run", F.lit(1).cast("long"))


def engine_base(date: Column, business: Column, engine: Column) -> Column:
    """The first identifier of an engine's row."""
    return F.concat(F.lit("NB-CZ-API_"), date, F.lit("_"), slugify(business), F.lit("_"), engine)


def page_base(date: Column, business: Column) -> Column:
    return F.concat(F.lit("NB-CZ-SERP_"), date, F.lit("_"), slugify(business))


def agreement_base(date: Column, business: Column) -> Column:
    return F.concat(F.lit("NB-CZ-AGREE_"), date, F.lit("_"), slugify(business))


def rotation_offset(date: Column, n: Column) -> Column:
    """Sum of the date's character codes modulo n."""
    codes = F.transform(F.filter(F.split(date, ""), lambda c: c != ""), lambda c: F.ascii(c).cast("long"))
    return F.pmod(F.aggregate(codes, F.lit(0).cast("long"), lambda a, c: a + c), n)


def rotate(rows: DataFrame, order: list[str], date: Column) -> DataFrame:
    """Adds ``position``: rows in ``order``, turned by the date's offset.

    Ranks are taken in one task: a roster is a list of subjects that people keep,
    of some thousand rows, and doesn't grow with the observations.
    """
    w = Window.orderBy(*order)
    at = rows.withColumns({"__p": F.row_number().over(w).cast("long") - 1, "__n": F.count("*").over(Window.partitionBy())})
    return at.withColumn("position", F.pmod(F.col("__p") - rotation_offset(date, F.col("__n")), F.col("__n"))).drop("__p", "__n")


def active(roster: DataFrame) -> DataFrame:
    return roster.filter(F.col("active").eqNullSafe(True))


def probes(roster: DataFrame, engines: DataFrame) -> DataFrame:
    """Every active subject with every engine: two small dimension tables, whose product is the result. Spark chooses the side that travels by size."""
    return active(roster).crossJoin(engines)


def base_row(date: Column, check_id: Column, engine: Column, channel: str = "api", run: Column | None = None) -> list[Column]:
    """The fields of every new row: from the roster, with their defaults, and of the run."""
    return [
        check_id.alias("check_id"),
        date.alias("date_utc"),
        F.col("business"),
        F.coalesce("niche", F.lit("")).alias("niche"),
        F.coalesce("market", F.lit("")).alias("market"),
        F.coalesce("row_type", F.lit("business")).alias("row_type"),
        F.lit(1).cast("long").alias("prompt_variant"),
        (F.lit(1).cast("long") if run is None else run).alias("run"),
        F.col("prompt_1").alias("prompt_text"),
        engine.alias("engine"),
        F.lit(channel).alias("run_channel"),
        F.lit(SCHEMA_VERSION).alias("schema_version"),
    ]


def call_status(ok: Column, error: Column) -> Column:
    return F.when(ok, OK).when(or_empty(error).startswith("QUOTA: "), QUOTA_BLOCKED).otherwise(FAILED)


def page_status(ok: Column, organic: Column) -> Column:
    """A failed fetch, quota or not, is FAILED; a page without result links EXTRACTION_FAILED."""
    return F.when(~F.coalesce(ok, F.lit(False)), FAILED).when(F.size(organic) > 0, OK).otherwise(EXTRACTION_FAILED)


def index_id(n: Column) -> Column:
    """The identifier of the ``n``-th index row, of four digits at least."""
    digits = n.cast("string")
    return F.concat(F.lit("NB-CZ-"), F.when(F.length(digits) < 4, F.lpad(digits, 4, "0")).otherwise(digits))


def next_index_id(rows: DataFrame, id_col: str = "check_id") -> DataFrame:
    """One row: the number of index rows that aren't corrections, and the next identifier."""
    n = F.count_if(F.col(id_col).startswith("NB-CZ-") & ~F.contains(F.col(id_col), F.lit("FIX")))
    return rows.agg(n.alias("n_rows")).select("n_rows", index_id(F.col("n_rows") + 1).alias("next_id"))
