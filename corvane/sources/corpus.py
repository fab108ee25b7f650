"""Scans and sinks of the corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .schema import INDEX, INDEX_ROW, OBSERVATION, ROSTER

_CORRUPT = "_corrupt_record"


def scan(spark: SparkSession, path: str, names: str = "*.json") -> tuple[DataFrame, DataFrame]:
    """(rows, corrupt): one JSON object per file whose name fits ``names``. Rows keep their ``file_name``; rows without a business are dropped.

    The schema is declared, so nothing is read to infer it; small files are
    bundled into partitions by the reader.
    """
    schema = T.StructType([*OBSERVATION.fields, T.StructField(_CORRUPT, T.StringType())])
    read = spark.read.schema(schema).option("multiLine", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _CORRUPT).option("pathGlobFilter", names)
    rows = read.json(path).withColumns({"file_path": F.col("_metadata.file_path"), "file_name": F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)})
    good = rows.filter(F.col(_CORRUPT).isNull() & (F.coalesce("business", F.lit("")) != "")).drop(_CORRUPT, "file_path")
    # the reader refuses queries on the corrupt column alone, so the filter names another one too
    bad = F.col(_CORRUPT).isNotNull() & (F.coalesce(F.length("check_id"), F.lit(0)) >= 0)
    return good, rows.filter(bad).select("file_name", "file_path", F.col(_CORRUPT).alias("content"))


def scan_compact(spark: SparkSession, path: str) -> DataFrame:
    """The corpus as ``compact`` wrote it: filters on date and channel prune folders, others reach the scan."""
    return spark.read.parquet(path)


def compact(rows: DataFrame, path: str) -> None:
    """Appends rows to a Parquet corpus, in folders by date and channel; existing files are never touched."""
    rows.withColumn("run_channel", F.coalesce("run_channel", F.lit("none"))).repartition("date_utc", "run_channel").write.mode("append").partitionBy("date_utc", "run_channel").parquet(path)


def write_json(rows: DataFrame, path: str) -> None:
    """Appends rows as JSON lines, UTF-8 unescaped, in folders by date."""
    rows.write.mode("append").option("ignoreNullFields", False).partitionBy("date_utc").json(path)


def roster(spark: SparkSession, path: str) -> DataFrame:
    doc = spark.read.schema(ROSTER).option("multiLine", True).json(path)
    return doc.select(F.explode("roster").alias("r")).select("r.*").filter(F.col("active").eqNullSafe(True))


def index_rows(spark: SparkSession, path: str) -> DataFrame:
    doc = spark.read.schema(INDEX).option("multiLine", True).json(path)
    return doc.select(F.explode("rows").alias("r")).select("r.*")


def append_index(rows: DataFrame, path: str, order: list[str]) -> None:
    """Appends rows to an index table, numbered on from the rows that it has, corrections not counted.

    One row is a question asked by hand, so a call appends few rows; they are
    numbered in one task.
    """
    spark = rows.sparkSession
    from corvane.operators.identifiers import index_id, next_index_id

    there = spark.read.schema(INDEX_ROW).json(path)
    n = next_index_id(there).first()["n_rows"]
    numbered = rows.withColumn("check_id", index_id(F.lit(n) + F.row_number().over(Window.orderBy(*order))))
    none = [F.lit(None).cast(f.dataType).alias(f.name) for f in INDEX_ROW.fields if f.name not in numbered.columns]
    numbered.select("*", *none).select(*INDEX_ROW.names).write.mode("append").option("ignoreNullFields", False).json(path)


def worker_outputs(spark: SparkSession, path: str) -> DataFrame:
    """One text per file, and what failed: file_path, file_name, text, failed, http_code."""
    text = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file_path"), F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1).alias("file_name"), F.col("value").alias("text"))
    return text.withColumns({"failed": F.col("text").startswith("WORKER_FAILED"), "http_code": F.nullif(F.regexp_extract("text", r"HTTP Error (\d+)", 1), F.lit("")).cast("long")})


def heartbeat(spark: SparkSession, path: str) -> DataFrame:
    """Dated lines of a log: at, message. Lines without a date are dropped."""
    lines = spark.read.text(path)
    day = F.regexp_extract("value", r"(\d{4}-\d{2}-\d{2})", 1)
    return lines.filter(day != "").select(F.try_to_date(day).alias("at"), F.trim(F.regexp_replace("value", r"^.*?\d{4}-\d{2}-\d{2}\S*", "")).alias("message"))
