"""Incremental ingestion of the corpus, and cadence kept up to date per batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvane.operators import cadence
from corvane.sources.schema import OBSERVATION


#: What is kept: every field of an observation, and the file that it came from.
STORED = T.StructType([*OBSERVATION.fields, T.StructField("file_name", T.StringType())])


def stored(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(STORED).parquet(path)


def stream(spark: SparkSession, path: str, files_per_trigger: int = 10_000, multi_line: bool = True) -> DataFrame:
    """New files of a JSON corpus as a stream, with their names: an object per file, or without ``multi_line`` per line."""
    rows = spark.readStream.schema(OBSERVATION).option("multiLine", multi_line).option("pathGlobFilter", "*.json").option("maxFilesPerTrigger", files_per_trigger).json(path)
    return rows.withColumn("file_name", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)).filter(F.coalesce("business", F.lit("")) != "")


def append_batch(batch: DataFrame, path: str, reject_backdated: bool = True) -> DataFrame:
    """Appends the rows of a batch that the corpus lacks; returns what was rejected as back-dated.

    Idempotent: identifiers already present are left out, so a batch that is
    run again after a failure adds nothing twice. An identifier holds its date,
    so only stored rows of the batch's dates are looked through: the filter
    reaches the scan, and folders or row groups of other dates are not read.
    """
    spark = batch.sparkSession
    whole = spark.createDataFrame([], STORED).unionByName(batch, allowMissingColumns=True).select(*STORED.names)
    new = whole.dropDuplicates(["check_id"])
    rejected = new.limit(0)
    try:
        kept = stored(spark, path)
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
            raise
        kept = None
    if kept is not None:
        dates = [r[0] for r in new.select(F.coalesce("date_utc", F.lit(""))).distinct().collect()]  # days of one batch
        there = kept.filter(F.col("date_utc").isin(dates)) if dates else kept.limit(0)
        new = new.join(there.select("check_id"), "check_id", "left_anti")
        if reject_backdated:
            last = kept.agg(F.max("date_utc").cast("string").alias("last_date"))
            dated = new.crossJoin(F.broadcast(last))  # one row
            late = F.coalesce(F.col("date_utc") < F.col("last_date"), F.lit(False))
            rejected, new = dated.filter(late).drop("last_date"), dated.filter(~late).drop("last_date")
    new.withColumn("date_utc", F.coalesce("date_utc", F.lit(""))).write.mode("append").parquet(path)
    return rejected


def ingest(spark: SparkSession, source: str, path: str, checkpoint: str, reject_backdated: bool = True, late_path: str | None = None, multi_line: bool = True) -> None:
    """Takes in all files that are there and not yet seen, then stops.

    Back-dated rows go to ``late_path``, a folder for each batch, which a batch
    that is run again writes anew; without that path they are left out.
    """

    def take(batch: DataFrame, number: int) -> None:
        batch = batch.persist()
        late = append_batch(batch, path, reject_backdated)
        if late_path and not late.isEmpty():
            late.write.mode("overwrite").parquet(f"{late_path}/batch={number}")
        batch.unpersist()

    stream(spark, source, multi_line=multi_line).writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def cadence_now(spark: SparkSession, path: str, **options) -> DataFrame:
    return cadence.plan(stored(spark, path), **options)


def windowed_counts(events: DataFrame, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Counts by event-time window and type, with a watermark: a streaming form beyond batch ingestion."""
    return events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late).groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
