"""Incremental extraction: by date, by flag or change time in batch, and as a file stream."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from querylode.functions import sqltext as S
from querylode.lineage import shared_dir
from querylode.operators import filters
from querylode.sources import derived


def of_day(logs: DataFrame, day: str, at: str = "collected_at") -> DataFrame:
    """Logs of one calendar day, as a range so that the filter reaches the files."""
    start = F.lit(day).cast("date").cast("timestamp_ntz")
    return logs.filter((F.col(at) >= start) & (F.col(at) < F.date_add(F.lit(day).cast("date"), 1).cast("timestamp_ntz")))


def changed_since(logs: DataFrame, at: str, last_run: Column, processed: str | None = None) -> DataFrame:
    """Logs not yet processed, or changed after the last run."""
    fresh = F.col(at) > last_run
    if processed:
        fresh = fresh | (F.coalesce(F.col(processed), F.lit("N")) == "N")
    return logs.filter(fresh)


def template_counts(logs: DataFrame) -> DataFrame:
    """Template counts of one batch; they add up over batches."""
    rows = filters.keep_valid(logs).select(S.template_id(S.mask_literals(F.col("sql_text"))).alias("template_id"), "exec_count")
    return rows.groupBy("template_id").agg(F.count("*").alias("log_count"), F.sum("exec_count").alias("exec_count"))


def write_batches(stream: DataFrame, target: str, checkpoint: str, per_batch=template_counts) -> None:
    """Run a stream over all files now present.  Each batch overwrites its own folder, so a repeated batch
    after a failure does not count twice."""

    def write(batch: DataFrame, batch_id: int) -> None:
        per_batch(batch).write.mode("overwrite").parquet(f"{target}/batch_id={batch_id}")

    query = (stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()


def merged_counts(spark: SparkSession, target: str) -> DataFrame:
    """Totals over all batches written so far."""
    return spark.read.parquet(target).groupBy("template_id").agg(
        F.sum("log_count").alias("log_count"), F.sum("exec_count").alias("exec_count"))


def stream_template_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The derived log as a file stream, counted batch by batch and merged."""
    schema = derived.table(spark, sf_dir, "events").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    logs = stream.selectExpr(*derived.PARTS).selectExpr(*derived.LOG_COLUMNS)
    run = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    write_batches(logs, f"{run}/counts", f"{run}/checkpoint")
    return merged_counts(spark, f"{run}/counts")
