"""Incremental intake: batch forms, and Structured Streaming where intake is continuous."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def stream_documents(spark: SparkSession, path: str, schema, process: Callable[[DataFrame, int], None], checkpoint: str):
    """Processes the files that are new since the last run, and ends; process gets each micro-batch and must be idempotent."""
    source = spark.readStream.schema(schema).parquet(path)
    return source.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def pending_documents(df: DataFrame, now: Column, limit: int = 100, started: str = "ingested_at", source: str | None = None) -> DataFrame:
    """Pending documents, and those in processing for over an hour; oldest first."""
    stuck = (F.col("status") == "processing") & (F.col(started) < now - F.expr("INTERVAL 1 HOUR"))
    rows = df.where((F.col("status") == "pending") | stuck)
    rows = rows.where(F.col("source") == source) if source else rows
    return rows.orderBy(started, "id").limit(limit)


def apply_status(docs: DataFrame, updates: DataFrame) -> DataFrame:
    """Documents with the latest update of each id: status, message of failures, time of completion."""
    last = updates.groupBy("id").agg(F.max(F.struct("at", "status", "message")).alias("u"))
    j = docs.join(last, "id", "left")
    status = F.coalesce("u.status", "status")
    done = F.when(F.col("u.status") == "completed", F.col("u.at")).otherwise(F.col("processed_at"))
    return j.select("id", status.alias("status"), done.alias("processed_at"), F.when(F.col("u.status") == "failed", F.col("u.message")).alias("message"))


def recent_activity(df: DataFrame, ts: str, now: Column, minutes: int) -> DataFrame:
    return df.where((F.col(ts) > now - F.expr(f"INTERVAL {minutes} MINUTES")) & (F.col(ts) <= now)).agg(F.count("*").alias("n"))


def windowed_activity(df: DataFrame, ts: str, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Counts by window; for a stream, rows later than the watermark are dropped and state is freed."""
    rows = df.withWatermark(ts, late) if df.isStreaming else df
    return rows.groupBy(F.window(ts, width).alias("w")).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def stream_dedup(df: DataFrame, content: str, ts: str, late: str = "7 days") -> DataFrame:
    """The first row of each content within the watermark (stream), or of all (batch)."""
    h = df.withColumn("content_hash", F.sha2(content, 256))
    if df.isStreaming:
        return h.withWatermark(ts, late).dropDuplicatesWithinWatermark(["content_hash"])
    return h.withColumn("_r", F.row_number().over(Window.partitionBy("content_hash").orderBy(ts))).where("_r = 1").drop("_r")


def plateau_detect(counts: DataFrame, at: str, n: int = 5, least: float = 500_000, enough: float = 850_000) -> DataFrame:
    """counts with `run` (checks with the same count so far) and `plateau`. counts is a short series of checks."""
    order = Window.partitionBy(F.lit(0)).orderBy(at)
    changed = counts.withColumn("_c", F.coalesce((F.col("n") != F.lag("n").over(order)).cast("int"), F.lit(1)))
    grouped = changed.withColumn("_g", F.sum("_c").over(order))
    run = F.row_number().over(Window.partitionBy("_g").orderBy(at))
    return grouped.withColumn("run", run).withColumn("plateau", ((F.col("run") >= n) & (F.col("n") > least)) | (F.col("n") > enough)).drop("_c", "_g")


def run_log(df: DataFrame, started: str, finished: str) -> DataFrame:
    """One row a run: processed, failed, first start, last end."""
    return df.groupBy("run").agg(F.count_if(F.col("status") == "completed").alias("processed"), F.count_if(F.col("status") == "failed").alias("failed"), F.min(started).alias("started_at"), F.max(finished).alias("completed_at"))


def collect_by_source(df: DataFrame, ts: str) -> DataFrame:
    """source, n, and rows an hour over the source's own time span."""
    hours = (F.unix_timestamp(F.max(ts)) - F.unix_timestamp(F.min(ts))) / 3600
    return df.groupBy("source").agg(F.count("*").alias("n"), F.try_divide(F.count("*"), hours).alias("per_hour"))
