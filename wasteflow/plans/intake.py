"""Queries of incremental intake (N)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources.shared import new_folder, written
from ..sources.versioned import VersionedTable
from ..streaming import intake as N
from ..streaming.delivery import Outbox, into_table
from ..streaming.runlog import watched
from ..streaming.stateful import plateau_stream
from .catalog import query


def streamed(t, name: str):
    """A stream over a table of the folder; as a pattern, its path may be that of one file."""
    return t.spark.readStream.schema(getattr(t, name).schema).parquet(f"{t.sf_dir}/{name}[.]parquet")


def finish(t, stream, process) -> None:
    """Runs a stream over what is there, to its end."""
    q = stream.writeStream.foreachBatch(process).option("checkpointLocation", new_folder(t.spark, "stream")).trigger(availableNow=True).start()
    q.awaitTermination()


LAST = "(SELECT max(ingested_at) FROM {queue})"


def with_now(t):
    """The queue with the time of its last row in each row: a join with one row, which is broadcast."""
    return t.queue.join(F.broadcast(t.queue.agg(F.max("ingested_at").alias("now"))))


@query("n2_pending_documents", f"SELECT id, status FROM {{queue}} WHERE status = 'pending' OR (status = 'processing' AND ingested_at < {LAST} - INTERVAL 1 HOUR) ORDER BY ingested_at, id LIMIT 100")
def _(t):
    return N.pending_documents(with_now(t), F.col("now")).select("id", "status")


@query("n3_apply_status", """WITH u AS (SELECT o_custkey AS id, o_orderdate AS happened, CASE o_orderstatus WHEN 'F' THEN 'failed' ELSE 'completed' END AS status, o_orderkey FROM {orders}), l AS (SELECT * FROM u QUALIFY row_number() OVER (PARTITION BY id ORDER BY happened DESC, status DESC, 'm' || o_orderkey::VARCHAR DESC) = 1)
    SELECT c_custkey AS id, coalesce(l.status, 'pending') AS status, CASE WHEN l.status = 'failed' THEN 'm' || o_orderkey::VARCHAR END AS message FROM {customer} LEFT JOIN l ON c_custkey = l.id""")
def _(t):
    docs = t.customer.select(F.col("c_custkey").alias("id"), F.lit("pending").alias("status"), F.lit(None).cast("timestamp").alias("processed_at"))
    updates = t.orders.select(F.col("o_custkey").alias("id"), F.col("o_orderdate").cast("timestamp").alias("at"), F.expr("CASE o_orderstatus WHEN 'F' THEN 'failed' ELSE 'completed' END").alias("status"), F.concat(F.lit("m"), "o_orderkey").alias("message"))
    return N.apply_status(docs, updates).select("id", "status", "message")


@query("n4_recent_activity", f"SELECT count(*) AS n FROM {{queue}} WHERE ingested_at > {LAST} - INTERVAL 60 MINUTE")
def _(t):
    return N.recent_activity(with_now(t), "ingested_at", F.col("now"), 60)


@query("n4_windowed_activity", "SELECT date_trunc('hour', ts) AS start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS \"end\", count(*) AS n FROM {events} GROUP BY 1, 2")
def _(t):
    return N.windowed_activity(t.events, "ts")


@query("n5_stream_dedup", "SELECT min(doc_id) AS doc_id, sha256(text) AS content_hash FROM {documents} GROUP BY text")
def _(t):
    return N.stream_dedup(t.documents, "text", "doc_id").select("doc_id", "content_hash")


DAYS = "SELECT CAST(ts AS DATE) AS day, CAST(floor(count(*) / 10) AS BIGINT) AS n FROM {events} GROUP BY 1"


@query("n6_plateau_detect", f"WITH d AS ({DAYS}), c AS (SELECT *, CASE WHEN n = lag(n) OVER (ORDER BY day) THEN 0 ELSE 1 END AS c FROM d), g AS (SELECT *, sum(c) OVER (ORDER BY day) AS g FROM c) SELECT day, n, CAST(row_number() OVER (PARTITION BY g ORDER BY day) AS INT) AS run, (row_number() OVER (PARTITION BY g ORDER BY day) >= 2 AND n > 10) OR n > 850000 AS plateau FROM g")
def _(t):
    return N.plateau_detect(t.sql(DAYS), "day", 2, 10)


@query("n7_run_log", "SELECT source AS run, count(*) FILTER (status = 'completed') AS processed, count(*) FILTER (status = 'failed') AS failed, min(ingested_at) AS started_at, max(ingested_at) AS completed_at FROM {queue} GROUP BY 1")
def _(t):
    return N.run_log(t.queue.withColumnRenamed("source", "run"), "ingested_at", "ingested_at")


@query("n8_collect_by_source", "SELECT source, count(*) AS n, round(count(*) / ((epoch(date_trunc('second', max(ingested_at))) - epoch(date_trunc('second', min(ingested_at)))) / 3600.0), 6)::DOUBLE AS per_hour FROM {queue} GROUP BY 1")
def _(t):
    return N.collect_by_source(t.queue, "ingested_at").withColumn("per_hour", F.round("per_hour", 6))


@query("n1_stream_documents", "SELECT doc_id, source, length(text) AS chars, sha256(text) AS content_hash FROM {documents}")
def _(t):
    """Every document once, with its digest, through a stream into a versioned table."""
    table = VersionedTable(t.spark, new_folder(t.spark, "intake"))
    taken = streamed(t, "documents").select("doc_id", "source", F.length("text").alias("chars"), F.sha2("text", 256).alias("content_hash"))
    finish(t, taken, into_table(table, "intake"))
    return table.read()


HOURS = "SELECT event_type AS series, date_trunc('hour', ts) AS hour, CAST(floor(count(*) / {per}) AS BIGINT) AS n FROM {events} GROUP BY 1, 2"
PER = "3"


@query("n6_plateau_stream", f"WITH d AS ({HOURS.replace('{per}', PER)}), c AS (SELECT *, CASE WHEN n = lag(n) OVER w THEN 0 ELSE 1 END AS c FROM d WINDOW w AS (PARTITION BY series ORDER BY hour)), g AS (SELECT *, sum(c) OVER (PARTITION BY series ORDER BY hour) AS g FROM c) SELECT series, hour, n, CAST(row_number() OVER w AS INT) AS run, (row_number() OVER w >= 2 AND n > 1) OR n > 850000 AS plateau FROM g WINDOW w AS (PARTITION BY series, g ORDER BY hour)")
def _(t):
    counts = t.sql(HOURS.replace("{per}", PER)).withColumnRenamed("hour", "at")
    source = new_folder(t.spark, "checks")
    counts.write.parquet(source)
    table = VersionedTable(t.spark, new_folder(t.spark, "plateaus"))
    finish(t, plateau_stream(t.spark.readStream.schema(counts.schema).parquet(source), 2, 1), into_table(table, "plateaus"))
    return table.read().withColumnRenamed("at", "hour")


@query("n7_observed_run", "SELECT count(*) FILTER (event_type <> 'error') AS processed, count(*) FILTER (event_type = 'error') AS failed FROM {events}")
def _(t):
    """The counts that a stream's listener gets, taken from the progress of each of its micro-batches."""
    stream = watched(streamed(t, "events"), F.col("event_type") == "error")
    q = stream.writeStream.format("noop").option("checkpointLocation", new_folder(t.spark, "stream")).trigger(availableNow=True).start()
    q.awaitTermination()
    seen = [p["observedMetrics"]["wasteflow_run"] for p in q.recentProgress if p["observedMetrics"].get("wasteflow_run")]
    rows = t.spark.createDataFrame([(int(s["processed"]), int(s["failed"])) for s in seen], "processed long, failed long")
    return rows.agg(F.coalesce(F.sum("processed"), F.lit(0)).alias("processed"), F.coalesce(F.sum("failed"), F.lit(0)).alias("failed"))


@query("m10_outbox", "SELECT event_type, count(*) AS n FROM {events} GROUP BY 1")
def _(t):
    """Every event goes out once, in lots; the other side is a table that keeps each row under its token."""
    at = new_folder(t.spark, "outbox")
    box = Outbox(t.spark, at, ["event_id"], lambda token, rows: None, parts=16, parts_in_lot=8)
    table = VersionedTable(t.spark, f"{at}-out")

    def both(rows, batch):
        box(rows, batch)
        table.append(rows, "out", batch)

    finish(t, streamed(t, "events").select("event_id", "event_type"), both)
    return table.read().groupBy("event_type").agg(F.count("*").alias("n"))
