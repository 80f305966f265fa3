"""One row a micro-batch: observed metrics, taken up by a listener and kept as small files."""

from __future__ import annotations

import json
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from ..sources.shared import Files

SCHEMA = "run string, batch long, status string, processed long, failed long, started_at timestamp, completed_at timestamp, message string"
OBSERVED = "wasteflow_run"


def watched(df: DataFrame, failed: Column) -> DataFrame:
    """df whose rows are counted on their way: processed, and failed where the condition holds."""
    return df.observe(OBSERVED, F.count_if(~F.coalesce(failed, F.lit(False))).alias("processed"), F.count_if(failed).alias("failed"))


class RunLog(StreamingQueryListener):
    """Writes a file for each micro-batch of watched streams, and one for a query that ends by an error.

    A file is named by query and batch: a batch that runs again after a restart takes the place of its earlier row. Batches
    without new rows that Spark runs for its state have a row with counts of zero. No Spark job runs in the listener.
    """

    def __init__(self, spark: SparkSession, path: str):
        self._spark, self._files = spark, Files(spark, path)

    def rows(self) -> DataFrame:
        """The log so far: run, batch, status, processed, failed, started_at, completed_at, message."""
        if not any(n.endswith(".json") for n in self._files.names()):
            return self._spark.createDataFrame([], SCHEMA)
        return self._spark.read.schema(SCHEMA).json(self._files.path + "/*.json")

    def _put(self, name: str, **row) -> None:
        self._files.put(name, json.dumps(row))

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        seen = p.observedMetrics.get(OBSERVED)
        if seen is None:
            return
        started = datetime.fromisoformat(p.timestamp.replace("Z", "+00:00"))
        ended = datetime.fromtimestamp(started.timestamp() + p.durationMs.get("triggerExecution", 0) / 1000, timezone.utc)
        run = p.name or str(p.id)
        self._put(f"{p.id}-{p.batchId:012d}.json", run=run, batch=p.batchId, status="completed", processed=seen["processed"], failed=seen["failed"], started_at=started.isoformat(), completed_at=ended.isoformat())

    def onQueryTerminated(self, event) -> None:
        if event.exception:
            now = datetime.now(timezone.utc).isoformat()
            self._put(f"{event.id}-failed-{event.runId}.json", run=str(event.id), status="failed", processed=0, failed=0, completed_at=now, message=event.exception[:2000])
