"""Sinks that take every row of a stream exactly once, however often a micro-batch is run."""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.shared import Files
from ..sources.versioned import VersionedTable


def into_table(table: VersionedTable, writer: str) -> Callable[[DataFrame, int], None]:
    """foreachBatch function that appends micro-batches to a versioned table; a batch that is in it already is left out."""
    return lambda rows, batch: table.append(rows, writer, batch)


class Outbox:
    """Delivers micro-batches to an outer system through `send(token, rows)`.

    A micro-batch is first written to the outbox, dealt by key into numbered parts; a replay reads what was written, so that
    its parts are the same. Parts are sent in lots, and the ledger gets the parts of a lot when all of them are out; parts
    in the ledger are not sent again. What is sent again is only what a lost task or a broken lot had begun, under the
    same token (batch-part-chunk) and with the same rows, by which the other side knows it.
    """

    def __init__(self, spark: SparkSession, path: str, key: list[str], send: Callable[[str, list[dict]], None], parts: int = 64, parts_in_lot: int = 16, size: int = 1000):
        self.spark, self.path, self.key, self.send = spark, path.rstrip("/"), key, send
        self.parts, self.parts_in_lot, self.size = parts, parts_in_lot, size

    def delivered(self) -> DataFrame:
        """batch, part, n of what is out."""
        schema = "batch long, part int, n long"
        return self.spark.read.schema(schema).parquet(f"{self.path}/ledger") if Files(self.spark, f"{self.path}/ledger").names() else self.spark.createDataFrame([], schema)

    def __call__(self, rows: DataFrame, batch: int) -> None:
        box = f"{self.path}/rows/{batch:012d}"
        if "_SUCCESS" not in Files(self.spark, box).names():
            part = F.pmod(F.xxhash64(*self.key), F.lit(self.parts)).cast("int")
            dealt = rows.withColumn("wf_part", part).repartition("wf_part").sortWithinPartitions("wf_part", *self.key)
            dealt.write.mode("overwrite").partitionBy("wf_part").parquet(box)
        stored = sorted(int(n.split("=")[1]) for n in Files(self.spark, box).names() if n.startswith("wf_part="))
        out = {r["part"] for r in self.delivered().where(F.col("batch") == batch).collect()}  # at most `parts` numbers
        todo = [p for p in stored if p not in out]
        for at in range(0, len(todo), self.parts_in_lot):
            self._deliver(box, batch, todo[at : at + self.parts_in_lot])
        Files(self.spark, self.path).delete(f"rows/{batch - 2:012d}")  # a stream runs its last batch again at most

    def _deliver(self, box: str, batch: int, lot: list[int]) -> None:
        send, size = self.send, self.size
        full = self.spark.read.option("basePath", box).parquet(*[f"{box}/wf_part={p}" for p in lot])
        order = ["wf_part", *self.key, *[c for c in full.columns if c not in self.key and c != "wf_part"]]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            """Chunks of each part, one at a time; rows come sorted by part."""
            rows = (r for b in batches for r in b.to_pylist())
            for part, own in itertools.groupby(rows, key=lambda r: r["wf_part"]):
                n = 0
                for number, chunk in enumerate(itertools.batched(own, size)):
                    send(f"{batch}-{part}-{number}", [{c: v for c, v in r.items() if c != "wf_part"} for r in chunk])
                    n += len(chunk)
                yield pa.RecordBatch.from_arrays([pa.array([batch], pa.int64()), pa.array([part], pa.int32()), pa.array([n], pa.int64())], names=["batch", "part", "n"])

        sent = full.repartition(len(lot), "wf_part").sortWithinPartitions(*order).mapInArrow(run, "batch long, part int, n long")
        sent.write.mode("append").parquet(f"{self.path}/ledger")
