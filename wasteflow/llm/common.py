"""Helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SLICE_BYTES = 4 << 20
BATCH, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 1000
BROADCAST_BYTES = 8 << 20
MOST_FILES = 100_000  # file names that are broadcast at most
_OWN: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """Folder that driver and executors share: spark.checkpoint.dir; a temporary one only in local mode."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith(("local[", "local*")) and spark.sparkContext.master != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if not _OWN:
        _OWN.append(tempfile.mkdtemp(prefix="wasteflow-"))
    return _OWN[0]


def materialize(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Writes df as Parquet to the shared folder and reads it back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=compression)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes what materialize wrote. Only for tables that no later job reads, recomputation after a lost executor included."""
    for t in tables:
        spark = t.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(t.written_to)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def few(ids: DataFrame) -> DataFrame:
    """ids (one column, written before) for a join: broadcast if they are at most BROADCAST_BYTES, else met by a merge join."""
    (name, kind), = ids.dtypes
    size = F.sum(F.length(name) + 8) if kind in ("string", "binary") else 8 * F.count("*")
    return F.broadcast(ids) if (ids.agg(size).first()[0] or 0) <= BROADCAST_BYTES else ids.hint("merge")


def with_row_key(df: DataFrame, column: str, name: str) -> DataFrame:
    """df with a long that differs in all rows, the same at every use.

    Rows of a table that is read from files are known by file and place; others are written with a key and read again.
    """
    spark = df.sparkSession
    if df._jdf.queryExecution().analyzed().getClass().getSimpleName() == "LogicalRelation":
        files = [r[0] for r in df.select(F.col("_metadata.file_path").alias("f")).distinct().limit(MOST_FILES + 1).collect()]
        if len(files) <= MOST_FILES:
            numbers = spark.createDataFrame(list(enumerate(sorted(files))), "wf_number long, wf_file string")
            placed = df.select("*", F.col("_metadata.file_path").alias("wf_path"), F.col("_metadata.row_index").alias("wf_index"))
            placed = placed.join(F.broadcast(numbers), F.col("wf_path") == F.col("wf_file"))
            return placed.select(*[F.col(f"`{c}`") for c in df.columns], (F.shiftleft("wf_number", 40) + F.col("wf_index")).alias(column))
    return materialize(df.withColumn(column, F.monotonically_increasing_id()), name)


def map_rows(df: DataFrame, fn: Callable[[Iterator[dict]], Iterator[dict]], schema: str) -> DataFrame:
    """mapInArrow where fn gets each batch as a dict of Python lists and yields such dicts.

    Rows with whole texts are wide: the session's limit of rows for a batch is lowered to BATCH_ROWS where it is higher,
    and large batches come in slices, so that few texts are Python objects at once, however long they are.
    """
    conf = df.sparkSession.conf
    if not 0 < int(conf.get(BATCH)) <= BATCH_ROWS:
        conf.set(BATCH, str(BATCH_ROWS))
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for b in batches:
            step = max(1, b.num_rows * SLICE_BYTES // max(b.nbytes, 1))
            for at in range(0, b.num_rows, step):
                part = b.slice(at, step)
                yield {n: c.to_pylist() for n, c in zip(part.schema.names, part.columns)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for out in fn(slices(batches)):
            yield pa.RecordBatch.from_arrays([pa.array(out[f.name], type=f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, schema)
