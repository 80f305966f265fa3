"""Cosine search, exact; queries meet vectors as broadcast lots of counted bytes."""

from __future__ import annotations

from collections.abc import Iterator
from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DoubleType, StructField, StructType

LOT_BYTES = 8 << 20  # of queries that are broadcast at once, with their results in a task
BATCH_BYTES = 4 << 20  # of vectors that a task scores at once
QUERY_ROWS, VECTOR_ROWS = 256, 4096  # that are scored against each other at once
PAIR_BYTES = 4 << 20  # of pairs that are evaluated exactly at once
SLACK = 2e-9  # more than rounding to 9 digits and sums in another order move a similarity
PLAIN = 1e-100, 1e100  # lengths whose squares and products neither vanish nor overflow


def dots(x: np.ndarray, y: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products of x's rows a with y's rows b, summed from first to last component: the same bits wherever a pair is met."""
    step = max(1, PAIR_BYTES // (8 * x.shape[1]))
    parts = [np.cumsum(x[a[i : i + step]] * y[b[i : i + step]], axis=1)[:, -1] for i in range(0, len(a), step)]
    return np.concatenate(parts or [np.zeros(0)])


def rounded(x: np.ndarray, digits: int = 9) -> np.ndarray:
    """Half up by the decimal form, as Spark's round."""
    large = np.abs(x) * 10.0**digits
    down = np.floor(large)
    out = np.copysign(np.floor(large + 0.5) / 10.0**digits, x) + 0.0
    for i in np.flatnonzero(np.abs(large - down - 0.5) < 1e-4):
        out[i] = float(Decimal(repr(float(x[i]))).quantize(Decimal(1).scaleb(-digits), ROUND_HALF_UP)) + 0.0
    return out


def matrices(ids: pa.Array, vectors: pa.ListArray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, rows) of the vectors of one length that hold no nulls, a few at a time."""
    lengths = np.diff(vectors.offsets.to_numpy())
    for dim in np.unique(lengths[lengths > 0]).tolist():
        at = np.flatnonzero(lengths == dim)
        step = max(1, min(VECTOR_ROWS, BATCH_BYTES // (8 * dim)))
        for own in (at[i : i + step] for i in range(0, len(at), step)):
            flat = vectors.take(pa.array(own)).flatten()
            x = flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(own), dim)
            whole = flat.is_valid().to_numpy(zero_copy_only=False).reshape(len(own), dim).all(1)
            yield ids.take(pa.array(own[whole])).to_numpy(zero_copy_only=False), x[whole]


class Vectors:
    """Ids, rows, lengths and directions of the rows that are not zero; rows of odd lengths have no direction."""

    def __init__(self, ids: np.ndarray, x: np.ndarray):
        every = np.arange(len(x))
        length = np.sqrt(dots(x, x, every, every))
        some = ~(length <= 0)
        self.ids, self.x, self.length = ids[some], x[some], length[some]
        plain = (self.length > PLAIN[0]) & (self.length < PLAIN[1])
        self.direction = np.where(plain[:, None], self.x / self.length[:, None], np.nan)


class Nearest:
    """The k nearest rows so far of a few queries, by similarity rounded to 9 digits, then id."""

    def __init__(self, queries: Vectors, k: int):
        self.queries, self.k, self.rows = queries, k, None
        self.least = np.full(len(queries.ids), -np.inf)

    def meet(self, v: Vectors) -> None:
        """Products of directions leave out what is surely below the k nearest; the rest is evaluated exactly."""
        q = self.queries
        near, same = q.direction @ v.direction.T, q.ids[:, None] == v.ids[None]
        near[same] = -np.inf
        limit = self.least - SLACK
        if len(v.ids) > self.k and np.isneginf(limit).any():
            sure = np.where(np.isnan(near), -np.inf, near)
            limit = np.maximum(limit, np.partition(sure, -self.k, axis=1)[:, -self.k] - SLACK)
        a, b = np.nonzero(~(near < limit[:, None]) & ~same)
        if not len(a):
            return
        new = pd.DataFrame({"query": a, "similarity": rounded(dots(q.x, v.x, a, b) / (q.length[a] * v.length[b])), "id": v.ids[b]})
        rows = new if self.rows is None else pd.concat([self.rows, new])
        rows = rows.sort_values(["query", "similarity", "id"], ascending=[True, False, True], na_position="first")
        rank = rows.groupby("query").cumcount()
        self.rows, last = rows[rank < self.k], rows[rank == self.k - 1]
        self.least[last["query"]] = last["similarity"].fillna(np.inf)


def cosine_topk(vectors: DataFrame, queries: DataFrame, k: int, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank, id, similarity (rounded to 9): each query's k nearest by cosine, itself left out, ties to smaller ids.

    Every query is compared with every vector of as many components, which is quadratic where queries are a share of the
    rows. Vectors are dealt by id; queries meet them in lots of LOT_BYTES, which are broadcast one by one. A task scores
    blocks of queries and vectors by matrix products and evaluates in a fixed order of sums only what may be among the k
    nearest, so it holds and returns k rows of a query. Vectors that are null, zero or hold nulls take no part; one with a
    NaN has the similarity NaN, which is above all.
    """
    spark = vectors.sparkSession
    q = queries.select(F.col(id_col).alias("query_id"), F.col(vector).alias("q")).where("query_id IS NOT NULL AND q IS NOT NULL")
    v = vectors.select(F.col(id_col).alias("id"), F.col(vector).alias("v")).where("id IS NOT NULL AND v IS NOT NULL").repartition("id")
    schema = StructType([StructField("query_id", q.schema["query_id"].dataType), StructField("id", v.schema["id"].dataType), StructField("similarity", DoubleType())])
    arrow = to_arrow_schema(schema)

    def nearest(asked):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            with np.errstate(all="ignore"):
                found = [Nearest(Vectors(ids[i : i + QUERY_ROWS], x[i : i + QUERY_ROWS]), k) for ids, x in asked.value for i in range(0, len(ids), QUERY_ROWS)]
                for b in batches:
                    for ids, x in matrices(b.column(0), b.column(1)):
                        met = Vectors(ids, x)
                        for f in found:
                            if f.queries.x.shape[1] == x.shape[1] and len(f.queries.ids) and len(met.ids):
                                f.meet(met)
            for f in found:
                if f.rows is not None:
                    columns = f.queries.ids[f.rows["query"]], f.rows["id"].to_numpy(), f.rows["similarity"].to_numpy()
                    yield pa.RecordBatch.from_arrays([pa.array(c, type=t.type) for c, t in zip(columns, arrow)], schema=arrow)

        return run

    n = max(1, -(-(q.agg(F.sum(8 * F.size("q") + 64 * k)).first()[0] or 0) // LOT_BYTES))
    found = None
    for i in range(n):
        lot = q.where(F.pmod(F.xxhash64("query_id"), F.lit(n)) == i).toArrow().combine_chunks()
        asked = spark.sparkContext.broadcast(list(matrices(lot.column(0).combine_chunks(), lot.column(1).combine_chunks())))
        met = v.mapInArrow(nearest(asked), schema)
        found = met if found is None else found.unionAll(met)
    order = Window.partitionBy("query_id").orderBy(F.desc("similarity"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search_filtered(vectors: DataFrame, queries: DataFrame, k: int, where: str) -> DataFrame:
    """cosine_topk over the vectors that pass the filter, which reaches the scan."""
    return cosine_topk(vectors.where(where), queries, k)


def chunk_for_embedding(df: DataFrame, text: str, size: int = 8000, least: int = 50) -> DataFrame:
    """Consecutive chunks of `size` characters, the last one shorter, of texts with at least `least`; chunk_index from 0."""
    starts = F.sequence(F.lit(0), F.floor((F.length(text) - 1) / size).cast("int"))
    cut = df.where(F.length(text) >= F.lit(max(least, 1))).withColumn("chunk_index", F.explode(starts))
    return cut.withColumn("chunk", F.substr(F.col(text), F.col("chunk_index") * size + 1, F.lit(size)))
