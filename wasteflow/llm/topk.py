"""Operator 1: exact top-k inner products by pivot-table elimination.

Inner products become distances by adding one component: with x' = (x, sqrt(M - |x|^2)) and q' = (q, 0), where M is
the largest squared length, |q' - x'|^2 = |q|^2 + M - 2 q.x. Distances of every vector to many pivots are computed once
and stored with it. By the triangle inequality the largest |d(q, p) - d(x, p)| over the pivots p bounds d(q, x) from
below, hence q.x from above.

Vectors lie in blocks of bounded size by their nearest pivot, and in a block in rings by the distance to it, so that
intervals of the pivot distances bound whole blocks and rings. Every query first meets the block with the highest bound;
its k-th score there is the threshold that goes on to all other blocks, which are left out for queries whose bound is
below. In a block, rings come in the order of their bounds, rows below the threshold are left out, and what remains
is evaluated exactly. The pivots come from a bounded sample; they decide speed, not results.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_rows, materialize

PIVOTS = 24
PIVOT_SAMPLE = 1024
BLOCK_ROWS = 4096
RING = 512
QUERY_ROWS = 256
SMALL = 1_000_000  # rows of some 30 bytes that are broadcast at most
SUMMARY_BYTES = 64 << 20  # intervals of blocks that are broadcast at once
PROBED = 16  # queries on which a block tries whether bounds of rows eliminate enough to pay
EXACT = 2.0**53


def integer_vectors(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """vec_id, x, dim: floor(256 * component), whole numbers as double, of rows with an id and finite components only."""
    x = F.transform(F.col(vector_col).cast("array<double>"), lambda v: v * 256)
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    whole = F.transform(x, lambda v: F.when(F.abs(v) < EXACT, F.floor(v).cast("double")).otherwise(v))
    out = df.where(F.col(vector_col).isNotNull() & F.col(id_col).isNotNull() & F.coalesce(finite, F.lit(False)))
    return out.select(F.col(id_col).cast("long").alias("vec_id"), whole.alias("x"), F.size(whole).alias("dim"))


def choose_pivots(sample: np.ndarray, n: int) -> np.ndarray:
    """Farthest-first: each next pivot is the sample row farthest from those chosen."""
    chosen = [0]
    apart = ((sample - sample[0]) ** 2).sum(1)
    while len(chosen) < min(n, len(sample)):
        chosen.append(int(np.argmax(apart)))
        apart = np.minimum(apart, ((sample - sample[chosen[-1]]) ** 2).sum(1))
    return sample[chosen]


def distances(x: np.ndarray, extra: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distances of the rows (x, extra) to the pivots (p, 0)."""
    squared = (x**2).sum(1)[:, None] + (extra**2)[:, None] + (pivots**2).sum(1)[None] - 2 * x @ pivots.T
    return np.sqrt(np.maximum(squared, 0))


def upper(constant: np.ndarray, apart: np.ndarray) -> np.ndarray:
    """Highest inner products at distances of at least `apart`; the slack covers rounding of the distances."""
    return np.nan_to_num((constant - apart**2) / 2 + 1e-6 * constant + 1, nan=np.inf, posinf=np.inf)


def gap(at: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """[query, interval]: the largest distance over the pivots from a query's place to an interval's."""
    out = np.zeros((len(at), len(low)))
    for p in range(at.shape[1]):
        np.maximum(out, np.maximum(at[:, p, None] - high[None, :, p], low[None, :, p] - at[:, p, None]), out=out)
    return out


class Best:
    """The k best (query, score, id) of each query so far."""

    def __init__(self, threshold: np.ndarray, k: int):
        self.k, self.threshold = k, threshold.copy()
        self.query, self.score, self.id = np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64)

    def add(self, query: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        query, score, ids = (np.concatenate(p) for p in ((self.query, query), (self.score, score), (self.id, ids)))
        order = np.lexsort((ids, -score, query))
        query = query[order]
        first = np.flatnonzero(np.diff(query, prepend=-1))
        rank = np.arange(len(query)) - np.repeat(first, np.diff(np.append(first, len(query))))
        keep = rank < self.k
        self.query, self.score, self.id = query[keep], score[order][keep], ids[order][keep]
        last = rank[keep] == self.k - 1
        at = self.query[last]
        self.threshold[at] = np.maximum(self.threshold[at], self.score[last])


def search(q: np.ndarray, own: np.ndarray, threshold: np.ndarray, to_q: np.ndarray, rows: np.ndarray, ids: np.ndarray, x: np.ndarray, to_x: np.ndarray, longest: float, k: int) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """(query place, id, score) of one block's rows that can be among the k best; a query's own row is left out."""
    if np.abs(q).max(initial=0) * np.abs(x).max(initial=0) * max(q.shape[1], 1) >= EXACT:
        return exactly(q, own, rows, ids, x, k)
    constant = (q**2).sum(1) + longest
    firsts = np.arange(0, len(x), RING)
    bounds = upper(constant[:, None], gap(to_q, np.minimum.reduceat(to_x, firsts), np.maximum.reduceat(to_x, firsts)))
    best, by_row = Best(threshold, k), None
    for ring in np.argsort(-bounds.max(0), kind="stable"):
        live = np.flatnonzero(bounds[:, ring] >= best.threshold)
        if not len(live):
            continue
        part = slice(firsts[ring], firsts[ring] + RING)
        xs, limit = x[part], best.threshold[live]
        if by_row is None and np.isfinite(limit).any():
            tried = live[:PROBED]
            by_row = (upper(constant[tried, None], gap(to_q[tried], to_x[part], to_x[part])) >= best.threshold[tried, None]).mean() < 0.5
        if by_row:
            a, b = np.nonzero(upper(constant[live, None], gap(to_q[live], to_x[part], to_x[part])) >= limit[:, None])
            score = np.einsum("ij,ij->i", q[live[a]], xs[b])
        else:
            found = q[live] @ xs.T
            found[own[live, None] == rows[part][None]] = -np.inf
            if len(xs) > k:
                limit = np.maximum(limit, np.partition(found, len(xs) - k, axis=1)[:, len(xs) - k])
            a, b = np.nonzero(found >= limit[:, None])
            score = found[a, b]
        keep = own[live[a]] != rows[part][b]
        best.add(live[a][keep], score[keep], ids[part][b][keep])
    return best.query, best.id, best.score.astype(np.int64).tolist()


def exactly(q, own, rows, ids, x, k) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """The same for numbers too large for doubles: whole numbers of any size, all rows of the block."""
    whole = [[int(v) for v in row] for row in x.tolist()]
    out: list[tuple[int, int, int]] = []
    for i, query in enumerate([[int(v) for v in row] for row in q.tolist()]):
        scores = sorted((-sum(a * b for a, b in zip(query, row)), n) for row, n, r in zip(whole, ids.tolist(), rows.tolist()) if r != own[i])
        out += [(i, n, -s) for s, n in scores[:k]]
    if any(not -(1 << 63) <= s < 1 << 63 for _, _, s in out):
        raise OverflowError("an inner product among the best leaves a long")
    return np.array([o[0] for o in out], np.int64), np.array([o[1] for o in out], np.int64), [o[2] for o in out]


def numbers(frame: pd.DataFrame, column: str, kind=np.float64) -> np.ndarray:
    return np.frombuffer(b"".join(frame[column]), kind).reshape(len(frame), -1)


def exact_top_k(df: DataFrame, k: int = 5, every: int = 50, id_col: str = "vec_id", vector_col: str = "embedding", n_pivots: int = PIVOTS) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: each query's k highest integer inner products, ties to smaller ids.

    Queries are the rows whose id is divisible by `every`; candidates are all other rows with as many components, rows
    that share an id included. Rows without an id, and vectors that are null or hold null or non-finite components (256-fold
    ones included), take no part. Scores are exact at any size; one among the best that leaves a long raises an error.
    Other columns are ignored; an empty table gives no rows.
    """
    spark = df.sparkSession
    source = integer_vectors(df, id_col, vector_col)
    norm = F.aggregate("x", F.lit(0.0), lambda s, v: s + v * v)
    sample = source.orderBy(F.xxhash64("vec_id"), "vec_id", "x").limit(PIVOT_SAMPLE).select("x", "dim").collect()
    pivots = {d: choose_pivots(np.array([r["x"] for r in sample if r["dim"] == d], np.float64), n_pivots) for d in {r["dim"] for r in sample}}

    def small(table: DataFrame) -> DataFrame:
        return F.broadcast(table) if table.count() <= SMALL else table.hint("merge")

    longest = materialize(source.groupBy("dim").agg(F.max(norm).alias("longest")), "topk-lengths")
    placed = source.join(small(longest), "dim").select("vec_id", "x", "dim", "longest")

    def place(batches):
        row = TaskContext.get().partitionId() << 40
        for b in batches:
            dims = np.array(b["dim"])
            for dim in np.unique(dims).tolist():
                own = np.flatnonzero(dims == dim).tolist()
                x = np.array([b["x"][i] for i in own], np.float64).reshape(len(own), dim)
                extra = np.sqrt(np.maximum(b["longest"][own[0]] - (x**2).sum(1), 0))
                table = distances(x, extra, pivots.get(dim, np.zeros((1, dim))))
                yield {"row": list(range(row, row + len(own))), "vec_id": [b["vec_id"][i] for i in own], "dim": [dim] * len(own), "longest": [b["longest"][own[0]]] * len(own), "cell": table.argmin(1), "x": [v.tobytes() for v in x], "table": [t.tobytes() for t in table]}
                row += len(own)

    vectors = materialize(map_rows(placed, place, "row long, vec_id long, dim int, longest double, cell int, x binary, table binary"), "topk-vectors")
    cells = materialize(vectors.groupBy("dim", "cell").agg(F.count("*").alias("n"), F.count_if(F.col("vec_id") % every == 0).alias("n_queries")), "topk-cells")
    cells = small(cells)

    def part(n: str, size: int):
        return F.pmod(F.xxhash64("row"), F.greatest(F.lit(1), F.ceil(F.col(n) / size))).cast("int")

    def pack(frame):
        to_x = numbers(frame, "table")
        order = np.argsort(to_x[:, int(frame["cell"].iloc[0])], kind="stable")
        to_x, x = to_x[order], numbers(frame, "x")[order]
        out = {"rows": frame["row"].to_numpy(np.int64)[order], "ids": frame["vec_id"].to_numpy(np.int64)[order], "x": x, "table": to_x, "low": to_x.min(0), "high": to_x.max(0)}
        return pd.DataFrame({"dim": frame["dim"].iloc[:1], "block": (int(frame["cell"].iloc[0]) << 32) + int(frame["part"].iloc[0]), "longest": frame["longest"].iloc[:1]} | {c: [v.tobytes()] for c, v in out.items()})

    schema = "dim int, block long, longest double, rows binary, ids binary, x binary, table binary, low binary, high binary"
    index = vectors.join(cells, ["dim", "cell"]).select("row", "vec_id", "dim", "longest", "cell", "x", "table", part("n", BLOCK_ROWS).alias("part"))
    index = materialize(index.groupBy("dim", "cell", "part").applyInPandas(pack, schema), "topk-index")

    # Intervals of all blocks, in lots of bounded size.
    lots = -(-(index.agg(F.coalesce(F.sum(F.length("low") + F.length("high") + 16), F.lit(0))).first()[0]) // SUMMARY_BYTES)
    summaries = []
    for i in range(lots):
        lot = index.where(F.pmod(F.xxhash64("block"), F.lit(lots)) == i).select("dim", "block", "low", "high").orderBy("dim", "block").toPandas()
        by_dim = {int(d): (f["block"].to_numpy(np.int64), numbers(f, "low"), numbers(f, "high")) for d, f in lot.groupby("dim")}
        summaries.append(spark.sparkContext.broadcast(by_dim))

    asked = vectors.where(F.col("vec_id") % every == 0).join(cells, ["dim", "cell"]).withColumn("part", part("n_queries", QUERY_ROWS))
    asked = asked.select("dim", "cell", "part", "row", "vec_id", "longest", "x", "table")
    fields = {"own": np.int64, "query_ids": np.int64, "threshold": np.float64, "q": np.float64, "to_q": np.float64}

    def pack_queries(frame):
        out = {"own": frame["row"], "query_ids": frame["vec_id"], "threshold": frame["threshold"]}
        packed = {c: [v.to_numpy(fields[c]).tobytes()] for c, v in out.items()} | {"q": [b"".join(frame["x"])], "to_q": [b"".join(frame["table"])]}
        return pd.DataFrame({"dim": frame["dim"].iloc[:1], "longest": frame["longest"].iloc[:1]} | packed)

    def packs(queries: DataFrame) -> DataFrame:
        return queries.groupBy("dim", "cell", "part").applyInPandas(pack_queries, "dim int, longest double, " + ", ".join(f"{c} binary" for c in fields))

    def unpack(b: dict, i: int) -> list[np.ndarray]:
        own = np.frombuffer(b["own"][i], np.int64)
        return [own, *(np.frombuffer(b[c][i], kind) for c, kind in list(fields.items())[1:3]), *(np.frombuffer(b[c][i]).reshape(len(own), -1) for c in ("q", "to_q"))]

    def choose(summary, first: bool, all_blocks: bool = False):
        """For each pack and block, the queries that meet there: only the block of the highest bound, or all others not below the threshold."""

        def run(batches):
            for b in batches:
                for i, (dim, longest) in enumerate(zip(b["dim"], b["longest"])):
                    if dim not in summary.value:
                        continue
                    parts = unpack(b, i)
                    blocks, low, high = summary.value[dim]
                    bounds = upper(((parts[3] ** 2).sum(1) + longest)[:, None], gap(parts[4], low, high))
                    at_first = bounds.argmax(1)[:, None] == np.arange(len(blocks))[None]
                    meets = at_first if first else (bounds >= parts[2][:, None]) & (all_blocks | ~at_first)
                    for n in np.flatnonzero(meets.any(0)).tolist():
                        chosen = [p[meets[:, n]].tobytes() for p in parts]
                        yield {"dim": [dim], "block": [int(blocks[n])]} | {c: [v] for c, v in zip(fields, chosen)}

        return lambda queries: map_rows(packs(queries), run, "dim int, block long, " + ", ".join(f"{c} binary" for c in fields))

    def meet(batches):
        for b in batches:
            for i, (dim, longest) in enumerate(zip(b["dim"], b["longest"])):
                own, query_ids, threshold, q, to_q = unpack(b, i)
                rows, ids = np.frombuffer(b["rows"][i], np.int64), np.frombuffer(b["ids"][i], np.int64)
                x, to_x = (np.frombuffer(b[c][i]).reshape(len(rows), -1) for c in ("x", "table"))
                at, found, scores = search(q, own, threshold, to_q, rows, ids, x, to_x, longest, k)
                yield {"own": own[at], "query_id": query_ids[at], "vec_id": found, "score": scores}

    def met(chosen: DataFrame) -> DataFrame:
        both = index.drop("low", "high").join(chosen.hint("shuffle_hash"), ["dim", "block"])
        return map_rows(both, meet, "own long, query_id long, vec_id long, score long")

    none = F.lit(float("-inf"))
    if not summaries:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    seeded = materialize(met(choose(summaries[0], True)(asked.withColumn("threshold", none))), "topk-seeded")
    reached = seeded.groupBy("own").agg(F.count("*").alias("n"), F.min("score").alias("least"))
    # A rounded threshold must not be above the score.
    least = F.when(F.col("n") >= k, F.col("least").cast("double") - F.abs(F.col("least")) * 1e-15)
    known = asked.join(reached.hint("merge"), F.col("row") == F.col("own"), "left").withColumn("threshold", F.coalesce(least, none))
    found = seeded
    for i, summary in enumerate(summaries):
        found = found.unionAll(met(choose(summary, False, i > 0)(known)))
    order = Window.partitionBy("own", "query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
