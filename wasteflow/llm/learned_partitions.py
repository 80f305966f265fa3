"""Operator 13: approximate nearest neighbours by learned partitions.

On a bounded sample the exact neighbour graph is built and cut into balanced parts that few edges cross. A small classifier
learns, from a vector, how its neighbours are dealt over the parts. It then puts every row of the table into its most
probable part, and routes a query to its most probable parts until their probabilities add up to a share; rows there are
ranked by exact cosines. The share is the least that reaches the target recall on sample rows which the classifier did not
see. Rows lie in blocks of bounded size by part, written once; queries meet them in lots of bounded bytes.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, map_rows, materialize
from .vector_rows import finite, stacked

SAMPLE, SAMPLE_BYTES = 6000, 64 << 20  # rows that the index is fitted on at most, and their size
PARTS = 32
LEAST_ROWS = 40  # sample rows of a part at least
NEIGHBOURS = 10
HIDDEN = 128
EPOCHS = 60
TARGET = 0.96  # recall on held-out sample rows that the routed share is chosen for
SHARES = (0.5, 0.6, 0.7, 0.75, 0.8, 0.85, 0.9, 0.93, 0.95, 0.97, 0.98, 0.99, 0.995, 0.998, 1.0)
BLOCK_ROWS = 1024
PACK_ROWS = 512
LOT_BYTES = 32 << 20  # routed queries that are broadcast at once
FEW_PARTS = 200_000  # rows of a dozen bytes that are broadcast at most
PAIRS = 1 << 14  # candidates that are scored again at once


def lengths(x: np.ndarray) -> np.ndarray:
    return np.sqrt((x**2).sum(1))


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows times powers of two: cosines stay as they are, and squares of very large and very small components finite."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(1))[1][:, None])


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """[row, k]: the k nearest other rows by cosine, by blocks of rows."""
    unit = x / lengths(x)[:, None]
    out = []
    for at in range(0, len(x), 1024):
        near = unit[at : at + 1024] @ unit.T
        near[np.arange(len(near)), np.arange(at, at + len(near))] = -np.inf
        out.append(np.argpartition(-near, min(k, len(x) - 1) - 1, axis=1)[:, : min(k, len(x) - 1)])
    return np.concatenate(out)


def bisect(near: np.ndarray, rows: np.ndarray, left: int, rng: np.random.Generator) -> np.ndarray:
    """Side (False: one of `left` rows) of each of the rows: an ordering by smoothing over the graph, then swaps that cut fewer edges."""
    place = np.full(len(near), -1)
    place[rows] = np.arange(len(rows))
    ends = place[near[rows]]
    a, b = np.repeat(np.arange(len(rows)), near.shape[1]), ends.ravel()
    a, b = a[b >= 0], b[b >= 0]
    a, b = np.concatenate([a, b]), np.concatenate([b, a])
    degree = np.bincount(a, minlength=len(rows)) + 1.0
    v = rng.standard_normal(len(rows))
    for _ in range(60):
        v -= (v * degree).sum() / degree.sum()
        v = (v + (np.bincount(a, v[b], len(rows)) + v) / degree) / 2
        v /= np.sqrt((v**2).sum()) or 1
    side = np.ones(len(rows), bool)
    side[np.argsort(v, kind="stable")[:left]] = False
    for _ in range(20):
        # Edges that a row would mend by changing sides; the best of both sides change places, so sizes stay.
        across = np.bincount(a, side[a] != side[b], len(rows))
        gain = 2 * across - (degree - 1)
        one, two = (np.flatnonzero(side == s) for s in (False, True))
        one, two = one[np.argsort(-gain[one], kind="stable")], two[np.argsort(-gain[two], kind="stable")]
        n = min(len(one), len(two))
        better = np.flatnonzero(gain[one[:n]] + gain[two[:n]] > 2)[: max(1, n // 20)]
        if not len(better):
            break
        changed = side.copy()
        changed[one[better]], changed[two[better]] = True, False
        if (changed[a] != changed[b]).sum() >= (side[a] != side[b]).sum():
            break
        side = changed
    return side


def balanced_parts(near: np.ndarray, n: int, rng: np.random.Generator) -> np.ndarray:
    """Part of each row: repeated bisection into n parts whose sizes differ by rounding only."""
    part = np.zeros(len(near), np.int64)
    todo = [(np.arange(len(near)), 0, n)]
    while todo:
        rows, first, count = todo.pop()
        if count == 1:
            part[rows] = first
            continue
        half = count // 2
        side = bisect(near, rows, len(rows) * half // count, rng)
        todo += [(rows[~side], first, half), (rows[side], first + half, count - half)]
    return part


class Classifier:
    """One hidden layer over unit vectors; gives probabilities of the parts."""

    def __init__(self, x: np.ndarray, wanted: np.ndarray, rng: np.random.Generator, hidden: int = HIDDEN, epochs: int = EPOCHS):
        x = self.inputs(x)
        sizes = ((x.shape[1], hidden), (hidden,), (hidden, wanted.shape[1]), (wanted.shape[1],))
        self.weights = [rng.standard_normal(s) * np.sqrt(2 / s[0]) if len(s) == 2 else np.zeros(s) for s in sizes]
        first, second = ([np.zeros_like(w) for w in self.weights] for _ in range(2))
        steps, batch = 0, 128
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for at in range(0, len(x), batch):
                own = order[at : at + batch]
                inner = self.inner(x[own])
                off = (self.softmax(inner @ self.weights[2] + self.weights[3]) - wanted[own]) / len(own)
                back = (off @ self.weights[2].T) * (inner > 0)
                grads = (x[own].T @ back, back.sum(0), inner.T @ off, off.sum(0))
                steps += 1
                for w, g, m, s in zip(self.weights, grads, first, second):
                    g = g + 1e-4 * w
                    m += 0.1 * (g - m)
                    s += 0.001 * (g * g - s)
                    w -= 0.003 * (m / (1 - 0.9**steps)) / (np.sqrt(s / (1 - 0.999**steps)) + 1e-8)

    @staticmethod
    def inputs(x: np.ndarray) -> np.ndarray:
        return x / lengths(x)[:, None] * np.sqrt(x.shape[1])

    @staticmethod
    def softmax(z: np.ndarray) -> np.ndarray:
        e = np.exp(z - z.max(1, keepdims=True))
        return e / e.sum(1, keepdims=True)

    def inner(self, x: np.ndarray) -> np.ndarray:
        return np.maximum(x @ self.weights[0] + self.weights[1], 0)

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return self.softmax(self.inner(self.inputs(x)) @ self.weights[2] + self.weights[3])


def routed(probabilities: np.ndarray, share: float) -> np.ndarray:
    """[row, part]: the most probable parts up to the one at which their sum reaches the share, two at least."""
    order = np.argsort(-probabilities, axis=1, kind="stable")
    ranked = np.take_along_axis(probabilities, order, 1)
    before = np.cumsum(ranked, 1) - ranked
    chosen = (before < share) | (np.arange(probabilities.shape[1])[None] < 2) | (share >= 1)
    out = np.zeros_like(chosen)
    np.put_along_axis(out, order, chosen, 1)
    return out


class Index:
    """Classifier and routed share fitted on a sample of rows of one length."""

    def __init__(self, x: np.ndarray, k: int, target: float, n_parts: int = PARTS, seed: int = 13):
        rng = np.random.default_rng(seed)
        n = min(n_parts, len(x) // LEAST_ROWS)
        self.classifier, self.share, self.n = None, 1.0, max(n, 1)
        if n < 2:
            return
        # A quarter is held out: the classifier never sees it, and it says how far queries must be routed.
        mixed = rng.permutation(len(x))
        seen, held = x[mixed[len(x) // 4 :]], x[mixed[: len(x) // 4]]
        near = neighbour_graph(seen, NEIGHBOURS)
        part = balanced_parts(near, n, rng)
        wanted = np.zeros((len(seen), n))
        np.add.at(wanted, (np.arange(len(seen))[:, None], part[near]), 1 / (near.shape[1] + 1))
        wanted[np.arange(len(seen)), part] += 1 / (near.shape[1] + 1)
        self.classifier = Classifier(seen, wanted, rng)
        placed = self.part(seen)
        unit = held / lengths(held)[:, None] @ (seen / lengths(seen)[:, None]).T
        true = np.argpartition(-unit, min(k, len(seen)) - 1, axis=1)[:, :k]
        found = self.classifier.probabilities(held)
        for share in SHARES:
            self.share = share
            if np.take_along_axis(routed(found, share), placed[true], 1).mean() >= target:
                break

    def part(self, x: np.ndarray) -> np.ndarray:
        return self.classifier.probabilities(x).argmax(1) if self.classifier else np.zeros(len(x), np.int64)

    def route(self, x: np.ndarray) -> np.ndarray:
        return routed(self.classifier.probabilities(x), self.share) if self.classifier else np.ones((len(x), 1), bool)


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k highest scores of each row, ties to smaller ids."""
    order = np.lexsort((ids, -scores), axis=1)[:, :k]
    return np.take_along_axis(scores, order, 1), np.take_along_axis(ids, order, 1)


def candidates(q: np.ndarray, own: np.ndarray, x: np.ndarray, rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of (query, row) places that can be among a query's k best of this block: all but those clearly below the k-th."""
    near = q @ x.T / lengths(q)[:, None] / lengths(x)[None]
    near[own[:, None] == rows[None]] = -np.inf
    n = min(k, len(x))
    least = np.partition(near, len(x) - n, axis=1)[:, len(x) - n]
    return np.nonzero((near >= least[:, None] - 1e-9) & (near > -np.inf))


def cosines(q: np.ndarray, x: np.ndarray, at: np.ndarray, to: np.ndarray) -> np.ndarray:
    """Cosines of pairs; unlike a product of matrices, equal vectors give equal numbers wherever they stand."""
    out = np.zeros(len(at))
    of_q, of_x = lengths(q), lengths(x)
    for i in range(0, len(at), PAIRS):
        a, b = at[i : i + PAIRS], to[i : i + PAIRS]
        out[i : i + PAIRS] = (q[a] * x[b]).sum(1) / (of_q[a] * of_x[b])
    return out


def approximate_neighbours(df: DataFrame, k: int = 5, every: int = 50, target: float = TARGET, n_parts: int = PARTS, id_col: str = "vec_id", vector_col: str = "embedding", lot_bytes: int = LOT_BYTES) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: each query's k nearest found by cosine, ties to smaller ids.

    Queries are the rows whose id is divisible by `every`; candidates are all other rows with as many components, rows that
    share an id included. Rows without an id and vectors that are null, empty, zero or hold null or non-finite components
    take no part. A query gets all candidates if they are fewer than k and lie in its parts (with under 2 * LEAST_ROWS rows
    of its length in the sample there is one part: the search is exact). Repeated queries get rows each. The index is fitted
    on at most SAMPLE rows, chosen by a hash of id and vector; all rows are indexed. An empty table gives no rows; other
    columns are ignored.
    """
    spark = df.sparkSession
    schema = "query_id long, rank int, vec_id long, score double"
    x = F.col(vector_col).cast("array<double>")
    kept = df.where(finite(F.col(vector_col)) & F.col(id_col).isNotNull() & F.exists(x, lambda v: v != 0))
    source = kept.select(F.col(id_col).cast("long").alias("vec_id"), x.alias("x"), F.size(x).alias("dim"))
    longest = source.agg(F.max("dim")).first()[0] or 1
    sample = source.orderBy(F.xxhash64("vec_id", "x"), "vec_id", "x").limit(min(SAMPLE, max(LEAST_ROWS, SAMPLE_BYTES // (32 * longest)))).select("x", "dim").collect()
    if not sample:
        return spark.createDataFrame([], schema)
    by_dim = {d: scaled(np.array([r["x"] for r in sample if r["dim"] == d])) for d in {r["dim"] for r in sample}}
    shared = spark.sparkContext.broadcast({d: Index(rows, k, target, n_parts) for d, rows in by_dim.items()})
    one_part = Index(np.zeros((0, 1)), k, target)  # for lengths that the sample missed

    def place(batches):
        for b in batches:
            dims = np.array(b["dim"])
            for dim in np.unique(dims).tolist():
                own = np.flatnonzero(dims == dim).tolist()
                x = scaled(np.array([b["x"][i] for i in own], np.float64))
                index = shared.value.get(dim, one_part)
                ids = np.array([b["vec_id"][i] for i in own], np.int64)
                routes: list = [None] * len(own)
                asked = np.flatnonzero(ids % every == 0)
                if len(asked):
                    for i, r in zip(asked.tolist(), index.route(x[asked])):
                        routes[i] = np.flatnonzero(r).tolist()
                yield {"vec_id": ids, "dim": [dim] * len(own), "part": index.part(x), "x": [v.tobytes() for v in x], "routes": routes}

    placed = map_rows(source, place, "vec_id long, dim int, part int, x binary, routes array<int>")
    placed = materialize(placed.withColumn("row", F.monotonically_increasing_id()), "neighbours-rows")

    # Rows of a part are dealt into blocks by a hash, so that no part, however large, is one group.
    sizes = counted(placed)
    block = F.pmod(F.xxhash64("row"), F.ceil(F.col("n") / BLOCK_ROWS)).cast("int").alias("block")
    dealt = placed.drop("routes").join(sizes, ["dim", "part"]).select("dim", "part", "row", "vec_id", "x", block)
    packed = dealt.groupBy("dim", "part", "block").agg(F.collect_list(F.struct("row", "vec_id", "x")).alias("rows"))
    index = materialize(packed.select("dim", "part", F.col("rows.row").alias("rows"), F.col("rows.vec_id").alias("ids"), F.col("rows.x").alias("xs")), "neighbours-index")

    # Queries of a lot, with all their routes, are of bounded size; the queries of a part lie in packs.
    asked = placed.where(F.col("routes").isNotNull())
    n_lots = max(1, -(-asked.agg(F.coalesce(F.sum(F.size("routes") * (F.length("x") + 64)), F.lit(0))).first()[0] // lot_bytes))
    routes = asked.select("dim", "row", "vec_id", "x", F.explode("routes").alias("part"))
    sizes = counted(routes)
    pack = F.pmod(F.xxhash64("row", F.lit("pack")), F.ceil(F.col("n") / (n_lots * PACK_ROWS))).cast("int").alias("pack")
    lot = F.pmod(F.xxhash64("row", F.lit("lot")), F.lit(n_lots)).cast("int").alias("lot")
    packs = routes.join(sizes, ["dim", "part"]).select("dim", "part", pack, lot, F.struct("row", "vec_id", "x").alias("q"))
    packs = packs.groupBy("lot", "dim", "part", "pack").agg(F.collect_list("q").alias("q"))
    packs = materialize(packs.select("lot", "dim", "part", "pack", F.col("q.row").alias("own"), F.col("q.vec_id").alias("query_ids"), F.col("q.x").alias("qs")), "neighbours-queries")
    discard(placed)

    def meet(batches):
        """A task's best so far of every query that it has met."""
        held: dict[tuple, tuple[np.ndarray, ...]] = {}
        for b in batches:
            for i, dim in enumerate(b["dim"]):
                own, q = np.array(b["own"][i], np.int64), stacked(b["qs"][i], np.float64)
                rows, ids, x = np.array(b["rows"][i], np.int64), np.array(b["ids"][i], np.int64), stacked(b["xs"][i], np.float64)
                at, to = candidates(q, own, x, rows, k)
                score = cosines(q, x, at, to)
                order = np.lexsort((ids[to], -score, at))
                at, to, score = at[order], to[order], score[order]
                first = np.searchsorted(at, at)
                keep = np.arange(len(at)) - first < k
                column = (np.arange(len(at)) - first)[keep]
                scores, found = np.full((len(q), k), -np.inf), np.zeros((len(q), k), np.int64)
                scores[at[keep], column], found[at[keep], column] = score[keep], ids[to[keep]]
                key = (dim, b["part"][i], b["pack"][i])
                if key in held:
                    _, _, s, f = held[key]
                    scores, found = best(np.concatenate([s, scores], 1), np.concatenate([f, found], 1), k)
                held[key] = (own, np.array(b["query_ids"][i], np.int64), scores, found)
        for own, query_ids, scores, found in held.values():
            at, column = np.nonzero(scores > -np.inf)
            yield {"own": own[at], "query_id": query_ids[at], "vec_id": found[at, column], "score": scores[at, column]}

    def met(lot: int) -> DataFrame:
        # Blocks stay where they are; the lot's size is known.
        both = index.join(F.broadcast(packs.where(F.col("lot") == lot).drop("lot")), ["dim", "part"])
        return map_rows(both, meet, "own long, query_id long, vec_id long, score double")

    found = reduce(DataFrame.unionAll, [met(i) for i in range(n_lots)])
    order = Window.partitionBy("own", "query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def counted(rows: DataFrame) -> DataFrame:
    """n of each (dim, part): as many rows as lengths times parts; broadcast if they are few."""
    sizes = materialize(rows.groupBy("dim", "part").agg(F.count("*").alias("n")), "neighbours-sizes")
    return F.broadcast(sizes) if sizes.count() <= FEW_PARTS else sizes.hint("merge")
