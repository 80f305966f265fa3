"""Operator 11: exact integer k-means with PCA-rotated filtering.

The covariance of all vectors gives a rotation. Each vector is stored with its leading rotated coordinates and the norm of
the rest. For a vector and a centroid, the squared distance of the leading parts plus the squared difference of the two
residual norms is at most their squared distance. A vector meets centroids in the order of this bound, each evaluated in
integers, and stops at the first whose bound is above the best distance so far. The rotation decides speed, not results.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, map_rows, materialize
from .vector_rows import add_rows, finite, stacked, totals, whole, widened

LEADING = 24
SLACK = 1e-9  # share of the squared lengths by which a bound may err from rounding


class Rotation:
    """Mean and principal axes; splits vectors into leading coordinates and the norm of the rest."""

    def __init__(self, n: int, sums: np.ndarray, products: np.ndarray, leading: int):
        self.mean = sums / n
        _, axes = np.linalg.eigh(products / n - np.outer(self.mean, self.mean))
        self.axes, self.leading = axes[:, ::-1], leading

    def split(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Leading coordinates, residual norms, and squared lengths that rounding errors are measured by."""
        x = x.astype(np.float64)
        z = (x - self.mean) @ self.axes
        return z[:, : self.leading], np.sqrt((z[:, self.leading :] ** 2).sum(1)), (x**2).sum(1) + (self.mean**2).sum()


def nearest(x: np.ndarray, y: np.ndarray, rest: np.ndarray, size: np.ndarray, centroids: np.ndarray, rotation: Rotation) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Place of the nearest centroid (ties: the smaller), squared distance, and number of centroids evaluated, for each row."""
    lead, norm, length = rotation.split(centroids)
    bound = (y**2).sum(1)[:, None] + (lead**2).sum(1)[None] - 2 * y @ lead.T + (rest[:, None] - norm[None]) ** 2
    bound -= SLACK * (size[:, None] + length[None] + 1)
    order = np.argsort(bound, axis=1, kind="stable")
    x, centroids = widened(x, centroids)
    best = np.full(len(x), 1 << 62 if x.dtype != object else 1 << 200, x.dtype)
    at, met, open_ = np.full(len(x), len(centroids)), np.zeros(len(x), np.int64), np.arange(len(x))
    for step in range(len(centroids)):
        open_ = open_[bound[open_, order[open_, step]] <= best[open_].astype(np.float64)]
        if not len(open_):
            break
        c = order[open_, step]
        apart = ((x[open_] - centroids[c]) ** 2).sum(1)
        closer = (apart < best[open_]) | ((apart == best[open_]) & (c < at[open_]))
        best[open_[closer]], at[open_[closer]] = apart[closer], c[closer]
        met[open_] += 1
    return at, best, met


def rotated_clusters(df: DataFrame, k: int = 40, rounds: int = 5, dim: int = 64, scale: int = 256, salt: str = "2", leading: int = LEADING, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, cluster, distance (squared), cluster_inertia, inertia, centroid_sha256, n_verified (centroids met in integers).

    Vectors with exactly `dim` components take part, none of them null or non-finite, as floor(scale * component). The first
    centroids are the k rows with the smallest SHA-256 of salt:id, ties by components; fewer rows give fewer centroids. Each
    of the `rounds` rounds assigns all vectors and moves non-empty centroids to floor(sum / count); then vectors are assigned
    once more. Repeated rows and ids count each by themselves. A row without an id is clustered but is no first centroid (a
    table with such rows only gives no rows). Components of 2^53 and more, and results that leave a long, raise an
    error. An empty table gives no rows; other columns are ignored.
    """
    spark = df.sparkSession
    schema = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string, n_verified int"
    kept = df.where(finite(F.col(vector_col)) & (F.size(vector_col) == dim))
    source = kept.select(F.col(id_col).cast("long").alias("vec_id"), whole(F.col(vector_col), scale).alias("x"))
    hashed = F.sha2(F.concat(F.lit(f"{salt}:"), F.col("vec_id").cast("string")), 256)
    first = source.where("vec_id is not null").orderBy(hashed, "x").limit(k).collect()
    if not first:
        return spark.createDataFrame([], schema)
    centroids = np.array([r["x"] for r in first], np.int64)

    def moments(batches):
        """Sum and products of a task's vectors, by row of the matrix of products; the last row is the sum."""
        n, sums, products = 0, np.zeros(dim), np.zeros((dim, dim))
        for b in batches:
            x = np.array(b["x"], np.float64).reshape(-1, dim)
            n, sums, products = n + len(x), sums + x.sum(0), products + x.T @ x
        if n:
            yield {"key": list(range(dim + 1)), "n": [n] * (dim + 1), "sums": [*products.tolist(), sums.tolist()]}

    found = sorted(totals(map_rows(source, moments, "key int, n long, sums array<double>"), "key", dim, "double"), key=lambda r: r["key"])
    rotation = Rotation(found[-1]["n"], np.array(found[-1]["sums"]), np.array([r["sums"] for r in found[:-1]]), leading)

    def rotate(batches):
        for b in batches:
            x = np.array(b["x"], np.int64).reshape(-1, dim)
            lead, rest, size = rotation.split(x)
            yield {"vec_id": b["vec_id"], "x": [v.tobytes() for v in x], "lead": [v.tobytes() for v in lead], "rest": rest, "size": size}

    vectors = materialize(map_rows(source, rotate, "vec_id long, x binary, lead binary, rest double, size double"), "clusters-vectors")

    def assigned(centroids: np.ndarray, b: dict):
        x = stacked(b["x"])
        return x, *nearest(x, stacked(b["lead"], np.float64), np.array(b["rest"]), np.array(b["size"]), centroids, rotation)

    def moved(centroids: np.ndarray):
        def run(batches):
            """Count and sum of a task's vectors by cluster."""
            n, sums = np.zeros(len(centroids), np.int64), np.zeros(centroids.shape, np.int64)
            for b in batches:
                x, at, _, _ = assigned(centroids, b)
                np.add.at(n, at, 1)
                sums = add_rows(sums, at, x)
            held = np.flatnonzero(n)
            yield {"key": held, "n": n[held], "sums": sums[held].tolist()}

        return run

    for _ in range(rounds):
        centroids = centroids.copy()
        for r in totals(map_rows(vectors.drop("vec_id"), moved(centroids), "key int, n long, sums array<long>"), "key", dim):
            centroids[r["key"]] = [s // r["n"] for s in r["sums"]]

    def label(batches):
        for b in batches:
            _, at, apart, met = assigned(centroids, b)
            yield {"vec_id": b["vec_id"], "cluster": at, "distance": apart.tolist(), "n_verified": met}

    out = materialize(map_rows(vectors, label, "vec_id long, cluster int, distance long, n_verified int"), "clusters-assigned")
    discard(vectors)
    sums = {r["cluster"]: int(r["inertia"]) for r in out.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("inertia")).collect()}
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    # One row a cluster, at most k.
    rows = [(c, s, sum(sums.values()), digests[c]) for c, s in sums.items()]
    known = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return out.join(F.broadcast(known), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256", "n_verified")
