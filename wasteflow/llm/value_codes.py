"""Operator 12: product codes of integer vectors by value dictionaries of each dimension.

Every dimension has a dictionary of the distinct integers that occur in it, and vectors are stored as places in these
dictionaries. In each round a task tabulates, for each dimension, the squared differences of every distinct integer to the
dimension's component of all entries; distances of a part are then sums of table rows gathered by the stored codes. The
tables are bounded: dimensions are taken from the smallest dictionary on while their tables fit TABLE_BYTES. The components
of the others, and of dimensions with integers of NARROW and more, stay integers whose differences are squared directly,
with the same results.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_BYTES, discard, map_rows, materialize
from .vector_rows import NARROW, add_rows, finite, totals, whole, widened

TABLE_BYTES = 96 << 20  # squared differences that a task keeps at most
FLUSH = 1 << 20  # distinct values that a task gathers before it sends them on


def main_dim(sizes: DataFrame, parts: int) -> int | None:
    """The most frequent number of components that can be cut into equal parts, the larger one at ties."""
    found = sizes.where((F.col("dim") > 0) & (F.col("dim") % parts == 0)).groupBy("dim").count().orderBy(F.desc("count"), F.desc("dim")).first()
    return found["dim"] if found else None


class Tables:
    """Squared differences of all dictionary values to the entries of their part, and distances by gathers from them."""

    def __init__(self, codebooks: np.ndarray, dictionaries: dict[int, np.ndarray], rest: list[int]):
        self.codebooks, self.rest = codebooks, rest
        self.width = codebooks.shape[2]
        self.dims = list(dictionaries)
        self.values, self.squares = [], []
        for d, values in dictionaries.items():
            self.values.append(values)
            self.squares.append((values[:, None] - codebooks[d // self.width, :, d % self.width][None]) ** 2)

    def distances(self, codes: np.ndarray, raw: np.ndarray) -> np.ndarray:
        """[part, row, entry]: sums of gathered table rows, and of squares for the dimensions without a table."""
        out = np.zeros((len(self.codebooks), len(codes), self.codebooks.shape[1]), np.int64)
        for i, d in enumerate(self.dims):
            out[d // self.width] += self.squares[i][codes[:, i]]
        for i, d in enumerate(self.rest):
            v, entries = widened(raw[:, i], self.codebooks[d // self.width, :, d % self.width])
            squares = (v[:, None] - entries[None]) ** 2
            if squares.dtype == object and out.dtype != object:
                out = out.astype(object)
            out[d // self.width] += squares
        return out

    def components(self, codes: np.ndarray, raw: np.ndarray) -> np.ndarray:
        """The vectors again."""
        out = np.zeros((len(codes), len(self.dims) + len(self.rest)), np.int64)
        for i, d in enumerate(self.dims):
            out[:, d] = self.values[i][codes[:, i]]
        out[:, self.rest] = raw
        return out


def vector_codes(df: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", table_bytes: int = TABLE_BYTES) -> DataFrame:
    """vec_id, code (two hex digits a part), error, label_error, codebooks_sha256.

    Vectors without null or non-finite components take part as floor(scale * component), those of the most frequent length
    that is a multiple of `parts` (ties: the longer); vectors of other lengths have no codes. Codebooks start with the
    parts of the `entries` rows with the smallest ids, ties by components, rows without an id left out; fewer rows give
    fewer entries. Each of the `rounds` rounds assigns all parts to the nearest entries (ties: the first) and moves used
    entries to floor(sum / count); then parts are assigned again. Repeated rows and ids count each by themselves; rows
    without an id are coded, unless no row has one, which gives no rows. Null labels are one label. Components of 2^53 and
    more, and results that leave a long, raise an error. An empty table gives no rows; other columns are ignored.
    """
    spark = df.sparkSession
    schema = "vec_id long, code string, error long, label_error long, codebooks_sha256 string"
    kept = df.where(finite(F.col(vector_col)))
    dim = main_dim(kept.select(F.size(vector_col).alias("dim")), parts)
    if dim is None:
        return spark.createDataFrame([], schema)
    if entries > 256:
        raise ValueError("a code has two hex digits a part: at most 256 entries")
    source = kept.where(F.size(vector_col) == dim).select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"), whole(F.col(vector_col), scale).alias("x"))
    first = source.where("vec_id is not null").select("vec_id", "x").orderBy("vec_id", "x").limit(entries).collect()
    if not first:
        return spark.createDataFrame([], schema)
    width = dim // parts
    codebooks = np.array([r["x"] for r in first], np.int64).reshape(len(first), parts, width).transpose(1, 0, 2)

    def distinct(batches):
        """The distinct values of a task, by dimension; sent on before they are too many."""
        held: list[set[int]] = [set() for _ in range(dim)]

        def sent():
            out = {"d": [d for d, s in enumerate(held) if s], "values": [list(s) for s in held if s]}
            for s in held:
                s.clear()
            return out

        for b in batches:
            x = np.array(b["x"], np.int64).reshape(-1, dim)
            for d in range(dim):
                held[d].update(np.unique(x[:, d]).tolist())
            if sum(map(len, held)) > FLUSH:
                yield sent()
        yield sent()

    values = map_rows(source.select("x"), distinct, "d int, values array<long>").select("d", F.explode("values").alias("value")).distinct()
    values = materialize(values, "codes-values")
    narrow = F.max(F.greatest("value", -F.col("value"))) < NARROW
    counts = {r["d"]: r["n"] for r in values.groupBy("d").agg(F.count("*").alias("n"), narrow.alias("narrow")).where("narrow").collect()}
    tabled, used = [], 0
    for d in sorted(counts, key=lambda d: (counts[d], d)):
        used += counts[d] * (len(first) + 1) * 8
        if used > table_bytes:
            break
        tabled.append(d)
    tabled.sort()
    rest = sorted(set(range(dim)) - set(tabled))
    # Only dictionaries whose tables fit are collected, so their size is known.
    found: dict[int, list[int]] = {d: [] for d in tabled}
    for r in values.where(F.col("d").isin(tabled)).toLocalIterator():
        found[r["d"]].append(r["value"])
    shared = spark.sparkContext.broadcast({d: np.array(sorted(v), np.int64) for d, v in found.items()})

    def encode(batches):
        for b in batches:
            x = np.array(b["x"], np.int64).reshape(-1, dim)
            codes = np.stack([np.searchsorted(v, x[:, d]) for d, v in shared.value.items()], 1).astype(np.int32) if tabled else np.zeros((len(x), 0), np.int32)
            yield {"vec_id": b["vec_id"], "label": b["label"], "codes": [v.tobytes() for v in codes], "raw": [v.tobytes() for v in x[:, rest]]}

    label_type = dict(source.dtypes)["label"]
    vectors = materialize(map_rows(source, encode, f"vec_id long, label {label_type}, codes binary, raw binary"), "codes-vectors")

    def unpacked(b: dict) -> tuple[np.ndarray, np.ndarray]:
        n = len(b["codes"])
        return np.frombuffer(b"".join(b["codes"]), np.int32).reshape(n, len(tabled)), np.frombuffer(b"".join(b["raw"]), np.int64).reshape(n, len(rest))

    def moved(codebooks: np.ndarray):
        def run(batches):
            """Count and sum of a task's parts by part and entry."""
            tables = Tables(codebooks, shared.value, rest)
            n, sums = np.zeros(codebooks.shape[:2], np.int64), list(np.zeros(codebooks.shape, np.int64))
            for b in batches:
                codes, raw = unpacked(b)
                at, x = tables.distances(codes, raw).argmin(2), tables.components(codes, raw)
                for p in range(parts):
                    np.add.at(n[p], at[p], 1)
                    sums[p] = add_rows(sums[p], at[p], x[:, p * width : (p + 1) * width])
            held = np.flatnonzero(n.ravel())
            yield {"key": held, "n": n.ravel()[held], "sums": np.concatenate(sums)[held].tolist()}

        return run

    for _ in range(rounds):
        codebooks = codebooks.copy()
        for r in totals(map_rows(vectors.select("codes", "raw"), moved(codebooks), "key int, n long, sums array<long>"), "key", width):
            codebooks[divmod(r["key"], len(first))] = [s // r["n"] for s in r["sums"]]

    def coded(batches):
        tables = Tables(codebooks, shared.value, rest)
        for b in batches:
            apart = tables.distances(*unpacked(b))
            at = apart.argmin(2)
            error = np.take_along_axis(apart, at[:, :, None], 2)[:, :, 0].sum(0)
            yield {"vec_id": b["vec_id"], "label": b["label"], "code": [c.tobytes().hex() for c in at.T.astype(np.uint8)], "error": error.tolist()}

    out = materialize(map_rows(vectors, coded, f"vec_id long, label {label_type}, code string, error long"), "codes-coded")
    by_label = materialize(out.groupBy("label").agg(F.sum("error").alias("label_error")), "codes-labels")
    discard(values, vectors)
    digest = hashlib.sha256(",".join(map(str, codebooks.ravel().tolist())).encode()).hexdigest()
    return with_label_error(out, by_label).select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def with_label_error(rows: DataFrame, by_label: DataFrame) -> DataFrame:
    """rows with the sum of their label, which is broadcast where the labels are few by bytes, else met by a merge join."""
    named = by_label.select(F.col("label").alias("known"), "label_error")
    size = by_label.agg(F.sum(F.coalesce(F.length(F.col("label").cast("string")), F.lit(0)) + 24)).first()[0]
    named = F.broadcast(named) if (size or 0) <= BROADCAST_BYTES else named.hint("merge")
    return rows.join(named, F.col("label").eqNullSafe(F.col("known")))
