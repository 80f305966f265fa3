"""Rows of vectors for the operators on the embeddings table: whole numbers, packed bytes, exact sums."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EXACT = 2.0**53
NARROW = 1 << 23  # below it sums of squared differences of 16,384 components stay inside a long
TOO_LARGE = "a component leaves the whole numbers that a double holds exactly"


def finite(vector: Column) -> Column:
    """Whether a vector is not null and holds no null or non-finite component."""
    x = vector.cast("array<double>")
    return vector.isNotNull() & F.coalesce(F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))), F.lit(False))


def whole(vector: Column, scale: int) -> Column:
    """floor(scale * component) as longs; components beyond 2^53 raise an error."""
    scaled = F.transform(vector.cast("array<double>"), lambda v: v * scale)
    return F.transform(scaled, lambda v: F.when(F.abs(v) < EXACT, F.floor(v)).otherwise(F.raise_error(F.lit(TOO_LARGE)).cast("long")))


def stacked(values: list[bytes], kind=np.int64) -> np.ndarray:
    """Packed vectors of one length as the rows of a matrix."""
    return np.frombuffer(b"".join(values), kind).reshape(len(values), -1)


def widened(x: np.ndarray, *others: np.ndarray) -> tuple[np.ndarray, ...]:
    """Whole numbers as they are if squares of their differences stay inside a long, else as Python's, of any size."""
    large = any(v.size and max(int(v.max()), -int(v.min())) >= NARROW for v in (x, *others))
    return tuple(v.astype(object) if large else v for v in (x, *others))


def add_rows(sums: np.ndarray, at: np.ndarray, x: np.ndarray) -> np.ndarray:
    """sums with each row of x added at its place; of Python's whole numbers from components of 2^31 on, so that nothing wraps."""
    if sums.dtype == object or (x.size and max(int(x.max()), -int(x.min())) >= 1 << 31):
        sums, x = sums.astype(object), x.astype(object)
    np.add.at(sums, at, x)
    return sums


def totals(parts: DataFrame, key: str, width: int, kind: str = "decimal(38,0)") -> list[dict]:
    """key, n and sums added up over the rows that tasks made; collects one row for each key, of which there are few by design."""
    added = [F.sum(F.col("sums")[i].cast(kind)).alias(f"s{i}") for i in range(width)]
    rows = parts.groupBy(key).agg(F.sum("n").alias("n"), *added).collect()
    number = int if kind.startswith("decimal") else float
    return [{key: r[key], "n": r["n"], "sums": [number(r[f"s{i}"]) for i in range(width)]} for r in rows]
