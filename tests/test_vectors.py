"""Cosine search in blocks."""

import math
import random
from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pytest

import __spark_entry__ as entry
from wasteflow.operators import vectors as V

SF = "/root/testdata/sf0.001"


def wanted(rows, k, every):
    """Each query's k best by plain loops."""
    rows = [(i, [float(np.float32(c)) for c in x]) for i, x in rows if i is not None and x and None not in x and any(c != 0 for c in x)]
    dot = lambda a, b: sum(p * q for p, q in zip(a, b))
    out = []
    for i, x in rows:
        if i % every:
            continue
        found = []
        for j, y in rows:
            if i != j and len(x) == len(y):
                s = dot(x, y) / (math.sqrt(dot(x, x)) * math.sqrt(dot(y, y)))
                found.append((-math.inf if math.isnan(s) else -float(Decimal(repr(s)).quantize(Decimal("1e-9"), ROUND_HALF_UP)), j))
        out += [(i, rank, j, -s) for rank, (s, j) in enumerate(sorted(found)[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("small", [False, True])
def test_nearest_equal_plain_loops(spark, monkeypatch, small):
    """Copies, ties, and odd vectors; the same with small lots and blocks."""
    if small:
        for name, value in {"LOT_BYTES": 2000, "QUERY_ROWS": 3, "VECTOR_ROWS": 5, "PAIR_BYTES": 64}.items():
            monkeypatch.setattr(V, name, value)
    rng = random.Random(1)
    some = [[rng.gauss(0, 1) for _ in range(8)] for _ in range(60)]
    rows = [(i, some[i % 60] if i % 3 else [1.0, 2.0] * 4) for i in range(300)] + [(i, [float(rng.randint(-1, 1)) for _ in range(3)]) for i in range(300, 400)]
    rows += [(400, None), (410, []), (420, [0.0] * 8), (430, [None] + [1.0] * 7), (None, [1.0] * 8), (441, [math.nan] + [1.0] * 7), (450, [math.inf] + [1.0] * 7), (460, [1e30] * 8), (470, [1e-30] * 8), (480, [5.0] * 9)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = V.cosine_topk(df, df.where("vec_id % 10 = 0"), 4).select("query_id", "rank", "id", "similarity").collect()
    assert sorted((*r[:3], math.inf if math.isnan(r[3]) else r[3]) for r in got) == wanted(rows, 4, 10)


def test_ids_may_be_strings(spark):
    df = spark.createDataFrame([("b", [1.0, 0.0]), ("c", [1.0, 0.0]), ("a", [1.0, 1.0])], "vec_id string, embedding array<double>")
    got = V.cosine_topk(df, df.where("vec_id = 'a'"), 5).orderBy("rank").collect()
    assert [(r["id"], r["similarity"]) for r in got] == [("b", 0.707106781), ("c", 0.707106781)]


def test_rounds_as_spark_does(spark):
    values = [0.1234567885, -0.1234567885, 0.1234567875, 5e-10, -4e-10, 1.0, 0.9999999995, 0.49999999949999, 1 / 3]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(values)], "i int, x double").selectExpr("round(x, 9) AS r").collect()
    assert V.rounded(np.array(values)).tolist() == [r["r"] for r in df]


@pytest.mark.parametrize("name", ["l1_cosine_topk", "l2_search_filtered"])
def test_pairs_are_no_rows(spark, name):
    """Before, a join made a row of each pair of a query and a vector, and a window sorted them."""
    assert "Join" not in entry.queries()[name](spark, SF)._jdf.queryExecution().analyzed().toString()
