"""Clustering, codes and approximate neighbours against brute force, with the vectors that tables may hold."""

import hashlib
import math

import duckdb
import numpy as np
import pytest

from wasteflow.llm import learned_partitions, queries, rotated_kmeans, value_codes

# The last columns clash with names that operators use.
SCHEMA = "vec_id long, embedding array<double>, label int, x int, row string, cluster string, part int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, label, 1, "a", "b", 2) for i, v, label in rows], SCHEMA)


def vectors(n, dim=64, seed=5):
    """Clustered vectors, copies of one of them (a third of all), and rows that take no part or only in some operators."""
    rng = np.random.default_rng(seed)
    middle = rng.normal(0, 0.4, (6, dim))
    rows = [(i, (middle[i % 6] + rng.normal(0, 0.2, dim)).tolist(), i % 4 if i % 7 else None) for i in range(n)]
    rows = [(i, rows[3][1] if i % 3 == 0 else v, label) for i, v, label in rows]
    odd = [None, [], [0.5] * 3, [math.nan] + [0.1] * (dim - 1), [math.inf] + [0.1] * (dim - 1), [None] + [0.1] * (dim - 1), [0.0] * dim]
    return [*rows, rows[1], rows[50], *[(1000 + 50 * n, v, 1) for n, v in enumerate(odd)], (None, rows[2][1], 2)]


def clusters(rows, k, rounds, dim=64):
    kept = [(i, [math.floor(256 * c) for c in v]) for i, v, _ in rows if v is not None and len(v) == dim and all(c is not None and math.isfinite(c) for c in v)]
    order = sorted((hashlib.sha256(f"2:{i}".encode()).hexdigest(), x) for i, x in kept if i is not None)
    centroids = [x for _, x in order[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(x, c)), n) for n, c in enumerate(centroids)) for _, x in kept]

    for _ in range(rounds):
        at = assign()
        for n in range(len(centroids)):
            own = [x for (_, x), (_, c) in zip(kept, at) if c == n]
            if own:
                centroids[n] = [sum(c) // len(own) for c in zip(*own)]
    at = assign()
    per = {n: sum(d for d, c in at if c == n) for n in range(len(centroids))}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, c, d, per[c], sum(per.values()), digest[c]) for (i, _), (d, c) in zip(kept, at)), key=str)


@pytest.mark.parametrize("k, n", [(40, 150), (8, 150), (40, 20)])
def test_clusters(spark, k, n):
    rows = vectors(max(n, 51))[: n if n < 51 else None]
    out = rotated_kmeans.rotated_clusters(table(spark, rows).repartition(3), k=k).collect()
    assert sorted((tuple(r)[:6] for r in out), key=str) == clusters(rows, k, 5)
    assert all(1 <= r["n_verified"] <= k for r in out)


def test_cluster_bounds_leave_centroids_out(spark):
    """On clustered vectors most centroids are never met; on large components results stay exact."""
    rng = np.random.default_rng(1)
    middle = rng.normal(0, 3, (10, 64))
    rows = [(i, (middle[i % 10] + rng.normal(0, 0.1, 64)).tolist(), 0) for i in range(200)]
    out = rotated_kmeans.rotated_clusters(table(spark, rows), k=10).collect()
    assert sum(r["n_verified"] for r in out) < 3 * len(out)
    rows = [(i, (rng.normal(0, 1, 64) * 10.0**5).tolist(), 0) for i in range(30)]
    out = rotated_kmeans.rotated_clusters(table(spark, rows), k=5).collect()
    assert sorted((tuple(r)[:6] for r in out), key=str) == clusters(rows, 5, 5)


def codes(rows, dim=64, parts=8, entries=16, rounds=6):
    kept = [(i, [math.floor(4096 * c) for c in v], label) for i, v, label in rows if v is not None and len(v) == dim and all(c is not None and math.isfinite(c) for c in v)]
    first = sorted((i, x) for i, x, _ in kept if i is not None)[:entries]
    w = dim // parts
    books = [[x[p * w : p * w + w] for _, x in first] for p in range(parts)]

    def assign():
        return [[min((sum((a - b) ** 2 for a, b in zip(x[p * w : p * w + w], e)), n) for n, e in enumerate(books[p])) for p in range(parts)] for _, x, _ in kept]

    for _ in range(rounds):
        at = assign()
        for p in range(parts):
            for n in range(len(first)):
                own = [x[p * w : p * w + w] for (_, x, _), a in zip(kept, at) if a[p][1] == n]
                if own:
                    books[p][n] = [sum(c) // len(own) for c in zip(*own)]
    at = assign()
    error = [sum(d for d, _ in a) for a in at]
    per = {}
    for (_, _, label), e in zip(kept, error):
        per[label] = per.get(label, 0) + e
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    return sorted(((i, "".join(f"{n:02x}" for _, n in a), e, per[label], digest) for (i, _, label), a, e in zip(kept, at, error)), key=str)


@pytest.mark.parametrize("table_bytes", [value_codes.TABLE_BYTES, 20_000, 0])
def test_codes(spark, table_bytes):
    """The same codes whether all dimensions have tables, some or none."""
    rows = vectors(120)
    out = value_codes.vector_codes(table(spark, rows).repartition(3), table_bytes=table_bytes).collect()
    assert sorted((tuple(r) for r in out), key=str) == codes(rows)


def test_codes_of_few_rows_and_large_components(spark):
    rows = [(i, [float((i * 7 + j * 3) % 5) * (10.0**6 if j == 3 else 1) for j in range(16)], i % 2) for i in range(9)]
    out = value_codes.vector_codes(table(spark, rows)).collect()
    assert sorted((tuple(r) for r in out), key=str) == codes(rows, dim=16)


def neighbours(rows, k, every=50):
    """All pairs of queries and candidates: score and id by query row."""
    kept = [(i, np.array(v, float)) for i, v, _ in rows if i is not None and v and all(c is not None and math.isfinite(c) for c in v) and any(v)]
    out = []
    for n, (i, q) in enumerate(kept):
        if i % every == 0:
            met = [(-(q @ x) / math.sqrt(q @ q) / math.sqrt(x @ x), j) for m, (j, x) in enumerate(kept) if m != n and len(x) == len(q)]
            out.append((i, sorted((round(s, 9), j) for s, j in met)[:k]))
    return out


def test_neighbours(spark):
    """Small tables have one part, so the search is exact: ties to smaller ids, copies, repeated ids, fewer candidates than k."""
    rows = [r for r in vectors(70, dim=8) if r[1] is None or len(r[1]) != 3]
    rows += [(2000, [1.0, 2.0, 3.0], 1), (2001, [1.0, 2.0, 2.0], 1), (3000, [1e-200, 0.0, 1e200], 0), (3001, [1e200, 0.0, 1e200], 0)]
    out = learned_partitions.approximate_neighbours(table(spark, rows).repartition(3)).collect()
    got = {}
    for r in sorted(out, key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append((round(-r["score"], 9), r["vec_id"], r["rank"]))
    small = [r for r in rows if r[0] not in (3000, 3001)]
    want = {i: met for i, met in neighbours(small, 5) if i not in (2000, 50)}
    assert {i: [p[:2] for p in got[i]] for i in want} == want
    assert {p[1] for p in got[2000]} == {2001, 3000, 3001} and [p[2] for p in got[2000]] == [1, 2, 3]
    assert [p[:2] for p in got[3000]] == [(round(-3 / math.sqrt(14), 9), 2000), (round(-math.sqrt(0.5), 9), 3001), (round(-2 / 3, 9), 2001)]
    assert len(got[50]) == 10 and sum(p[:2] == (-1.0, 50) for p in got[50]) == 2


def test_neighbours_recall(spark):
    """Learned parts: recall against brute force, with several lots, a hot part of copies, and every row in the index."""
    rows = [r for r in vectors(900, dim=32, seed=8) if r[0] is not None]
    df = table(spark, rows).repartition(4)
    out = learned_partitions.approximate_neighbours(df, lot_bytes=20_000).collect()
    want = [(i, met) for i, met in neighbours(rows, 5)]
    got = {}
    for r in out:
        got.setdefault(r["query_id"], set()).add((round(-r["score"], 9)))
    hits = sum(s in got[i] for i, met in want for s, _ in met)
    assert hits / sum(len(met) for _, met in want) >= 0.9
    hot = [r for r in out if r["query_id"] == 0]
    assert [r["vec_id"] for r in sorted(hot, key=lambda r: r["rank"])] == [3, 6, 9, 12, 15]


def test_parts_are_balanced_and_follow_the_graph():
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(c, 0.05, (100, 16)) for c in rng.normal(0, 1, (8, 16))])
    near = learned_partitions.neighbour_graph(x, 10)
    part = learned_partitions.balanced_parts(near, 8, rng)
    assert np.bincount(part).tolist() == [100] * 8
    assert (part[near] == part[:, None]).mean() > 0.85
    index = learned_partitions.Index(x, 5, 0.96, 8)
    assert index.route(x).sum(1).mean() < 5


def test_empty_tables(spark):
    for f in (rotated_kmeans.rotated_clusters, value_codes.vector_codes, learned_partitions.approximate_neighbours):
        assert f(table(spark, [])).count() == 0
        assert f(table(spark, [(1, None, None), (50, [], 2)])).count() == 0


@pytest.mark.parametrize("name", ["op11_clusters", "op12_codes"])
def test_vector_oracles(spark, name):
    sf = "/root/testdata/sf0.001"
    c = duckdb.connect()
    c.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf}/embeddings.parquet'")
    df = queries.QUERIES[name](spark, sf)
    found = c.execute(queries.ORACLE_SQL[name])
    names = [d[0] for d in found.description]
    assert sorted(map(str, (tuple(r[n] for n in names) for r in df.collect()))) == sorted(map(str, found.fetchall()))
