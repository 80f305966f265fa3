"""Joins of names against brute force."""

import random

import pytest

from wasteflow.operators import names as names_of


def column(spark, values, name):
    return spark.createDataFrame([(v,) for v in values], f"{name} string")


def test_contains_join_equals_brute_force(spark):
    rng = random.Random(4)
    words = ["Steel", "ste", "iron works", "a", "AB", "zinc", "x", "Ärzte", "st", "el", "oxide"]
    names = {"".join(rng.choice(words) + rng.choice(["", " "]) for _ in range(rng.randint(1, 4))) for _ in range(80)} | {"", None, "q"}
    keys = [(k, f"v{i}", i) for i, k in enumerate(["steel iron works long key", "STEEL", "el", "zinc ", "ab", "", None, "oxide", "Ärzte", "steel", "x x"])]
    want = {}
    for n in names - {"", None}:
        met = [(n.lower() != k.lower(), o, k, v) for k, v, o in keys if k and (n.lower() in k.lower() or k.lower() in n.lower())]
        want[n] = min(met)[3] if met else "Unknown"
    out = names_of.contains_join(column(spark, names, "n"), spark.createDataFrame(keys, "k string, v string, o int"), "n", "k", "v", "o").collect()
    assert len(out) == len(want) and {r["name"]: r["value"] for r in out} == want
    assert len(set(want.values())) > 5


def test_contains_join_has_no_nested_loop(spark):
    df = names_of.contains_join(column(spark, ["a b"], "n"), spark.createDataFrame([("a", "v", 1)], "k string, v string, o int"), "n", "k", "v", "o")
    assert "NestedLoop" not in df._jdf.queryExecution().toString() and "Cartesian" not in df._jdf.queryExecution().toString()


def test_common_words_do_not_join_all_names(spark):
    """1,000 names that share a word meet only those of 100 others whose numbers are alike."""
    left = spark.createDataFrame([(f"{n} Supplier", f"{n} Supplier", len(f"{n} Supplier")) for n in range(1000, 2000)], "name string, x string, a int")
    right = spark.createDataFrame([(f"{n} Supplier", f"{n} Supplier", len(f"{n} Supplier")) for n in range(1000, 2000, 10)], "match string, y string, b int")
    pairs = names_of.alike(left, right, names_of.Bounds(85)).collect()
    assert len(pairs) < 30_000  # of 100,000; all of the others end in 0
    met = {(r["name"], r["match"]) for r in pairs}
    assert all((a["name"], b["match"]) in met for a in left.collect() for b in right.collect() if names_of.indel_ratio(a["x"], b["y"]) >= 85)


def test_no_known_company(spark):
    out = names_of.resolve_company(column(spark, ["a", "b", None], "n"), column(spark, [], "r"), "n", "r").collect()
    assert sorted(map(tuple, out)) == [("a", "a", 1.0), ("b", "b", 1.0)]
    out = names_of.resolve_company(column(spark, ["steel a", "zzz"], "n"), column(spark, ["a steel"], "r"), "n", "r").collect()
    assert sorted(map(tuple, out)) == [("steel a", "a steel", 1.0), ("zzz", "zzz", 0.0)]


@pytest.mark.parametrize("threshold", [95, 85, 70])
def test_long_names(spark, threshold):
    rng = random.Random(threshold)
    base = ["the united zinc and steel works of the north " * 4, "aa " * 60, "b" * 200]
    names = {"".join(c for c in t if rng.random() > 0.03) for t in base for _ in range(15)}
    out = names_of.fuzzy_join(column(spark, names, "n"), column(spark, base, "r"), "n", "r", threshold).collect()
    best = {n: max((names_of.token_sort_ratio(n, r), r) for r in base) for n in names}
    assert {r["name"]: r["match"] for r in out} == {n: r for n, (s, r) in best.items() if s > threshold}


def test_numbered_names_need_no_piece_join(spark):
    """Names with a near partner are settled by forms without a character or two; before, each met all with alike numbers."""
    l = spark.createDataFrame([(f"Supplier {n}", f"{n} Supplier", len(f"{n} Supplier")) for n in range(1000, 6000, 3)], "name string, x string, a int")
    r = spark.createDataFrame([(f"Supplier {n}", f"{n} Supplier", len(f"{n} Supplier")) for n in range(100, 600)], "match string, y string, b int")
    _, rest = names_of.nearest(l, r, 85)
    assert rest.count() == 0


@pytest.mark.parametrize("threshold, inclusive", [(85, True), (60, False)])
def test_near_names_equal_brute_force(spark, threshold, inclusive):
    rng = random.Random(9)
    text = lambda: "".join(rng.choice("aab é") for _ in range(rng.randint(0, 9)))
    refs = {text() for _ in range(60)} | {"zinc works b", "works zinc", "x" * 41, "x" * 40, "x" * 43}
    names = {text() for _ in range(150)} | {"works b zinc", "b zinc works", "zinc work", "x" * 39, "x" * 42, "q"}
    out = names_of.fuzzy_join(column(spark, names, "n"), column(spark, refs, "r"), "n", "r", threshold, inclusive).collect()
    want = {}
    for n in names:
        score, match = min((-names_of.token_sort_ratio(n, m), m) for m in refs)
        if n in refs:
            want[n] = (n, 100.0)
        elif -score > threshold or inclusive and -score == threshold:
            want[n] = (match, -score)
    assert len(out) == len(want) and {r["name"]: (r["match"], r["score"]) for r in out} == want
