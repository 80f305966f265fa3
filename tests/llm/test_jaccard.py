import random

import pytest

from wasteflow.llm import jaccard, shingling

SCHEMA = "doc_id long, text string, component string"


def brute(rows):
    sets = {}
    for i, text in rows:
        w = (text or "").encode().lower().split()
        sets[i] = {tuple(w[k : k + 4]) for k in range(max(1, len(w) - 3))} if w else set()
    comp = {i: i for i in sets}

    def root(i):
        while comp[i] != i:
            i = comp[i]
        return i

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= 85 * len(x | y):
                ra, rb = root(a), root(b)
                comp[max(ra, rb)] = min(ra, rb)
    return {i: (len(sets[i]), root(i)) for i in ids}


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefgh") * rng.randint(1, 3) + str(rng.randint(0, 60))
    passage = [word() for _ in range(60)]
    rows = []
    for _ in range(12):
        base = [word() for _ in range(rng.randint(1, 120))]
        for _ in range(rng.randint(1, 9)):
            w = list(base)
            for _ in range(rng.randint(0, 3)):
                w[rng.randrange(len(w))] = word()
            if rng.random() < 0.3:
                w += passage
            rows.append(" ".join(w).upper() if rng.random() < 0.2 else " ".join(w))
    rows += [None, "", "  ", "a", "A", "a b", "a b c d"] + [rows[0]] * 5 + [" ".join(base * 30)]
    ids = rng.sample(range(1000), len(rows))
    return list(zip(ids, rows))


@pytest.mark.parametrize("seed", [1, 2])
def test_matches_brute_force(spark, seed):
    rows = corpus(seed)
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], SCHEMA)
    out = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.jaccard_components(df, sketch_bits=14).collect()}
    assert out == brute(rows)


def brute_rows(rows, width, percent):
    """(doc_id, set size, component) of rows, of which several can share an id."""
    sets = []
    for _, text in rows:
        w = (text or "").encode().lower().split()
        sets.append({tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1))} if w else set())
    comp = list(range(len(rows)))
    for a, x in enumerate(sets):
        for b in range(a):
            if x and sets[b] and 100 * len(x & sets[b]) >= percent * len(x | sets[b]):
                old, new = max(comp[a], comp[b]), min(comp[a], comp[b])
                comp = [new if c == old else c for c in comp]
    low = {}
    for c, (i, _) in zip(comp, rows):
        low[c] = min(low.get(c, i), i)
    return sorted((i, len(s), low[c]) for (i, _), s, c in zip(rows, sets, comp))


def altered(rng, words, n):
    w = list(words)
    for _ in range(n):
        w[rng.randrange(len(w))] = f"q{rng.random()}"
    return w


@pytest.mark.parametrize("width, percent, pairs_per_row, hot_class", [(4, 85, 200, 17), (5, 80, 0, 4)])
def test_large_groups_of_altered_copies_and_repeated_ids(spark, width, percent, pairs_per_row, hot_class):
    rng = random.Random(width)
    original = [f"w{i}" for i in range(150)]
    passage = [f"p{i}" for i in range(60)]
    rows = [(i, " ".join(altered(rng, original, rng.choice([0, 1, 2, 3, 4, 6])))) for i in range(60, 120)]  # most link with the original alone
    rows += [(200 + i, " ".join(altered(rng, passage, 1) + [f"x{i}_{k}" for k in range(i)])) for i in range(30)]  # one passage, other rests
    chain = [f"c{i}" for i in range(140)]
    rows += [(300 + i, " ".join(chain[i : i + 100])) for i in range(0, 40, 3)]  # each links with its neighbours
    rows += [(7, "a b c d e f"), (7, " ".join(chain[:100])), (7, "z y x w v u"), (2, "z y x w v u"), (7, "a b c d e f"), (9, "A b c d e f")]  # one id with several texts
    rng.shuffle(rows)
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], SCHEMA).repartition(3)
    out = jaccard.jaccard_components(df, width, percent, sketch_bits=14, pairs_per_row=pairs_per_row, hot_class=hot_class).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in out) == brute_rows(rows, width, percent)


def test_shingle_hashes_follow_the_words():
    piece = shingling.PIECE
    rng = random.Random(6)
    parts = ["A", "b", "cc", "\x0b", "é", "Ä", "\t\n", " x"]
    texts = [" ".join(rng.choice(parts) for _ in range(rng.randint(0, 60))) for _ in range(300)]
    texts += ["x" * piece, "x" * (piece - 1), " " + "x" * piece + " y", "y " * 90 + "x" * (piece - 1), "a " * 200000 + "x" * piece + " b", None, "", "  ", " " * 2_000_000]
    seen = {}
    for text, hashes in zip(texts, shingling.words_of(texts)):
        words = (text or "").encode().lower().split()
        assert len(words) == len(hashes) and all(seen.setdefault(w, h) == h for w, h in zip(words, hashes.tolist()))
    assert len(set(seen.values())) == len(seen)
    for text, found in zip(texts, shingling.shingle_sets(texts, 4)):
        w = (text or "").encode().lower().split()
        assert len(found) == (len({tuple(w[k : k + 4]) for k in range(max(1, len(w) - 3))}) if w else 0)


def test_empty_table_and_null_id(spark):
    assert jaccard.jaccard_components(spark.createDataFrame([], SCHEMA), sketch_bits=14).count() == 0
    out = jaccard.jaccard_components(spark.createDataFrame([(None, "a b c d e", ""), (4, "a b c d e", ""), (4, "a b c d e", "")], SCHEMA), sketch_bits=14).collect()
    assert sorted((r["doc_id"] is None, r["component_id"]) for r in out if r["doc_id"]) == [(False, 4), (False, 4)]
