import random

import pytest

from tarn.llm.path_join import _bounded, near_duplicates, survival, trees_for

SCHEMA = "doc_id long, text string, component_id string"


def shingles(text, k):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def brute(rows, k, percent):
    sets = {i: shingles(t, k) for i, t in rows}
    comp = {i: i for i in sets}

    def root(i):
        while comp[i] != i:
            i = comp[i]
        return i

    ids = sorted(sets)
    for x in ids:
        for y in ids:
            if x < y and sets[x] and sets[y] and 100 * len(sets[x] & sets[y]) >= percent * len(sets[x] | sets[y]):
                a, b = sorted((root(x), root(y)))
                comp[b] = a
    return {i: (len(sets[i]), root(i)) for i in ids}


def corpus(seed=1, groups=12):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    rows, i = [], 0
    for g in range(groups):
        base = [word() for _ in range(rng.choice([3, 8, 40, 120]))]
        for _ in range(rng.choice([1, 2, 9])):
            t = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                t[rng.randrange(len(t))] = word()
            rows.append((i, (" " if g % 2 else "\t").join(t).upper() if g % 3 == 0 else "  ".join(t)))
            i += 1
    return rows


@pytest.mark.parametrize("k,options", [(4, {}), (5, {}), (4, {"leaf": 4, "depth": 2}), (4, {"bunch_docs": 3}), (4, {"bunch_docs": 3, "bunch_shingles": 150}), (4, {"bunch_shingles": 60})])
def test_equals_brute_force(spark, k, options):
    rows = corpus() + [(900, None), (901, ""), (902, " \n "), (903, "one two"), (904, "One TWO"), (905, "x " * 30_000)]
    df = spark.createDataFrame([(i, t, "clash") for i, t in rows], SCHEMA)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(df, k=k, **options).collect()}
    assert got == brute(rows, k, 80)


def test_null_ids_repeated_rows_and_empty_table(spark):
    df = spark.createDataFrame([(None, "a b c d e", ""), (1, "a b c d e", ""), (1, "a b c d e", ""), (2, "A B C D E", "")], SCHEMA)
    got = near_duplicates(df).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0, r.kept is None) for r in got) == [(0, 0, True), (1, 1, False), (1, 1, False), (2, 1, False)]
    assert near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_clusters_of_long_texts(spark):
    """Twelve near copies of 20,000 words among others, in bunches that hold two of them at most."""
    rng = random.Random(6)
    base = [f"w{rng.randrange(50_000)}" for _ in range(20_000)]
    rows = []
    for i in range(12):
        t = list(base)
        for _ in range(200 * (i % 3)):
            t[rng.randrange(len(t))] = "zz"
        rows.append((i, " ".join(t) + f" {i}"))
    rows += [(50 + i, " ".join(rng.sample(base, 300))) for i in range(5)]
    df = spark.createDataFrame([(i, t, "") for i, t in rows], SCHEMA)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(df, k=4, bunch_shingles=50_000).collect()}
    assert got == brute(rows, 4, 80)


def test_blocks_meet_in_every_pair_and_stay_small(spark):
    df = spark.createDataFrame([(1, i, 100) for i in range(60)] + [(2, i, 10) for i in range(5)], "bunch long, rep long, n_shingles long")
    bunches = {}
    for r in _bounded(df, 1000).collect():
        bunches.setdefault(r.bunch, set()).add(r.rep)
    assert {frozenset((a, b)) for a in range(60) for b in range(60)} <= {frozenset((a, b)) for m in bunches.values() for a in m for b in m}
    assert bunches[2] == set(range(5)) and max(100 * len(m) for k, m in bunches.items() if k != 2) <= 3000


def test_trees_reach_the_recall():
    rng = random.Random(2)

    def together(depth):
        return depth == 0 or any(rng.random() < 0.8 and together(depth - 1) for _ in range(2 if rng.random() < 0.25 else 1))

    for depth in (1, 3, 8):
        assert abs(sum(together(depth) for _ in range(20_000)) / 20_000 - survival(80, depth)) < 0.015
    assert trees_for(0.998, 80, 8) == 12 and 1 - (1 - survival(80, 8)) ** 12 >= 0.998
