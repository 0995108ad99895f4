import numpy as np
import pytest

from tarn.llm.vector_graph import insert_all, near_vectors, range_search

SCHEMA = "vec_id long, embedding array<float>, label int, kept string"


def brute(rows, cos=0.98):
    unit = {}
    for i, v, y, _ in rows:
        x = None if v is None or any(c is None for c in v) else np.array(v, float)
        if i is not None and y is not None and x is not None and len(x) and np.isfinite(x).all() and x.any():
            unit[i] = (y, x / np.linalg.norm(x))
    comp = {r[0]: r[0] for r in rows}
    n = dict.fromkeys(comp, 0)

    def root(i):
        while comp[i] != i:
            i = comp[i]
        return i

    for i, (y, a) in unit.items():
        for j, (z, b) in unit.items():
            if i != j and y == z and len(a) == len(b) and a @ b >= cos:
                n[i] += 1
                lo, hi = sorted((root(i), root(j)))
                comp[hi] = lo
    return {i: (n[i], root(i)) for i in comp}


@pytest.mark.parametrize("options", [{}, {"shard_rows": 40}, {"shard_rows": 40, "shard_limit": 30}, {"shard_rows": 20, "shard_limit": 30, "most_centres": 4}, {"shard_rows": 15}, {"shard_rows": 15, "shard_limit": 20}])
def test_equals_brute_force(spark, options):
    rng = np.random.default_rng(0)
    rows, i = [], 0
    for g in range(30):
        base = rng.normal(size=16)
        for _ in range(1 + g % 7):
            v = base + rng.normal(size=16) * 0.05 * (g % 3)
            rows.append((i, [float(np.float32(c)) for c in v * (1 + g % 2)], g % 2, "x"))
            i += 1
    rows += [(500, None, 1, ""), (501, [], 1, ""), (502, [0.0] * 16, 1, ""), (503, [float("nan")] * 16, 1, ""), (504, [None] * 16, 1, ""), (505, rows[0][1], None, ""), (506, rows[0][1], rows[0][2], ""), (507, rows[0][1], rows[0][2], ""), (508, [1.0, 2.0], 0, "")]
    got = {r.vec_id: (r.n_links, r.component_id) for r in near_vectors(spark.createDataFrame(rows, SCHEMA), **options).collect()}
    want = brute(rows)
    true = sum(n for n, _ in want.values())
    assert set(got) == set(want)
    assert sum(min(got[k][0], want[k][0]) for k in want) >= 0.98 * true
    assert all(got[k][0] <= want[k][0] for k in want)
    assert all(got[k] == (0, k) for k in range(500, 506))
    if not options:
        assert got == want


def test_repeated_ids_and_tiny_components(spark):
    rows = [(1, [1.0, 0, 0]), (1, [0, 1.0, 0]), (2, [1.0, 0, 0]), (3, [0, 0, 1.0]), (7, [1e-30, 2e-30, 0]), (8, [1e-30, 2e-30, 0]), (9, [0, 1e-200, 0])]
    df = spark.createDataFrame([(i, [float(c) for c in v], 1) for i, v in rows], "vec_id long, embedding array<double>, label int")
    got = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in near_vectors(df).collect())
    # vector 1 is once a copy of 2 and once one of 9: every row is judged by its own vector
    assert got == [(1, 1, 1, True), (1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True), (7, 1, 7, True), (8, 1, 7, False), (9, 1, 1, False)]


@pytest.mark.parametrize("dim", [6, 10, 32])
def test_recall_on_planted_vectors(spark, dim):
    """Groups of near copies among strangers, over several shards of every label; recall by query and audit."""
    rng, rows = np.random.default_rng(dim), []
    base = rng.normal(size=(1500, dim))
    for i, b in enumerate(base):
        for _ in range(1 + 3 * (i % 2)):
            v = b / np.linalg.norm(b) + rng.normal(size=dim) * 0.09 / np.sqrt(dim)
            rows.append((len(rows), [float(c) for c in v], i % 2))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(4)
    got = near_vectors(df, shard_rows=200, shard_limit=900).collect()
    x, y = np.array([v for _, v, _ in rows]), np.array([r[2] for r in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    true = ((x @ x.T >= 0.98) & (y[:, None] == y)).sum(axis=1) - 1
    n = np.zeros(len(rows), int)
    for r in got:
        n[r.vec_id] = r.n_links
    assert (n <= true).all() and n.sum() >= 0.98 * true.sum() > 1000
    assert got[0].audit_links > 0 and got[0].audit_recall >= 0.95


def test_recall_is_null_where_nothing_links(spark):
    df = spark.createDataFrame([(i, [float(i == j) for j in range(8)], 1) for i in range(8)], "vec_id long, embedding array<double>, label int")
    (r,) = near_vectors(df).select("audit_recall", "audit_classes", "audit_links").distinct().collect()
    assert tuple(r) == (None, 8, 0)


def test_graph_by_insertion_reaches_all():
    x = np.random.default_rng(2).normal(size=(900, 24))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    adj = insert_all(x, first=64, step=32)
    inside, best = range_search(x, adj, np.array([0, 1, 2]), x, np.full(900, -1), 0.999)
    assert np.diag(inside).mean() >= 0.97 and (best > 0.999).mean() >= 0.97  # each vector meets itself


def test_empty_and_null_ids(spark):
    assert near_vectors(spark.createDataFrame([], SCHEMA)).count() == 0
    (r,) = near_vectors(spark.createDataFrame([(None, [1.0], 1, "")], SCHEMA)).collect()
    assert (r.vec_id, r.n_links, r.component_id) == (None, None, None)
