import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tarn.llm import queries as Q
from tarn.llm.packed_negatives import Fields, mine

SF = "/root/testdata/sf0.01"
SCHEMA = "vec_id long, embedding array<float>, label int, score double, q string, a long"


def plain(rows, every, scale=256, positives=5, negatives=3):
    """Every anchor against every row, one product at a time."""
    use = [(i, lab, [math.floor(scale * float(np.float32(x))) for x in v]) for i, v, lab in rows if None not in (i, lab, v) and all(x is not None and math.isfinite(x) for x in v)]
    out, seen = [], set()
    for i, lab, q in use:
        if i % every or (i, lab, tuple(q)) in seen:
            continue
        seen.add((i, lab, tuple(q)))
        scored = sorted((-sum(x * y for x, y in zip(q, r, strict=False)), j, other) for j, other, r in use)
        for s, j, _ in [x for x in scored if x[2] == lab and x[1] != i][:positives]:
            fit = [x for x in scored if x[2] != lab and 50 * -s <= 100 * -x[0] <= 95 * -s]
            out += [(i, j, n + 1, x[1], -s, -x[0]) for n, x in enumerate(fit[:negatives])]
    return sorted(out)


def run(spark, rows, every, **how):
    df = spark.createDataFrame([(*r, 1.0, "x", 5) for r in rows], SCHEMA)
    return sorted(map(tuple, mine(df, F.col("vec_id") % every == 0, **how).collect()))


def test_query_equals_brute_force(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    rows = [(r.vec_id, r.embedding, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label) for r in table]
    got = Q.op12_packed_negatives(spark, SF)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(map(tuple, got.collect())) == plain(rows, 50) != []


@pytest.mark.parametrize("scale", [4, 256, 1 << 20])
def test_ties_repeats_nulls_and_many_small_blocks(spark, scale):
    rng = np.random.default_rng(scale)
    rows = [(int(i), rng.integers(-8, 12, 5).astype(float).tolist(), int(rng.choice([0, 0, 1, 2]))) for i in rng.integers(-20, 300, 260)]
    rows += rows[:40] + [(rows[0][0], None, 0), (None, [1.0] * 5, 0), (10, [1.0] * 5, None), (20, [1.0, None, 1.0, 1.0, 1.0], 1), (30, [float("nan")] * 5, 1), (40, [float("inf")] * 5, 1)]
    rows += [(50, [], 2), (60, [2.0], 1), (70, [0.0] * 5, 0), (71, [0.0] * 5, 0), (72, [0.0] * 5, 1)]
    rows += [(500 + i, [3.0, 1.0, -1.0, 0.0, 2.0], i % 2) for i in range(40)]  # equal vectors: ties by id
    want = plain(rows, 10, scale)
    assert want and run(spark, rows, 10, scale=scale) == want
    assert run(spark, rows, 10, scale=scale, block_rows=37, block_anchors=11, width=16) == want


def test_wide_integers_hold_every_field():
    rng = np.random.default_rng(1)
    q, a = rng.integers(-512, 512, (1000, 64)), rng.integers(-512, 512, 64)
    for size in (4, 8):
        low = int(a.min())
        got = Fields(q, size).scores((a - low).tolist(), int((a - low).sum()), low)
        assert (got == q @ a).all()


def test_empty_table_and_scores_beyond_a_long(spark):
    assert run(spark, [], 10) == [] and run(spark, [(0, [1.0], 1)], 10) == [] and run(spark, [(1, [1.0], 1)], 10) == []
    with pytest.raises(ValueError):
        run(spark, [(0, [1e12], 1), (1, [1e12], 1)], 10)
