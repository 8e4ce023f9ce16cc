import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from wardline.llm import vptree

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, k, modulus):
    """k nearest of each query by plain loops in double precision."""
    good = [(i, [float(np.float32(x)) for x in v]) for i, v in rows
            if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = {}
    for q, a in good:
        if q % modulus:
            continue
        best = {}
        for c, b in good:
            if c != q and len(b) == len(a):
                s = sum(x * y for x, y in zip(a, b)) / math.sqrt(sum(x * x for x in a) * sum(y * y for y in b))
                best[c] = max(s, best.get(c, -2))
        out[q] = sorted(best.items(), key=lambda x: (-round(x[1], 9), x[0]))[:k]
    return out


def search(spark, rows, k=5, modulus=5, factor=1.0, **sizes):
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA).selectExpr("*", "'x' AS key", "'x' AS id", "'x' AS dim")
    out = {}
    for r in vptree.nearest(df, F.col("id") % modulus == 0, k, factor, **sizes).collect():
        out.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    return {q: [(v, s) for _, v, s in sorted(x)] for q, x in out.items()}


def same(got, want):
    assert got.keys() == {q for q, x in want.items() if x}
    for q, x in got.items():
        assert [v for v, _ in x] == [v for v, _ in want[q]]
        assert np.allclose([s for _, s in x], [s for _, s in want[q]], atol=1e-12)


def test_exact_search_over_many_shards_and_blocks(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=8).astype(np.float32).tolist()) for i in range(600)]
    same(search(spark, rows, shard_rows=100, block_rows=30), brute(rows, 5, 5))


def test_awkward_vectors(spark):
    rng = np.random.default_rng(2)
    copies = [(1000 + i, [1.0, 2.0, 3.0]) for i in range(40)]               # one vector that many rows share
    near = [(2000 + i, (np.array([1, 2, 3]) + rng.normal(size=3) * 0.1).tolist()) for i in range(30)]
    odd = [(0, None), (5, []), (10, [0.0, 0.0, 0.0]), (15, [float("nan"), 1.0, 2.0]), (20, [float("inf"), 1.0, 2.0]),
           (25, [None, 1.0, 2.0]), (None, [1.0, 2.0, 3.0]), (30, [3e-30, -1e-30, 2e-30]), (35, [1e30, 0.0, 0.0]),
           (40, [1.0, 2.0]), (41, [2.0, 1.0]), (45, [7.0]), (1000, [1.0, 2.0, 3.0]), (50, [-0.0, 0.0, 1.0]), (55, [0.0, -0.0, 1.0])]
    rows = copies + near + odd
    want = brute([r for r in dict.fromkeys((i, None if v is None else tuple(v)) for i, v in rows)], 5, 5)
    got = search(spark, rows, shard_rows=16, block_rows=4)
    got.pop(30), want.pop(30)                                                # underflows in plain arithmetic
    assert 45 not in got and got[40] == [(41, pytest.approx(0.8))]
    for q, x in got.items():
        assert np.allclose([s for _, s in x], [s for _, s in want[q]], atol=1e-9)
    assert [v for v, _ in got[1005]] == [1000, 1001, 1002, 1003, 1004] and [v for v, _ in got[1000]] == [1001, 1002, 1003, 1004, 1005]


@pytest.mark.parametrize("n", [0, 1, 2, 4])
def test_few_rows(spark, n):
    rows = [(5 * i, [1.0, float(i)]) for i in range(n)]
    same(search(spark, rows), brute(rows, 5, 5))


def test_factor_trades_work_for_recall():
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(40, 6))
    x = (centres[rng.integers(0, 40, 4000)] + rng.normal(size=(4000, 6)) * 0.05)
    tree = vptree.VPTree.build(x, list(range(len(x))), leaf=32)
    assert sorted(tree.ids) == list(range(4000))
    q = x[:100]
    exact, cos, taken = tree.search(q, 5)
    unit = vptree.unit_rows(x)
    want = np.sort(vptree.unit_rows(q) @ unit.T, axis=1)[:, -5:]
    assert np.allclose(np.sort(cos, axis=1), want) and taken < 0.5 * 100 * 4000
    assert all(len(set(r)) == 5 for r in exact.tolist())
    _, less, fewer = tree.search(q, 5, factor=0.5)
    assert fewer < taken
    assert np.mean(np.isclose(np.sort(less, axis=1), want)) > 0.9


def test_ties_of_more_directions_than_find_room(spark):
    rows = [(i, [c * x for x in (1.0, 2.0, 3.0)]) for i, c in enumerate(2.0 ** (k % 7) for k in range(60))]   # powers of two: equal cosines
    for sizes in ({}, {"shard_rows": 5, "block_rows": 4}):
        got = search(spark, rows, modulus=20, **sizes)
        assert [v for v, _ in got[0]] == [1, 2, 3, 4, 5] and [v for v, _ in got[20]] == [0, 1, 2, 3, 4]
    hot = [(i, np.eye(4)[i % 4].tolist()) for i in range(400)] + [(1000 + i, (2.0 ** (i % 9) * np.eye(4)[i % 4]).tolist()) for i in range(80)]
    got = search(spark, hot, modulus=100)
    assert [v for v, _ in got[100]] == [0, 4, 8, 12, 16] and [v for v, _ in got[0]] == [4, 8, 12, 16, 20]
    rng = np.random.default_rng(4)
    signs = [(i, rng.choice([-1.0, 1.0], 6).tolist()) for i in range(300)]       # many equal cosines between different vectors
    same(search(spark, signs, shard_rows=40), brute(signs, 5, 5))
