import hashlib
import math

import numpy as np
import pytest

from wardline.llm import codes

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, parts, entries, rounds, scale):
    """The same by loops over every entry, in Python integers."""
    kept = [(i, [math.floor(scale * float(np.float32(x))) for x in v], label) for i, v, label in rows
            if v and all(x is not None and math.isfinite(x) for x in v)]
    width = len(kept[0][1]) // parts
    cut = [[v[p * width:(p + 1) * width] for p in range(parts)] for _, v, _ in kept]
    starts = {}
    for k, (i, v, _) in enumerate(kept):
        if i is not None and (i not in starts or v < kept[starts[i]][1]):
            starts[i] = k
    book = [[cut[starts[i]][p] for i in sorted(starts)[:entries]] for p in range(parts)]

    def assign():
        return [[min((sum((a - b) ** 2 for a, b in zip(x, c)), e) for e, c in enumerate(book[p])) for p, x in enumerate(xs)]
                for xs in cut]
    for _ in range(rounds):
        found = assign()
        for p in range(parts):
            for e in range(len(book[p])):
                own = [xs[p] for xs, f in zip(cut, found) if f[p][1] == e]
                if own:
                    book[p][e] = [sum(c) // len(own) for c in zip(*own)]
    found = assign()
    error = [sum(d for d, _ in f) for f in found]
    by_label = {}
    for (_, _, label), e in zip(kept, error):
        by_label[label] = by_label.get(label, 0) + e
    digest = hashlib.sha256(",".join(str(x) for b in book for c in b for x in c).encode()).hexdigest()
    return sorted((str(i), "".join(f"{e:02x}" for _, e in f), s, by_label[label], digest)
                  for (i, _, label), f, s in zip(kept, found, error))


def run(spark, rows, **how):
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' AS id", "'x' AS v", "1 AS code", "2 AS of", "3 AS error")
    return sorted((str(r.vec_id), r.code, r.error, r.label_error, r.codebooks_sha256)
                  for r in codes.compress(df.repartition(3), **how).collect())


@pytest.mark.parametrize("width", [1, 2, 3, 4, 7, 8, 16])
def test_nearest_entry_is_the_plain_one(width):
    rng = np.random.default_rng(width)
    for top in (2, 300, 1 << 30):
        x = rng.integers(-top, top + 1, (200, width))
        book = np.concatenate([rng.integers(-top, top + 1, (20, width)), x[:5], x[:5]])
        plainly = ((x[:, None].astype(object) - book[None].astype(object)) ** 2).sum(2)
        entry, distance = codes.nearest_entry(x, book)
        assert entry.tolist() == [min(range(len(book)), key=lambda e: (d[e], e)) for d in plainly]
        assert [int(d) for d in distance] == plainly.min(1).tolist()


def test_transform_keeps_distances_and_orders_by_sign_changes():
    x = np.eye(8, dtype=np.int64)
    w = codes.walsh(x)
    assert (w @ w.T == 8 * np.eye(8)).all()
    assert (np.diff(np.sign(w.T), axis=1) != 0).sum(1).tolist() == list(range(8))


def test_same_as_plain_loops(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=12).astype(np.float32).tolist(), int(i % 3) if i % 5 else None) for i in range(90)]
    rows += [(200 + i, [0.25] * 12, 7) for i in range(30)]                   # one vector that many rows share
    rows += [rows[0], (None, rng.normal(size=12).tolist(), 1), (3, rng.normal(size=12).tolist(), 2)]
    odd = [(-1, None, 1), (-2, [float("nan")] * 12, 1), (-3, [float("inf")] * 12, 1), (-4, [None] * 12, 1)]
    got = run(spark, rows + odd, parts=4, entries=8, rounds=2, scale=256)
    assert got == plain(rows, 4, 8, 2, 256)


def test_few_rows_other_lengths_and_large_numbers(spark):
    rows = [(5, [1.0] * 6, 1), (6, [1.5] * 6, 1), (7, [2.0] * 4, None), (8, [], None), (9, [3e38] * 6, None), (10, [-3e38] * 6, 2)]
    got = {i: rest for i, *rest in run(spark, rows, parts=4, entries=64)}   # 6 components in 4 parts: filled with zeros
    assert got["5"][:3] == ["00000000", 0, 0] and got["6"][:3] == ["01010100", 0, 0]   # the last part is all zeros: a tie
    assert got["7"][:2] == [None, None] and got["8"][:2] == [None, None]
    assert got["9"][:2] == ["02020200", 0] and got["10"][:2] == ["03030300", 0]


def test_nothing_and_no_ids(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, None, 1)]) == []
    assert [r[:4] for r in run(spark, [(None, [1.0, 2.0], 1)])] == [("None", None, None, None)]
