import random

import pytest
from pyspark.sql import functions as F

from wardline.operators import incidence as IN


def _plain(rows):
    """Aalen-Johansen by a loop over the times."""
    out, s, c1, c2 = [], 1.0, 0.0, 0.0
    for t in sorted({t for t, _ in rows}):
        n = sum(u >= t for u, _ in rows)
        d1, d2 = (sum(u == t and e == k for u, e in rows) for k in IN.CAUSES)
        c1, c2, s = c1 + s * d1 / n, c2 + s * d2 / n, s * (1 - (d1 + d2) / n)
        out.append((t, n, s, c1, c2))
    return out


def test_aalen_johansen_with_ties_and_censoring(spark):
    rng = random.Random(3)
    rows = [(k % 2, float(rng.randint(1, 30)), rng.choice(["discharge", "death", "censored", None])) for k in range(300)]
    rows += [(2, 5.0, "death"), (2, 5.0, "death"), (0, None, "death")]
    df = spark.createDataFrame(rows, "g int, t double, e string")
    got = IN.aalen_johansen(df, "t", "e", keys=["g"])
    for g in (0, 1, 2):
        mine = [(r.t, r.at_risk, r.survival, r.cif_discharge, r.cif_death) for r in got.where(F.col("g") == g).orderBy("t").collect()]
        want = _plain([(t, e) for k, t, e in rows if k == g and t is not None])
        assert len(mine) == len(want) and all(a == pytest.approx(b) for a, b in zip(mine, want))
    at = {(r.g, r.horizon): r.cif_death for r in IN.incidence_at(got, "t", [0.5, 5.0], keys=["g"]).collect()}
    assert at[2, 0.5] == 0.0 and at[2, 5.0] == pytest.approx(1.0)
    assert IN.aalen_johansen(df.where("false"), "t", "e").collect() == []


def test_pooled_and_separate_models_against_the_observed_incidence(spark):
    from wardline.operators import labels as LB
    from wardline.plans import matrices as MX
    from wardline.plans import runs as RN
    rng = random.Random(5)
    rows = []
    for s in range(600):
        x = rng.gauss(0, 1)
        for t in (24.0, 48.0):
            left = rng.expovariate(1 / (40 if x + (t - 36) / 24 > 0 else 120)) + 0.1
            rows.append((s, s, t, x, "death" if rng.random() < 0.3 else "discharge", t + left, left, ["train", "test"][s % 2]))
    df = spark.createDataFrame(rows, "stay_id long, subject_id long, t_end double, x double, event_type string, event_hour double, "
                                     "remaining_hours double, split string")
    table = LB.survival_targets(df)
    got = RN.landmark_comparison(MX.Matrices(df.select("stay_id", "t_end", "split", "x"), ["x"]), table, [24, 48]).collect()
    assert len(got) == 2 * 3 * 2
    for r in got:
        assert r.separate_gap == pytest.approx(r.separate_mean - r.observed) and abs(r.separate_gap) < 0.12
    mean = lambda name: sum(abs(r[name]) for r in got) / len(got)
    assert mean("separate_gap") < mean("pooled_gap") + 0.02               # the pooled model does not know the landmark here
    assert all(r.pooled_variance > 0 for r in got)
