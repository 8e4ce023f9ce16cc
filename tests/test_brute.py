"""Window features against a plain pandas computation of the definitions
(dense hourly grid, rolling / expanding statistics) on the smallest tables."""

import os

import numpy as np
import pandas as pd
import pytest

from conftest import SF_SMALL
from wardline.operators import cohort, hourly, landmarks
from wardline.sources import fixtures

VARS = ["hr", "map", "lactate", "gcs"]
pytestmark = pytest.mark.skipif(not os.path.exists(SF_SMALL), reason="driver tables absent")


def _hourly(spark, rounding):
    st = fixtures.stays(spark, SF_SMALL)
    kept = cohort.los_filter(st)
    rel = hourly.with_relative_hour(cohort.restrict(fixtures.vitals(spark, SF_SMALL, st), kept), kept)
    return hourly.hourly_means(rel, VARS, rounding)


def _brute(hr_pdf, kind):
    out = []
    for sid, g in hr_pdf.groupby("stay_id"):
        g = g.set_index("hour").sort_index()
        mx = int(g.index.max())
        if mx < 24:
            continue
        grid = g.reindex(np.arange(0, mx + 1))
        obs = pd.Series(1.0, index=g.index).reindex(grid.index, fill_value=0.0)
        for t in range(24, mx + 1, 12):
            win = grid.loc[t - 23:t] if kind == "trailing" else grid.loc[0:t]
            o = obs.loc[t - 23:t] if kind == "trailing" else obs.loc[0:t]
            if o.sum() == 0:
                continue
            row = {"stay_id": sid, "t_end": float(t)}
            for v in VARS:
                s = win[v]
                if kind == "trailing":
                    row[f"{v}_mean"] = s.mean()
                    row[f"{v}_is_measured"] = float(s.notna().any())
                else:
                    row[f"{v}_cum_mean"] = s.mean()
                    row[f"{v}_cum_std"] = s.std() if s.notna().sum() >= 2 else 0.0
                    row[f"{v}_last"] = s.ffill().iloc[-1]
                    row[f"{v}_measured_frac"] = s.notna().mean()
                row[f"{v}_{'min' if kind == 'trailing' else 'cum_min'}"] = s.min()
            out.append(row)
    return pd.DataFrame(out)


@pytest.mark.parametrize("kind", ["trailing", "cumulative"])
def test_window_features_match_pandas(spark, kind):
    hr = _hourly(spark, "rint" if kind == "trailing" else "floor")
    got = (landmarks.trailing_features(hr, VARS) if kind == "trailing"
           else landmarks.cumulative_features(hr, VARS)).toPandas()
    exp = _brute(hr.toPandas(), kind)
    assert len(got) == len(exp) > 0
    m = got.merge(exp, on=["stay_id", "t_end"], suffixes=("", "_exp"))
    assert len(m) == len(exp)
    for c in exp.columns:
        if c in ("stay_id", "t_end"):
            continue
        a, b = m[c].astype(float).to_numpy(), m[f"{c}_exp"].astype(float).to_numpy()
        assert np.allclose(a, b, equal_nan=True, rtol=1e-9, atol=1e-9), c
