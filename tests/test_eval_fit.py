"""Evaluation, fitted transforms, curves and survival arithmetic."""

import math
import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from wardline.operators import curves as CV
from wardline.operators import evaluate as EV
from wardline.operators import fit as FT
from wardline.operators import survival as SV
from wardline.operators.prefix import exact_quantiles


def _auc_brute(y, p):
    pos = [s for s, t in zip(p, y) if t == 1]
    neg = [s for s, t in zip(p, y) if t == 0]
    if not pos or not neg:
        return None
    tot = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg)
    return tot / (len(pos) * len(neg))


def _ap_brute(y, p):
    order = sorted(set(p), reverse=True)
    P = sum(y)
    if P == 0 or P == len(y):
        return None
    ap, prev_r = 0.0, 0.0
    for th in order:
        tp = sum(1 for s, t in zip(p, y) if s >= th and t == 1)
        k = sum(1 for s in p if s >= th)
        r = tp / P
        ap += (r - prev_r) * (tp / k)
        prev_r = r
    return ap


def test_ranking_metrics_match_brute_force(spark):
    rnd = random.Random(7)
    rows = [(rnd.randint(0, 1), round(rnd.random(), 1)) for _ in range(300)]   # many ties
    df = spark.createDataFrame(rows, "y int, p double")
    got = EV.ranking_metrics(df, "y", "p", n_buckets=8).first()
    y, p = zip(*rows)
    assert got["auc"] == pytest.approx(_auc_brute(y, p))
    assert got["pr_auc"] == pytest.approx(_ap_brute(y, p))


def test_single_class_and_equal_scores(spark):
    one = spark.createDataFrame([(1, 0.3), (1, 0.9)], "y int, p double")
    r = EV.task_metrics(one, "y", "p").first()
    assert r["auc"] is None and r["pr_auc"] is None and r["recall"] == 0.5
    eq = spark.createDataFrame([(1, 0.5), (0, 0.5), (0, 0.5)], "y int, p double")
    r = EV.task_metrics(eq, "y", "p").first()
    assert r["auc"] == 0.5 and r["tp"] == 1 and r["fp"] == 2
    none_pos = spark.createDataFrame([(0, 0.1), (0, 0.2)], "y int, p double")
    r = EV.task_metrics(none_pos, "y", "p").first()
    assert r["recall"] is None and r["precision"] == 0.0


def test_empty_mask_bundle(spark):
    pred = spark.createDataFrame([(1, 0.7, 1, 0.4, 0), (0, 0.2, 1, 0.9, 0)],
                                 "y1_true int, y1_prob double, y2_true int, y2_prob double, y2_mask int")
    rows = {r["task"]: r for r in EV.metrics_bundle(pred).collect()}
    t2 = rows[EV.TASK2]
    assert t2["n_eval"] == 0 and t2["tp"] == 0 and t2["auc"] is None and t2["precision"] is None
    assert rows[EV.JOINT]["n_eval"] == 2


@settings(max_examples=15, deadline=None)
@given(st.lists(st.integers(min_value=-5, max_value=5), min_size=1, max_size=40))
def test_exact_quantiles_property(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    probs = [0.0, 0.1, 0.5, 0.9, 1.0]
    got = {r["q"]: r["value"] for r in exact_quantiles(df, "v", probs, n_buckets=4).collect()}
    for q in probs:
        assert got[q] == pytest.approx(float(np.percentile(values, q * 100)))


def test_median_impute_and_scaler(spark):
    df = spark.createDataFrame([(1.0, 5.0, None), (2.0, 5.0, None), (None, 5.0, None), (4.0, 5.0, None)],
                               "a double, b double, c double")
    p = FT.fit_median(df, ["a", "b", "c"])
    assert p.medians == {"a": 2.0, "b": 5.0, "c": None}
    out = FT.apply_median(df, p).collect()
    assert out[2]["a"] == 2.0 and "c" not in out[0].asDict()
    keep = FT.apply_median(df, FT.ImputeParams(p.medians, keep_empty=True)).collect()
    assert keep[0]["c"] == 0.0
    sc = FT.fit_standard(FT.apply_median(df, p), ["a", "b"])
    assert sc.scale["b"] == 1.0                                  # zero deviation -> 1
    assert sc.scale["a"] == pytest.approx(np.std([1, 2, 2, 4]))   # population


def test_corr_drop_rule():
    cols = ["a", "b", "c", "d"]
    nan = float("nan")
    corr = [[1, 0.96, 0.1, nan], [0.96, 1, 0.97, nan], [0.1, 0.97, 1, nan], [nan, nan, nan, 1]]
    # b is near a; c is near b (already dropped, still counts); d is constant (NaN never drops)
    assert FT.corr_drop_columns(cols, corr) == ["b", "c"]
    assert FT.corr_drop_columns(["a"], [[1]]) == []


def test_split_groups_disjoint(spark):
    df = spark.createDataFrame([(i, i % 37) for i in range(2000)], "row_id long, subject_id long")
    s = FT.group_split(df)
    per = s.groupBy("subject_id").agg(F.count_distinct("split").alias("n")).where("n > 1").count()
    assert per == 0
    shares = {r["split"]: r["count"] for r in s.groupBy("split").count().collect()}
    assert set(shares) <= {"train", "val", "test"}
    with pytest.raises(ValueError):
        FT.check_groups(df.where("subject_id < 2"))


def _lambda_brute(rows):
    lam, out = 1.0, []
    for l1, l2 in rows:
        if l2 is not None and math.isfinite(l2) and l2 > 0:
            lam = min(max(0.9 * lam + 0.1 * l1 / (l2 + 1e-8), 0.1), 10.0)
        out.append(lam)
    return out


def test_lambda_curve_and_best_round(spark):
    rows = [(1, 0.7, 0.3, 0.72, 0.31), (2, 0.6, None, 0.65, None), (3, 0.5, 0.0, 0.6, 0.2),
            (4, 0.4, 0.05, 0.58, 0.25), (5, 0.35, 0.04, 0.59, 0.3), (6, 0.3, 0.03, 0.61, 0.33)]
    loss = spark.createDataFrame(rows, "epoch int, train_loss_task1 double, train_loss_task2_masked double, "
                                       "val_loss_task1 double, val_loss_task2_masked double")
    c = CV.lambda_curve(loss).orderBy("epoch").collect()
    assert [r["lambda"] for r in c] == pytest.approx(_lambda_brute([(r[1], r[2]) for r in rows]))
    assert c[1]["train_loss_total"] == pytest.approx(0.6)       # task-2 term skipped when NULL
    tot = [r["val_loss_total"] for r in c]
    b = CV.best_round(CV.lambda_curve(loss)).first()
    assert b["best_round"] == 1 + tot.index(min(tot))
    es = CV.early_stop(CV.lambda_curve(loss), patience=2).first()
    assert es["best_epoch"] == 1 + tot.index(min(tot))


def test_cif_bounds(spark):
    rnd = random.Random(3)
    rows = [tuple([i] + [rnd.uniform(-6, 6) for _ in range(9)]) for i in range(50)]
    cols = ["vec_id"] + [SV.logit_col(b, k) for b in range(3) for k in SV.CLASSES]
    df = spark.createDataFrame(rows, cols)
    for rescale in (False, True):
        for r in SV.cif_from_logits(df, rescale=rescale).collect():
            prev = 0.0
            for hz in SV.HORIZONS:
                s = r[f"cif_discharge_{hz}"] + r[f"cif_death_{hz}"]
                assert -1e-12 <= s <= 1 + 1e-12 and s >= prev - 1e-12
                prev = s


def test_exact_group_counts(spark):
    from pyspark.sql import functions as F
    from wardline.operators import fit as FT
    for n in (3, 7, 100, 333):
        df = spark.range(n * 4).select((F.col("id") % n).alias("subject_id"), "id")
        got = FT.exact_group_split(df.union(spark.createDataFrame([(None, -1)], df.schema)))
        by = {r.split: r.n for r in got.groupBy("split").agg(F.count_distinct("subject_id").alias("n")).collect()}
        outer = n * 8 // 10
        assert by.get("test") == n - outer and by.get("train", 0) == outer * 8 // 10 and by.get("val", 0) == outer - outer * 8 // 10
        assert got.where("subject_id IS NULL AND split IS NOT NULL").count() == 0
        assert got.groupBy("subject_id").agg(F.count_distinct("split").alias("s")).where("s > 1").count() == 0
    with pytest.raises(ValueError):
        FT.exact_group_split(spark.createDataFrame([(1,), (2,)], "subject_id long"))
