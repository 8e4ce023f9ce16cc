"""Boosted heads trained on histograms."""

import random

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from wardline.operators import boost, models as MD


def _rows(spark, n=900, seed=3):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        x = [rnd.gauss(0, 1), float(rnd.randrange(5)), rnd.choice([0.0, 0.0, 0.0, rnd.random()])]
        y1 = int(x[0] + 0.4 * x[1] + 0.5 * rnd.gauss(0, 1) > 1)
        y2 = int(x[0] * x[2] + 0.3 * rnd.gauss(0, 1) > 0)
        out.append((i, *x, x[0] - x[1] if i % 7 else 0.0, y1, y2, int(i % 3 > 0)))
    return spark.createDataFrame(out, "stay_id long, x1 double, `x 2` double, x3 double, x4 double, "
                                      "label_can_discharge_24h int, label_no_return_72h int, task2_mask int").coalesce(2)


FEATURES = ["x1", "x 2", "x3", "x4"]


def _mllib(df, label, p):
    n, pos = df.agg(F.count("*"), F.sum(label)).first()
    d = df.withColumn("_w", F.when(F.col(label) == 1, (n - pos) / pos).otherwise(1.0)).withColumn(label, F.col(label).cast("double"))
    va = VectorAssembler(inputCols=FEATURES, outputCol="_features", handleInvalid="keep")
    return MD.Head(model=Pipeline(stages=[va, MD._estimator("gbt", label, {**p, "weight_col": "_w"})]).fit(d))


def test_without_draws_the_trees_are_those_of_mllib(spark):
    df = _rows(spark).cache()
    p = {"rounds": 6, "max_depth": 4, "subsample": 1.0, "colsample": 1.0, "lr": 0.1}
    model = MD.fit_two_head(df, FEATURES, "gbt", p)
    for head, label, rows in ((model.head1, MD.TASK1_COL, df), (model.head2, MD.TASK2_COL, df.where("task2_mask = 1"))):
        other = _mllib(rows, label, p)
        got = other.predict(head.predict(df, "a"), "b").select("a", "b").collect()
        assert max(abs(r.a - r.b) for r in got) < 1e-9
        # and the losses those of its own pass
        va, gbt = other.model.stages
        expected = gbt.evaluateEachIteration(va.transform(rows.withColumn(label, F.col(label).cast("double")).withColumn("_w", F.lit(1.0))))
        assert MD._head_curve(head, rows, label, 6) == pytest.approx([x / 2 for x in expected], abs=1e-9)


def test_a_round_takes_one_pass_a_level_for_both_heads(spark):
    df, sc, jobs = _rows(spark).cache(), spark.sparkContext, []
    for rounds in (2, 12):
        sc.setJobGroup(f"boost-{rounds}", "")
        MD.fit_two_head(df, FEATURES, "gbt", {"rounds": rounds, "max_depth": 3})
        jobs.append(len(sc.statusTracker().getJobIdsForGroup(f"boost-{rounds}")))
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[1] - jobs[0] <= 10 * 3


def test_rounds_beyond_a_checkpoint_and_many_blocks(spark, monkeypatch):
    df, p = _rows(spark).cache(), {"rounds": 7, "max_depth": 3}
    target = [boost.Target(df, MD.TASK1_COL, 2.0)]
    plain = boost.fit(target, FEATURES, 7, 3, 0.1, 1.0, 0.5, 42)[0]
    monkeypatch.setattr(boost, "CHECKPOINT_ROUNDS", 2)
    monkeypatch.setattr(boost, "BLOCK_ROWS", 50)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "40")
    try:
        small = boost.fit(target, FEATURES, 7, 3, 0.1, 1.0, 0.5, 42)[0]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    for a, b in zip(plain, small):
        assert a.feature.tolist() == b.feature.tolist() and np.allclose(a.values(), b.values())
    assert len(small) == p["rounds"]


def test_split_points():
    w = np.ones(6)
    assert boost.split_points(np.array([1.0, 1, 2, 4, np.nan, 4]), w).tolist() == [1.5, 3.0]
    assert boost.split_points(np.full(6, 7.0), w).tolist() == [] and boost.split_points(np.full(6, np.nan), w).tolist() == []
    many = boost.split_points(np.arange(6400.0), np.ones(6400))
    assert len(many) == 31 and np.diff(many).tolist() == [200.0] * 30


def test_a_missing_value_goes_right(spark):
    df = _rows(spark).withColumn("x1", F.when(F.col("x1") < 1, F.col("x1")))
    head = MD.fit_head(df, FEATURES, MD.TASK1_COL, "gbt", {"rounds": 5, "max_depth": 3})
    p = {r.gone: r.p for r in head.predict(df, "p").groupBy(F.col("x1").isNull().alias("gone")).agg(F.avg("p").alias("p")).collect()}
    assert p[True] > p[False] + 0.2
    got = head.predict(df, "p").selectExpr(f"avg(-ln(if({MD.TASK1_COL} = 1, p, 1 - p)))").first()[0]
    assert MD._head_curve(head, df, MD.TASK1_COL, 5)[-1] == pytest.approx(got)


def test_labels_must_be_0_or_1(spark):
    df = _rows(spark).withColumn(MD.TASK1_COL, F.when(F.col("stay_id") > 3, F.col(MD.TASK1_COL)))
    with pytest.raises(Exception, match="label must be 0 or 1"):
        MD.fit_head(df, FEATURES, MD.TASK1_COL, "gbt", {"rounds": 1})


def test_split_points_come_from_all_rows(spark, monkeypatch):
    rnd, inf = random.Random(9), float("inf")
    rows = [([rnd.gauss(0, 1), float(rnd.randrange(6)), rnd.choice([0.0, 0.0, 0.0, rnd.random()]), rnd.choice([None, float("nan"), i * 1.0]),
              10.0 ** rnd.randint(-300, 300) * rnd.choice([-1, 1]), 5.0 if i % 997 else float(i), rnd.choice([inf, -inf, -0.0, 0.0, rnd.random()]),
              1.0 + i * 2 ** -40, None, 3.0], int(rnd.random() < 0.3)) for i in range(6000)]
    df = spark.createDataFrame(rows, "x array<double>, y int").repartition(5).cache()
    x, y = np.array([r[0] for r in rows], float), np.array([r[1] for r in rows])
    want = [boost.split_points(x[:, f] + 0.0, np.where(y == 1, 2.25, 1.0)) for f in range(x.shape[1])]
    monkeypatch.setattr(boost, "SPLIT_ROWS", 40)
    for edges, finer in ((2048, 64), (7, 4)):
        monkeypatch.setattr(boost, "EDGES", edges)
        monkeypatch.setattr(boost, "FINER", finer)
        got = boost._splits(df, len(rows), x.shape[1], 2.25, 42)
        assert [a.tolist() for a in got] == [a.tolist() for a in want]
