"""Distributed binary-classification evaluation.

Every metric is an aggregate over a prediction DataFrame, optionally per
group key; ranking metrics use :mod:`.prefix` so ties collapse map-side and
no single task holds the whole score column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .prefix import DEFAULT_BUCKETS, exact_quantiles, running_sums

THRESHOLD = 0.5
LOGLOSS_EPS = 2.220446049250313e-16   # float64 machine epsilon

TASK1, TASK2, JOINT = "task1_discharge", "task2_no_return72_masked", "joint_both_positive"


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def confusion(df: DataFrame, label: str, prob: str | None = None, pred=None, keys=(),
              threshold: float = THRESHOLD) -> DataFrame:
    """tn, fp, fn, tp with ``pred = prob >= threshold`` (A9); all four always present."""
    y = _c(label) == 1
    p = _c(pred) == 1 if pred is not None else _c(prob) >= F.lit(threshold)
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_eval"),
        F.count_if(~y & ~p).alias("tn"), F.count_if(~y & p).alias("fp"),
        F.count_if(y & ~p).alias("fn"), F.count_if(y & p).alias("tp"))


def recall_precision_cols():
    """Recall (NULL when there is no positive) and precision (0 when nothing
    is predicted positive) from confusion columns (A10)."""
    pos = F.col("tp") + F.col("fn")
    recall = F.when(pos > 0, F.col("tp") / pos)
    ppos = F.col("tp") + F.col("fp")
    precision = F.when(ppos > 0, F.col("tp") / ppos).otherwise(F.when(F.col("n_eval") > 0, F.lit(0.0)))
    return recall.alias("recall"), precision.alias("precision")


def _ranked_scores(src: DataFrame, keys, n_buckets, sums: dict | None = None) -> DataFrame:
    """Distinct scores (columns keys, _p from _y, _p) with ``pos``, ``cnt``,
    their running sums from the highest score down, and the totals in one
    struct ``tot``; further ``sums`` appear in the totals."""
    keys = list(keys)
    every = {"pos": F.when(F.col("_y") == 1, 1).otherwise(0), "cnt": F.lit(1), **(sums or {})}
    ps, tot = running_sums(src, "_p", every, keys, descending=True, n_buckets=n_buckets, with_totals=True)
    packed = tot.select(*keys, F.struct(*[F.col(f"tot_{n}").alias(n) for n in every]).alias("tot"))
    if keys:
        return ps.join(packed, on=keys, how="inner")
    return ps.withColumn("tot", packed.select("tot").scalar())


def _ranking_aggs():
    """Aggregates for AUC and average precision over ranked scores."""
    neg, cumneg = F.col("cnt") - F.col("pos"), F.col("cum_cnt") - F.col("cum_pos")
    n_neg = F.col("tot.cnt") - F.col("tot.pos")
    return [F.first("tot").alias("tot"),
            F.sum(F.col("pos") * ((n_neg - cumneg) + neg / 2.0)).alias("_auc"),
            F.sum(F.col("pos") * F.col("cum_pos") / F.col("cum_cnt")).alias("_ap")]


def _auc_cols():
    n_pos, n_neg = F.col("tot.pos"), F.col("tot.cnt") - F.col("tot.pos")
    two = (n_pos > 0) & (n_neg > 0)
    return F.when(two, F.col("_auc") / (n_pos * n_neg)).alias("auc"), F.when(two, F.col("_ap") / n_pos).alias("pr_auc")


def ranking_metrics(df: DataFrame, label: str, prob, keys=(), n_buckets: int | None = DEFAULT_BUCKETS) -> DataFrame:
    """Exact ROC AUC (ties count one half, A11) and average precision
    (step-wise, A12) per key; NULL when only one class is present."""
    keys = list(keys)
    src = df.select(*keys, _c(label).alias("_y"), _c(prob).cast("double").alias("_p"))
    return _ranked_scores(src, keys, n_buckets).groupBy(*keys).agg(*_ranking_aggs()).select(*keys, *_auc_cols())


def roc_points(df: DataFrame, label: str, prob: str, keys=(), n_buckets: int | None = DEFAULT_BUCKETS) -> DataFrame:
    """ROC curve: (threshold, fpr, tpr) at every distinct score, and its start
    (0, 0) above every score, with a NULL threshold (A14)."""
    keys = list(keys)
    src = df.select(*keys, _c(label).alias("_y"), _c(prob).cast("double").alias("_p"))
    j = _ranked_scores(src, keys, n_buckets)
    n = F.col("tot.cnt") - F.col("tot.pos")
    fpr = F.when(n > 0, (F.col("cum_cnt") - F.col("cum_pos")) / n)
    tpr = F.when(F.col("tot.pos") > 0, F.col("cum_pos") / F.col("tot.pos"))
    point = F.struct(F.col("_p").alias("threshold"), fpr.alias("fpr"), tpr.alias("tpr"))
    # the highest score is the one whose running count is its own
    start = F.struct(F.lit(None).cast("double").alias("threshold"), (fpr * 0).alias("fpr"), (tpr * 0).alias("tpr"))
    points = F.when(F.col("cum_cnt") == F.col("cnt"), F.array(start, point)).otherwise(F.array(point))
    return j.select(*keys, F.explode(points).alias("x")).select(*keys, "x.threshold", "x.fpr", "x.tpr")


def log_loss(df: DataFrame, label: str, prob: str, keys=(), eps: float = LOGLOSS_EPS) -> DataFrame:
    """Mean binary cross-entropy with probabilities clipped to [eps, 1-eps]."""
    p = F.least(F.greatest(_c(prob).cast("double"), F.lit(eps)), F.lit(1.0 - eps))
    y = _c(label).cast("double")
    return df.groupBy(*keys).agg(F.avg(-(y * F.log(p) + (1.0 - y) * F.log(1.0 - p))).alias("log_loss"),
                                 F.count(F.lit(1)).alias("n_eval"))


def brier(df: DataFrame, label: str, prob: str, keys=()) -> DataFrame:
    """Mean squared error of the probability."""
    return df.groupBy(*keys).agg(F.avg(F.pow(_c(prob) - _c(label), 2)).alias("brier"),
                                 F.count(F.lit(1)).alias("n_eval"))


def calibration_bins(df: DataFrame, label: str, prob: str, n_bins: int = 10,
                     n_buckets: int | None = DEFAULT_BUCKETS) -> DataFrame:
    """Quantile reliability table (A16): edges are exact linear-interpolated
    percentiles of the probability; a row's bin is the number of inner edges
    strictly below it; one row per non-empty bin, none unless both classes
    are present."""
    src = df.select(_c(label).cast("double").alias("_y"), _c(prob).cast("double").alias("_p"))
    both = src.select(F.min("_y") < F.max("_y")).scalar()
    src = src.where(F.coalesce(both, F.lit(False)))
    probs = [i / n_bins for i in range(1, n_bins)]
    edges = exact_quantiles(src, "_p", probs, n_buckets=n_buckets)
    arr = edges.agg(F.array_sort(F.collect_list(F.struct("q", "value"))).alias("e")).select(
        F.transform("e", lambda s: s["value"]).alias("edges"))
    binned = src.withColumn("_edges", arr.select("edges").scalar())
    binned = binned.withColumn("bin", F.size(F.filter("_edges", lambda e: e < F.col("_p"))))
    return binned.groupBy("bin").agg(F.avg("_p").alias("mean_pred"), F.avg("_y").alias("frac_pos"),
                                     F.count(F.lit(1)).alias("n"))


def _long(pred: DataFrame, keys, threshold: float, joint: bool = True) -> DataFrame:
    """(task, keys, _y, _p, _d): one row per prediction and task it counts in."""
    def row(task, y, p, d):
        return F.struct(F.lit(task).alias("task"), y.cast("int").alias("_y"), p.cast("double").alias("_p"), d.cast("int").alias("_d"))
    y1, y2, p1, p2 = F.col("y1_true") == 1, F.col("y2_true") == 1, F.col("y1_prob"), F.col("y2_prob")
    d1, d2 = p1 >= threshold, p2 >= threshold
    rows = [row(TASK1, y1, p1, d1), F.when(F.col("y2_mask") == 1, row(TASK2, y2, p2, d2))]
    if joint:
        rows.append(row(JOINT, y1 & y2, p1 * p2, d1 & d2))
    return pred.select(*keys, F.explode(F.array(*rows)).alias("r")).where("r is not null").select("r.task", *keys, "r._y", "r._p", "r._d")


def _all_metrics(long: DataFrame, keys, threshold: float, n_buckets) -> DataFrame:
    """Every metric of every (task, keys) from one table of distinct scores."""
    keys = ["task", *keys]
    hit = (F.col("_d") == 1) & (F.col("_y") == 1)
    ranked = _ranked_scores(long, keys, n_buckets, {"tp": hit.cast("int"), "pp": F.col("_d")})
    g = ranked.groupBy(*keys).agg(*_ranking_aggs()).select(
        *keys, *_auc_cols(), F.col("tot.cnt").alias("n_eval"), F.col("tot.tp").alias("tp"),
        (F.col("tot.pp") - F.col("tot.tp")).alias("fp"), (F.col("tot.pos") - F.col("tot.tp")).alias("fn"),
        (F.col("tot.cnt") - F.col("tot.pos") - F.col("tot.pp") + F.col("tot.tp")).alias("tn"))
    rec, prec = recall_precision_cols()
    return g.select(*keys, "auc", "pr_auc", rec, prec, F.lit(float(threshold)).alias("threshold"),
                    "n_eval", "tn", "fp", "fn", "tp")


def task_metrics(df: DataFrame, label: str, prob: str, keys=(), threshold: float = THRESHOLD,
                 n_buckets: int | None = DEFAULT_BUCKETS) -> DataFrame:
    """auc, pr_auc, recall, precision, threshold, n_eval, tn, fp, fn, tp of one
    task per key."""
    long = df.select(F.lit("").alias("task"), *keys, (_c(label) == 1).cast("int").alias("_y"),
                     _c(prob).cast("double").alias("_p"), (_c(prob) >= threshold).cast("int").alias("_d"))
    return _all_metrics(long, keys, threshold, n_buckets).drop("task")


def metrics_bundle(pred: DataFrame, threshold: float = THRESHOLD, keys=(),
                   n_buckets: int | None = DEFAULT_BUCKETS) -> DataFrame:
    """Task 1, task 2 on the masked rows, and the joint event (A18, C16), all
    from one pass over the predictions.

    Expects y1_true, y1_prob, y2_true, y2_prob, y2_mask.  Without keys all
    three tasks have a row: an empty mask gives NULL metrics and zero counts,
    as the reference does.
    """
    keys = list(keys)
    got = _all_metrics(_long(pred, keys, threshold), keys, threshold, n_buckets)
    if not keys:
        tasks = pred.sparkSession.createDataFrame([(t,) for t in (TASK1, TASK2, JOINT)], "task string")
        counts = ("n_eval", "tn", "fp", "fn", "tp")
        got = tasks.join(got, "task", "left").withColumns({c: F.coalesce(c, F.lit(0)) for c in counts}) \
            .withColumn("threshold", F.lit(float(threshold)))
    return got.select("task", *keys, "auc", "pr_auc", "recall", "precision", "threshold", "n_eval",
                      "tn", "fp", "fn", "tp")


def subgroup_metrics(pred: DataFrame, group_col: str = "first_careunit", threshold: float = THRESHOLD,
                     n_buckets: int | None = DEFAULT_BUCKETS) -> DataFrame:
    """Task 1 and masked task 2 metrics per subgroup (A17); NULL group is
    ``UNKNOWN``; task 2 rows only where the group has masked rows."""
    if group_col not in pred.columns:
        return pred.sparkSession.createDataFrame([], "group string, task string")
    g = pred.withColumn("group", F.coalesce(F.col(group_col).cast("string"), F.lit("UNKNOWN")))
    got = _all_metrics(_long(g, ["group"], threshold, joint=False), ["group"], threshold, n_buckets)
    return got.select("group", "task", "auc", "pr_auc", "recall", "precision", "threshold", "n_eval", "tn", "fp", "fn", "tp")
