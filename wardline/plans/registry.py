"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per
operator of the inventory, each over the whole driver tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import cohort, hourly, labels, landmarks, notes
from ..session import cut_lineage, spread
from ..sources import fixtures
from . import master as M
from .inputs import cohort_inputs, rounded, without_timestamps

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(name: str):
    def deco(fn):
        REGISTRY[name] = fn
        return fn
    return deco


VARS = [v for v, _ in fixtures.VITAL_SOURCES]


def _tables(spark, d):
    return fixtures.cohort_tables(spark, d)


def _kept(spark, d):
    return cohort.los_filter(_tables(spark, d)["stays"])


def _rel(spark, d):
    t = _tables(spark, d)
    kept = cohort.los_filter(t["stays"])
    ts = cohort.restrict(t["vitals"], kept)
    return kept, hourly.with_relative_hour(ts, kept)


# ---- step 1: cohort, hourly grid, trailing window ---------------------------

@query("los_filter")
def q_los_filter(spark, d):
    return rounded(without_timestamps(_kept(spark, d)))


@query("los_report")
def q_los_report(spark, d):
    return rounded(cohort.los_report(_tables(spark, d)["stays"]))


@query("cohort_semi_join")
def q_cohort_semi_join(spark, d):
    _, rel = _rel(spark, d)
    return rounded(rel.select("stay_id", "relative_hour", *VARS))


@query("hour_range")
def q_hour_range(spark, d):
    _, rel = _rel(spark, d)
    return rounded(hourly.hour_range(rel))


@query("hourly_mean_rint")
def q_hourly_rint(spark, d):
    _, rel = _rel(spark, d)
    return rounded(hourly.hourly_means(rel, VARS, "rint"))


@query("hourly_mean_floor")
def q_hourly_floor(spark, d):
    _, rel = _rel(spark, d)
    return rounded(hourly.hourly_means(rel, VARS, "floor"))


@query("landmark_spine")
def q_spine(spark, d):
    _, rel = _rel(spark, d)
    return landmarks.landmark_spine(hourly.hourly_means(rel, VARS, "rint"))


@query("trailing_features")
def q_trailing(spark, d):
    _, rel = _rel(spark, d)
    return rounded(landmarks.trailing_features(hourly.hourly_means(rel, VARS, "rint"), VARS))


@query("task1_label")
def q_task1(spark, d):
    kept, rel = _rel(spark, d)
    feats = landmarks.trailing_features(hourly.hourly_means(rel, VARS, "rint"), VARS)
    m = feats.select("stay_id", "t_end").join(kept.select("stay_id", "subject_id"), "stay_id")
    out = labels.task_labels(m, kept, labels.readmit_labels(kept))
    return rounded(out.select("stay_id", "t_end", "icu_out_hour", "icu_death_flag", "discharge_in_24h",
                              labels.TASK1_COL))


# ---- step 2: cohort labels ------------------------------------------------------

@query("icu_death_flag")
def q_icu_death(spark, d):
    return rounded(labels.stay_outcomes(_tables(spark, d)["stays"]))


@query("readmit_labels")
def q_readmit(spark, d):
    return labels.readmit_labels(_kept(spark, d))


@query("event_table")
def q_event_table(spark, d):
    return rounded(labels.event_table(_tables(spark, d)["stays"]))


@query("landmark_labels")
def q_landmark_labels(spark, d):
    lt = M.landmark_table(cohort_inputs(spark, d, with_text=False))
    keep = ["stay_id", "t_end", "event_type", "event_hour", "remaining_hours", "landmark_bin",
            "landmark_hour", "landmark_hour_sq"] + [c for c in lt.columns if c.startswith("event_d")]
    return rounded(lt.select(*keep))


@query("survival_targets")
def q_survival_targets(spark, d):
    inp = cohort_inputs(spark, d)
    mt = M.master_trailing(inp).select("stay_id", "subject_id", "t_end")
    ev = labels.event_table(cohort.los_filter(inp.static), require_positive=False)
    j = mt.join(ev.select("stay_id", "subject_id", "event_type", "event_hour"), ["stay_id", "subject_id"])
    return rounded(labels.survival_targets(j.dropna(subset=["event_type", "event_hour"])))


@query("multi_horizon_labels")
def q_multi_horizon(spark, d):
    lt = M.landmark_table(cohort_inputs(spark, d, with_text=False))
    out = labels.multi_horizon_labels(lt.select("stay_id", "t_end", "event_type", "remaining_hours"))
    return rounded(out)


# ---- step 3: cumulative path ------------------------------------------------------

@query("cumulative_features")
def q_cumulative(spark, d):
    _, rel = _rel(spark, d)
    return rounded(landmarks.cumulative_features(hourly.hourly_means(rel, VARS, "floor"), VARS), 6,
                   {f"{v}_cum_std": 4 for v in VARS})


@query("locf")
def q_locf(spark, d):
    _, rel = _rel(spark, d)
    return rounded(landmarks.locf(hourly.hourly_means(rel, VARS, "floor"), VARS))


@query("master_cumulative")
def q_master_cumulative(spark, d):
    m = M.master_cumulative(cohort_inputs(spark, d, with_text=False))
    return rounded(without_timestamps(m), 6, {f"{v}_cum_std": 4 for v in VARS})


@query("landmark_table")
def q_landmark_table(spark, d):
    m = M.landmark_table(cohort_inputs(spark, d, with_text=False))
    return rounded(without_timestamps(m), 6, {f"{v}_cum_std": 4 for v in VARS})


# ---- step 4: notes ----------------------------------------------------------------

def _segments(spark, d):
    t = _tables(spark, d)
    kept = cohort.los_filter(t["stays"])
    return kept, notes.note_segments(cohort.restrict(spread(t["notes"]), kept), kept)


@query("note_segments")
def q_note_segments(spark, d):
    _, seg = _segments(spark, d)
    return rounded(seg)


@query("note_asof_text")
def q_note_asof(spark, d):
    kept, seg = _segments(spark, d)
    ts = cohort.restrict(_tables(spark, d)["vitals"], kept)
    rel = hourly.with_relative_hour(ts, kept)
    spine = landmarks.trailing_features(hourly.hourly_means(rel, VARS, "rint"), VARS).select("stay_id", "t_end")
    return rounded(notes.asof_text(spine, seg))


@query("master_trailing")
def q_master_trailing(spark, d):
    return rounded(without_timestamps(M.master_trailing(cohort_inputs(spark, d))))


# ---- step 5: evaluation -----------------------------------------------------------

from ..operators import evaluate as EV  # noqa: E402


def _pred(spark, d):
    return fixtures.predictions(spark, d)


@query("confusion")
def q_confusion(spark, d):
    return EV.confusion(_pred(spark, d), "y1_true", "y1_prob")


@query("precision_recall")
def q_precision_recall(spark, d):
    cf = EV.confusion(_pred(spark, d), "y1_true", "y1_prob")
    rec, prec = EV.recall_precision_cols()
    return rounded(cf.select(rec, prec, "n_eval"))


@query("roc_auc")
def q_roc_auc(spark, d):
    return rounded(EV.ranking_metrics(_pred(spark, d), "y1_true", "y1_prob").select("auc"))


@query("average_precision")
def q_average_precision(spark, d):
    return rounded(EV.ranking_metrics(_pred(spark, d), "y1_true", "y1_prob").select("pr_auc"))


@query("roc_points")
def q_roc_points(spark, d):
    return rounded(EV.roc_points(_pred(spark, d), "y1_true", "y1_prob"))


def _per_task(fn, pred):
    t1 = fn(pred, "y1_true", "y1_prob").withColumn("task", F.lit(EV.TASK1))
    t2 = fn(pred.where(F.col("y2_mask") == 1), "y2_true", "y2_prob").withColumn("task", F.lit(EV.TASK2))
    return t1.unionByName(t2)


@query("log_loss")
def q_log_loss(spark, d):
    return rounded(_per_task(EV.log_loss, _pred(spark, d)))


@query("brier")
def q_brier(spark, d):
    return rounded(_per_task(EV.brier, _pred(spark, d)))


@query("calibration_bins")
def q_calibration(spark, d):
    return rounded(EV.calibration_bins(_pred(spark, d), "y1_true", "y1_prob"))


@query("calibration_task2")
def q_calibration_task2(spark, d):
    return rounded(EV.calibration_bins(_pred(spark, d).where("y2_mask = 1"), "y2_true", "y2_prob"))


@query("subgroup_metrics")
def q_subgroup(spark, d):
    return rounded(EV.subgroup_metrics(_pred(spark, d)))


@query("metrics_bundle")
def q_bundle(spark, d):
    return rounded(EV.metrics_bundle(_pred(spark, d)))


# ---- step 6: split and fitted transforms ------------------------------------------

from ..operators import fit as FT  # noqa: E402

WIDE = list(fixtures.WIDE_FEATURES)


def _wide_split(spark, d):
    return FT.group_split(fixtures.wide(spark, d))


@query("group_split")
def q_group_split(spark, d):
    return _wide_split(spark, d).select("row_id", "subject_id", "split")


@query("group_split_exact")
def q_group_split_exact(spark, d):
    return FT.exact_group_split(fixtures.wide(spark, d)).select("row_id", "subject_id", "split")


@query("split_summary")
def q_split_summary(spark, d):
    m = FT.group_split(M.master_trailing(cohort_inputs(spark, d)))
    return rounded(FT.split_summary(m, labels.TASK1_COL))


@query("debug_sample")
def q_debug_sample(spark, d):
    return cohort.debug_sample(_kept(spark, d), 50).select("stay_id", "subject_id")


@query("leakage_drop")
def q_leakage_drop(spark, d):
    return rounded(without_timestamps(cohort.drop_leakage(_kept(spark, d))))


@query("missing_rate")
def q_missing_rate(spark, d):
    tr = _wide_split(spark, d).where("split = 'train'")
    return rounded(FT.missing_rates(tr, WIDE))


def _imputed(spark, d):
    """The wide table with its split, and imputed.  Written once: every fit
    passes over it, and none runs the join again."""
    w = cut_lineage(_wide_split(spark, d), "wide")
    params = FT.fit_median(w.where("split = 'train'"), WIDE, written=True)
    return w, FT.apply_median(w, params, passthrough=["row_id", "subject_id", "split"])


@query("median_impute")
def q_median_impute(spark, d):
    return rounded(_imputed(spark, d)[1])


@query("standardize")
def q_standardize(spark, d):
    _, imp = _imputed(spark, d)
    cols = [c for c in imp.columns if c in WIDE]
    sp = FT.fit_standard(imp.where("split = 'train'"), cols)
    return rounded(FT.apply_standard(imp, sp, passthrough=["row_id", "split"]))


@query("corr_drop")
def q_corr_drop(spark, d):
    _, imp = _imputed(spark, d)
    cols = [c for c in imp.columns if c in WIDE]
    dropped = set(FT.fit_corr_drop(imp.where("split = 'train'"), cols))
    var = FT.variance_table(imp.where("split = 'train'"), cols)   # one row per fitted column
    return var.select("column", F.col("column").isin(list(dropped) or [""]).cast("int").alias("dropped"))


@query("top_variance")
def q_top_variance(spark, d):
    _, imp = _imputed(spark, d)
    cols = [c for c in imp.columns if c in WIDE]
    train = imp.where("split = 'train'")
    ranks = spark.createDataFrame(list(enumerate(FT.top_variance(train, cols), 1)), "rank int, column string")
    return rounded(FT.variance_table(train, cols).join(F.broadcast(ranks), "column"), 4)


# ---- step 7: text features and history tensors ------------------------------------

from ..operators import tensors as TS  # noqa: E402
from ..operators import text_features as TX  # noqa: E402
from ..sources.tables import read_table  # noqa: E402


@query("tfidf")
def q_tfidf(spark, d):
    """Fitted on the training documents, all documents weighted."""
    docs = FT.group_split(read_table(spark, d, "documents").select("doc_id", "text"), group="doc_id")
    model = TX.fit_tfidf(docs.where("split = 'train'"), "text")
    return rounded(TX.tfidf_long(docs, "doc_id", "text", model))


@query("vocab_encode")
def q_vocab_encode(spark, d):
    docs = FT.group_split(read_table(spark, d, "documents").select("doc_id", "text"), group="doc_id")
    vocab = TX.fit_vocab(docs.where("split = 'train'"), "text")
    enc = TX.encode(docs, "doc_id", "text", vocab)
    return enc.select("doc_id", "n_tokens", F.array_join("input_ids", " ").alias("input_ids"),
                      F.aggregate("attention_mask", F.lit(0), lambda a, x: a + x).alias("attention_len"))


def _tensor_inputs(spark, d):
    inp = cohort_inputs(spark, d)
    mt = M.master_trailing(inp)
    kept = cohort.los_filter(inp.static)
    rel = hourly.with_relative_hour(cohort.restrict(inp.time_series, kept), kept)
    hf = hourly.hourly_means(rel, VARS, "floor")
    return mt, hf


def _tensor_long(df):
    x = df.select("stay_id", "t_end", F.posexplode("time_series").alias("pos", "_v"))
    return x.select("stay_id", "t_end", "pos", *[F.col("_v")[i].alias(v) for i, v in enumerate(VARS)])


@query("history_tensor")
def q_history_tensor(spark, d):
    mt, hf = _tensor_inputs(spark, d)
    return rounded(_tensor_long(TS.history_tensor(mt.select("stay_id", "t_end"), hf, VARS)))


@query("tensor_normalize")
def q_tensor_normalize(spark, d):
    mt, hf = _tensor_inputs(spark, d)
    train = FT.group_split(mt).where("split = 'train'").select("stay_id", "t_end")
    return rounded(TS.tensor_norm_table(TS.history_cells(train, hf, VARS), VARS))


@query("modality_switch")
def q_modality_switch(spark, d):
    mt, hf = _tensor_inputs(spark, d)
    t = TS.history_tensor(mt.select("stay_id", "t_end"), hf, VARS)
    return rounded(_tensor_long(TS.modality_switch(t, use_time=False)))


# ---- step 8: models, loss curves, survival ----------------------------------------

from ..operators import curves as CV  # noqa: E402
from ..operators import incidence as IN  # noqa: E402
from ..operators import models as MD  # noqa: E402
from ..operators import survival as SV  # noqa: E402
from . import matrices as MX  # noqa: E402
from . import runs as RN  # noqa: E402

def _master_split(spark, d):
    return FT.group_split(M.master_trailing(cohort_inputs(spark, d)))


@query("class_weight")
def q_class_weight(spark, d):
    tr = _master_split(spark, d).where("split = 'train'")
    t1 = MD.class_balance(tr, labels.TASK1_COL).withColumn("task", F.lit(EV.TASK1))
    t2 = MD.class_balance(tr, labels.TASK2_COL, F.col(labels.TASK2_MASK_COL) == 1).withColumn("task", F.lit(EV.TASK2))
    return rounded(t1.unionByName(t2))


@query("seeded_sample")
def q_seeded_sample(spark, d):
    m = M.master_trailing(cohort_inputs(spark, d)).select("stay_id", "t_end")
    s = MD.seeded_sample(m.withColumn("t_hour", F.col("t_end").cast("bigint")), 2000, ["stay_id", "t_hour"])
    return s.select("stay_id", "t_end")


@query("cif")
def q_cif(spark, d):
    return rounded(SV.cif_from_logits(fixtures.survival_logits(spark, d)).drop(
        *[c for c in fixtures.survival_logits(spark, d).columns if c.startswith("logit")]))


@query("cif_rescaled")
def q_cif_rescaled(spark, d):
    return rounded(SV.cif_from_logits(fixtures.survival_logits(spark, d), rescale=True).drop(
        *[c for c in fixtures.survival_logits(spark, d).columns if c.startswith("logit")]))


def _matrix_long(m, features):
    """(stay_id, t_end, split, feature, value); standard deviations rounded
    less, as two engines sum them up differently.  Numbers are unpivoted first,
    then named and rounded: one expression over all columns is too large for
    the JVM to compile."""
    x = m.data.select("stay_id", "t_end", "split", F.posexplode(F.array(*[F.col(FT.quoted(c)) for c in features])).alias("_c", "v"))
    names = F.array(*[F.lit(c) for c in features])
    coarse = F.array(*[F.lit("_cum_std" in c) for c in features])
    return x.select("stay_id", "t_end", "split", F.get(names, F.col("_c")).alias("feature"),
                    F.when(F.get(coarse, F.col("_c")), F.round("v", 3)).otherwise(F.round("v", 6)).alias("value"))


def _base(spark, d):
    return MX.base_matrices(FT.group_split(M.master_trailing(cohort_inputs(spark, d), increments=True)), scale_for_linear=True)


@query("base_matrix")
def q_base_matrix(spark, d):
    m = _base(spark, d)
    return _matrix_long(m, [c for c in m.features if not c.startswith("tfidf_")])


@query("base_matrix_text")
def q_base_matrix_text(spark, d):
    """The TF-IDF part of the base matrix, summed up by split and term."""
    m = _base(spark, d)
    terms = [c for c in m.features if c.startswith("tfidf_")]
    x = m.data.select("split", F.posexplode(F.array(*[F.col(FT.quoted(c)) for c in terms])).alias("_c", "v"))
    sums = x.groupBy("split", "_c").agg(
        F.count("*").alias("n"), F.avg("v").alias("mean_value"), F.max("v").alias("max_value"),
        F.avg(F.col("v") * F.col("v")).alias("mean_square"))
    return rounded(sums.select("split", F.get(F.array(*[F.lit(c) for c in terms]), F.col("_c")).alias("feature"),
                               "n", "mean_value", "max_value", "mean_square"))


@query("cumulative_matrix")
def q_cumulative_matrix(spark, d):
    m = MX.cumulative_matrices(FT.group_split(M.master_cumulative(cohort_inputs(spark, d, False))))
    return _matrix_long(m, m.features)


@query("landmark_matrix")
def q_landmark_matrix(spark, d):
    m = MX.landmark_matrices(FT.group_split(M.landmark_table(cohort_inputs(spark, d, False))))
    return _matrix_long(m, m.features)


@query("logistic_two_head")
def q_logistic(spark, d):
    return RN.run_logistic(_base(spark, d)).predictions


@query("gbt_two_head")
def q_gbt(spark, d):
    m = MX.cumulative_matrices(FT.group_split(M.master_cumulative(cohort_inputs(spark, d, False))))
    return RN.run_gbt(m).predictions


@query("loss_table")
def q_loss_table(spark, d):
    return rounded(fixtures.loss_table(spark, d))


@query("lambda_curve")
def q_lambda_curve(spark, d):
    return rounded(CV.lambda_curve(fixtures.loss_table(spark, d)))


@query("lambda_curve_gated")
def q_lambda_curve_gated(spark, d):
    """Update only with at least 64 valid task-2 rows, ratio L1/max(L2, eps)."""
    return rounded(CV.lambda_curve(fixtures.loss_table(spark, d), min_valid=64,
                                   valid_count_col="train_task2_valid_count", ratio_mode="max_eps"))


@query("best_round")
def q_best_round(spark, d):
    return rounded(CV.best_round(CV.lambda_curve(fixtures.loss_table(spark, d))))


@query("early_stop")
def q_early_stop(spark, d):
    return rounded(CV.early_stop(CV.lambda_curve(fixtures.loss_table(spark, d)), patience=5))


@query("two_monitors")
def q_two_monitors(spark, d):
    curve = CV.lambda_curve(fixtures.loss_table(spark, d))
    return rounded(CV.two_monitors(curve, "val_loss_total", "val_loss_task2_masked", patience=5))


@query("attribution_linear")
def q_attribution(spark, d):
    m = _base(spark, d)
    run = RN.run_logistic(m)
    means = FT.fit_standard(m.split("train"), m.features).mean     # one pass
    sample = MD.seeded_sample(m.split("test").withColumn("t_hour", F.col("t_end").cast("bigint")), 2000,
                              ["stay_id", "t_hour"])
    return MD.linear_attribution(run.model.head1, sample, means)


def _tree_head(spark, d):
    m = MX.cumulative_matrices(FT.group_split(M.master_cumulative(cohort_inputs(spark, d, False))))
    head = MD.fit_head(m.split("train"), m.features, labels.TASK1_COL, "gbt")
    return head, m.split("test").withColumn("t_hour", F.col("t_end").cast("bigint"))


@query("attribution_tree")
def q_attribution_tree(spark, d):
    """Mean absolute contributions to the boosted task-1 head on all test rows."""
    head, rows = _tree_head(spark, d)
    return MD.tree_attribution(head, rows, ["stay_id", "t_hour"])


@query("permutation_importance")
def q_permutation_importance(spark, d):
    """Permutation importance of the boosted task-1 head on all test rows."""
    head, rows = _tree_head(spark, d)
    return MD.permutation_importance(head, rows, labels.TASK1_COL, ["stay_id", "t_hour"])


@query("cause_specific_cif")
def q_cause_specific(spark, d):
    inp = cohort_inputs(spark, d, with_text=False)
    table = M.landmark_table(inp)
    m = MX.landmark_matrices(FT.group_split(table))
    targets = labels.survival_targets(table)
    return RN.cif_table(RN.cause_specific_cif(m, targets), targets)


@query("aalen_johansen")
def q_aalen_johansen(spark, d):
    lt = M.landmark_table(cohort_inputs(spark, d, with_text=False))
    return rounded(IN.aalen_johansen(lt.select("t_end", "event_type", "remaining_hours"), "remaining_hours", "event_type",
                                     keys=["t_end"]))


@query("tensor_dataset")
def q_tensor_dataset(spark, d):
    inp = cohort_inputs(spark, d)
    kept = cohort.los_filter(inp.static)
    mt = M.master_trailing(inp, increments=True)
    rel = hourly.with_relative_hour(cohort.restrict(inp.time_series, kept), kept)
    hf = hourly.hourly_means(rel, VARS, "floor")
    ev = labels.event_table(kept, require_positive=False)
    out, _ = MX.tensor_dataset(mt.drop("split"), kept, hf, VARS, None, ev)
    # arrays as text or position-weighted sums, so that another engine can compare them
    def weighted(i):
        terms = F.transform("time_series", lambda h, p: h[i] * (p + 1))
        return F.round(F.aggregate(terms, F.lit(0.0), lambda a, x: a + x), 4)
    return out.select("stay_id", "t_end", "split", *MX.TASK_COLS, *[f"surv_label_bin{i}" for i in (1, 2, 3)],
                      *[weighted(i).alias(f"{v}_weighted") for i, v in enumerate(VARS)],
                      F.round(F.col("static")[0], 6).alias("static_age"), F.size("static").alias("n_static"),
                      F.array_join("input_ids", " ").alias("input_ids"),
                      F.aggregate("attention_mask", F.lit(0), lambda a, x: a + x).alias("attention_len"))


# ---- comparisons ---------------------------------------------------------------------

from ..operators import compare as CP  # noqa: E402


def _three_bundles(spark, d):
    p = _pred(spark, d)
    swapped = p.select("row_id", "first_careunit", "y1_true", F.col("y2_prob").alias("y1_prob"), "y2_true",
                       F.col("y1_prob").alias("y2_prob"), "y2_mask")
    flipped = p.select("row_id", "first_careunit", "y1_true", (1 - F.col("y1_prob")).alias("y1_prob"), "y2_true",
                       (1 - F.col("y2_prob")).alias("y2_prob"), "y2_mask")
    # tables as a metrics file stores them (6 decimals), then compared
    return {"candidate": rounded(EV.metrics_bundle(p)), "baseline_a": rounded(EV.metrics_bundle(swapped)),
            "baseline_b": rounded(EV.metrics_bundle(flipped))}


@query("comparison_long")
def q_comparison_long(spark, d):
    b = _three_bundles(spark, d)
    return rounded(CP.comparison_long(b["candidate"], {"baseline_a": b["baseline_a"], "baseline_b": b["baseline_b"]}))


@query("comparison_wide")
def q_comparison_wide(spark, d):
    return rounded(CP.comparison_wide(_three_bundles(spark, d), "candidate"))


@query("interactions")
def q_interactions(spark, d):
    lt = FT.group_split(M.landmark_table(cohort_inputs(spark, d, with_text=False)))
    return rounded(MX.landmark_interactions(lt))
