"""Feature-matrix builders (X2, X3, X4, X6): fit every transform on the
training split, apply it to all splits.

The input is checkpointed once (reliable checkpoint in the shared folder)
because fitting makes several passes over the training rows; after that each
fitted step is a projection with literal parameters.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F

from ..operators import fit as FT
from ..operators import labels as LB
from ..operators import notes
from ..operators import tensors as TS
from ..operators import text_features as TX
from ..operators.cohort import GROUP_COL, HADM_COL, ID_COL, leakage_columns
from ..session import cut_lineage
from ..sources.tables import numeric_variables, require_columns

TASK_COLS = (LB.TASK1_COL, LB.TASK2_COL, LB.TASK2_MASK_COL)
KEEP = (ID_COL, GROUP_COL, "t_end", "split", "first_careunit") + TASK_COLS

# --- fixed values: never-dropped and never-feature columns per path -------------
BASE_SAFE = (ID_COL, GROUP_COL, "t_start", "t_end", "icu_out_hour", "discharge_in_24h", "icu_death_flag",
             LB.TASK1_COL, LB.TASK2_COL, LB.TASK2_MASK_COL, "final_text", "has_text", "intime", "outtime")
BASE_EXCLUDE = (ID_COL, GROUP_COL, HADM_COL, "t_start", "t_end", "icu_out_hour", "intime", "outtime",
                "final_text", "discharge_in_24h", "icu_death_flag", LB.TASK1_COL, LB.TASK2_COL, LB.TASK2_MASK_COL)
CUM_SAFE = (ID_COL, GROUP_COL, HADM_COL, "t_start", "t_end", "icu_out_hour", "discharge_in_24h",
            "icu_death_flag", "intime", "outtime", LB.TASK1_COL, LB.TASK2_COL, LB.TASK2_MASK_COL)
CUM_EXCLUDE = (ID_COL, GROUP_COL, HADM_COL, "t_start", "t_end", "icu_out_hour", "intime", "outtime",
               "discharge_in_24h", "icu_death_flag", LB.TASK1_COL, LB.TASK2_COL, LB.TASK2_MASK_COL)
LANDMARK_SAFE = ((ID_COL, GROUP_COL, HADM_COL, "t_start", "t_end", "icu_out_hour", "event_type", "event_hour",
                  "death_hour", "remaining_hours", "landmark_bin")
                 + tuple(f"event_{k}_within_{h}h" for h in LB.INTERVAL_BOUNDS for k in ("discharge", "death"))
                 + tuple(f"event_{k}_{lo}_{hi}h" for lo, hi in ((0, 24), (24, 48), (48, 72))
                         for k in ("discharge", "death")))
LANDMARK_EXTRA_EXCLUDE = ("final_text", "intime", "outtime", "discharge_in_24h", "icu_death_flag",
                          LB.TASK1_COL, LB.TASK2_COL, LB.TASK2_MASK_COL)
# ---------------------------------------------------------------------------------


@dataclass
class Matrices:
    data: DataFrame                      # all splits: KEEP columns + final features
    features: list
    artifacts: dict = field(default_factory=dict)

    def split(self, name: str) -> DataFrame:
        return self.data.where(F.col("split") == name)

    def apply(self, table: DataFrame) -> DataFrame:
        """The fitted transforms on another landmark table: its key and label
        columns that are there, and the final features."""
        return apply_artifacts(table, self.artifacts, self.features)


BASE_REQUIRED = (ID_COL, GROUP_COL, "t_end", *TASK_COLS)


def _split(table: DataFrame, required) -> DataFrame:
    """The table with its split, after the guards: required columns, and at
    least three groups where the split is made here."""
    require_columns(table, required, "landmark table")
    if "split" in table.columns:
        return table
    FT.check_groups(table)
    return FT.group_split(table)


def _present(df, cols):
    return [c for c in cols if c in df.columns]


def _apart(df: DataFrame, checkpoint: bool = True):
    """The table without its added texts (written, with ``checkpoint``), the one
    that these are read from (None: there are none), and the column that says how
    many rows hold them, if there is one.  Texts of a master that was written
    with them are not written again."""
    if "new_text" not in df.columns:
        return cut_lineage(df) if checkpoint else df, None, None
    later = notes.LATER if notes.LATER in df.columns else None
    if checkpoint and later is None:
        df = cut_lineage(df)
        return df.drop("new_text"), df, None
    narrow = df.drop("new_text", notes.LATER)
    return cut_lineage(narrow) if checkpoint else narrow, df, later


def base_matrices(master: DataFrame, scale_for_linear: bool, tfidf_max_features: int = 300,
                  checkpoint: bool = True) -> Matrices:
    """X2 on the trailing master: missing drop, TF-IDF, numeric selection,
    median imputation, optional standardisation, correlation drop.

    A master with ``new_text`` (what each landmark adds) gives the same matrix
    as one with the cumulative ``final_text``, and tokenizes every report
    once."""
    df = _split(master, BASE_REQUIRED)
    df, whole, later = _apart(df, checkpoint)
    train = df.where("split = 'train'")
    drop = FT.fit_missing(train, [c for c in df.columns if c != "split"], safe=BASE_SAFE, keep_suffixes=("_is_measured",))
    df = df.drop(*drop)
    train = df.where("split = 'train'")
    tfidf_names, model = [], None
    if whole is not None:
        if whole.where("split = 'train' AND length(new_text) > 0").select("split").limit(1).count():
            added = TX.growing_tokens(whole, ID_COL, "t_end", "new_text", ["split"], later)
            model = TX.fit_tfidf_growing(added.where("split = 'train'"), max_features=tfidf_max_features)
            df = TX.tfidf_wide_growing(df, ID_COL, "t_end", added, model)
            tfidf_names = [f"tfidf_{t}" for t in model.vocabulary]
    elif "final_text" in df.columns and train.where(F.length(F.coalesce("final_text", F.lit(""))) > 0).limit(1).count():
        model = TX.fit_tfidf(train, "final_text", max_features=tfidf_max_features)
        df = TX.tfidf_wide(df, "final_text", model)
        tfidf_names = [f"tfidf_{t}" for t in model.vocabulary]
    feats = FT.feature_columns(df, exclude=BASE_EXCLUDE + ("split",))
    return _finish(df, feats, scale_for_linear, {"cols_to_drop_missing": drop, "tfidf_feature_names": tfidf_names,
                                                 "tfidf": model}, checkpoint)


def _finish(df, feats, scale, artifacts, checkpoint=True, interactions: int = 0):
    if not feats:
        raise ValueError("no numeric features left for modeling")
    keep = _present(df, KEEP) + (["landmark_hour"] if "landmark_hour" in df.columns and "landmark_hour" not in feats
                                 else [])
    work = df.selectExpr(*map(FT.quoted, keep), *[f"cast({FT.quoted(c)} AS DOUBLE) AS {FT.quoted(c)}" for c in feats])
    if checkpoint:
        work = cut_lineage(work)
    train = work.where("split = 'train'")
    imp = FT.fit_median(train, feats, written=checkpoint)
    work = FT.apply_median(work, imp, passthrough=keep)
    feats = [c for c in feats if imp.medians.get(c) is not None]
    created = []
    if interactions:
        top = FT.top_variance(work.where("split = 'train'"), feats, k=interactions)
        work = FT.add_interactions(work, top)
        created = [f"{c}_x_landmark" for c in top]
        feats = feats + created
    scaler = None
    if scale:
        scaler = FT.fit_standard(work.where("split = 'train'"), feats)
        work = FT.apply_standard(work, scaler, passthrough=keep)
    dropped = FT.fit_corr_drop(work.where("split = 'train'"), feats)
    final = [c for c in feats if c not in set(dropped)]
    artifacts.update({"numeric_features": feats, "medians": imp.medians, "interaction_cols": created,
                      "scaler": scaler, "corr_drop_cols": dropped, "final_feature_names": final})
    return Matrices(work.selectExpr(*map(FT.quoted, [*keep, *final])), final, artifacts)


def apply_artifacts(table: DataFrame, artifacts: dict, features: list) -> DataFrame:
    """Fitted transforms from their artifacts (as saved with a run): TF-IDF,
    imputation, interactions, scaling, final columns.  No fitting, no join."""
    df, tfidf = table, artifacts.get("tfidf")
    if tfidf and tfidf.vocabulary and "new_text" in df.columns:
        df = TX.tfidf_wide_growing(df, ID_COL, "t_end", TX.growing_tokens(df, ID_COL, "t_end", "new_text"), tfidf)
    elif tfidf and tfidf.vocabulary:
        df = TX.tfidf_wide(df, "final_text", tfidf)
    if "landmark_hour" not in df.columns:
        df = df.withColumn("landmark_hour", F.col("t_end").cast("double"))
    if "landmark_hour_sq" not in df.columns:
        df = df.withColumn("landmark_hour_sq", F.pow("landmark_hour", 2))
    keep = [c for c in df.columns if c in KEEP or c == "landmark_hour"]
    imputed = FT.ImputeParams({c: m for c, m in artifacts["medians"].items() if c not in keep})
    hour = {"landmark_hour": artifacts["medians"].get("landmark_hour")} if "landmark_hour" in artifacts["medians"] else {}
    df = FT.apply_median(df, imputed, passthrough=keep)
    df = df.fillna({k: v for k, v in hour.items() if v is not None})
    if artifacts["interaction_cols"]:
        df = FT.add_interactions(df, [c.removesuffix("_x_landmark") for c in artifacts["interaction_cols"]])
    keep = [c for c in keep if c not in artifacts["numeric_features"]]
    if artifacts["scaler"] is not None:
        df = FT.apply_standard(df, artifacts["scaler"], passthrough=keep)
    return df.select(*keep, *[F.col(f"`{c}`") for c in features])


def cumulative_matrices(master: DataFrame, checkpoint: bool = True) -> Matrices:
    """X3 on the cumulative master: missing drop (``_measured_frac`` kept),
    numeric selection, median imputation, correlation drop; no scaling."""
    df = _split(master, BASE_REQUIRED)
    if checkpoint:
        df = cut_lineage(df)
    train = df.where("split = 'train'")
    drop = FT.fit_missing(train, [c for c in df.columns if c != "split"], safe=CUM_SAFE,
                          keep_suffixes=("_measured_frac",))
    df = df.drop(*drop)
    feats = FT.feature_columns(df, exclude=CUM_EXCLUDE + ("split",))
    return _finish(df, feats, False, {"cols_to_drop_missing": drop}, checkpoint)


def landmark_matrices(table: DataFrame, max_interactions: int = 12, checkpoint: bool = True) -> Matrices:
    """X4 on the landmark table: missing drop, numeric selection plus the
    landmark terms, median imputation, top-variance interactions (X5),
    standardisation, correlation drop."""
    df = _split(table, (ID_COL, GROUP_COL, "t_end"))
    if checkpoint:
        df = cut_lineage(df)
    train = df.where("split = 'train'")
    drop = FT.fit_missing(train, [c for c in df.columns if c != "split"], safe=LANDMARK_SAFE,
                          keep_suffixes=("_measured_frac",))
    df = df.drop(*drop)
    feats = FT.feature_columns(df, exclude=LANDMARK_SAFE + LANDMARK_EXTRA_EXCLUDE + ("split",))
    if "landmark_hour" not in df.columns:
        df = df.withColumn("landmark_hour", F.col("t_end").cast("double"))
    if "landmark_hour_sq" not in df.columns:
        df = df.withColumn("landmark_hour_sq", F.pow("landmark_hour", 2))
    for c in ("landmark_hour", "landmark_hour_sq"):
        if c not in feats:
            feats.append(c)
    return _finish(df, feats, True, {"cols_to_drop_missing": drop}, checkpoint, interactions=max_interactions)


def static_features_of(static: DataFrame) -> list[str]:
    """Static columns that may be features: numeric, no id, no time, and not
    leaking the outcome; in column order."""
    leaking = set(leakage_columns(static.columns))
    return [c for c in numeric_variables(static, exclude=("intime", "outtime", "deathtime")) if c not in leaking]


def tensor_dataset(master: DataFrame, static: DataFrame, hourly_floor: DataFrame, variables,
                   static_features, events: DataFrame, max_text_len: int = TX.MAX_TEXT_LEN,
                   window: int = TS.WINDOW_HOURS) -> tuple[DataFrame, dict]:
    """Per landmark the normalised history tensor, the imputed and
    scaled static vector (empty-in-train columns kept as 0), the encoded
    note text, both task labels and the three survival targets.

    A master with ``new_text`` (what each landmark adds) gives the same as one
    with the cumulative ``final_text``, which is then never built.
    ``static_features`` None: every column that may be one."""
    if static_features is None:
        static_features = static_features_of(static)
    ev = events.select(ID_COL, GROUP_COL, "event_type", "event_hour")
    added = "new_text" in master.columns
    later = notes.LATER if notes.LATER in master.columns else None
    # every join by the stay alone; the texts that a master was written with are read apart
    df = master.drop("new_text", notes.LATER) if later else master
    df = df.join(ev.withColumnRenamed(GROUP_COL, "_group"), ID_COL, "inner").where(F.col(GROUP_COL) == F.col("_group")) \
        .drop("_group").dropna(subset=["event_type", "event_hour"])
    df = LB.survival_targets(df)
    st = FT.prefix_columns(static.select(ID_COL, *static_features), static_features)
    sfe = [f"static__{c}" for c in static_features]
    df = df.join(st, ID_COL, "left")
    df = FT.group_split(df)
    df = cut_lineage(df)
    train = df.where("split = 'train'")
    slots_train = TS.history_cells(train.select(ID_COL, "t_end"), hourly_floor, variables, window)
    norm = TS.fit_tensor_norm(slots_train, variables)
    tens = TS.normalize_tensor(TS.history_tensor(df.select(ID_COL, "t_end"), hourly_floor, variables, window),
                               norm, variables)
    imp = FT.ImputeParams(FT.fit_median(train, sfe).medians, keep_empty=True)
    sdf = FT.apply_median(df, imp, passthrough=[ID_COL, "t_end"])
    scaler = FT.fit_standard(FT.apply_median(train, imp, passthrough=[]), sfe) if sfe else FT.ScaleParams()
    sdf = FT.apply_standard(sdf, scaler, passthrough=[ID_COL, "t_end"]).select(
        ID_COL, "t_end", F.array(*[F.col(c) for c in sfe]).alias("static") if sfe else
        F.array().cast("array<double>").alias("static"))
    if added:
        texts = df
        if later:
            texts = FT.group_split(master.select(ID_COL, GROUP_COL, "t_end", "new_text", later)).join(df.select(ID_COL).distinct(), ID_COL, "left_semi")
        added = TX.growing_terms(texts, ID_COL, "t_end", "new_text", ["split"], later)
        vocab = TX.fit_vocab_growing(added.where("split = 'train'"))
        enc = TX.growing_ids(added, vocab, max_text_len).withColumnsRenamed({"group": ID_COL, "order": "t_end"})
    else:
        vocab = TX.fit_vocab(train, "final_text")
        enc = TX.encode(df.select(ID_COL, "t_end", "final_text"), [ID_COL, "t_end"], "final_text", vocab, max_text_len)
    base = df.select(ID_COL, GROUP_COL, "t_end", "split", *TASK_COLS,
                     *[f"surv_label_bin{i + 1}" for i in range(3)])
    out = (base.join(tens, [ID_COL, "t_end"], "left").join(sdf, [ID_COL, "t_end"], "left")
           .join(enc.drop("n_tokens"), [ID_COL, "t_end"], "left"))
    if "ids" in out.columns:                                      # padded where they stay
        out = TX.padded(out, max_text_len)
    return out, {"time_mean": norm.mean, "time_std": norm.std, "static_medians": imp.medians,
                 "static_scaler": scaler, "vocabulary": vocab, "static_features": list(static_features)}


def landmark_interactions(table: DataFrame, max_interactions: int = 12, checkpoint: bool = True) -> DataFrame:
    """X5 on its own: the landmark path up to the interaction step (missing
    drop, median imputation fitted on train), then ``{col}_x_landmark`` for
    the top-variance training columns, in long form
    (stay_id, t_end, feature, value) for every split."""
    df = _split(table, (ID_COL, GROUP_COL, "t_end"))
    if checkpoint:
        df = cut_lineage(df)
    train = df.where("split = 'train'")
    drop = FT.fit_missing(train, [c for c in df.columns if c != "split"], safe=LANDMARK_SAFE,
                          keep_suffixes=("_measured_frac",))
    df = df.drop(*drop)
    feats = FT.feature_columns(df, exclude=LANDMARK_SAFE + LANDMARK_EXTRA_EXCLUDE + ("split",))
    imp = FT.fit_median(df.where("split = 'train'"), feats)
    work = FT.apply_median(df, imp, passthrough=[ID_COL, "t_end", "split"])
    feats = [c for c in feats if imp.medians.get(c) is not None]
    top = FT.top_variance(work.where("split = 'train'"), feats, k=max_interactions)
    if not top:
        return work.select(ID_COL, "t_end", F.lit(None).cast("string").alias("feature"),
                           F.lit(None).cast("double").alias("value")).limit(0)
    pairs = F.array(*[F.struct(F.lit(f"{c}_x_landmark").alias("feature"),
                               (F.col(c) * F.col("landmark_hour")).alias("value")) for c in top])
    return work.select(ID_COL, "t_end", F.explode(pairs).alias("p")).select(ID_COL, "t_end", "p.feature", "p.value")
