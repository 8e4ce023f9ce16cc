"""Cohort selection: LOS filter, id sampling, semi joins, leakage drop."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

ID_COL, GROUP_COL, HADM_COL = "stay_id", "subject_id", "hadm_id"
MIN_LOS_HOURS = 24.0

# --- fixed values: static columns that leak the outcome ----------------------
LEAKAGE_COLUMNS = (
    "spo2_min", "spo2_max", "spo2_mean", "gcs_min", "gcs_max", "gcs_mean",
    "platelets_min", "platelets_max", "platelets_mean", "wbc_min", "wbc_max", "wbc_mean",
    "bun_min", "bun_max", "bun_mean", "creatinine_min", "creatinine_max", "creatinine_mean",
    "sodium_min", "sodium_max", "sodium_mean", "inr_min", "inr_max", "inr_mean",
    "los", "icu_los_hours", "outtime", "deathtime", "hospital_expire_flag",
    "icu_death_flag", "radiology_note_count",
)
LEAKAGE_KEYWORDS = ("discharge", "expire", "mortality", "outcome", "target", "label", "readmit")
LEAKAGE_EXEMPT = (ID_COL, GROUP_COL, HADM_COL, "intime")
# -----------------------------------------------------------------------------


def los_filter(static: DataFrame, min_hours: float = MIN_LOS_HOURS) -> DataFrame:
    """Keep stays with ``icu_los_hours >= min_hours``; NULL LOS drops (F1)."""
    return static.filter(F.col("icu_los_hours") >= F.lit(min_hours))


def los_report(static: DataFrame, min_hours: float = MIN_LOS_HOURS) -> DataFrame:
    """One-row report: total stays, short stays and their share in percent."""
    total = F.count(F.lit(1))
    short = F.count_if(F.col("icu_los_hours") < F.lit(min_hours))
    return static.agg(total.alias("total_stays"), short.alias("short_stays"),
                      (short * 100.0 / F.greatest(total, F.lit(1))).alias("short_pct"))


def restrict(df: DataFrame, cohort: DataFrame, key: str = ID_COL) -> DataFrame:
    """Semi join to the kept ids (J1).  The planner broadcasts the id side
    when its runtime size is under the broadcast threshold, otherwise it
    shuffles both sides; no hint is forced because the cohort grows with
    the data."""
    return df.join(cohort.select(key), on=key, how="left_semi")


def attach_intime(df: DataFrame, static: DataFrame) -> DataFrame:
    """Add ``intime`` from the static table when the input lacks it."""
    if "intime" in df.columns:
        return df
    return df.join(static.select(ID_COL, "intime"), on=ID_COL, how="left")


def leakage_columns(columns) -> list[str]:
    """Columns that are dropped from the static table (F3), sorted."""
    out = set(c for c in LEAKAGE_COLUMNS if c in columns)
    for c in columns:
        if c in LEAKAGE_EXEMPT:
            continue
        if any(k in c.lower() for k in LEAKAGE_KEYWORDS):
            out.add(c)
    return sorted(out)


def drop_leakage(static: DataFrame) -> DataFrame:
    return static.drop(*leakage_columns(static.columns))


def seeded_rank(col, seed: int):
    """Deterministic pseudo-random rank of an id: first 32 bits of
    ``md5('<seed>:<id>')`` as a number.  Same value in any SQL engine."""
    key = F.concat(F.lit(str(seed)), F.lit(":"), F.col(col).cast("string"))
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint")


def debug_sample(static: DataFrame, n: int, seed: int = 42, key: str = ID_COL) -> DataFrame:
    """At most ``n`` distinct ids without replacement, reproducible (F2);
    ``n <= 0`` keeps all.  This is a sampling operator: the limit is the
    feature.  Only the ``n`` winning ids reach a single task."""
    if n <= 0:
        return static
    ids = (static.select(key).where(F.col(key).isNotNull()).distinct()
           .withColumn("_r", seeded_rank(key, seed))
           .orderBy("_r", key).limit(n).select(key))
    return static.join(ids, on=key, how="left_semi")
