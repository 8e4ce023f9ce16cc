"""Outcome labels: exit hour, ICU death, readmission, competing events."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.timecols import hours_between
from ..sources.tables import with_optional_column
from .cohort import GROUP_COL, HADM_COL, ID_COL
from .sequence import next_in_group

TASK1_COL = "label_can_discharge_24h"
TASK2_COL = "label_no_return_72h"
TASK2_MASK_COL = "task2_mask"
READMIT_GAP_HOURS = 72.0
HORIZON_HOURS = 24.0
INTERVAL_BOUNDS = (24, 48, 72)


def icu_death(static: DataFrame):
    """Death in the ICU: death time known and not after ICU exit."""
    s = with_optional_column(static, "deathtime")
    return s, F.coalesce(F.col("deathtime") <= F.col("outtime"), F.lit(False))


def stay_outcomes(static: DataFrame) -> DataFrame:
    """``icu_out_hour`` and ``icu_death_flag`` per stay."""
    s, died = icu_death(static)
    return s.select(ID_COL, hours_between("intime", "outtime").alias("icu_out_hour"),
                    died.cast("int").alias("icu_death_flag"))


def readmit_labels(static: DataFrame, gap_hours: float = READMIT_GAP_HOURS, skew_safe: bool = True) -> DataFrame:
    """Return to the ICU within ``gap_hours`` of exit in the same admission.

    Next stay = next ``intime`` in the same ``hadm_id`` (NULL times last,
    ``stay_id`` breaks ties).  Stays with a NULL admission id never link:
    they bypass the window, so NULL keys cannot pile up in one partition.
    By default :func:`next_in_group` is used, which splits an admission with
    very many stays across tasks (one extra table write); ``skew_safe=False``
    uses a plain window that keeps each admission's stays in one task.
    """
    base = static.select(ID_COL, HADM_COL, "intime", "outtime")
    keyed = base.where(F.col(HADM_COL).isNotNull())
    if skew_safe:
        nxt = next_in_group(keyed, HADM_COL, ["intime", ID_COL], "intime", "_next_intime")
        gap = hours_between("outtime", "_next_intime")
        src = nxt
    else:
        w = Window.partitionBy(HADM_COL).orderBy(F.asc_nulls_last("intime"), ID_COL)
        gap = hours_between("outtime", F.lead("intime").over(w))
        src = keyed
    linked = src.select(ID_COL, F.coalesce((gap >= 0) & (gap <= gap_hours), F.lit(False)).cast("int")
                        .alias("readmit_72h"))
    unkeyed = base.where(F.col(HADM_COL).isNull()).select(ID_COL, F.lit(0).alias("readmit_72h"))
    return linked.unionByName(unkeyed).withColumn(TASK2_COL, 1 - F.col("readmit_72h"))


def task_labels(master: DataFrame, static: DataFrame, readmit: DataFrame,
                horizon: float = HORIZON_HOURS) -> DataFrame:
    """Attach exit hour and death flag, keep landmarks before exit (F4), and
    add task 1, task 2 and the task-2 mask (L1, L2, F7)."""
    m = master.join(stay_outcomes(static), on=ID_COL, how="left")
    m = m.where(F.col("t_end") <= F.col("icu_out_hour"))
    m = m.withColumn("discharge_in_24h", ((F.col("icu_out_hour") - F.col("t_end")) <= horizon).cast("int"))
    m = m.withColumn(TASK1_COL, ((F.col("discharge_in_24h") == 1) & (F.col("icu_death_flag") == 0)).cast("int"))
    m = m.join(readmit.select(ID_COL, TASK2_COL), on=ID_COL, how="left")
    m = m.withColumn(TASK2_COL, F.coalesce(F.col(TASK2_COL), F.lit(0)).cast("int"))
    m = m.withColumn(TASK2_MASK_COL, (F.col(TASK1_COL) == 1).cast("int"))
    return m.dropna(subset=[ID_COL, GROUP_COL, TASK1_COL, TASK2_COL, TASK2_MASK_COL])


def event_table(static: DataFrame, require_positive: bool = True) -> DataFrame:
    """Competing event per stay (C11, F6): death in the ICU at its hour,
    otherwise discharge at the exit hour.  No censoring class."""
    s, died = icu_death(static)
    exit_h = hours_between("intime", "outtime")
    death_h = hours_between("intime", "deathtime")
    ev = s.select(ID_COL, GROUP_COL, HADM_COL,
                  F.when(died, "death").otherwise("discharge").alias("event_type"),
                  F.when(died, death_h).otherwise(exit_h).alias("event_hour"),
                  death_h.alias("death_hour"))
    ev = ev.dropna(subset=[ID_COL, GROUP_COL, "event_hour"])
    if require_positive:
        ev = ev.where(F.col("event_hour") > 0)
    return ev


def interval_labels(df: DataFrame, bounds=INTERVAL_BOUNDS) -> DataFrame:
    """Event of each type in (lo, hi] and within each bound (L3, L4);
    expects ``event_type`` and ``remaining_hours``."""
    rem, et = F.col("remaining_hours"), F.col("event_type")
    cols, lo = [], 0
    for hi in bounds:
        inside = (rem > lo) & (rem <= hi)
        cols += [((et == "discharge") & inside).cast("int").alias(f"event_discharge_{lo}_{hi}h"),
                 ((et == "death") & inside).cast("int").alias(f"event_death_{lo}_{hi}h")]
        lo = hi
    for hi in bounds:
        cols += [((et == "discharge") & (rem <= hi)).cast("int").alias(f"event_discharge_within_{hi}h"),
                 ((et == "death") & (rem <= hi)).cast("int").alias(f"event_death_within_{hi}h")]
    return df.select("*", *cols)


def landmark_labels(master: DataFrame, events: DataFrame, bounds=INTERVAL_BOUNDS,
                    bin_size: int = 24) -> DataFrame:
    """Competing-risk landmark table (L8): events joined to landmarks (J7),
    still at risk (F5), interval labels, landmark bin and polynomial (C17)."""
    df = master.join(events.select(ID_COL, "event_type", "event_hour", "death_hour"), on=ID_COL, how="inner")
    df = df.withColumn("remaining_hours", F.col("event_hour") - F.col("t_end")).where(F.col("remaining_hours") > 0)
    df = interval_labels(df, bounds)
    lb = F.greatest((F.floor(F.col("t_end") / bin_size) * bin_size).cast("int"), F.lit(bin_size))
    return (df.withColumn("landmark_bin", lb)
            .withColumn("landmark_hour", F.col("t_end").cast("double"))
            .withColumn("landmark_hour_sq", F.pow(F.col("t_end").cast("double"), 2))
            .dropna(subset=[GROUP_COL]))


SURVIVAL_INTERVALS = ((0, 24), (24, 48), (48, 72))


def survival_targets(df: DataFrame, intervals=SURVIVAL_INTERVALS) -> DataFrame:
    """3-class target per bin: 0 none, 1 discharge, 2 death in (lo, hi].
    Rows already past their event keep class 0 in every bin."""
    rem = F.col("event_hour") - F.col("t_end")
    cols = []
    for i, (lo, hi) in enumerate(intervals):
        inside = (rem > lo) & (rem <= hi)
        cols.append(F.when(inside & (F.col("event_type") == "discharge"), 1)
                    .when(inside & (F.col("event_type") == "death"), 2).otherwise(0)
                    .alias(f"surv_label_bin{i + 1}"))
    return df.select("*", *cols)


def multi_horizon_labels(df: DataFrame, horizons=(6, 12, 18, 24)) -> DataFrame:
    """Discharge / death within each short horizon (M7, planned in the
    reference): the within-bound labels of L4 with other bounds."""
    rem, et = F.col("remaining_hours"), F.col("event_type")
    cols = []
    for h in horizons:
        cols += [((et == "discharge") & (rem <= h)).cast("int").alias(f"event_discharge_within_{h}h"),
                 ((et == "death") & (rem <= h)).cast("int").alias(f"event_death_within_{h}h")]
    return df.select("*", *cols)
