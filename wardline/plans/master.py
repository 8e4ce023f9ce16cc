"""End-to-end landmark tables.

Each function builds one lazy plan from the three cohort inputs; nothing is
collected.  Column lists are decided from schemas on the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from ..operators import cohort, hourly, labels, landmarks, notes
from ..sources.tables import numeric_variables, require_columns
from ..operators.cohort import GROUP_COL, ID_COL
from ..operators.fit import quoted
from ..session import spread


@dataclass
class CohortInputs:
    static: DataFrame
    time_series: DataFrame
    text: DataFrame | None = None


def _time_variables(time_df: DataFrame) -> list[str]:
    return numeric_variables(time_df, exclude=hourly.TIME_EXCLUDE)


STATIC_COLUMNS = (ID_COL, GROUP_COL, cohort.HADM_COL, "intime", "outtime", "icu_los_hours")


def check_inputs(inp: CohortInputs) -> None:
    """Checks that need the data (one job): required columns, a unique stay id
    in the static table, and at least one stay that is long enough.  The
    builders themselves stay lazy and check the schemas only."""
    _check_schemas(inp)
    row = inp.static.agg(F.count(ID_COL).alias("n"), F.count_distinct(ID_COL).alias("d"),
                         F.count_if(F.col("icu_los_hours") >= cohort.MIN_LOS_HOURS).alias("kept")).first()
    if row["n"] != row["d"]:
        raise ValueError(f"static: {ID_COL} is not unique ({row['n']} rows, {row['d']} ids)")
    if not row["kept"]:
        raise ValueError(f"no stay of at least {cohort.MIN_LOS_HOURS:g} hours")


def _check_schemas(inp: CohortInputs) -> None:
    require_columns(inp.static, STATIC_COLUMNS, "static")
    require_columns(inp.time_series, [ID_COL, "hour_ts"], "time series")
    if inp.text is not None:
        require_columns(inp.text, [ID_COL, notes.TEXT_COL], "text")


def _prepare(inp: CohortInputs, debug_max_stays: int = 0):
    _check_schemas(inp)
    kept = cohort.los_filter(inp.static)
    kept = cohort.debug_sample(kept, debug_max_stays)
    ts = cohort.restrict(inp.time_series, kept)
    variables = _time_variables(ts)
    if not variables:
        raise ValueError("no numeric time-series variables")
    rel = hourly.with_relative_hour(ts, kept)
    return kept, rel, variables


def master_trailing(inp: CohortInputs, debug_max_stays: int = 0, window: int = landmarks.WINDOW_HOURS,
                    step: int = landmarks.STEP_HOURS, increments: bool = False) -> DataFrame:
    """Trailing-window master table (L6): one row per (stay, t_end) with
    24-h statistics, time-gated note text, static columns and labels.

    With ``increments`` the text is ``new_text``, what each landmark adds to
    the one before, in place of the cumulative ``final_text``, and beside it how
    many rows of the stay hold it; the increments add up as long as later steps
    drop whole stays.  All else is joined before the texts, which then stay
    where they are."""
    kept, rel, variables = _prepare(inp, debug_max_stays)
    hr = hourly.hourly_means(rel, variables, "rint")
    feats = landmarks.trailing_features(hr, variables, window=window, step=step)
    m = feats.join(cohort.drop_leakage(kept), on=ID_COL, how="left")
    m = labels.task_labels(m, kept, labels.readmit_labels(kept))
    name = "new_text" if increments else "final_text"
    front = [ID_COL, "t_end", *[c for c in feats.columns if c not in (ID_COL, "t_end")]]
    columns = front + [name, "has_text"] + [c for c in m.columns if c not in front] + [notes.LATER] * (increments and inp.text is not None)
    if inp.text is not None:
        seg = notes.note_segments(cohort.restrict(spread(inp.text), kept), kept)
        m = (notes.with_increments if increments else notes.with_asof_text)(m, seg)
    else:
        m = m.withColumn(name, F.lit("")).withColumn("has_text", F.lit(0))
    return m.select(*map(quoted, columns))


def master_cumulative(inp: CohortInputs, debug_max_stays: int = 0, first: int = landmarks.FIRST_LANDMARK,
                      step: int = landmarks.STEP_HOURS) -> DataFrame:
    """Cumulative ("pseudo-dynamic") master table (L7): statistics over
    hours 0..t_end, static columns and labels; no text."""
    kept, rel, variables = _prepare(inp, debug_max_stays)
    hr = hourly.hourly_means(rel, variables, "floor")
    feats = landmarks.cumulative_features(hr, variables, step=step, first=first)
    m = feats.join(cohort.drop_leakage(kept), on=ID_COL, how="left")
    return labels.task_labels(m, kept, labels.readmit_labels(kept))


def landmark_table(inp: CohortInputs, debug_max_stays: int = 0, bounds=labels.INTERVAL_BOUNDS,
                   bin_size: int = 24, first: int = landmarks.FIRST_LANDMARK,
                   step: int = landmarks.STEP_HOURS) -> DataFrame:
    """Pooled competing-risk landmark table (L8) on the cumulative master,
    with landmarks from hour ``first`` in steps of ``step``.  The event table
    is built from the full static table, as in the source."""
    master = master_cumulative(inp, debug_max_stays, first, step)
    return labels.landmark_labels(master, labels.event_table(inp.static), bounds, bin_size)
