"""Per-landmark history tensors and their normalisation.

A landmark's history is the ``window`` hours ``floor(t_end)-window+1 ..
floor(t_end)`` of the (floor-bucketed) hourly table, hour-major, with NULL
for hours the stay does not have.  Every hourly row goes to the landmarks of
the grid whose window holds it (two with the usual step) and meets them by an
equi-join on (stay, landmark); the same partitioning then collects them, and
the array's positions are filled in the row.  Nothing is expanded to the
window's length on the way.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F

from .cohort import ID_COL
from .landmarks import FIRST_LANDMARK, STEP_HOURS

WINDOW_HOURS = 24


def _sent(hourly: DataFrame, variables, window: int, first: int, step: int) -> DataFrame:
    """(stay, t_end, pos, hour, variables): each hourly row at the grid's
    landmarks ``first + k step`` (any whole k) whose window holds it."""
    hour = F.col("hour")
    lo = F.ceil((hour - first) / F.lit(step))
    hi = F.floor((hour + (window - 1) - first) / F.lit(step))
    k = F.when(lo <= hi, F.sequence(lo, hi)).otherwise(F.array().cast("array<bigint>"))
    ex = hourly.select(ID_COL, "hour", *variables, F.explode(k).alias("_k"))
    t_end = F.lit(first) + F.col("_k") * step
    return ex.select(ID_COL, t_end.cast("double").alias("t_end"), (hour - t_end + (window - 1)).cast("int").alias("pos"),
                     "hour", *variables)


def history_cells(landmarks: DataFrame, hourly: DataFrame, variables, window: int = WINDOW_HOURS,
                  first: int = FIRST_LANDMARK, step: int = STEP_HOURS) -> DataFrame:
    """One row per (landmark, observed hour) with its position and values;
    landmarks must lie on the grid ``first``, ``step``."""
    keys = landmarks.select(ID_COL, F.col("t_end").cast("double").alias("t_end"))
    return keys.join(_sent(hourly, variables, window, first, step), [ID_COL, "t_end"])


def history_tensor(landmarks: DataFrame, hourly: DataFrame, variables, window: int = WINDOW_HOURS,
                   first: int = FIRST_LANDMARK, step: int = STEP_HOURS) -> DataFrame:
    """``time_series``: ARRAY<ARRAY<DOUBLE>> of shape (window, variables)."""
    cells = F.array(*[F.col(v).cast("double") for v in variables])
    got = _sent(hourly, variables, window, first, step).groupBy(ID_COL, "t_end").agg(
        F.map_from_entries(F.collect_list(F.struct("pos", cells.alias("v")))).alias("_at"))
    keys = landmarks.select(ID_COL, F.col("t_end").cast("double").alias("t_end"))
    empty = F.array(*[F.lit(None).cast("double") for _ in variables])
    row = F.transform(F.sequence(F.lit(0), F.lit(window - 1)), lambda p: F.coalesce(F.try_element_at("_at", p), empty))
    return keys.join(got, [ID_COL, "t_end"], "left").select(ID_COL, "t_end", row.alias("time_series"))


@dataclass
class TensorNorm:
    mean: dict = field(default_factory=dict)
    std: dict = field(default_factory=dict)


def tensor_norm_table(train_cells: DataFrame, variables) -> DataFrame:
    """Mean and population std of every variable over all non-NULL
    (landmark, hour) cells of the training rows (an hour counts once per
    window that holds it); non-finite mean -> 0, std not finite or <= 1e-6 -> 1."""
    cols = list(variables)
    agg = train_cells.agg(*[F.avg(v).alias(f"m_{i}") for i, v in enumerate(cols)],
                          *[F.stddev_pop(v).alias(f"s_{i}") for i, v in enumerate(cols)])
    return agg.select(F.explode(F.array(*[
        F.struct(F.lit(v).alias("variable"),
                 F.coalesce(F.col(f"m_{i}"), F.lit(0.0)).alias("mean"),
                 F.when(F.col(f"s_{i}") > 1e-6, F.col(f"s_{i}")).otherwise(F.lit(1.0)).alias("std"))
        for i, v in enumerate(cols)])).alias("p")).select("p.*")


def fit_tensor_norm(train_cells: DataFrame, variables) -> TensorNorm:
    rows = tensor_norm_table(train_cells, variables).collect()
    mean = {r["variable"]: (r["mean"] if r["mean"] is not None and math.isfinite(r["mean"]) else 0.0) for r in rows}
    std = {r["variable"]: (r["std"] if r["std"] is not None and math.isfinite(r["std"]) and r["std"] > 1e-6 else 1.0)
           for r in rows}
    return TensorNorm(mean, std)


def normalize_tensor(df: DataFrame, p: TensorNorm, variables, col: str = "time_series") -> DataFrame:
    """(x - mean) / std per variable, then NULL -> 0."""
    mean = F.array(*[F.lit(float(p.mean[v])) for v in variables])
    std = F.array(*[F.lit(float(p.std[v])) for v in variables])
    norm = F.transform(col, lambda hour: F.transform(
        hour, lambda x, i: F.coalesce((x - mean[i]) / std[i], F.lit(0.0))))
    return df.withColumn(col, norm)


def modality_switch(df: DataFrame, use_text: bool = True, use_time: bool = True, use_static: bool = True,
                    text_cols=("input_ids", "attention_mask"), time_col: str = "time_series",
                    static_col: str = "static") -> DataFrame:
    """Replace a modality's inputs by zeros for every row."""
    out = df
    if not use_time and time_col in df.columns:
        out = out.withColumn(time_col, F.transform(time_col, lambda h: F.transform(h, lambda x: F.lit(0.0))))
    if not use_static and static_col in df.columns:
        out = out.withColumn(static_col, F.transform(static_col, lambda x: F.lit(0.0)))
    if not use_text:
        for c in text_cols:
            if c in df.columns:
                out = out.withColumn(c, F.transform(c, lambda x: F.lit(0)))
    return out
