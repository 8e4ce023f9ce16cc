"""Landmark spine and per-landmark window statistics.

Landmarks are ``t_end = first, first + step, ...`` up to the stay's last
observed hour.  Neither builder densifies the hourly grid nor runs a
sliding frame over it:

* trailing statistics: each hourly row is sent to the (at most
  ``ceil(window / step)``) landmarks whose window holds it, then a hash
  aggregate per (stay, t_end) computes the statistics;
* cumulative statistics: one running window per stay over the hourly rows
  (bounded by the stay's duration in hours, not by its raw row count); each
  hourly row then answers the landmarks that fall before the next observed
  hour.

Both read the hourly table (already reduced per (stay, hour)), so a stay
with a huge number of raw measurements cannot overload one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from .cohort import ID_COL

WINDOW_HOURS = 24
STEP_HOURS = 12
FIRST_LANDMARK = 24


def _first_landmark_at_or_after(hour, first: int, step: int):
    """Smallest grid landmark ``first + k*step >= hour`` (k >= 0)."""
    k = F.greatest(F.lit(0), F.ceil((hour - F.lit(first)) / F.lit(step)))
    return (F.lit(first) + k * F.lit(step)).cast("int")


def _grid(lo, hi, step: int):
    """Landmarks ``lo, lo+step, ... <= hi``; empty when ``lo > hi``
    (``sequence`` would count downwards)."""
    return F.when(lo <= hi, F.sequence(lo, hi, F.lit(step))).otherwise(F.array().cast("array<int>"))


def landmark_spine(hourly: DataFrame, first: int = FIRST_LANDMARK, step: int = STEP_HOURS) -> DataFrame:
    """All grid landmarks of each stay up to its maximum hour (W1); stays
    whose last hour is before ``first`` have none."""
    mx = hourly.groupBy(ID_COL).agg(F.max("hour").alias("max_hour"))
    return mx.select(ID_COL, F.explode(_grid(F.lit(first), F.col("max_hour"), step)).alias("t_end"))


def trailing_features(hourly: DataFrame, variables, window: int = WINDOW_HOURS,
                      step: int = STEP_HOURS, first: int | None = None) -> DataFrame:
    """Mean, min, max and ``is_measured`` of each variable over the hours
    ``t_end-window+1 .. t_end`` (W2).  The first landmark is the first full
    window, unless ``first`` says otherwise.

    A landmark exists when the stay reaches ``t_end`` and at least one hourly
    row (measured or not) lies in its window.
    """
    first = window if first is None else first
    by_stay = Window.partitionBy(ID_COL)
    h = hourly.withColumn("_max_hour", F.max("hour").over(by_stay))
    lo = _first_landmark_at_or_after(F.col("hour"), first, step)
    hi = F.least(F.col("hour") + F.lit(window - 1), F.col("_max_hour"))
    ex = h.withColumn("t_end", F.explode(_grid(lo, hi, step)))
    aggs = ([F.avg(v).alias(f"{v}_mean") for v in variables]
            + [F.min(v).alias(f"{v}_min") for v in variables]
            + [F.max(v).alias(f"{v}_max") for v in variables]
            + [F.max(F.when(F.col(v).isNotNull(), 1.0).otherwise(0.0)).alias(f"{v}_is_measured")
               for v in variables])
    out = ex.groupBy(ID_COL, "t_end").agg(*aggs)
    return out.select(ID_COL, (F.col("t_end") - window).cast("double").alias("t_start"),
                      F.col("t_end").cast("double").alias("t_end"),
                      *[a for a in out.columns if a not in (ID_COL, "t_end")])


def cumulative_features(hourly: DataFrame, variables, step: int = STEP_HOURS,
                        first: int = FIRST_LANDMARK) -> DataFrame:
    """Statistics over hours ``0 .. t_end`` (W3): mean, sample std (0 below
    two values), min, max, last non-null value (LOCF, W4) and the share of
    hours with a value, ``count / (t_end + 1)``.

    A landmark exists when the stay reaches ``t_end`` and some hourly row is
    at or before it.
    """
    w = Window.partitionBy(ID_COL).orderBy("hour")
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    nxt = F.lead("hour").over(w)
    # this hourly row holds the running state for landmarks in [hour, next_hour - 1];
    # the last row only answers a landmark at exactly its hour (the stay's max hour)
    hi = F.coalesce(nxt - 1, F.col("hour"))
    lo = _first_landmark_at_or_after(F.col("hour"), first, step)
    stats = []
    for v in variables:
        stats += [F.avg(v).over(run).alias(f"{v}_cum_mean"),
                  F.stddev_samp(v).over(run).alias(f"_{v}_std"),
                  F.min(v).over(run).alias(f"{v}_cum_min"),
                  F.max(v).over(run).alias(f"{v}_cum_max"),
                  F.last(v, ignorenulls=True).over(run).alias(f"{v}_last"),
                  F.count(v).over(run).alias(f"_{v}_n")]
    r = hourly.select(ID_COL, "hour", _grid(lo, hi, step).alias("_lm"), *stats)
    r = r.select("*", F.explode("_lm").alias("t_end"))
    te = F.col("t_end").cast("double")
    cols = ([F.col(f"{v}_cum_mean") for v in variables]
            + [F.coalesce(F.col(f"_{v}_std"), F.lit(0.0)).alias(f"{v}_cum_std") for v in variables]
            + [F.col(f"{v}_cum_min") for v in variables]
            + [F.col(f"{v}_cum_max") for v in variables]
            + [F.col(f"{v}_last") for v in variables]
            + [(F.col(f"_{v}_n") / (te + 1.0)).alias(f"{v}_measured_frac") for v in variables])
    return r.select(ID_COL, F.lit(0.0).alias("t_start"), te.alias("t_end"), *cols)


def locf(hourly: DataFrame, variables) -> DataFrame:
    """Last observation carried forward at every observed hour."""
    run = Window.partitionBy(ID_COL).orderBy("hour").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return hourly.select(ID_COL, "hour", *[F.last(v, ignorenulls=True).over(run).alias(f"{v}_locf")
                                           for v in variables])
