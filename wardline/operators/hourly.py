"""Relative time and hourly aggregation of the time-series table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.timecols import hour_index, relative_hour
from .cohort import ID_COL, attach_intime

TIME_EXCLUDE = (ID_COL, "subject_id", "hadm_id", "hour_ts", "intime", "relative_hour", "hour")


def with_relative_hour(time_df: DataFrame, static: DataFrame) -> DataFrame:
    """Attach ``intime`` if needed and add ``relative_hour`` (hours since
    admission, clipped at 0)."""
    t = attach_intime(time_df, static)
    return t.withColumn("relative_hour", relative_hour("hour_ts", "intime"))


def hour_range(time_rel: DataFrame) -> DataFrame:
    """Min and max relative hour."""
    return time_rel.agg(F.min("relative_hour").alias("min_hour"), F.max("relative_hour").alias("max_hour"))


def hourly_means(time_rel: DataFrame, variables, rounding: str = "rint") -> DataFrame:
    """Mean of every variable per (stay, hour bucket) (A1).

    Rows with an unknown hour are dropped.  A row whose variables are all
    NULL still creates its hour bucket (observed, not measured).  The
    aggregation runs partial-then-final, so a stay with very many rows is
    reduced map-side before the shuffle on (stay, hour).
    """
    t = (time_rel.withColumn("hour", hour_index("relative_hour", rounding))
         .where(F.col("hour").isNotNull()))
    return t.groupBy(ID_COL, "hour").agg(*[F.avg(F.col(v).cast("double")).alias(v) for v in variables])
