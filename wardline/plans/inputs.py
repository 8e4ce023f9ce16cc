"""Cohort inputs over the driver tables (fixture views), cached per call."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..sources import fixtures
from .master import CohortInputs


def cohort_inputs(spark: SparkSession, sf_dir: str, with_text: bool = True) -> CohortInputs:
    t = fixtures.cohort_tables(spark, sf_dir)
    return CohortInputs(static=t["stays"], time_series=t["vitals"], text=t["notes"] if with_text else None)


def rounded(df: DataFrame, digits: int = 6, overrides: dict | None = None) -> DataFrame:
    """Round every double column for cross-engine comparison; ``overrides``
    maps column name to its own number of digits."""
    overrides = overrides or {}
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(F.round(F.col(f.name).cast("double"), overrides.get(f.name, digits)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def without_timestamps(df: DataFrame) -> DataFrame:
    """Drop timestamp columns from a result (compared on derived hours)."""
    keep = [f.name for f in df.schema.fields
            if not isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))]
    return df.select(*keep)
