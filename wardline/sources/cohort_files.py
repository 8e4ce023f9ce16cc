"""Loading the three cohort CSV files (S1) into typed DataFrames.

CSV is parsed once with an explicit, lenient typing pass and written to
parquet; every later run reads the parquet copy (columnar, pruned,
splittable).
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession, functions as F, types as T

from ..plans.master import CohortInputs
from ..functions.timecols import try_double
from ..operators.notes import NOTE_TIME_COLUMNS
from .tables import coerce_types, read_cohort_csv, read_quoted_csv

STATIC_TIMES = ("intime", "outtime", "deathtime")
ID_COLUMNS = ("stay_id", "subject_id", "hadm_id")
NON_NUMERIC = ("first_careunit", "radiology_note_text") + STATIC_TIMES + ("hour_ts",) + NOTE_TIME_COLUMNS[:2]


def _numeric_strings(df, candidates, lenient: bool) -> list[str]:
    """String columns that hold numbers, by a test over the whole column: every
    non-empty value parses, or for a ``lenient`` table (measurements, where
    single bad readings become NULL) at least one does."""
    if not candidates:
        return []
    filled = {c: F.length(F.trim(F.col(c))) > 0 for c in candidates}
    row = df.agg(*[x for k, c in enumerate(candidates) for x in (
        F.count_if(filled[c]).alias(f"f{k}"), F.count_if(filled[c] & try_double(F.col(c)).isNotNull()).alias(f"n{k}"))]).first()
    return [c for k, c in enumerate(candidates)
            if row[f"n{k}"] and (lenient or row[f"n{k}"] == row[f"f{k}"])]


def _typed(df, timestamps, lenient: bool = False):
    """Known columns by name; of the rest, those that hold numbers become
    doubles and all others stay strings."""
    unknown = [f.name for f in df.schema.fields
               if f.name not in NON_NUMERIC and f.name not in ID_COLUMNS and isinstance(f.dataType, T.StringType)
               and f.name not in timestamps]
    known = [c for c in unknown if c in ("icu_los_hours",)]
    numerics = known + _numeric_strings(df, [c for c in unknown if c not in known], lenient)
    return coerce_types(df, timestamps=timestamps, numerics=numerics, ids=ID_COLUMNS)


def read_cohort_tables(spark: SparkSession, static_csv: str, text_csv: str, time_csv: str,
                       parquet_dir: str | None = None) -> CohortInputs:
    """Read the static, text and time-series CSV files (header row, quotes),
    type them leniently (unparseable -> NULL) and, when ``parquet_dir`` is
    given, persist them as parquet and read that back.  Notes hold line
    breaks, so the text file is read by quote parity; all three are read over
    many tasks."""
    st = _typed(read_cohort_csv(spark, static_csv), STATIC_TIMES)
    tx = _typed(read_quoted_csv(spark, text_csv), NOTE_TIME_COLUMNS[:2] + ("intime",))
    ts = _typed(read_cohort_csv(spark, time_csv), ("hour_ts", "intime"), lenient=True)
    if parquet_dir:
        out = {}
        for name, df in (("static", st), ("text", tx), ("time_series", ts)):
            path = os.path.join(parquet_dir, name)
            df.write.mode("overwrite").parquet(path)
            out[name] = spark.read.parquet(path)
        st, tx, ts = out["static"], out["text"], out["time_series"]
    return CohortInputs(static=st, time_series=ts, text=tx)
