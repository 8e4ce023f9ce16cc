"""Time arithmetic on wall-clock (TIMESTAMP_NTZ) columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

MICROS_PER_HOUR = 3.6e9


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hours_between(start, end) -> Column:
    """Fractional hours ``end - start`` (C9); NULL when either side is NULL."""
    return F.timestamp_diff("MICROSECOND", _col(start), _col(end)) / F.lit(MICROS_PER_HOUR)


def relative_hour(ts, intime) -> Column:
    """Hours since ICU admission, clipped at 0.

    ``greatest`` skips NULLs in Spark, so the NULL case is kept explicitly:
    an unknown time must stay unknown, not become hour 0.
    """
    h = hours_between(intime, ts)
    return F.when(h.isNotNull(), F.greatest(h, F.lit(0.0)))


def hour_index(rel_hour, rounding: str = "rint") -> Column:
    """Integer hour bucket: half-even rounding (trailing path, C2) or floor
    (cumulative and tensor paths, C3)."""
    c = _col(rel_hour)
    if rounding == "rint":
        return F.rint(c).cast("int")
    if rounding == "floor":
        return F.floor(c).cast("int")
    raise ValueError(f"unknown rounding {rounding!r}")


def try_timestamp(c) -> Column:
    """Lenient timestamp parse (S3): strings that do not parse become NULL.

    Typed timestamps pass through unchanged.
    """
    return F.try_to_timestamp(_col(c).cast("string")).cast("timestamp_ntz")


def try_double(c) -> Column:
    """Lenient numeric parse (S5): non-numeric values become NULL."""
    return F.expr(f"try_cast({c} AS DOUBLE)") if isinstance(c, str) else c.try_cast("double")
