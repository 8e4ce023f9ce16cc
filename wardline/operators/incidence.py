"""Non-parametric cumulative incidence of competing events (M6): the
Aalen-Johansen estimate, as the reference that hazard models are held to.

Everything is a running sum over the event times: the number at risk is the
total less the rows before, the survival before a time is the exponential of
summed log steps, and the incidence of a cause sums survival times hazard.
The sums run over value ranges (``prefix.running_sums``), so no group's times
come together in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import cut_lineage
from .prefix import running_sums

CAUSES = ("discharge", "death")


def aalen_johansen(df: DataFrame, time: str, event: str, causes=CAUSES, keys=()) -> DataFrame:
    """One row per key and distinct ``time``: ``at_risk``, ``survival`` (after
    the time) and ``cif_<cause>``.  Rows whose ``event`` is none of ``causes``
    (or NULL) are censored at their time, after the events of that time; rows
    without a time are left out."""
    keys = list(keys)
    counts = {"n": F.lit(1), **{f"d_{c}": F.coalesce(F.col(event) == c, F.lit(False)).cast("int") for c in causes}}
    # each pass reads its input several times, so what it works on is written first
    df = cut_lineage(df.select(*keys, time, event), "event-times")
    rows, totals = running_sums(df, time, counts, keys, with_totals=True)
    totals = totals.select(*keys, "tot_n")
    rows = rows.join(totals, keys) if keys else rows.withColumn("tot_n", totals.select("tot_n").scalar())
    rows = rows.withColumn("at_risk", F.col("tot_n") - F.col("cum_n") + F.col("n"))
    hazard = sum(F.col(f"d_{c}") for c in causes) / F.col("at_risk")
    step = {"log": F.when(hazard < 1, F.log1p(-hazard)).otherwise(0.0), "over": (hazard >= 1).cast("int"),
            "at": F.col("at_risk"), **{f"h_{c}": F.col(f"d_{c}") / F.col("at_risk") for c in causes}}
    along = running_sums(cut_lineage(rows, "at-risk"), time, step, keys)      # one row a time: the sums of it are itself
    along = cut_lineage(along, "survival")
    before = F.when(F.col("cum_over") - F.col("over") > 0, 0.0).otherwise(F.exp(F.col("cum_log") - F.col("log")))
    after = F.when(F.col("cum_over") > 0, 0.0).otherwise(F.exp("cum_log"))
    parts = {"at_risk": F.col("at"), "left": after, **{f"p_{c}": before * F.col(f"h_{c}") for c in causes}}
    out = running_sums(along, time, parts, keys)
    return out.select(*keys, time, "at_risk", F.col("left").alias("survival"),
                      *[F.col(f"cum_p_{c}").alias(f"cif_{c}") for c in causes])


def incidence_at(curve: DataFrame, time: str, horizons, causes=CAUSES, keys=()) -> DataFrame:
    """The curve read at each horizon (0 before the first time): keys,
    ``horizon``, ``cif_<cause>``."""
    keys = list(keys)
    shown = curve.select("*", F.explode(F.array(*[F.lit(float(h)) for h in horizons])).alias("horizon"))
    seen = F.col(time) <= F.col("horizon")
    return shown.groupBy(*keys, "horizon").agg(
        *[F.coalesce(F.max(F.when(seen, F.col(f"cif_{c}"))), F.lit(0.0)).alias(f"cif_{c}") for c in causes])
