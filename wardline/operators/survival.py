"""Survival-head arithmetic: per-bin softmax hazards and cumulative
incidence (C13-C15), plus the pooled cause-specific hazard model (M6)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.prob import softmax3

BIN_NAMES = ("0_24h", "24_48h", "48_72h")
HORIZONS = ("24h", "48h", "72h")
CLASSES = ("none", "dis", "death")
RESCALE_LIMIT = 0.999


def logit_col(b: int, k: str) -> str:
    return f"logit_b{b + 1}_{k}"


def hazards_from_logits(df: DataFrame, n_bins: int = 3) -> DataFrame:
    """Per bin, softmax over (none, discharge, death) logits gives the
    discharge and death hazards; task 1 probability = P(discharge) in the
    first bin, i.e. sigmoid(l_dis - logsumexp(l_none, l_death)) (C13)."""
    cols = {}
    for b in range(n_bins):
        _, pd_, pm = softmax3(*[F.col(logit_col(b, k)) for k in CLASSES])
        cols[f"hazard_discharge_{BIN_NAMES[b]}"] = pd_
        cols[f"hazard_death_{BIN_NAMES[b]}"] = pm
    out = df.withColumns(cols)
    return out.withColumn("task1_prob", F.col(f"hazard_discharge_{BIN_NAMES[0]}"))


def cumulative_incidence(df: DataFrame, n_bins: int = 3, rescale: bool = False) -> DataFrame:
    """CIF over the bins (C14): ``cif += S*h``, ``S *= clip(1-h_dis-h_death, 0, 1)``.

    With ``rescale`` (C15) a bin whose two hazards sum above 0.999 has both
    scaled to sum 0.999 first; the exported hazard columns stay unscaled.
    """
    s = F.lit(1.0)
    cd, cm = F.lit(0.0), F.lit(0.0)
    cols = {}
    for b in range(n_bins):
        hd = F.col(f"hazard_discharge_{BIN_NAMES[b]}")
        hm = F.col(f"hazard_death_{BIN_NAMES[b]}")
        if rescale:
            tot = hd + hm
            k = F.when(tot > RESCALE_LIMIT, F.lit(RESCALE_LIMIT) / F.greatest(tot, F.lit(1e-8))).otherwise(1.0)
            hd, hm = hd * k, hm * k
        cd = cd + s * hd
        cm = cm + s * hm
        cols[f"cif_discharge_{HORIZONS[b]}"] = cd
        cols[f"cif_death_{HORIZONS[b]}"] = cm
        s = s * F.least(F.greatest(F.lit(1.0) - hd - hm, F.lit(0.0)), F.lit(1.0))
    # each CIF column is an expression over the hazards; a projection keeps
    # the expression tree shallow enough for codegen at three bins
    return df.withColumns(cols)


def cif_from_logits(df: DataFrame, rescale: bool = False) -> DataFrame:
    return cumulative_incidence(hazards_from_logits(df), rescale=rescale)


def pooled_hazard_rows(df: DataFrame, features, target_prefix: str = "surv_label_bin",
                       n_bins: int = 3) -> DataFrame:
    """Person-period expansion for the pooled cause-specific hazard model
    (M6): one row per (landmark, bin) while the landmark is still at risk
    (no event in an earlier bin), with the bin index as a feature."""
    rows = F.array(*[F.struct(F.lit(b).alias("bin"), F.col(f"{target_prefix}{b + 1}").alias("y"))
                     for b in range(n_bins)])
    ex = df.select("*", F.posexplode(rows).alias("_i", "_r"))
    ex = ex.withColumn("_prior", F.aggregate(
        F.slice(F.array(*[F.col(f"{target_prefix}{b + 1}") for b in range(n_bins)]), 1, F.col("_i")),
        F.lit(0), lambda a, x: a + F.when(x > 0, 1).otherwise(0)))
    return ex.where(F.col("_prior") == 0).select(*df.columns, F.col("_r.bin").alias("bin"),
                                                  F.col("_r.y").cast("double").alias("surv_class"))
