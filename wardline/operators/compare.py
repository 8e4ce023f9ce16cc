"""Model comparison tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

METRICS = ("auc", "pr_auc", "recall", "precision")


def tag(metrics: DataFrame, model: str) -> DataFrame:
    """Add the ``model`` column to a metrics table (S10, in memory)."""
    return metrics.withColumn("model", F.lit(model))


def _long(df: DataFrame, metrics) -> DataFrame:
    return df.select("task", *[F.col(m).cast("double") for m in metrics]).unpivot(
        ["task"], list(metrics), "metric", "value")


def comparison_long(candidate: DataFrame, baselines: dict, candidate_name: str = "candidate",
                    metrics=METRICS) -> DataFrame:
    """Per (task, metric): candidate value, each baseline value and the
    candidate-minus-baseline deltas (T6).  Only tasks present in every table
    are kept (inner joins, J11)."""
    out = _long(candidate, metrics).withColumnRenamed("value", candidate_name)
    for name, b in baselines.items():
        out = out.join(_long(b, metrics).withColumnRenamed("value", name), ["task", "metric"], "inner")
    for name in baselines:
        out = out.withColumn(f"delta_vs_{name}", F.col(candidate_name) - F.col(name))
    return out


def comparison_wide(tables: dict, candidate_name: str, metrics=METRICS) -> DataFrame:
    """One row per task: ``{metric}_{model}`` for every model and
    ``{metric}_{candidate}_minus_{other}`` deltas (T7)."""
    names = list(tables)
    union = None
    for name, t in tables.items():
        part = tag(t.select("task", *metrics), name)
        union = part if union is None else union.unionByName(part)          # T3
    p = union.groupBy("task").pivot("model", names).agg(*[F.first(m).alias(m) for m in metrics])
    p = p.withColumnsRenamed({f"{n}_{m}": f"{m}_{n}" for n in names for m in metrics})
    for m in metrics:
        for n in names:
            if n != candidate_name:
                p = p.withColumn(f"{m}_{candidate_name}_minus_{n}", F.col(f"{m}_{candidate_name}") - F.col(f"{m}_{n}"))
    return p
