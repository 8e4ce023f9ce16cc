"""Train-only fitted transforms.

``fit_*`` functions run aggregates over the training rows and return small
parameter objects (one number per column); ``apply_*`` functions are plain
projections that embed those numbers as literals, so applying a fit adds no
join and no shuffle.  Parameters can be saved and reloaded as parquet.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window, functions as F, types as T

from ..session import cut_lineage
from .cohort import GROUP_COL, seeded_rank
from .sequence import ranked

SEED = 42
MISSING_DROP = 0.90
CORR_DROP = 0.95


# ---- T5 / A2: group-aware split ------------------------------------------------

def group_split(df: DataFrame, group: str = GROUP_COL, seed: int = SEED, train_frac: float = 0.8,
                inner_frac: float = 0.8) -> DataFrame:
    """Add ``split`` in {train, val, test} by hashing the group id: 20 % of
    groups to test, then 20 % of the rest to validation (64/16/20 of groups).

    Each row is decided on its own (no shuffle, stable when rows are
    appended); every row of a group lands in the same split.  Shares are
    hash-based, so group counts are close to, not exactly, the fractions.
    """
    cut1, cut2 = int(round(train_frac * 10000)), int(round(inner_frac * 10000))
    r1 = seeded_rank(group, seed) % 10000
    r2 = seeded_rank(group, seed + 1) % 10000
    return df.withColumn("split", F.when(r1 >= cut1, "test").when(r2 >= cut2, "val").otherwise("train"))


def exact_group_split(df: DataFrame, group: str = GROUP_COL, seed: int = SEED, train_frac: float = 0.8,
                      inner_frac: float = 0.8) -> DataFrame:
    """Add ``split`` with exact group counts (T5): of ``n`` distinct groups
    ``floor(train_frac * n)`` are kept for training and validation, and of
    these ``floor(inner_frac * ...)`` for training.

    Groups are ordered by a seeded hash of the id, ties by id.  The id at the
    rank of each cut is found among the distinct groups by a distributed
    ranking; rows are then decided on their own against two literals, with no
    join.  Rows without a group have no split."""
    check_groups(df, group)
    groups = cut_lineage(df.select(group).where(F.col(group).isNotNull()).distinct(), "groups")
    outer = math.floor(train_frac * groups.count())
    inner = math.floor(inner_frac * outer)

    def first(among: DataFrame, k: int, rank):
        """Whether a row's group is one of the first ``k`` of ``among``."""
        cut = ranked(among.select(F.col(group), rank.alias("_h")), ["_h", group], "_at").where(F.col("_at") == k).first()
        if cut is None:
            return F.lit(False)
        last = F.lit(cut[group]).cast(df.schema[group].dataType)
        return (rank < cut["_h"]) | ((rank == cut["_h"]) & (F.col(group) <= last))
    kept = first(groups, outer, seeded_rank(group, seed))
    own = first(groups.where(kept), inner, seeded_rank(group, seed + 1))
    return df.withColumn("split", F.when(F.col(group).isNotNull(), F.when(~kept, "test").when(own, "train").otherwise("val")))


def check_groups(df: DataFrame, group: str = GROUP_COL, minimum: int = 3) -> None:
    n = df.select(F.count_distinct(group)).first()[0]
    if n < minimum:
        raise ValueError(f"need at least {minimum} distinct {group} groups for a split, got {n}")


def split_summary(df: DataFrame, label: str | None = None, group: str = GROUP_COL) -> DataFrame:
    """Rows, distinct groups and label rate per split (A2)."""
    aggs = [F.count(F.lit(1)).alias("rows"), F.count_distinct(group).alias("patients")]
    if label:
        aggs.append(F.avg(label).alias("pos_rate"))
    return df.groupBy("split").agg(*aggs)


# ---- A3: missing rate -------------------------------------------------------------

def missing_rates(train: DataFrame, columns) -> DataFrame:
    """Share of NULL (or NaN) per column on the training rows, long format."""
    cols = list(columns)
    floats = {f.name for f in train.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    miss = [f"double({quoted(c)} IS NULL{f' OR isnan({quoted(c)})' if c in floats else ''})" for c in cols]
    names = ", ".join("'" + c.replace("\\", "\\\\").replace("'", "\\'") + "'" for c in cols)
    rows = train.selectExpr(f"posexplode_outer(array({', '.join(miss)})) AS (c, v)").groupBy("c").agg(F.avg("v").alias("missing_rate"))
    got = rows.selectExpr(f"array({names})[c] AS column", "missing_rate")
    if cols:
        return got
    return got.limit(0)


def columns_to_drop(rates: dict, threshold: float = MISSING_DROP, safe=(), keep_suffixes=()) -> list[str]:
    return [c for c, r in rates.items() if r is not None and r > threshold and c not in safe
            and not any(c.endswith(s) for s in keep_suffixes)]


def fit_missing(train: DataFrame, columns, threshold: float = MISSING_DROP, safe=(), keep_suffixes=()) -> list[str]:
    rates = {r["column"]: r["missing_rate"] for r in missing_rates(train, columns).collect()}
    return columns_to_drop(rates, threshold, safe, keep_suffixes)


# ---- A4 / A5: imputation and scaling parameters -------------------------------------

@dataclass
class ImputeParams:
    medians: dict = field(default_factory=dict)   # column -> median (None: empty in train)
    keep_empty: bool = False


def quoted(c: str) -> str:
    return "`" + c.replace("`", "``") + "`"


def literal(x: float) -> str:
    """A number in SQL text.  Wide projections are written as SQL text: one
    parse, where hundreds of column objects take seconds to make."""
    return f"{float(x)!r}D" if math.isfinite(x) else f"double('{float(x)!r}')"


def cells(df: DataFrame, columns) -> DataFrame:
    """The numbers of all columns as rows (``c``: place of the column, ``v``;
    NaN as NULL); aggregates over any number of columns are then one pass with
    a small plan.  The outer form, as no filter on the array is inferred for
    it: that takes the optimizer minutes for many derived columns."""
    numbers = ", ".join(f"nanvl(cast({quoted(c)} AS DOUBLE), null)" for c in columns)
    return df.selectExpr(f"array({numbers}) AS x").selectExpr("posexplode_outer(x) AS (c, v)")


def column_stats(df: DataFrame, columns, **stats) -> dict:
    """{column: {name: value}} of aggregate functions, each taking the column's
    numbers; one pass for all columns."""
    cols = list(columns)
    if not cols:
        return {}
    rows = cells(df, cols).groupBy("c").agg(*[fn(F.col("v")).alias(name) for name, fn in stats.items()]).collect()
    found = {r["c"]: r for r in rows}
    return {c: {name: found[k][name] if k in found else None for name in stats} for k, c in enumerate(cols)}


OCTAVE = 32            # bins of the first pass for each doubling of the magnitude
BINS = 1 << 18         # bins of a later pass, over the one bin that holds the middle


def medians(train: DataFrame, columns, written: bool = False) -> dict:
    """Exact median of each column (mean of the two middle values), None for
    an empty one.

    Radix selection of all columns at once: a pass counts the rows of each bin
    of a monotone function of the value and keeps, for either middle rank, the
    bin that holds it with its least and largest value.  The first pass bins
    by sign and logarithm, the later ones cut the range left into ``BINS``; a
    double has few enough bits that it takes four passes at most, whatever
    the number of rows or columns, and a pass is a hash aggregate with
    map-side combine.  The driver gets two rows a column.  The columns are
    written once, unless ``written`` says that ``train`` reads a written table;
    no pass runs the input's plan again."""
    cols = list(columns)
    if not cols:
        return {}
    numbers = ", ".join(f"nanvl(cast({quoted(c)} AS DOUBLE), null)" for c in cols)
    x = train.selectExpr(f"array({numbers}) AS x")
    x = (x if written else cut_lineage(x, "numbers")).selectExpr("posexplode_outer(x) AS (c, v)").where("v IS NOT NULL")

    def binned(rows: DataFrame, *keys: str) -> DataFrame:
        return rows.groupBy(*keys, "bin").agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))

    def holding(bins: DataFrame) -> list:
        before = Window.partitionBy("c", "t").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
        d = bins.withColumn("below", F.coalesce(F.sum("n").over(before), F.lit(0)))
        return d.where("r >= below AND r < below + n").selectExpr("c", "t", "lo", "hi", "r - below AS r").collect()

    first = binned(x.selectExpr("c", "v", f"""CASE WHEN v = 0 THEN 0 WHEN abs(v) = double('Infinity') THEN signum(v) * 1e6
                                              ELSE signum(v) * (floor(log2(abs(v)) * {OCTAVE}) + 1e5) END AS bin"""), "c")
    ranks = first.groupBy("c").agg(F.sum("n").alias("rows")).selectExpr(
        "c", "posexplode(array((rows - 1) div 2, rows div 2)) AS (t, r)")
    found = {(r["c"], r["t"]): r for r in holding(first.join(F.broadcast(ranks), "c"))}    # two rows a column
    while wide := [tuple(r[k] for k in ("c", "t", "lo", "hi", "r")) for r in found.values() if r["lo"] < r["hi"]]:
        targets = train.sparkSession.createDataFrame(wide, "c int, t int, lo double, hi double, r long")
        inside = x.join(F.broadcast(targets.withColumnsRenamed({"lo": "a", "hi": "b"})), "c").where("v BETWEEN a AND b")
        part = F.expr(f"least(floor((v / 2 - a / 2) / (b / 2 - a / 2) * {BINS}), {BINS - 1})")   # halves: no overflow
        found.update({(r["c"], r["t"]): r for r in holding(binned(inside.withColumn("bin", part), "c", "t", "r"))})
    return {c: (found[k, 0]["lo"] + found[k, 1]["lo"]) / 2 if (k, 0) in found else None for k, c in enumerate(cols)}


def fit_median(train: DataFrame, columns, keep_empty: bool = False, written: bool = False) -> ImputeParams:
    return ImputeParams(medians(train, columns, written), keep_empty)


def apply_median(df: DataFrame, p: ImputeParams, passthrough=()) -> DataFrame:
    """Fill NULLs with the train median.  Columns empty in train are dropped,
    or filled with 0 when ``keep_empty``."""
    fill = {c: 0.0 if m is None else m for c, m in p.medians.items() if m is not None or p.keep_empty}
    return df.selectExpr(*map(quoted, passthrough), *[
        f"coalesce(cast({quoted(c)} AS DOUBLE), {literal(m)}) AS {quoted(c)}" for c, m in fill.items()])


@dataclass
class ScaleParams:
    mean: dict = field(default_factory=dict)
    scale: dict = field(default_factory=dict)


def fit_standard(train: DataFrame, columns) -> ScaleParams:
    """Train mean and population standard deviation; a zero deviation
    divides by 1 (A5).  One pass, no unpivot."""
    got = column_stats(train, columns, m=F.avg, s=F.stddev_pop)
    return ScaleParams({c: v["m"] for c, v in got.items()},
                       {c: v["s"] if v["s"] not in (None, 0.0) else 1.0 for c, v in got.items()})


def apply_standard(df: DataFrame, p: ScaleParams, passthrough=()) -> DataFrame:
    return df.selectExpr(*map(quoted, passthrough), *[
        f"({quoted(c)} - {literal(m or 0.0)}) / {literal(p.scale[c])} AS {quoted(c)}" for c, m in p.mean.items()])


# ---- A6: correlation drop ------------------------------------------------------------

def correlation_matrix(train: DataFrame, columns):
    """Pearson correlation of the columns as a p x p numpy array.

    Computed by MLlib's distributed covariance (tree aggregation); only the
    p x p result reaches the driver.  A constant column gives NaN.
    """
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.stat import Correlation
    cols = list(columns)
    va = VectorAssembler(inputCols=cols, outputCol="_features", handleInvalid="keep")
    m = Correlation.corr(va.transform(train.select(*cols)), "_features", "pearson").first()[0]
    return m.toArray()


def corr_drop_columns(columns, corr, threshold: float = CORR_DROP) -> list[str]:
    """Drop column j when any earlier column i (dropped or not) has
    |r_ij| > threshold; NaN never drops; fewer than two columns drop none."""
    cols = list(columns)
    if len(cols) <= 1:
        return []
    out = []
    for j in range(len(cols)):
        for i in range(j):
            r = corr[i][j]
            if r is not None and not math.isnan(r) and abs(r) > threshold:
                out.append(cols[j])
                break
    return out


def fit_corr_drop(train: DataFrame, columns, threshold: float = CORR_DROP) -> list[str]:
    cols = list(columns)
    if len(cols) <= 1:
        return []
    return corr_drop_columns(cols, correlation_matrix(train, cols), threshold)


# ---- A8 / X5: top-variance interactions ----------------------------------------------

def variance_table(train: DataFrame, columns) -> DataFrame:
    """Sample variance per column, long format (A8); a column without values
    has a NULL variance.  One row per column: bounded by the schema."""
    got = column_stats(train, columns, v=F.var_samp)
    return train.sparkSession.createDataFrame([(c, v["v"]) for c, v in got.items()], "column string, variance double")


def top_variance(train: DataFrame, columns, k: int = 12, exclude=("landmark_hour", "landmark_hour_sq")) -> list[str]:
    """The ``k`` columns of largest sample variance (ties by name)."""
    cols = [c for c in columns if c not in set(exclude)]
    got = column_stats(train, cols, v=F.var_samp)
    known = sorted((-v["v"], c) for c, v in got.items() if v["v"] is not None and v["v"] == v["v"])
    return [c for _, c in known[:max(k, 0)]]


def add_interactions(df: DataFrame, columns, hour_col: str = "landmark_hour") -> DataFrame:
    """``{col}_x_landmark = col * landmark_hour``."""
    return df.withColumns({f"{c}_x_landmark": F.col(c) * F.col(hour_col) for c in columns})


# ---- F9 / F10: feature selection ----------------------------------------------------------

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
           T.DecimalType, T.BooleanType)


def feature_columns(df: DataFrame, exclude=()) -> list[str]:
    """Numeric (or boolean) columns outside ``exclude`` that are not ``*_id``."""
    ex = set(exclude)
    return [f.name for f in df.schema.fields if f.name not in ex and not f.name.lower().endswith("_id")
            and isinstance(f.dataType, NUMERIC)]


def prefix_columns(df: DataFrame, columns, prefix: str = "static__") -> DataFrame:
    """Rename ``col`` to ``{prefix}{col}``."""
    return df.withColumnsRenamed({c: f"{prefix}{c}" for c in columns})
