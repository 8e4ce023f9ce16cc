"""Skew-safe ``lead`` and running sums within a group.

``lead(x) OVER (PARTITION BY g ORDER BY o)`` places every row of a group in
one task.  Here rows are range-partitioned on (g, o), so a very large group
is cut into consecutive chunks on several tasks; ``lead`` runs per chunk, and
the last row of a chunk takes the first row of the next non-empty range
partition (a table with one row per partition) when it continues the same
group.  Running sums carry over in the same way: a chunk's first group starts
with the sums of the chunks before it that hold the same group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..session import cut_lineage


def range_chunks(df: DataFrame, group: str, order, n_parts: int | None = None) -> tuple[DataFrame, list]:
    """``df`` in range partitions on (``group``, ``order``) with the
    partition's number as ``_pid``, written once so that the numbers hold
    (range bounds come from a sample), and the sort keys (NULLs last)."""
    n = n_parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # total order without NULL ambiguity: (g, o1 is null, o1, o2 is null, o2, ...)
    keys = [F.col(group)]
    for c in order:
        keys += [F.col(c).isNull(), F.col(c)]
    r = df.repartitionByRange(n, *keys).withColumn("_pid", F.spark_partition_id())
    return cut_lineage(r, "range-chunks"), keys


def running_in_group(df: DataFrame, group: str, order, sums: dict, n_parts: int | None = None) -> DataFrame:
    """Add the running sums ``sums`` (name to column, not NULL) over the rows
    of the same ``group`` up to and including each row, in ``order`` (column
    names, a total order).  ``group`` must be non-NULL.

    Only the last group of a chunk can go on in the next ones, so the carries
    come from a table with two rows per chunk."""
    r, keys = range_chunks(df, group, order, n_parts)
    for name, col in sums.items():
        r = r.withColumn(name, col)
    ends = r.groupBy("_pid").agg(F.min(group).alias("_lo"), F.max(group).alias("_hi"))
    tails = r.join(F.broadcast(ends), "_pid").where(F.col(group) == F.col("_hi")).groupBy("_pid").agg(
        F.first("_lo").alias("_lo"), F.first("_hi").alias("_hi"), *[F.sum(n).alias(n) for n in sums])
    gives = tails.select("_pid", F.col("_hi").alias("_g"), F.lit(1).alias("_gives"), *sums)
    takes = tails.select("_pid", F.col("_lo").alias("_g"), F.lit(0).alias("_gives"),
                         *[(F.col(n) - F.col(n)).alias(n) for n in sums])
    before = Window.partitionBy("_g").orderBy("_pid", "_gives").rowsBetween(Window.unboundedPreceding, -1)
    carry = gives.unionByName(takes).select(F.col("_pid").alias("_cp"), "_g", "_gives",
                                            *[F.sum(n).over(before).alias(f"_c_{n}") for n in sums]).where("_gives = 0")
    own = Window.partitionBy("_pid", group).orderBy(*keys).rowsBetween(Window.unboundedPreceding, 0)
    local = r.select(*[c for c in r.columns if c not in sums], *[F.sum(n).over(own).alias(n) for n in sums])
    j = local.join(F.broadcast(carry), (F.col("_pid") == F.col("_cp")) & (F.col(group) == F.col("_g")), "left")
    return j.select(*df.columns, *[(F.col(n) + F.coalesce(F.col(f"_c_{n}"), F.col(n) - F.col(n))).alias(n) for n in sums])


def next_in_group(df: DataFrame, group: str, order, value: str, out: str = "next_value",
                  n_parts: int | None = None) -> DataFrame:
    """Add ``out`` = ``value`` of the next row of the same ``group`` in
    ``order`` (a list of column names; NULLs sort last, then the next column
    breaks ties).  ``group`` must be non-NULL."""
    r, keys = range_chunks(df, group, order, n_parts)
    sort_key = F.struct(*[x.alias(f"_k{i}") for i, x in enumerate(keys)])
    w = Window.partitionBy("_pid", group).orderBy(*keys)
    r = r.withColumn(out, F.lead(value).over(w)).withColumn("_last", F.lead(F.lit(1)).over(w).isNull())
    heads = r.groupBy("_pid").agg(F.min_by(F.struct(F.col(group).alias("g"), F.col(value).alias("v")),
                                           sort_key).alias("h"))
    # next non-empty partition's head; one row per range partition
    nxt = heads.select("_pid", F.lead("h").over(Window.orderBy("_pid")).alias("_nh"))
    j = r.join(F.broadcast(nxt), "_pid", "left")
    fill = F.when(F.col("_last") & (F.col("_nh.g") == F.col(group)), F.col("_nh.v"))
    return j.withColumn(out, F.coalesce(F.col(out), fill)).drop("_pid", "_last", "_nh")


def ranked(df: DataFrame, order, out: str = "rank", n_parts: int | None = None) -> DataFrame:
    """Add ``out``: the row's place (from 1) in the total order of ``order``
    (columns, ``desc`` allowed), without a global window.

    Rows are range-partitioned and written once, so that the partition ids
    hold; each partition is numbered on its own and starts after the rows of
    the partitions before it (a table with one row per partition)."""
    spark = df.sparkSession
    n = n_parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    r = cut_lineage(df.repartitionByRange(n, *order).withColumn("_pid", F.spark_partition_id()), "rank-chunks")
    sizes = r.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    own = F.row_number().over(Window.partitionBy("_pid").orderBy(*order))
    return r.withColumn(out, own).join(F.broadcast(starts), "_pid") \
        .withColumn(out, F.col(out) + F.col("_start")).drop("_pid", "_start")
