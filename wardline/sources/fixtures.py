"""Cohort-shaped inputs derived from the driver tables.

The driver provides star-schema and text tables, not ICU data.  These views
give them the shapes the pipelines expect (see FIXTURES.md):

* ``stays``   (static): one row per six-day activity block of a user;
* ``vitals``  (time series): the user's events around each stay;
* ``notes``   (text): documents attached to a stay, with a report time;
* ``predictions``: scored labelled documents (evaluation input);
* ``wide``    : a numeric feature table (fit/transform input).

Every view is a lazy DataFrame over the whole driver tables.
"""

from __future__ import annotations

import os
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..functions.timecols import hours_between
from ..session import table_path
from .tables import read_table

EPOCH = "2024-01-01 00:00:00"
BLOCK_SECONDS = 518400.0      # six days
SHORT_SECONDS = 108000.0      # 30 h, the blocks of users with id % 5 == 4


def _epoch():
    return F.lit(EPOCH).cast("timestamp_ntz")


def _hours(n: int):
    return F.make_dt_interval(F.lit(0), F.lit(n))


def stays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Static table: every event belongs to the stay of its user and time
    block.  Blocks are six days long, 30 h for users with id % 5 == 4 (short
    stays); two blocks in a row are one admission."""
    ev = read_table(spark, sf_dir, "events").select("user_id", "event_type", "ts")
    sec = F.timestamp_diff("MICROSECOND", _epoch(), F.col("ts")) / F.lit(1e6)
    width = F.when(F.col("user_id") % 5 == 4, SHORT_SECONDS).otherwise(BLOCK_SECONDS)
    e = ev.withColumn("blk", F.floor(sec / width).cast("bigint"))
    g = e.groupBy("user_id", "blk").agg(
        F.min("ts").alias("intime"), F.max("ts").alias("outtime"),
        F.max_by("event_type", "ts").alias("last_type"))
    return g.select(
        (F.col("user_id") * 100 + F.col("blk")).alias("stay_id"),
        F.col("user_id").alias("subject_id"),
        F.when(F.col("user_id") % 25 != 7, F.col("user_id") * 100 + F.floor(F.col("blk") / 2)).alias("hadm_id"),
        "intime", "outtime",
        F.when(F.col("last_type") == "error", F.col("outtime"))
         .when(F.col("last_type") == "signup", F.col("outtime") + _hours(10)).alias("deathtime"),
        hours_between("intime", "outtime").alias("icu_los_hours"),
        (F.lit(18) + F.col("user_id") % 73).cast("double").alias("age"),
        F.when(F.col("user_id") % 4 == 0, "MICU").when(F.col("user_id") % 4 == 1, "SICU")
         .when(F.col("user_id") % 4 == 2, "CVICU").alias("first_careunit"),
    )


VITAL_SOURCES = (("hr", "view"), ("map", "click"), ("lactate", "purchase"), ("gcs", "signup"))


def vitals(spark: SparkSession, sf_dir: str, stays_df: DataFrame | None = None) -> DataFrame:
    """Time-series table: one row per event within 12 h of a stay."""
    s = (stays_df if stays_df is not None else stays(spark, sf_dir)).select(
        "stay_id", "subject_id", "intime", "outtime")
    ev = read_table(spark, sf_dir, "events").select("user_id", "ts", "event_type", "value")
    j = s.join(ev, (ev.user_id == s.subject_id)
               & (ev.ts >= s.intime - _hours(12)) & (ev.ts <= s.outtime + _hours(12)))
    return j.select(
        "stay_id", F.col("ts").alias("hour_ts"),
        *[F.when(F.col("event_type") == et, F.col("value")).alias(name) for name, et in VITAL_SOURCES])


NOTE_TAIL = "\n-----\nImpression "
NOTE_SIGN = "\nElectronically signed by x\n---\n  "


def notes(spark: SparkSession, sf_dir: str, stays_df: DataFrame | None = None) -> DataFrame:
    """Text table: every document (whole text) becomes a multi-report note of
    the user ``doc_id % n_users``: of the user's stays in order, number
    ``doc_id // n_users`` modulo their count, between six hours before
    admission and the exit.  A user's stays are few (one per block)."""
    s = (stays_df if stays_df is not None else stays(spark, sf_dir)).select(
        "stay_id", "subject_id", "intime", "icu_los_hours")
    by_user = Window.partitionBy("subject_id")
    s = s.withColumn("ord", F.row_number().over(by_user.orderBy("stay_id")) - 1) \
        .withColumn("n_stays", F.count("*").over(by_user))
    n_users = read_table(spark, sf_dir, "events").select(F.count_distinct("user_id")).scalar()
    docs = read_table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("note_row"), (F.col("doc_id") % n_users).alias("uid"),
        F.floor(F.col("doc_id") / n_users).alias("turn"),
        F.concat(F.col("text"), F.lit(NOTE_TAIL), F.col("source"), F.lit(NOTE_SIGN)).alias("txt"))
    j = docs.join(s, (F.col("subject_id") == F.col("uid")) & (F.col("turn") % F.col("n_stays") == F.col("ord")))
    hour = ((F.col("note_row") * 37) % (F.floor("icu_los_hours") + 7) - 6).cast("int")
    return j.select("stay_id", "note_row", (F.col("intime") + F.make_dt_interval(F.lit(0), hour)).alias("radiology_note_time_max"),
                    F.col("txt").alias("radiology_note_text"))


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prediction table with tied scores, both classes and a subgroup column."""
    lab = read_table(spark, sf_dir, "labels")
    doc = read_table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    j = lab.join(doc, "doc_id")
    return j.select(
        F.col("doc_id").alias("row_id"), F.col("lang").alias("first_careunit"),
        F.col("quality").alias("y1_true"),
        F.least(F.lit(1.0), F.floor(F.col("n_chars").cast("double") / 4) / 1000).alias("y1_prob"),
        (F.lit(1) - F.col("toxic")).alias("y2_true"),
        (((F.col("doc_id") * 7919) % 1000).cast("double") / 1000).alias("y2_prob"),
        F.col("quality").alias("y2_mask"))


def wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numeric feature table with NULL, constant, duplicate and sparse columns."""
    li = read_table(spark, sf_dir, "lineitem")
    od = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    j = li.join(od, li.l_orderkey == od.o_orderkey)
    return j.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("row_id"),
        F.col("o_custkey").alias("subject_id"),
        F.when(F.col("l_linenumber") % 3 != 0, F.col("l_quantity")).alias("f1"),
        F.col("l_extendedprice").alias("f2"), F.col("l_discount").alias("f3"),
        F.when(F.col("l_orderkey") % 5 != 0, F.col("l_tax")).alias("f4"),
        F.lit(7.0).alias("f5_const"),
        (F.col("l_extendedprice") * 2.0 + F.col("l_linenumber")).alias("f6_dup"),
        F.when(F.col("l_orderkey") % 20 == 0, F.col("l_quantity")).alias("f7_sparse"))


WIDE_FEATURES = ("f1", "f2", "f3", "f4", "f5_const", "f6_dup", "f7_sparse")


def survival_logits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Survival-head outputs: the whole embedding folded into nine logits, 3
    bins x (none, discharge, death), each eight times the mean of the values
    whose position modulo 9 is its own."""
    emb = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding")

    def folded(i: int):
        own = F.filter("embedding", lambda x, k: k % 9 == i)
        total = F.aggregate(own, F.lit(0.0), lambda acc, x: acc + x.cast("double"))
        return (total / F.size(own) * 8).alias(f"logit_b{i // 3 + 1}_{('none', 'dis', 'death')[i % 3]}")
    return emb.select("vec_id", *[folded(i) for i in range(9)])


def loss_table(spark: SparkSession, sf_dir: str, epochs: int = 100) -> DataFrame:
    """Loss table of a two-task run, aggregated from every row of ``lineitem``:
    an order's epoch is its key modulo ``epochs``, supplier keys give the
    split; task 2 counts the first ``epoch % 3`` lines, so every third epoch
    has no valid task-2 row and a NULL loss."""
    li = read_table(spark, sf_dir, "lineitem")
    epoch = (F.col("l_orderkey") % epochs + 1).cast("int")
    train, valid = F.col("l_suppkey") % 5 != 0, F.col("l_linenumber") <= epoch % 3

    def loss(y, p):
        p = F.least(F.greatest(p.cast("double"), F.lit(1e-6)), F.lit(1 - 1e-6))
        return F.when(y, -F.log(p)).otherwise(-F.log(1 - p))
    one = loss(F.col("l_returnflag") == "R", F.col("l_discount") * 10)
    two = loss(F.col("l_linestatus") == "O", F.col("l_tax") * 10)
    return li.groupBy(epoch.alias("epoch")).agg(
        F.avg(F.when(train, one)).alias("train_loss_task1"), F.avg(F.when(train & valid, two)).alias("train_loss_task2_masked"),
        F.avg(F.when(~train, one)).alias("val_loss_task1"), F.avg(F.when(~train & valid, two)).alias("val_loss_task2_masked"),
        F.count_if(train & valid).alias("train_task2_valid_count"))


_MATERIALIZED: dict = {}


def _file_state(spark: SparkSession, sf_dir: str) -> tuple:
    """What identifies the input files: path, and names, sizes and times where
    the driver can list them."""
    out = []
    for t in ("events", "documents"):
        for f in sorted(spark.read.parquet(os.path.join(sf_dir, f"{t}.parquet")).inputFiles()):
            local = unquote(f.removeprefix("file:"))
            local = "/" + local.lstrip("/")
            st = os.stat(local) if f.startswith("file:") and os.path.exists(local) else None
            out.append((f, st.st_size, st.st_mtime_ns) if st else (f,))
    return tuple(out)


def cohort_tables(spark: SparkSession, sf_dir: str) -> dict:
    """The three cohort views written once per session as parquet tables in
    the shared checkpoint folder, then read like any input table (the role
    the source's CSV files play).  Deriving them inline would rebuild
    ``stays`` from ``events`` in every branch of a plan.  They are derived
    anew when the input files have changed."""
    key = (spark.sparkContext.applicationId, _file_state(spark, sf_dir))
    paths = _MATERIALIZED.get(key)
    if paths is None:
        base = table_path(spark, "inputs")
        st = stays(spark, sf_dir)
        paths = {"stays": f"{base}/stays", "vitals": f"{base}/vitals", "notes": f"{base}/notes"}
        st.write.parquet(paths["stays"])
        st_t = spark.read.parquet(paths["stays"])
        vitals(spark, sf_dir, st_t).write.parquet(paths["vitals"])
        notes(spark, sf_dir, st_t).write.parquet(paths["notes"])
        _MATERIALIZED[key] = paths
    return {k: spark.read.parquet(p) for k, p in paths.items()}
