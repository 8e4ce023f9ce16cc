"""Note segmentation, cleaning and the as-of cumulative text join."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.text import SEPARATOR_PATTERN, clean_report_text
from ..functions.timecols import relative_hour
from ..session import cut_lineage, spread
from .cohort import ID_COL, attach_intime
from .fit import quoted

# --- fixed values: note time columns, in priority order ----------------------
NOTE_TIME_COLUMNS = ("radiology_note_time_max", "radiology_note_time_min", "t_max_rel", "t_min_rel")
# -----------------------------------------------------------------------------
TEXT_COL = "radiology_note_text"


def note_time_column(columns) -> str | None:
    """The first existing note-time column (by column presence, C7)."""
    for c in NOTE_TIME_COLUMNS:
        if c in columns:
            return c
    return None


def note_segments(text_df: DataFrame, static: DataFrame, row_key: str | None = "note_row",
                  keep_unknown_time: bool = False) -> DataFrame:
    """One row per cleaned report: split on 3+ hyphens, trim, drop empty,
    clean, drop empty; ``report_time`` in hours since admission, clipped at 0.

    All reports of a text row share the row's time.  Rows with an unknown
    time are dropped unless ``keep_unknown_time`` (used for the report).
    Output: stay_id, report_time, row key, pos, clean_text.
    """
    if TEXT_COL not in text_df.columns:
        raise ValueError(f"text table needs column {TEXT_COL!r}")
    t = attach_intime(spread(text_df), static)
    tcol = note_time_column(t.columns)
    if tcol is None:
        rt = F.lit(None).cast("double")
    elif tcol.startswith("radiology"):
        rt = relative_hour(tcol, "intime")
    else:
        rt = F.expr(f"try_cast({tcol} AS DOUBLE)")
        rt = F.when(rt.isNotNull(), F.greatest(rt, F.lit(0.0)))
    key = F.col(row_key) if row_key and row_key in t.columns else F.lit(None).cast("bigint")
    # cleaned inside the array: later steps see a column, so the chain of patterns runs
    # once a report (a filter on the result would take a copy of it; so would the one
    # that is inferred for the inner form of explode)
    parts = F.transform(F.split(F.coalesce(F.col(TEXT_COL), F.lit("")), SEPARATOR_PATTERN), clean_report_text)
    seg = t.select(F.col(ID_COL), rt.alias("report_time"), key.alias("note_row"),
                   F.posexplode_outer(parts).alias("pos", "clean_text")).where(F.length("clean_text") > 0)
    if not keep_unknown_time:
        seg = seg.where(F.col("report_time").isNotNull())
    return seg


def unknown_time_count(segments_all: DataFrame) -> DataFrame:
    """Number of cleaned reports dropped for an unknown time (F8)."""
    return segments_all.agg(F.count_if(F.col("report_time").isNull()).alias("dropped_unknown_time"))


BLOCK = 4              # landmarks of a stay whose texts are put together in one group


def _place_of(ends, t):
    """Index of the first element of the sorted array ``ends`` that is not
    below ``t`` (binary search, in the row); its size if there is none."""
    def halve(acc, _):
        mid = F.floor((acc["lo"] + acc["hi"]) / 2).cast("int")
        open_, below = acc["lo"] < acc["hi"], F.get(ends, mid) < t
        return F.struct(F.when(open_ & below, mid + 1).otherwise(acc["lo"]).alias("lo"),
                        F.when(open_ & ~below, mid).otherwise(acc["hi"]).alias("hi"))
    start = F.struct(F.lit(0).alias("lo"), F.size(ends).alias("hi"))
    return F.aggregate(F.sequence(F.lit(0), F.ceil(F.log2(F.size(ends) + 1)).cast("int")), start, halve)["lo"]


LATER = "new_text_later"   # beside new_text: how many rows of the stay have it in their as-of text


def _ends(landmarks: DataFrame) -> DataFrame:
    """The landmarks of each stay in time order, in one array."""
    return landmarks.where(F.col("t_end").isNotNull()).groupBy(ID_COL).agg(
        F.array_sort(F.collect_set(F.col("t_end").cast("double"))).alias("_ends"))


def _seen(segments: DataFrame, ends: DataFrame) -> DataFrame:
    """Every report with the number ``_k`` of the first landmark that sees it,
    of ``_n``.  Reports after the last landmark are seen by none and dropped."""
    order = F.struct("report_time", F.col("note_row").isNull().alias("none"), "note_row", "pos", "clean_text")
    return segments.join(ends, ID_COL).withColumn("_k", _place_of(F.col("_ends"), F.col("report_time"))) \
        .select(ID_COL, F.size("_ends").alias("_n"), "_k", order.alias("_r")).where(F.col("_k") < F.col("_n"))


def _numbered(rows: DataFrame, ends: DataFrame) -> DataFrame:
    """Rows with the number of their landmark, themselves as ``_row``."""
    k = F.array_position("_ends", F.col("t_end").cast("double")) - 1
    return rows.select(ID_COL, "t_end", F.struct(*[F.col(quoted(c)) for c in rows.columns]).alias("_row")).join(ends, ID_COL).select(
        ID_COL, F.size("_ends").alias("_n"), k.cast("int").alias("_k"), "_row")


def _joined(reports) -> F.Column:
    """Texts of collected reports in order (time, row key, position, text)."""
    return F.array_join(F.transform(F.array_sort(F.collect_list(reports)), lambda r: r["clean_text"]), " ")


def with_increments(rows: DataFrame, segments: DataFrame) -> DataFrame:
    """``rows`` (of a stay at ``t_end``, neither NULL) with ``new_text``, the
    reports since the stay's landmark before, ``has_text`` (any report up to
    ``t_end``) and ``new_text_later``.  The texts of a stay's landmarks up to one,
    joined by a space, are its as-of text, so every report is in one row only.

    Rows travel to the texts and not the other way, and are written with them;
    the running flag comes from a join that a reader of the texts alone does
    without."""
    rows = cut_lineage(rows, "landmarks")
    ends = _ends(rows)
    both = _seen(segments, ends).unionByName(_numbered(rows, ends), allowMissingColumns=True)
    inc = both.groupBy(ID_COL, "_k").agg(F.max("_n").alias("_n"), F.collect_list("_row").alias("_rows"), _joined("_r").alias("new_text"))
    inc = inc.select("_k", "new_text", (F.length("new_text") > 0).alias("_any"), (F.col("_n") - F.col("_k")).alias(LATER),
                     F.explode("_rows").alias("_row")).select("_row.*", "new_text", LATER, "_k", "_any")
    inc = cut_lineage(inc, "note-increments")
    first = inc.where("_any").groupBy(ID_COL).agg(F.min("_k").alias("_first"))
    has = F.coalesce((F.col("_k") >= F.col("_first")).cast("int"), F.lit(0))
    return inc.join(first, ID_COL, "left").select(*[quoted(c) for c in rows.columns], "new_text", has.alias("has_text"), LATER)


def text_increments(landmarks: DataFrame, segments: DataFrame) -> DataFrame:
    """:func:`with_increments` of each different (stay, t_end)."""
    marks = landmarks.select(ID_COL, "t_end").where(F.col("t_end").isNotNull()).dropDuplicates()
    return with_increments(marks, segments).drop(LATER)


def with_asof_text(rows: DataFrame, segments: DataFrame, block: int = BLOCK) -> DataFrame:
    """``rows`` (of a stay at ``t_end``, neither NULL) with ``final_text``, all
    reports with ``report_time <= t_end``, joined by a space in time order, ""
    when none (J9), and ``has_text``.  Ties between reports are broken by (row
    key, position, text).

    A report belongs to the first landmark that sees it, found by binary
    search among the stay's landmarks; a report at exactly ``t_end`` is seen.
    Landmarks are put together in groups of ``block`` of a stay, so a stay with
    very many notes is spread over its groups: a group gets its own reports
    and, for the landmarks before it, all earlier ones.  No group is larger
    than the reports of its last landmark; reports are shuffled once for every
    ``block`` landmarks that see them.  The rows travel to the reports, and
    as-of texts, many times larger than these, are the last step: they are
    not shuffled, sorted or joined."""
    rows = cut_lineage(rows, "landmarks")
    ends = _ends(rows)
    reports = _seen(segments, ends)
    group, last = F.expr(f"_k div {block}"), F.expr(f"(_n - 1) div {block}")
    shown = reports.select(ID_COL, "_k", "_r", F.explode(F.sequence(group, last)).alias("_block")).select(
        ID_COL, "_block", F.when(group == F.col("_block"), F.col("_k")).otherwise(-1).alias("_k"), "_r")
    both = shown.unionByName(_numbered(rows, ends).select(ID_COL, group.alias("_block"), "_k", "_row"), allowMissingColumns=True)
    texts = both.repartition(ID_COL, "_block").groupBy(ID_COL, "_block", "_k").agg(
        F.collect_list("_row").alias("_rows"), _joined("_r").alias("_new"))
    w = Window.partitionBy(ID_COL, "_block").orderBy("_k").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    text = F.array_join(F.collect_list(F.when(F.length("_new") > 0, F.col("_new"))).over(w), " ")
    return texts.select("_k", "_rows", text.alias("final_text")).where(F.col("_k") >= 0).select(
        "final_text", F.explode("_rows").alias("_row")).select(
        "_row.*", "final_text", (F.length("final_text") > 0).cast("int").alias("has_text"))


def asof_text(landmarks: DataFrame, segments: DataFrame, block: int = BLOCK) -> DataFrame:
    """:func:`with_asof_text` of each different (stay, t_end)."""
    marks = landmarks.select(ID_COL, F.col("t_end").cast("double").alias("t_end")).where(F.col("t_end").isNotNull()).dropDuplicates()
    return with_asof_text(marks, segments, block)
