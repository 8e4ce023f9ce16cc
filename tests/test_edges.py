"""Hand-written edge cases for the landmark, note and label operators."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from wardline.functions.text import clean_report, strip_ws
from wardline.operators import hourly, labels, landmarks, notes
from wardline.plans import master as M

T0 = datetime(2024, 1, 1)
STATIC_SCHEMA = ("stay_id long, subject_id long, hadm_id long, intime timestamp_ntz, outtime timestamp_ntz, "
                 "deathtime timestamp_ntz, icu_los_hours double")
TIME_SCHEMA = "stay_id long, hour_ts timestamp_ntz, hr double"


def h(x):
    return T0 + timedelta(hours=x)


def static_row(sid, subj, hadm, out_h, death_h=None, start=0.0):
    return (sid, subj, hadm, h(start), h(start + out_h), None if death_h is None else h(start + death_h),
            float(out_h))


def test_rint_is_half_even(spark):
    st = spark.createDataFrame([static_row(1, 1, 1, 100)], STATIC_SCHEMA)
    ts = spark.createDataFrame([(1, h(x), 1.0) for x in (0.5, 1.5, 2.5)], TIME_SCHEMA)
    rel = hourly.with_relative_hour(ts, st)
    got = sorted(r["hour"] for r in hourly.hourly_means(rel, ["hr"], "rint").collect())
    assert got == [0, 2]   # 0.5 -> 0, 1.5 -> 2, 2.5 -> 2


def test_relative_hour_clips_and_keeps_null(spark):
    st = spark.createDataFrame([static_row(1, 1, 1, 100)], STATIC_SCHEMA)
    ts = spark.createDataFrame([(1, h(-3), 1.0), (1, None, 2.0)], TIME_SCHEMA)
    got = sorted((r["relative_hour"] for r in hourly.with_relative_hour(ts, st).collect()),
                 key=lambda v: (v is None, v))
    assert got == [0.0, None]


def _trailing(spark, hours_values, out_h=200):
    st = spark.createDataFrame([static_row(1, 1, 1, out_h)], STATIC_SCHEMA)
    ts = spark.createDataFrame([(1, h(x), v) for x, v in hours_values], TIME_SCHEMA)
    hr = hourly.hourly_means(hourly.with_relative_hour(ts, st), ["hr"], "rint")
    return {r["t_end"]: r for r in landmarks.trailing_features(hr, ["hr"]).collect()}


def test_trailing_window_bounds(spark):
    # hour 0 (= t_end - 24 for t_end 24) is outside, hour 24 inside; stay reaches 36
    got = _trailing(spark, [(0, 100.0), (1, 10.0), (24, 20.0), (36, None)])
    assert got[24.0]["hr_mean"] == pytest.approx(15.0)
    assert got[24.0]["hr_min"] == 10.0 and got[24.0]["hr_max"] == 20.0
    assert got[24.0]["t_start"] == 0.0
    # at 36 the window is 13..36: hour 24 measured, hour 36 observed but empty
    assert got[36.0]["hr_mean"] == 20.0 and got[36.0]["hr_is_measured"] == 1.0


def test_trailing_needs_an_observed_row_and_max_hour(spark):
    got = _trailing(spark, [(0, 1.0), (23, 2.0)])
    assert got == {}                                  # max hour 23: no landmark
    got = _trailing(spark, [(0, 1.0), (60, None)])
    # t_end 24 and 36 have no row in their window; 48 neither; 60 has the empty row
    assert sorted(got) == [60.0]
    assert got[60.0]["hr_is_measured"] == 0.0 and got[60.0]["hr_mean"] is None


def test_cumulative_stats(spark):
    st = spark.createDataFrame([static_row(1, 1, 1, 200)], STATIC_SCHEMA)
    ts = spark.createDataFrame([(1, h(2.7), 4.0), (1, h(30), None), (1, h(40), 8.0), (1, h(48), None)],
                               TIME_SCHEMA)
    hr = hourly.hourly_means(hourly.with_relative_hour(ts, st), ["hr"], "floor")
    got = {r["t_end"]: r for r in landmarks.cumulative_features(hr, ["hr"]).collect()}
    assert sorted(got) == [24.0, 36.0, 48.0]
    assert got[24.0]["hr_cum_std"] == 0.0 and got[24.0]["hr_last"] == 4.0
    assert got[24.0]["hr_measured_frac"] == pytest.approx(1 / 25)
    assert got[48.0]["hr_cum_mean"] == pytest.approx(6.0)
    assert got[48.0]["hr_cum_std"] == pytest.approx(2.8284271247)
    assert got[48.0]["hr_last"] == 8.0 and got[48.0]["hr_measured_frac"] == pytest.approx(2 / 49)


def test_note_cleaning_python_whitespace(spark):
    df = spark.createDataFrame([("  Chest clear.  Results  were\ncommunicated to Dr X ",),
                                ("ELECTRONICALLY SIGNED by someone",), ("a\x1cb",)], "t string")
    got = [r[0] for r in df.select(clean_report("t")).collect()]
    assert got == ["Chest clear.", None, "a b"]
    assert df.select(strip_ws(F.lit("　 x  "))).first()[0] == "x"


def test_note_segments_and_asof(spark):
    st = spark.createDataFrame([static_row(1, 1, 1, 100)], STATIC_SCHEMA)
    tx = spark.createDataFrame([(1, 0, h(24), "first ---- second\n---\n   "), (1, 1, h(30), "------"),
                                (1, 2, None, "lost")],
                               "stay_id long, note_row long, radiology_note_time_max timestamp_ntz, "
                               "radiology_note_text string")
    seg = notes.note_segments(tx, st)
    assert [r["clean_text"] for r in seg.orderBy("note_row", "pos").collect()] == ["first", "second"]
    allseg = notes.note_segments(tx, st, keep_unknown_time=True)
    assert notes.unknown_time_count(allseg).first()[0] == 1
    lm = spark.createDataFrame([(1, 12.0), (1, 24.0), (1, 36.0)], "stay_id long, t_end double")
    got = {r["t_end"]: (r["final_text"], r["has_text"]) for r in notes.asof_text(lm, seg).collect()}
    assert got == {12.0: ("", 0), 24.0: ("first second", 1), 36.0: ("first second", 1)}


def test_readmission_gaps(spark):
    rows = [static_row(1, 1, 10, 24, start=0), static_row(2, 1, 10, 24, start=24),      # gap 0 -> readmit
            static_row(3, 2, 20, 24, start=0), static_row(4, 2, 20, 24, start=96),      # gap 72 -> readmit
            static_row(5, 3, 30, 24, start=0), static_row(6, 3, 30, 24, start=96.0001),  # gap 72.0001 -> no
            static_row(7, 4, 40, 48, start=0), static_row(8, 4, 40, 24, start=24),      # negative gap -> no
            static_row(9, 5, None, 24, start=0), static_row(10, 5, None, 24, start=24)]  # null hadm -> no
    st = spark.createDataFrame(rows, STATIC_SCHEMA)
    got = {r["stay_id"]: r["readmit_72h"] for r in labels.readmit_labels(st).collect()}
    assert got == {1: 1, 2: 0, 3: 1, 4: 0, 5: 0, 6: 0, 7: 0, 8: 0, 9: 0, 10: 0}


def test_task_labels_and_exit_filter(spark):
    st = spark.createDataFrame([static_row(1, 1, 1, 50), static_row(2, 2, 2, 40, death_h=40)], STATIC_SCHEMA)
    m = spark.createDataFrame([(1, 1, 24.0), (1, 1, 36.0), (1, 1, 60.0), (2, 2, 24.0)],
                              "stay_id long, subject_id long, t_end double")
    got = {(r["stay_id"], r["t_end"]): (r["label_can_discharge_24h"], r["task2_mask"])
           for r in labels.task_labels(m, st, labels.readmit_labels(st)).collect()}
    # 60 > exit 50 is dropped; stay 2 dies in the ICU so task 1 is 0
    assert got == {(1, 24.0): (0, 0), (1, 36.0): (1, 1), (2, 24.0): (0, 0)}


def test_interval_labels_sum_to_within(spark):
    st = spark.createDataFrame([static_row(i, i, i, 30 + 7 * i, death_h=(30 + 7 * i) if i % 2 else None)
                                for i in range(1, 12)], STATIC_SCHEMA)
    ev = labels.event_table(st)
    m = spark.createDataFrame([(i, i, float(t)) for i in range(1, 12) for t in (24, 36, 48)],
                              "stay_id long, subject_id long, t_end double")
    lt = labels.landmark_labels(m, ev).collect()
    assert lt
    for r in lt:
        for k in ("discharge", "death"):
            assert r[f"event_{k}_within_48h"] == r[f"event_{k}_0_24h"] + r[f"event_{k}_24_48h"]
            assert r[f"event_{k}_within_72h"] == (r[f"event_{k}_0_24h"] + r[f"event_{k}_24_48h"]
                                                  + r[f"event_{k}_48_72h"])
        assert r["remaining_hours"] > 0 and r["landmark_bin"] >= 24


def test_master_without_text(spark):
    st = spark.createDataFrame([static_row(1, 1, 1, 60)], STATIC_SCHEMA)
    ts = spark.createDataFrame([(1, h(x), float(x)) for x in range(0, 60, 5)], TIME_SCHEMA)
    m = M.master_trailing(M.CohortInputs(st, ts, None)).collect()
    assert [r["t_end"] for r in sorted(m, key=lambda r: r["t_end"])] == [24.0, 36.0, 48.0]
    assert all(r["final_text"] == "" and r["has_text"] == 0 for r in m)


def test_next_in_group_matches_window(spark):
    import random
    from pyspark.sql import Window
    from wardline.operators.sequence import next_in_group
    rnd = random.Random(5)
    # one hot group holding most rows, NULL order values, ties broken by id
    rows = [(i, 1 if i % 4 else rnd.randint(2, 9), None if i % 17 == 0 else float(rnd.randint(0, 50)))
            for i in range(400)]
    df = spark.createDataFrame(rows, "id long, g long, t double")
    got = {r["id"]: r["nv"] for r in next_in_group(df, "g", ["t", "id"], "t", "nv", n_parts=7).collect()}
    w = Window.partitionBy("g").orderBy(F.asc_nulls_last("t"), "id")
    exp = {r["id"]: r["nv"] for r in df.select("id", F.lead("t").over(w).alias("nv")).collect()}
    exp_last = {r["id"]: r["x"] for r in df.select("id", F.lead("id").over(w).alias("x")).collect()}
    assert got == exp
    assert sum(v is None for v in exp_last.values()) == df.select("g").distinct().count()


def test_readmission_skew_safe_equals_window(spark):
    rows = [static_row(i, i // 3, (i // 3) if i % 7 else None, 24 + (i % 5), start=30.0 * (i % 3) + (i % 2))
            for i in range(60)]
    st = spark.createDataFrame(rows, STATIC_SCHEMA)
    a = {r["stay_id"]: r["readmit_72h"] for r in labels.readmit_labels(st).collect()}
    b = {r["stay_id"]: r["readmit_72h"] for r in labels.readmit_labels(st, skew_safe=False).collect()}
    assert a == b and sum(a.values()) > 0


@pytest.mark.parametrize("window,step,want", [(12, 12, [12.0, 24.0, 36.0, 48.0]), (12, 6, [12.0, 18.0, 24.0, 30.0, 36.0, 42.0, 48.0]),
                                              (48, 12, [48.0])])
def test_first_landmark_is_the_first_full_window(spark, window, step, want):
    st = spark.createDataFrame([static_row(1, 1, 1, 200)], STATIC_SCHEMA)
    ts = spark.createDataFrame([(1, h(x), 1.0) for x in range(1, 49)], TIME_SCHEMA)
    hr = hourly.hourly_means(hourly.with_relative_hour(ts, st), ["hr"], "rint")
    got = landmarks.trailing_features(hr, ["hr"], window=window, step=step).orderBy("t_end").collect()
    assert [r.t_end for r in got] == want and all(r.t_start == r.t_end - window for r in got)


@pytest.mark.parametrize("missing", [None, float("nan")])
def test_missing_loss_is_no_improvement(spark, missing):
    from wardline.operators import curves
    df = spark.createDataFrame([(1, 0.5)] + [(i, missing) for i in range(2, 8)], "epoch int, val_loss_total double")
    r = curves.early_stop(df, patience=2).first()
    assert (r.best_epoch, r.best_val_total_loss, r.stopped_epoch) == (1, 0.5, 3)


def test_guards(spark):
    st = spark.createDataFrame([static_row(1, 1, 1, 100), static_row(1, 2, 2, 50)], STATIC_SCHEMA)
    ts = spark.createDataFrame([(1, h(x), 1.0) for x in range(30)], TIME_SCHEMA)
    with pytest.raises(ValueError, match="not unique"):
        M.check_inputs(M.CohortInputs(st, ts))
    short = spark.createDataFrame([static_row(1, 1, 1, 10)], STATIC_SCHEMA)
    with pytest.raises(ValueError, match="no stay"):
        M.check_inputs(M.CohortInputs(short, ts))
    with pytest.raises(ValueError, match="hour_ts"):
        M.master_trailing(M.CohortInputs(short, ts.drop("hour_ts")))
    from wardline.plans import matrices as MX
    two = spark.createDataFrame([(1, 1, 24.0), (2, 2, 24.0)], "stay_id long, subject_id long, t_end double")
    with pytest.raises(ValueError, match="at least 3"):
        MX.landmark_matrices(two)
    with pytest.raises(ValueError, match="task2_mask"):
        MX.base_matrices(two, True)


def test_building_a_plan_runs_no_job(spark):
    from wardline.operators import evaluate as EV
    pred = spark.createDataFrame([(1, 0.7, 1, 0.4, 1, "a"), (0, 0.2, 1, 0.9, 0, "b")],
                                 "y1_true int, y1_prob double, y2_true int, y2_prob double, y2_mask int, first_careunit string")
    st = spark.createDataFrame([static_row(1, 1, 1, 100)], STATIC_SCHEMA)
    ts = spark.createDataFrame([(1, h(x), 1.0) for x in range(30)], TIME_SCHEMA)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("planning", "plans only")
    EV.metrics_bundle(pred), EV.subgroup_metrics(pred), EV.calibration_bins(pred, "y1_true", "y1_prob")
    landmarks.trailing_features(hourly.hourly_means(hourly.with_relative_hour(ts, st), ["hr"], "rint"), ["hr"])
    assert len(tracker.getJobIdsForGroup("planning")) == 0
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_history_tensor_matches_plain_lookup(spark):
    from wardline.operators import tensors as TS
    rows = [(1, x, float(x)) for x in (0, 1, 5, 23, 24, 30, 36)] + [(2, 24, 7.0)]
    hr = spark.createDataFrame(rows, "stay_id long, hour int, hr double")
    marks = spark.createDataFrame([(1, 24.0), (1, 36.0), (2, 24.0), (3, 24.0)], "stay_id long, t_end double")
    got = {(r.stay_id, r.t_end): [c[0] for c in r.time_series] for r in TS.history_tensor(marks, hr, ["hr"]).collect()}
    for (stay, t), cells in got.items():
        held = {x: v for s, x, v in rows if s == stay}
        assert cells == [held.get(int(t) - 23 + p) for p in range(24)]
    off = TS.modality_switch(TS.history_tensor(marks, hr, ["hr"]).selectExpr("*", "array(1.0D) AS static", "array(3) AS input_ids", "array(1) AS attention_mask"),
                             use_text=False, use_time=False, use_static=False).first()
    assert off.static == [0.0] and off.input_ids == [0] and off.attention_mask == [0] and off.time_series == [[0.0]] * 24


def test_medians_narrow_and_skip_nan(spark):
    import random
    from wardline.operators import fit
    rnd = random.Random(4)
    cols = {"a": [rnd.random() for _ in range(999)], "b": [1.0] * 998 + [None], "c": [float("nan"), None] * 499 + [2.0],
            "d": [None] * 999, "e": [float(i // 500) for i in range(999)], "f": [rnd.randint(0, 3) * 1.0 for _ in range(998)] + [None]}
    df = spark.createDataFrame(list(zip(*cols.values())), ", ".join(f"{c} double" for c in cols))
    want = {}
    for c, v in cols.items():
        x = sorted(y for y in v if y is not None and y == y)
        want[c] = (x[(len(x) - 1) // 2] + x[len(x) // 2]) / 2 if x else None
    assert fit.medians(df, cols) == want
    old = fit.BINS
    try:
        fit.BINS = 16                              # narrow again and again
        assert fit.medians(df, cols) == want
    finally:
        fit.BINS = old


def test_running_sums_in_group_match_window(spark):
    from pyspark.sql import Window, functions as F
    from wardline.operators.sequence import running_in_group
    rows = [(1, i, i % 7) for i in range(200)] + [(g, i, g) for g in range(2, 9) for i in range(3)] + [(0, None, 5), (0, 1, 2)]
    df = spark.createDataFrame(rows, "g int, t int, x long")
    w = Window.partitionBy("g").orderBy(F.col("t").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0)
    want = df.select("*", F.sum("x").over(w).alias("s"), F.sum(F.lit(1)).over(w).alias("n"))
    for parts in (1, 3, 40):
        got = running_in_group(df, "g", ["t"], {"s": F.col("x"), "n": F.lit(1)}, n_parts=parts)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert running_in_group(df.where("false"), "g", ["t"], {"s": F.col("x")}).collect() == []


def test_every_note_time_column(spark):
    st = spark.createDataFrame([static_row(1, 1, 1, 100)], STATIC_SCHEMA)
    for column, kind, value, want in (("radiology_note_time_min", "timestamp_ntz", h(24), 24.0), ("t_max_rel", "string", "7.5", 7.5),
                                      ("t_min_rel", "double", -3.0, 0.0), ("t_max_rel", "string", "soon", None)):
        tx = spark.createDataFrame([(1, 0, value, "one report")], f"stay_id long, note_row long, {column} {kind}, radiology_note_text string")
        assert notes.note_time_column(tx.columns) == column
        got = notes.note_segments(tx, st, keep_unknown_time=True).first()
        assert got["report_time"] == want and got["clean_text"] == "one report"
    both = tx.selectExpr("*", "1.0D AS t_min_rel")
    assert notes.note_time_column(both.columns) == "t_max_rel" and notes.note_time_column(["x"]) is None


def test_plan_without_deathtime(spark):
    from wardline.plans import master as M
    st = spark.createDataFrame([static_row(1, 1, 1, 100), static_row(2, 2, 2, 100)], STATIC_SCHEMA).drop("deathtime")
    ts = spark.createDataFrame([(s, h(k), float(k)) for s in (1, 2) for k in range(0, 60, 5)], "stay_id long, hour_ts timestamp_ntz, hr double")
    tx = spark.createDataFrame([(1, h(3), "a report")], "stay_id long, radiology_note_time_max timestamp_ntz, radiology_note_text string")
    for m in (M.master_trailing(M.CohortInputs(st, ts, tx)), M.master_cumulative(M.CohortInputs(st, ts))):
        rows = m.collect()
        assert rows and all(r.icu_death_flag == 0 for r in rows)


def test_cif_file_holds_the_table(spark, tmpdir_path):
    from wardline.operators import survival as SV
    from wardline.sources.sinks import write_cif
    df = spark.createDataFrame([(1, 24.0, *[0.1 * k for k in range(9)])],
                               "stay_id long, t_end double, " + ", ".join(f"{SV.logit_col(b, k)} double" for b in range(3) for k in SV.CLASSES))
    cif = SV.cif_from_logits(df)
    write_cif(cif, tmpdir_path)
    back = spark.read.option("header", True).option("inferSchema", True).csv(f"{tmpdir_path}/cif_predictions").first()
    want = cif.first()
    assert back.asDict().keys() == want.asDict().keys() and all(back[c] == pytest.approx(want[c]) for c in want.asDict())
