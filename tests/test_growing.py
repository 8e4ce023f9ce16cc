"""As-of text over groups of landmarks, TF-IDF of growing texts and radix
medians, each against a plain computation."""

import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from wardline.operators import fit as FT
from wardline.operators import notes
from wardline.operators import text_features as TX

SEG = "stay_id long, report_time double, note_row long, pos int, clean_text string"


def _notes(rng, hot=400):
    rows = [(s, float(rng.choice([0, 5, 24, 24.5, 48, 60, 95, 200])), rng.choice([None, rng.randint(0, 5)]), rng.randint(0, 2),
             rng.choice(["lungs clear", "heart", "no acute", "lungs clear heart"])) for s in range(1, 12) for _ in range(rng.randint(0, 9))]
    rows += [(99, float(rng.randint(0, 400)), i, 0, rng.choice(["lungs clear", "big heart lungs"])) for i in range(hot)]   # most notes
    marks = [(s, float(t)) for s in range(1, 14) for t in range(24, 24 * rng.randint(2, 8), 24)] + [(99, 12.0 * k) for k in range(1, 31)]
    return rows, marks


def _plain(rows, marks):
    key = lambda r: (r[1], r[2] is None, r[2] or 0, r[3], r[4])
    return {(s, t): " ".join(r[4] for r in sorted((r for r in rows if r[0] == s and r[1] <= t), key=key)) for s, t in marks}


@pytest.mark.parametrize("block", [1, 3, 4, 50])
def test_asof_text_and_increments(spark, block):
    rows, marks = _notes(random.Random(block))
    want = _plain(rows, marks)
    seg, lm = spark.createDataFrame(rows, SEG), spark.createDataFrame(marks + marks[:3], "stay_id long, t_end double")
    got = notes.asof_text(lm, seg, block).collect()
    assert {(r.stay_id, r.t_end): r.final_text for r in got} == want and len(got) == len(want)
    assert all(r.has_text == int(bool(r.final_text)) for r in got)
    if block == 1:
        inc = {(r.stay_id, r.t_end): r for r in notes.text_increments(lm, seg).collect()}
        assert inc.keys() == want.keys()
        for (s, t), text in want.items():
            own = [inc[s, u].new_text for u in sorted(u for v, u in want if v == s and u <= t)]
            assert " ".join(x for x in own if x) == text and inc[s, t].has_text == int(bool(text))


def test_asof_text_of_a_large_stay_is_spread(spark):
    rows, marks = _notes(random.Random(7), hot=3000)
    seg, lm = spark.createDataFrame(rows, SEG), spark.createDataFrame(marks, "stay_id long, t_end double")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = notes.asof_text(lm, seg, 2).withColumn("p", F.spark_partition_id())
        assert out.where("stay_id = 99").select("p").distinct().count() > 3
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert notes.asof_text(lm.where("false"), seg).collect() == []
    assert {r.final_text for r in notes.asof_text(lm, seg.where("false")).collect()} == {""}


def test_growing_tfidf_is_that_of_the_whole_texts(spark):
    rng = random.Random(4)
    words = ["lung", "heart", "clear", "acute", "fluid", "rib"]
    rows, whole = [], []
    for s in range(30):
        text = []
        for t in range(1, rng.randint(2, 6)):
            new = " ".join(rng.choice(words) for _ in range(rng.choice([0, 0, 1, 4])))
            text += [new] if new else []
            rows.append((s, float(t), new))
            whole.append((s, float(t), " ".join(text)))
    inc = spark.createDataFrame(rows, "stay_id long, t_end double, new_text string")
    full = spark.createDataFrame(whole, "stay_id long, t_end double, final_text string")
    for features in (4, 12, 300):
        a = TX.fit_tfidf(full, "final_text", features, 3)
        added = TX.growing_tokens(inc, "stay_id", "t_end", "new_text")
        b = TX.fit_tfidf_growing(added, features, 3)
        assert a.vocabulary == b.vocabulary and a.idf == pytest.approx(b.idf)
    assert any(" " in t for t in a.vocabulary)
    want = {(r.stay_id, r.t_end): r for r in TX.tfidf_wide(full, "final_text", a).collect()}
    for r in TX.tfidf_wide_growing(inc, "stay_id", "t_end", added, b).collect():
        for t in a.vocabulary:
            assert r[f"tfidf_{t}"] == pytest.approx(want[r.stay_id, r.t_end][f"tfidf_{t}"])


@pytest.mark.parametrize("length", [3, 7, 128])
def test_growing_encoding_is_that_of_the_whole_texts(spark, length):
    rng = random.Random(8)
    words = ["lung", "heart", "clear", "acute", "fluid", "rib"]
    rows = []
    for s in range(25):
        text = []
        for t in range(1, rng.randint(2, 7)):
            new = None if s == 3 else " ".join(rng.choice(words + ["own%d" % s]) for _ in range(rng.choice([0, 0, 1, 4])))
            text += [new] if new else []
            rows.append((s, float(t), "train" if s % 3 else "test", new, " ".join(text)))
    df = spark.createDataFrame(rows, "stay_id long, t_end double, split string, new_text string, final_text string")
    full = TX.fit_vocab(df.where("split = 'train'"), "final_text")
    added = TX.growing_terms(df, "stay_id", "t_end", "new_text", ["split"])
    vocab = TX.fit_vocab_growing(added.where("split = 'train'"))
    assert {tuple(r) for r in vocab.collect()} == {tuple(r) for r in full.collect()}
    want = TX.encode(df, ["stay_id", "t_end"], "final_text", full, length)
    got = TX.encode_growing(added, vocab, length)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.count() == len(rows)
    assert [f.dataType.simpleString() for f in got.schema] == [f.dataType.simpleString() for f in want.schema]


def test_pairs_without_naming_tokens(spark, monkeypatch):
    rng = random.Random(5)
    df = spark.createDataFrame([(" ".join(rng.choice("aa bb cc dd ee ff".split()) for _ in range(9)),) for _ in range(60)], "t string")
    want = TX.fit_tfidf(df, "t", 9, 2)
    monkeypatch.setattr(TX, "PAIR_TOKENS", 1)
    got = TX.fit_tfidf(df, "t", 9, 2)
    assert got.vocabulary == want.vocabulary and got.idf == pytest.approx(want.idf)


def test_radix_medians(spark):
    rng = random.Random(6)
    inf, nan = float("inf"), float("nan")
    columns = {
        "even": [1.0, 2.0], "odd": [3.0, -1.0, 2.0], "none": [], "nan": [nan, nan, 4.0], "inf": [inf, inf, -inf, 1.0, inf],
        "wide": [rng.uniform(-1, 1) * 10.0 ** rng.randint(-300, 300) for _ in range(501)],
        "near": [1.0 + k * 2 ** -52 for k in rng.sample(range(10 ** 6), 400)], "zero": [0.0, -0.0, 0.0, 1e-320, -1e-320],
        "ties": [rng.choice([1.5, 2.5]) for _ in range(500)], "large": [1.7e308, -1.7e308, 1.6e308, -1.6e308],
        "normal": [rng.gauss(0, 1) for _ in range(500)], "odd name `x`": [2.0, 9.0]}
    n = max(map(len, columns.values()))
    rows = [tuple(v[i] if i < len(v) else None for v in columns.values()) for i in range(n)]
    df = spark.createDataFrame(rows, ", ".join(f"{FT.quoted(c)} double" for c in columns))
    got = FT.medians(df, list(columns))
    for c, v in columns.items():
        v = [x for x in v if not math.isnan(x)]
        assert got[c] == (statistics.median(v) if v else None)
    stats = FT.column_stats(df, ["even", "none", "odd"], m=F.avg, s=F.stddev_pop)
    assert stats["even"]["m"] == 1.5 and stats["none"] == {"m": None, "s": None} and stats["odd"]["m"] == pytest.approx(4 / 3)
    rates = {r["column"]: r.missing_rate for r in FT.missing_rates(df, list(columns)).collect()}
    assert rates["none"] == 1.0 and rates["even"] == pytest.approx(1 - 2 / n) and rates["odd name `x`"] == pytest.approx(1 - 2 / n)


def _cohort(spark):
    from datetime import datetime, timedelta
    from wardline.plans import master as M
    t0, hour = datetime(2024, 1, 1), timedelta(hours=1)
    st = spark.createDataFrame([(s, s, s, t0, t0 + (60 + 12 * s) * hour, 60.0 + 12 * s, 40.0 + s) for s in (1, 2, 3)],
                               "stay_id long, subject_id long, hadm_id long, intime timestamp_ntz, outtime timestamp_ntz, icu_los_hours double, age double")
    ts = spark.createDataFrame([(s, t0 + h * hour, float(h)) for s in (1, 2, 3) for h in range(0, 100, 5)], "stay_id long, hour_ts timestamp_ntz, hr double")
    tx = spark.createDataFrame([(1, 1, 30.0, "first words---second words"), (1, 2, 50.0, "third"), (2, 3, 0.0, "early"), (9, 4, 1.0, "no stay")],
                               "stay_id long, note_row long, t_max_rel double, radiology_note_text string")
    return M.CohortInputs(st, ts, tx)


def test_texts_are_not_joined_after_they_are_put_together(spark):
    from wardline.plans import master as M
    m = M.master_trailing(_cohort(spark))
    got = {(r.stay_id, r.t_end): (r.final_text, r.has_text) for r in m.collect()}
    assert got[1, 24.0] == ("", 0) and got[1, 36.0] == ("first words second words", 1)
    assert got[1, 60.0] == ("first words second words third", 1) and got[2, 24.0] == ("early", 1) and got[3, 24.0] == ("", 0)
    plan = m._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" in plan and plan.index("Window") < plan.index("Join")            # as-of texts are the last step
    assert m.columns[:2] == ["stay_id", "t_end"] and m.columns.index("has_text") == m.columns.index("final_text") + 1


def test_increments_are_read_where_they_were_written(spark):
    from wardline.plans import master as M
    m = M.master_trailing(_cohort(spark), increments=True)
    rows = {(r.stay_id, r.t_end): r for r in m.collect()}
    assert rows[1, 36.0].new_text == "first words second words" and rows[1, 60.0].new_text == "third" and rows[1, 48.0].new_text == ""
    assert [rows[1, t].has_text for t in (24.0, 36.0, 48.0)] == [0, 1, 1] and rows[3, 24.0].has_text == 0
    for (s, t), r in rows.items():
        assert r.new_text_later == sum(k == s and u >= t for k, u in rows)
    plan = m.select("stay_id", "t_end", "new_text", "new_text_later")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_rows_that_come_twice_keep_their_text(spark):
    rows = spark.createDataFrame([(1, 24.0, "a"), (1, 24.0, "a"), (1, 48.0, None)], "stay_id long, t_end double, `odd name` string")
    seg = spark.createDataFrame([(1, 3.0, 1, 0, "x"), (1, 30.0, 2, 0, "y"), (1, 60.0, 3, 0, "z")], SEG)
    got = sorted(map(tuple, notes.with_asof_text(rows, seg).collect()), key=str)
    assert got == [(1, 24.0, "a", "x", 1), (1, 24.0, "a", "x", 1), (1, 48.0, None, "x y", 1)]
    inc = sorted(map(tuple, notes.with_increments(rows, seg).collect()), key=str)
    assert inc == [(1, 24.0, "a", "x", 1, 2), (1, 24.0, "a", "x", 1, 2), (1, 48.0, None, "y", 1, 1)]


def test_weights_along_a_group_go_on_from_batch_to_batch(spark):
    rng = random.Random(12)
    rows = [(s, float(t), " ".join(rng.choice("aa bb cc dd".split()) for _ in range(rng.choice([0, 0, 0, 2])))) for s, n in ((1, 700), (2, 1), (3, 40), (4, 3))
            for t in range(n)]
    rows.append((None, 1.0, "aa bb"))
    inc = spark.createDataFrame(rows, "stay_id long, t_end double, new_text string")
    added = TX.growing_tokens(inc, "stay_id", "t_end", "new_text")
    model = TX.fit_tfidf_growing(added, 9, 2)
    assert any(" " in t for t in model.vocabulary)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "64")
    try:
        got = {(r.stay_id, r.t_end): r for r in TX.tfidf_wide_growing(inc, "stay_id", "t_end", added, model).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(got) == len(rows) and all(got[None, 1.0][f"tfidf_{t}"] == 0 for t in model.vocabulary)
    for s in (1, 2, 3, 4):
        text = []
        for _, t, new in (r for r in rows if r[0] == s):
            text += new.split()
            words = text + [f"{a} {b}" for a, b in zip(text, text[1:])]
            w = [words.count(v) * model.idf[v] for v in model.vocabulary]
            size = math.sqrt(sum(x * x for x in w)) or 1.0
            assert [got[s, t][f"tfidf_{v}"] for v in model.vocabulary] == pytest.approx([x / size for x in w])
    plan = TX.tfidf_wide_growing(inc, "stay_id", "t_end", added, model)._jdf.queryExecution().optimizedPlan().toString()
    assert "sum(" not in plan and plan.count("RepartitionByExpression") == 1     # nothing as wide as the vocabulary is moved


def test_leading_terms_are_those_of_the_full_count(spark):
    rng = random.Random(13)
    words = [f"w{int(abs(rng.gauss(0, 9)))}" for _ in range(900)]
    tok = spark.createDataFrame([(s, rng.randint(1, 4), [rng.choice(words) for _ in range(rng.randint(0, 6))]) for s in range(40) for _ in range(3)],
                                "`group` long, later long, terms array<string>")
    full = sorted(((r.term, r.total, r.df) for r in TX._counted_growing(tok).collect()), key=lambda r: (-r[1], r[0]))
    for n in (1, 3, 8, 50):
        for least in (1, 30):
            want = [r for r in full if r[2] >= least]
            got = TX._leading(tok, n, least)
            if got is not None:
                assert got[0] == want[:n] and [r for r in got[1] if r not in want] == []
                assert got[1] == [r for r in want if len(want) < n or r[1] >= want[n - 1][1]]
    assert TX._leading(tok, 3, 1) is not None and TX._leading(tok, 3, 10 ** 6) is None
