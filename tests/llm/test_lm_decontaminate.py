import math
import re
import zlib
from collections import Counter

import pytest
from cases import AWKWARD, documents

from wardline.llm import decontaminate, lmscore


def brute_scores(rows, target):
    """Cross-entropy differences by plain counting with the same buckets."""
    def ids(text):
        return [1 + zlib.crc32(w.encode()) % (lmscore.WORDS - 1) for w in re.findall(r"[^\W_]+", (text or "").lower())]

    def bucket(h, w):
        return ((h * lmscore.WORDS + w) * 0x9E3779B97F4A7C15 & (1 << 64) - 1) >> 44
    tables = []
    for wanted in (lambda i: True, lambda i: i in target):
        one, head, pair = Counter(), Counter(), Counter()
        for i, text in rows:
            if wanted(i):
                seq = ids(text)
                one.update(seq)
                head.update([0, *seq][:len(seq)])
                pair.update(map(bucket, [0, *seq], seq))
        tables.append((one, head, pair, sum(one.values())))
    if not tables[1][3]:
        tables[1] = tables[0]
    total = tables[1][3]
    out = []
    for i, text in rows:
        seq, losses = ids(text), []
        for one, head, pair, n in tables:
            scale, loss = (total / n if n else 1.0), 0.0
            for h, w in zip([0, *seq], seq):
                p1 = (one[w] * scale + lmscore.ADD) / (total + lmscore.ADD * lmscore.WORDS)
                loss -= math.log((pair[bucket(h, w)] * scale + lmscore.PRIOR * p1) / (head[h] * scale + lmscore.PRIOR))
            losses.append(loss / len(seq) if seq else 0.0)
        out.append((i, len(seq), losses[1], losses[0], losses[0] - losses[1]))
    return out


def test_scores_match_plain_counting(spark):
    good = [f"the quick brown fox number {i} jumps over" for i in range(20)]
    bad = [f"zz xx yy {i} qq ww" for i in range(30)]
    texts = [t for t in AWKWARD if t is None or len(t) < 100] + good + bad
    docs = documents(spark, texts)
    target = {i for i, t in enumerate(texts) if t in good} | {1}
    labels = spark.createDataFrame([(i, 1, 0) for i in target] + [(0, 0, 0), (None, 1, 0), (99, 1, 0), (12, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    target |= {12}
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    want = sorted(brute_scores(rows, target), key=str)
    got = sorted((tuple(r) for r in lmscore.score_against(docs, labels).collect()), key=str)
    assert [x[:2] for x in got] == [x[:2] for x in want]
    for a, b in zip(got, want):
        assert a[2:] == pytest.approx(b[2:], abs=2e-5)
    score = {x[0]: x[4] for x in got}
    assert min(score[texts.index(t)] for t in good) > 0 > max(score[texts.index(t)] for t in bad)


def test_no_target_and_empty_table(spark):
    docs = documents(spark, AWKWARD)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in lmscore.score_against(docs, none).collect()} == {0.0}
    assert lmscore.score_against(docs.limit(0), none).count() == 0


def test_real_words_and_pairs_at_any_size(spark, monkeypatch):
    """Plain counting by the words themselves: 30,000 pairs share buckets of a
    fixed table, and a vocabulary above WORDS counts in the smoothing."""
    import random
    monkeypatch.setattr(lmscore, "WORDS", 1000)
    rng = random.Random(7)
    rows = [(i, " ".join(f"w{min(int(rng.paretovariate(0.5)), 6000)}" for _ in range(100))) for i in range(300)]
    target = set(range(0, 300, 3))
    models = []
    for chosen in (rows, [r for r in rows if r[0] in target]):
        one, head, pair = Counter(), Counter(), Counter()
        for _, text in chosen:
            seq = text.split()
            one.update(seq)
            head.update(["", *seq[:-1]])
            pair.update(zip(["", *seq], seq))
        models.append((one, head, pair, sum(one.values())))
    n, vocabulary = models[1][3], len(models[0][0])
    assert vocabulary > lmscore.WORDS
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    labels = spark.createDataFrame([(i, 1, 0) for i in target], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in lmscore.score_against(docs, labels).collect()}
    assert len(got) == 300
    for i, text in rows:
        seq, want = text.split(), []
        for one, head, pair, own in models:
            s, loss = n / own, 0.0
            for h, w in zip(["", *seq], seq):
                p1 = (one[w] * s + lmscore.ADD) / (n + lmscore.ADD * vocabulary)
                loss -= math.log((pair[h, w] * s + lmscore.PRIOR * p1) / (head[h] * s + lmscore.PRIOR))
            want.append(loss / len(seq))
        assert (got[i].background_loss, got[i].target_loss) == pytest.approx(want, abs=1e-9)


def test_many_levels_of_ranges_and_hot_ids(spark, monkeypatch):
    """Blocks meet over several levels of ranges, and one id or text on a
    third of all rows is spread over blocks: scores stay the same."""
    import random
    rng = random.Random(3)
    rows = [(7 if i % 3 == 0 else None if i % 3 == 1 else i, "the same words" if i % 2 else " ".join(rng.choices("abcdefghij", k=12)))
            for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(7, 1, 0), (8, 1, 0)], "doc_id long, quality int, toxic int")

    def result():
        return sorted((tuple(r) for r in lmscore.score_against(docs, labels).collect()), key=str)
    want = result()
    one = [r[0] for r in lmscore.blocks(docs.selectExpr("doc_id", "text", "false AS wanted")).select("block").collect()]
    monkeypatch.setattr(lmscore, "BLOCK_BYTES", 400)
    monkeypatch.setattr(lmscore, "FAN", 3)
    many = lmscore.blocks(docs.selectExpr("doc_id", "text", "false AS wanted")).selectExpr("block", "size(ids) AS n").collect()
    assert len(one) == 3 and len(many) > 3 ** 2 and len({r.block for r in many}) == len(many) and max(r.n for r in many) < 100
    got = result()
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert all(g[2:] == pytest.approx(w[2:], abs=1e-12) for g, w in zip(got, want))


ITEMS = [
    (1, "The farmer Alice picked 12 kg of apples and Alice sold 5 kg of them on the market. How many are left?"),
    (2, "Which river runs through the old town before it meets the northern sea at last"),
    (3, "Yes"), (4, None), (5, ""), (None, "an item without an id that holds quite a few words"),
    (6, "1 2 3 4 5 6 7 8 9 10 11 12"),
]
FILL = "some words in front that nobody else has written down so far "
CASES = [
    (FILL + ITEMS[0][1] + " and more", [1]),
    (FILL + "the farmer Bob picked 40 kg of apples and Bob sold 7 kg of them on the market. How many are left?", [1]),
    (FILL + "the farmer Bob picked 40 lb of apples and Bob sold 7 lb of them on the market. How many are left?", [1]),
    (FILL + ITEMS[1][1].upper(), [2]),
    (FILL + ITEMS[1][1].replace(" ", "\n") + ITEMS[0][1], [1, 2]),
    ("Which river runs through the valley", []),
    ("Yes", [3]), ("yes indeed", []),
    (FILL, []),
    ("20 30 40 50 60 70 80 90 100 110 120 130", []),
    ("1 2 3 4 5 6 7 8 9 10 11 12", [6]),
]


def test_planted_and_re_parameterised_items(spark):
    texts = AWKWARD + [t for t, _ in CASES]
    docs = documents(spark, texts)
    items = spark.createDataFrame(ITEMS + [ITEMS[1]], "item_id long, text string").selectExpr("*", "'x' AS h", "'x' AS raw")
    got = {r.doc_id: r for r in decontaminate.contaminated(docs, items).collect()}
    want = {len(AWKWARD) + i: ids for i, (_, ids) in enumerate(CASES) if ids}
    assert {i: r.item_ids for i, r in got.items()} == want
    assert all(r.n_items == len(r.item_ids) and 0.5 <= r.coverage <= 1 and r.run >= 1 for r in got.values())
    kept = decontaminate.clean(docs, items)
    assert kept.columns == docs.columns and kept.count() == docs.count() - len(want)


def test_verbatim_copies_in_any_case_and_white_space(spark):
    items = [(1, "Am Abend brachte der alte Bauer seine 3 Kühe in den Stall, während die Frau in der Küche das Brot für den Sonntag schnitt"),
             (2, "Then Alice met Bob and Carl before Dora saw Emil with Frieda near Hamburg and Gerd left Ida at Jena")]
    texts = [f(t) for _, t in items for f in (str, str.lower, str.upper, lambda t: t.replace(" ", "\n"), lambda t: t.replace(" ", "  "),
                                              lambda t: t.replace(" ", "\u00a0\t"), lambda t: t.lower().replace(" ", "\n"))]
    docs = spark.createDataFrame([(i, FILL + t + " and more") for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: (r.item_ids, r.coverage) for r in
           decontaminate.contaminated(docs, spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == {i: ([1 + i // 7], 1.0) for i in range(14)}


def test_part_of_a_long_item(spark):
    words = [f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60)]
    items = spark.createDataFrame([(1, " ".join(words))], "item_id long, text string")
    docs = spark.createDataFrame([(1, FILL + " ".join(words[20:33]) + " " + FILL), (2, FILL + " ".join(words[20:32]) + " " + FILL),
                                  (3, f" {FILL}".join(" ".join(words[k:k + 6]) for k in range(0, 24, 8)))], "doc_id long, text string")
    got = decontaminate.contaminated(docs, items).collect()
    assert [(r.doc_id, r.run) for r in got] == [(1, 13)] and got[0].coverage == pytest.approx(13 / 60)


def test_dense_slots_short_items_and_common_openings(spark):
    items = [(1, "12 + 7 * 30 - 5 / 4 = 9"), (2, "What is the capital of France"), (3, "define entropic gravity"),
             (4, "Anna has 3 4 5 6 7 8 9 and 10 cups left")]
    fill = "so " * 6000
    texts = [("they ask 13 + 8 * 31 - 6 / 5 = 8 here", [1]), ("13 + 8 * 31 / 6 - 5 = 8", []), ("call +1 555-12-13 or 20-30-40", []),
             ("what is the capital of the small firm", []), ("he said: what is the capital of Italy and left", [2]),
             ("what is the capital of france", [2]), ("please define entropic gravity in a few words", [3]),
             ("define entropic things, gravity", []), ("then Berta has 1 2 5 6 8 8 9 and 11 cups left there", [4]),
             ("what is the capital " + fill + " is the capital of France", []),
             (fill + "define entropic gravity", [3]), (fill + "then 13 + 8 * 31 - 6 / 5 = 8", [1])]
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r.item_ids for r in
           decontaminate.contaminated(docs, spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == {i: ids for i, (_, ids) in enumerate(texts) if ids}


def test_far_apart_alignments_do_not_add_up(spark):
    words = [f"word{chr(97 + i)}" for i in range(20)]
    items = spark.createDataFrame([(1, " ".join(words))], "item_id long, text string")
    parts = [" ".join(words[k:k + 6]) for k in (0, 7, 14)]
    docs = spark.createDataFrame([(1, " in between ".join(parts)), (2, (" in between" * 200 + " ").join(parts))], "doc_id long, text string")
    assert [r.doc_id for r in decontaminate.contaminated(docs, items).collect()] == [1]


def test_slots_must_be_consistent(spark):
    text = "then {0} gave it to {1} who told {0} that {1} had seen how {0} and {1} went away with {0} again"
    items = spark.createDataFrame([(1, text.format("Anna", "Berta"))], "item_id long, text string")
    docs = spark.createDataFrame([(1, text.format("Carla", "Dora")),
                                  (2, "then Carla gave it to Dora who told Emma that Fritz had seen how Gerd and Hans went away with Ida again")],
                                 "doc_id long, text string")
    assert [r.doc_id for r in decontaminate.contaminated(docs, items).collect()] == [1]


def test_tokens_and_windows_against_plain_loops(spark):
    from pyspark.sql import functions as F
    text = "In May, Anna paid $5 for 12.5km, then 3 % of it. " + "plain words only here " * 150
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    raw = df.select(decontaminate.tokens(decontaminate.marked(F.col("text"))).alias("r")).first().r
    canon = df.select(decontaminate.template(decontaminate.tokens(decontaminate.marked(F.col("text")))).alias("r")).first().r
    assert canon[:12] == ["in", "#name", "#name", "paid", "#money", "#num", "for", "#num", "#length", "then", "#num", "#share"]
    rows = sorted(decontaminate.placed(decontaminate.windows(df, "doc_id")).collect(), key=lambda r: r.at)
    assert [r.at for r in rows] == list(range(len(raw) - 4)) and {r.total for r in rows} == {len(raw)}
    for r in rows:
        own = raw[r.at:r.at + 5]
        assert r.raw == (own if any(t < ":" for t in own) else None)


def test_empty_sides_and_no_python(spark):
    docs = documents(spark, AWKWARD)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert decontaminate.contaminated(docs.limit(0), items).count() == 0
    assert decontaminate.contaminated(docs, items.limit(0)).count() == 0
    plan = decontaminate.contaminated(docs, items)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|ArrowEval", plan)
