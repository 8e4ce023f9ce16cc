import random
import zlib

import numpy as np
import pytest
from cases import AWKWARD, documents

from wardline.llm import langid, toxicity

SYLLABLES = {"en": "th er an ing on re".split(), "de": "sch ein ung der zu keit".split(), "fr": "eau oi que aux le tre".split()}
MARKS = {"en": "the of and", "de": "der die und", "fr": "les des et"}


def texts(n, seed, toxic_share=0.2):
    rng, out = random.Random(seed), []
    for i in range(n):
        lang = rng.choice(list(SYLLABLES))
        words = ["".join(rng.choices(SYLLABLES[lang], k=rng.randint(1, 4))) for _ in range(rng.randint(5, 120))]
        words += MARKS[lang].split()
        toxic = rng.random() < toxic_share
        if toxic:
            words += rng.choices([f"{lang}vile", f"{lang}scum"], k=2)
        rng.shuffle(words)
        out.append((i, " ".join(words), lang, int(toxic)))
    return out


def test_network_learns_words_and_scores_do_not_depend_on_the_batch():
    rows = texts(900, 1)
    model = toxicity.train([r[1] for r in rows[:600]], np.array([r[3] for r in rows[:600]]))
    scorer = toxicity.TextScorer(model)
    held = [r[1] for r in rows[600:]]
    scores = model.score(*scorer.logits(held))
    assert ((scores >= 0.7) == np.array([r[3] for r in rows[600:]])).mean() > 0.98
    one = [float(model.score(*toxicity.TextScorer(model, limit=5, window=40).logits([t]))[0]) for t in held[:40]]
    assert np.allclose(one, scores[:40], atol=1e-5)
    assert ((scores >= 0) & (scores <= 1)).all()


def test_forward_pass_matches_plain_loops():
    rows = texts(120, 2)
    model = toxicity.train([r[1] for r in rows], np.array([r[3] for r in rows]), epochs=1)
    zero = np.zeros(toxicity.DIM)
    for _, text, _, _ in rows[:5]:
        vectors = [model.embedding[model.rows(np.array(toxicity.word_buckets(w)))].sum(axis=0) for w in toxicity.words_of(text)]
        vectors += [zero] * toxicity.PAD
        pooled = []
        for width, weights in zip(toxicity.WIDTHS, model.filters):
            k = toxicity.WIDTHS.index(width)
            bias = model.bias[k * toxicity.FILTERS:(k + 1) * toxicity.FILTERS]
            acts = [sum(vectors[i + o] @ weights[o] for o in range(width) if i + o < len(vectors)) + bias
                    for i in range(len(vectors) - toxicity.PAD)]
            pooled.append(np.maximum(np.max(acts, axis=0), 0))
        want = np.concatenate(pooled) @ model.out + model.out_bias
        got, _ = toxicity.TextScorer(model).logits([text])
        assert np.isclose(got[0], want, atol=1e-4)


def test_thresholds_follow_the_language():
    z = np.array([-1.0, -0.9, 2.0, 2.2] * 10 + [1.0, 1.1, 4.0, 4.2] * 10)
    y = np.array([0, 0, 1, 1] * 20)
    groups = np.array([0] * 40 + [1] * 40)
    cut = toxicity.calibrated(z, groups, y, least=5)
    assert -0.9 < cut["en"] < 2.0 and 1.1 < cut["de"] < 4.0 and "fr" not in cut


def test_classify_awkward_rows(spark):
    rows = texts(400, 3)
    docs = documents(spark, AWKWARD, extra=[(100 + i, t, lang, "s", len(t)) for i, t, lang, _ in rows])
    labels = spark.createDataFrame([(100 + i, 1, y) for i, _, _, y in rows] + [(None, 1, 1), (100, 1, None)],
                                   "doc_id long, quality int, toxic int")
    got = toxicity.classify(docs, labels).collect()
    assert len(got) == len(AWKWARD) + 2 + len(rows)
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
    truth = {100 + i: y for i, _, _, y in rows}
    assert np.mean([r.predicted == truth[r.doc_id] for r in got if r.doc_id in truth]) > 0.95
    assert all(r.predicted == 0 for r in got if r.doc_id is None or r.doc_id < 100)
    kept = toxicity.accepted(docs, labels)
    assert kept.columns == docs.columns
    assert kept.count() == sum(1 - r.predicted for r in got)


def test_labels_of_held_out_rows_are_never_learnt(spark):
    rows = texts(300, 4)
    docs = spark.createDataFrame([(i, t) for i, t, _, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, _, y in rows], "doc_id long, toxic int")
    wrong = spark.createDataFrame([(i, 1 - y if zlib.crc32(b"%d" % i) % 3 == 1 else y) for i, _, _, y in rows],
                                  "doc_id long, toxic int")
    a, b = toxicity.training_sample(docs, labels), toxicity.training_sample(docs, wrong)
    assert a[0] == b[0] and (a[1] == b[1]).all() and 0 < len(a[0]) < 300


@pytest.mark.parametrize("label", [None, 0, 1])
def test_nothing_to_learn_from(spark, label):
    docs = documents(spark, AWKWARD)
    labels = spark.createDataFrame([(3, label)], "doc_id long, toxic int")
    assert {r.score for r in toxicity.classify(docs, labels).collect()} == {0.0}
    assert toxicity.classify(docs.limit(0), labels).count() == 0


def test_codewords_are_told_apart():
    for n in (2, 3, 4, 7, 8, 20):
        code = langid.codewords(n)
        gaps = [int((code[i] != code[j]).sum()) for i in range(n) for j in range(i)]
        assert min(gaps) >= max(1, code.shape[1] // 4) and set(np.unique(code)) == {-1, 1}
        assert all(0 < (c == 1).sum() < n for c in code.T)


def test_letters_and_ngrams_match_plain_loops():
    table = langid.letter_table()
    letters, starts, found = langid.letters_of(["Ab, é9x", "", None, "𝒳y"], table)
    assert [c if c < 65536 else 65536 for c in letters[:7].tolist()] == [0, ord("a"), ord("b"), 0, ord("é"), 0, ord("x")]
    assert found.tolist() == [4, 0, 0, 2]
    grams = langid.ngrams(letters)
    for i in range(len(letters)):
        h = 0
        for k in range(3):
            c = int(letters[i + k]) if i + k < len(letters) else 0
            h = (h ^ c) * int(langid._MIX[k]) & 0xFFFFFFFF
            h ^= h >> 15
            assert grams[i, k] == h >> 1 & langid.BUCKETS - 1


def test_decoding_matches_plain_loops():
    rng = np.random.default_rng(2)
    code = langid.codewords(5)
    model = langid.LanguageModel(list("abcde"), code, None, None, rng.random(code.shape[1]) + 0.1)
    margins = rng.normal(size=(30, code.shape[1])) * 3
    best, score, close = model.decode(margins)
    for m, b, s in zip(margins, best, score):
        loss = [sum(w * np.log1p(np.exp(-x * c)) for x, c, w in zip(m, word, model.trust)) for word in code]
        share = np.exp(-np.array(loss)) / np.exp(-np.array(loss)).sum()
        assert b == int(np.argmin(loss)) and np.isclose(s, share.max())


def test_identify_awkward_rows_and_held_out_accuracy(spark):
    rows = texts(500, 6)
    docs = documents(spark, AWKWARD, extra=[(1000 + i, t, lang, "s", len(t)) for i, t, lang, _ in rows])
    got = {r.doc_id: r for r in langid.identify(docs).collect()}
    assert all(got[i].lang_pred == "und" and got[i].score == 0 for i in (0, 1, 2, 9))
    held = [r for r in rows if zlib.crc32(b"%d" % (1000 + r[0])) % 4 == 2]
    assert np.mean([got[1000 + i].lang_pred == lang for i, _, lang, _ in held]) > 0.97
    for i, r in got.items():
        assert r.held_out == (i is not None and zlib.crc32(str(i).encode()) % 4 == 2) and 0 <= r.score <= 1


def test_one_language_none_and_empty(spark):
    one = spark.createDataFrame([(i, "abc def", "xx") for i in range(8)], "doc_id long, text string, lang string")
    assert {r.lang_pred for r in langid.identify(one).collect()} == {"xx"}
    none = one.selectExpr("doc_id", "text", "CAST(NULL AS STRING) AS lang")
    assert {r.lang_pred for r in langid.identify(none).collect()} == {"und"}
    assert langid.identify(one.limit(0)).count() == 0


def test_long_labelled_texts_are_learnt(spark):
    rng = random.Random(8)
    clean = lambda n: " ".join("".join(rng.choices(SYLLABLES["en"], k=3)) for _ in range(n))
    toxic = lambda n: " ".join(rng.choice(["vile", "scum", "filth"]) if k % 4 == 0 else clean(1) for k in range(n))
    rows = [(i, toxic(3000) if i < 150 else clean(40)) for i in range(300)]
    docs, labels = documents(spark, [t for _, t in rows]), spark.createDataFrame([(i, 1, int(i < 150)) for i, _ in rows], "doc_id long, quality int, toxic int")
    assert min(len(t) for _, t in rows[:150]) > 20_000
    got = {r.doc_id: r.score for r in toxicity.classify(docs, labels).collect() if r.doc_id is not None}
    assert all(got[i] >= 0.7 for i in range(150)) and all(got[i] < 0.7 for i in range(150, 300))


def test_long_texts_and_repeated_ids_in_the_language_sample(spark):
    rows = [(i, "es" if i < 200 else "en", ("la casa de los perros que comen " if i < 200 else "the house of them that were going ") * (2 if i < 200 else 260))
            for i in range(300)]
    same = [(7, "es", f"el perro numero {k} de la calle") for k in range(4000)]
    docs = spark.createDataFrame([(i, t, lang) for i, lang, t in rows + same], "doc_id long, text string, lang string")
    texts_, langs = langid.training_sample(docs, per_language=50)
    assert langs.count("es") == 50 and langs.count("en") == 50 and max(map(len, texts_)) <= 5000
    again = langid.training_sample(docs.repartition(5), per_language=50)
    assert again == (texts_, langs)
    got = {r.doc_id: r.lang_pred for r in langid.identify(docs).collect()}
    assert all(got[i] == lang for i, lang, _ in rows)
