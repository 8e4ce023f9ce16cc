import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from cases import AWKWARD, documents
from tokenizers import Tokenizer

from wardline.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = ["", "a b", "Ünḯ  x y\x85z \x1c q\x1dr", "don't I'LL  \n\n\t it's.", "<|startoftext|> hi<|ENDOFTEXT|>.", "e ́ ́a", "क़ख abc क़.",
       "ΑΣ ΣΑΣ ὈΔΥΣΣΕΎΣ", "İi ﬁ İ. Ǆ ẞ,", "漢字 テスト １２３ 12.5%", "a\r\nb\x0bc\x0cd", "​﻿x ", "😀 a😀b", "x\x00y", "a., b.. c.,, . ,", "K Å Ω"]


def encoded(text):
    ids = Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids + [1]
    return np.array(ids, "<u4").tobytes()


def test_remembered_parts_give_the_tokenizers_ids():
    known = packing.PieceIds(PATH, limit=6)            # so small that it forgets all the time
    got = known.encode(ODD) + known.encode(ODD)
    assert got == [encoded(t)[:-4] for t in ODD + ODD]


def test_random_marks_give_the_tokenizers_ids():
    rng = random.Random(11)
    letters = "aAhHtTjJwWsSiIİıΣσςÅåé漢 \n.,-" + "".join(chr(x) for x in range(0x300, 0x345)) + "\u094d\u0f71\u0591\u1ab0"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 12))) for _ in range(100_000)]
    texts += ["H\u0331", "T\u0308 x", "J\u030c", "W\u030a", "\u0130\u094d"]
    known, plain = packing.PieceIds(PATH), Tokenizer.from_file(PATH)
    got = [np.frombuffer(x, "<u4").tolist() for x in known.encode(texts)]
    want = [e.ids for e in plain.encode_batch(texts, add_special_tokens=False)]
    assert [t for t, a, b in zip(texts, got, want) if a != b] == []


def check(counts, capacity):
    runs, summary = packing.plan(counts, capacity)
    bins, placed = {}, {}
    for length, rank, n, times, first, offset in runs.itertuples(index=False):
        assert rank == placed.get(length, 0)
        placed[length] = rank + n * times
        for b in range(n):
            bins.setdefault(first + b, []).extend((offset + k * length, length) for k in range(times))
    assert placed == {k: v for k, v in counts.items() if v} and len(bins) == summary["sequences"]
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return summary


def fewest(items, capacity):
    items, best = sorted(items, reverse=True), [len(items)]

    def place(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(items):
            best[0] = len(bins)
            return
        for room in {b for b in bins if b + items[i] <= capacity}:
            k = bins.index(room)
            bins[k] += items[i]
            place(i + 1, bins)
            bins[k] -= items[i]
        place(i + 1, [*bins, items[i]])
    place(0, [])
    return best[0]


def test_plans_are_valid_and_dominance_never_costs_a_sequence():
    rng, worse = random.Random(3), 0
    for _ in range(400):
        capacity = rng.choice([10, 20, 50])
        items = [rng.randint(max(1, capacity // rng.choice([3, 5, 9])), capacity) for _ in range(rng.randint(0, 10))]
        counts = {}
        for x in items:
            counts[x] = counts.get(x, 0) + 1
        summary = check(counts, capacity)
        least = fewest(items, capacity) if items else 0
        assert summary["sequences"] >= least
        if summary["fixed"] == summary["sequences"]:
            assert summary["sequences"] == least         # nothing but dominating sets: optimal
        worse += summary["sequences"] - least
    assert worse <= 2


def test_large_counts_do_not_enlarge_the_plan():
    counts = {i: 10 ** 9 + i for i in range(1, 4097, 7)}
    runs, summary = packing.plan(counts)
    assert len(runs) < 5 * 4096 and summary["sequences"] < 1.02 * summary["volume_bound"]


def test_pack_places_every_piece(spark):
    docs = documents(spark, AWKWARD + ODD)
    got = [r.asDict() for r in packing.pack(docs, PATH).collect()]
    by_doc = {}
    for r in got:
        by_doc.setdefault(r["doc_id"], []).append(r)
    texts = AWKWARD + ODD
    for i, text in enumerate(texts):
        ids = encoded(text)
        pieces = [ids[k:k + 4 * 4096] for k in range(0, len(ids), 4 * 4096)]
        copies = 2 if i == 0 else 1
        rows = sorted(by_doc[i], key=lambda r: r["piece"])
        assert [(r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows] == [
            (k, k * 4096, len(p) // 4, zlib.crc32(p)) for k, p in enumerate(pieces) for _ in range(copies)]
    assert len(by_doc[None]) == 1
    sequences = {}
    for r in got:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096
    assert len(sequences) == -(-sum(r["length"] for r in got) // 4096)


def test_sequences_hold_the_documents_ids(spark):
    docs = spark.createDataFrame([(i, "word " * (i * 40)) for i in range(30)], "doc_id long, text string")
    pieces = packing.token_pieces(docs, PATH, 512, with_ids=True).cache()
    placed = {(r.sequence_id, r.offset): bytes(r.ids) for r in packing.place(pieces, 512).collect()}
    whole = {r.sequence_id: bytes(r.ids) for r in packing.sequences(pieces, 512).collect()}
    for (sequence, offset), ids in placed.items():
        assert whole[sequence][4 * offset:4 * offset + len(ids)] == ids
    assert sum(map(len, whole.values())) == sum(map(len, placed.values()))


@pytest.mark.parametrize("texts", [[]])
def test_empty_table(spark, texts):
    assert packing.pack(spark.createDataFrame(texts, "doc_id long, text string"), PATH).count() == 0


def test_new_parts_come_back_from_learning_without_another_lookup():
    class Counting(packing.PieceIds):
        asked = 0

        def __getitem__(self, part):
            Counting.asked += 1
            return super().__getitem__(part)
    known = Counting(PATH)
    new = ["word", "word,", "other!)", "naïve", "ﬁn", "12,5", "...", "x1", "日本", "é", "ſ", "İ.", "ok", "nowhere", "nowhere."]
    got = known.learn(new)
    assert list(got) and {p: got[p] for p in new} == {p: encoded(p)[:-4] for p in new}
    assert Counting.asked == 0 and all(dict.get(known, p) == got[p] for p in got)
    more = known.learn(["word.", "other,"])                   # the letters and one mark are known by now
    assert more["word."] == got["word"] + dict.get(known, ".") and more["other,"] == got["other"] + dict.get(known, ",")


def test_a_letter_that_becomes_a_letter_and_a_mark():
    texts = ["Σ İ. İ", "Σ \u0958. \u0958,", "<| a\u0958! \u0958"]
    assert packing.PieceIds(PATH).encode(texts) == [encoded(t)[:-4] for t in texts]
