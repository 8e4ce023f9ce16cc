"""Language identification with error-correcting output codes.

Every language has a codeword of bits; one binary classifier per bit, a
logistic model over hashed character n-grams (1 to 3 characters, word borders
included), predicts that bit for a text.  A text gets the language whose
codeword has the least loss against the predicted bits, each bit weighted by
its classifier's held-out reliability; a close second is flagged as ambiguous.

The classifiers are trained in numpy on a bounded sample of labelled texts;
prediction is one pass over whole texts in Spark tasks.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardline.llm.tables import broadcast_object, id_crc, pylist_batches, unpacked, window_of, worker_state, written

BUCKETS = 1 << 16
UNKNOWN = "und"
BROADCAST_LANGUAGES = 100
_DRAWS = 10 ** 15                          # steps of a sampling rate
AMBIGUOUS = 0.2                            # score lead of the best language over the second
_MIX = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D))


def letter_table() -> np.ndarray:
    """Lower-cased letter of each code point of the basic plane, 0 for what is
    no letter; the last entry stands for letters beyond the plane."""
    table = np.zeros(0x10001, np.uint32)
    for c in range(0x10000):
        ch = chr(c)
        if ch.isalpha():
            low = ch.lower()
            table[c] = ord(low) if len(low) == 1 else c
    table[0x10000] = 0x10000
    return table


def letters_of(texts: list[str | None], table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts end to end as lower-cased letters, every run of other characters
    one 0; (letters, first position of each text, letters in each text)."""
    parts, lengths, found = [], [], []
    for text in texts:
        points = np.frombuffer((text or "").encode("utf-32-le", "replace"), np.uint32)
        if len(points) and points.max() > 0xFFFF:
            astral = np.array([chr(c).isalpha() for c in points[points > 0xFFFF].tolist()])
            points = points.copy()
            points[points > 0xFFFF] = np.where(astral, 0x10000, 0)
        letters = np.zeros(len(points) + 2, np.uint32)
        letters[1:-1] = table[points]
        letters = letters[np.r_[True, (letters[1:] != 0) | (letters[:-1] != 0)]]
        if letters[-1]:
            letters = np.r_[letters, np.uint32(0)]
        parts.append(letters)
        lengths.append(len(letters))
        found.append(int(np.count_nonzero(letters)))
    starts = np.cumsum([0, *lengths])[:-1]
    return np.concatenate(parts), starts, np.array(found)


def ngrams(letters: np.ndarray) -> np.ndarray:
    """[positions, 3] buckets of the 1-, 2- and 3-grams starting at each
    position (n-grams that run over the end wrap into zeros)."""
    padded = np.concatenate([letters, np.zeros(2, np.uint32)])
    n, h = len(letters), np.zeros(len(letters), np.uint32)
    out = np.empty((n, 3), np.uint32)
    for k in range(3):
        h = (h ^ padded[k:k + n]) * _MIX[k]
        h = h ^ h >> np.uint32(15)
        out[:, k] = h >> np.uint32(1) & np.uint32(BUCKETS - 1)
    return out


def codewords(n: int, seed: int = 3) -> np.ndarray:
    """[languages, bits] of -1 and 1.  Up to 7 languages: every way to split
    them in two.  More: 10 log2(n) balanced random splits, the best of 50
    drawings by the least distance between two languages."""
    if n < 2:
        return np.zeros((n, 0), np.int8)
    if n <= 7:
        return np.array([[1 if k == 0 else (1 if code >> (k - 1) & 1 else -1)
                          for code in range(2 ** (n - 1) - 1)] for k in range(n)], np.int8)
    rng, bits = np.random.default_rng(seed), int(np.ceil(10 * np.log2(n)))
    best, best_gap = None, -1
    for _ in range(50):
        code = np.array([rng.permutation(np.arange(n) % 2 * 2 - 1) for _ in range(bits)], np.int8).T
        gap = min(int((code[i] != code[j]).sum()) for i in range(n) for j in range(i))
        if gap > best_gap:
            best, best_gap = code, gap
    return best


@dataclass
class LanguageModel:
    languages: list[str]
    code: np.ndarray                       # [languages, bits]
    weights: np.ndarray                    # [BUCKETS, bits]
    bias: np.ndarray
    trust: np.ndarray                      # [bits]

    def margins(self, texts: list[str | None], table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(classifier margins by text and bit, letters by text)."""
        letters, starts, found = letters_of(texts, table)
        sums = np.zeros((len(texts), self.weights.shape[1]), np.float64)
        doc = np.repeat(np.arange(len(texts)), np.diff(np.r_[starts, len(letters)]))
        step = 200_000
        for a in range(0, len(letters), step):
            grams = ngrams(letters[a:a + step + 2])[:step]
            values = self.weights[grams].sum(axis=1)
            own = doc[a:a + step]
            edge = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
            sums[own[edge]] += np.add.reduceat(values, edge, axis=0)
        size = np.diff(np.r_[starts, len(letters)])
        return sums / np.sqrt(3 * size)[:, None] + self.bias, found

    def decode(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(language index, score 0 to 1, ambiguous) by loss-weighted decoding."""
        loss = (np.logaddexp(0, -margins[:, None, :] * self.code[None]) * self.trust).sum(axis=2)
        loss -= loss.min(axis=1, keepdims=True)
        share = np.exp(-loss)
        share /= share.sum(axis=1, keepdims=True)
        ordered = np.sort(share, axis=1)
        second = ordered[:, -2] if share.shape[1] > 1 else np.zeros(len(share))
        return share.argmax(axis=1), ordered[:, -1], ordered[:, -1] - second < AMBIGUOUS


def train(texts: list[str], langs: list[str], epochs: int = 12, rate: float = 0.3, batch: int = 128,
          seed: int = 5) -> LanguageModel:
    """Train a classifier per bit (Adagrad on the logistic loss) on four fifths
    of the texts; the rest gives each bit's reliability."""
    names = sorted(set(langs))
    code = codewords(len(names))
    model = LanguageModel(names, code, np.zeros((BUCKETS, code.shape[1]), np.float32),
                          np.zeros(code.shape[1]), np.ones(code.shape[1]))
    if not code.shape[1]:
        return model
    table, rng = letter_table(), np.random.default_rng(seed)
    at = {x: k for k, x in enumerate(names)}
    bits = code[[at[x] for x in langs]].astype(np.float64)
    held = np.arange(len(texts)) % 5 == 4
    fit = np.flatnonzero(~held) if (~held).any() else np.arange(len(texts))
    rows = []
    for i in fit:
        letters, _, _ = letters_of([texts[i]], table)
        bucket, count = np.unique(ngrams(letters).ravel(), return_counts=True)
        rows.append((bucket, (count / np.sqrt(3 * len(letters))).astype(np.float32)))
    sums, bias_sums = np.full_like(model.weights, 1e-2), np.full(code.shape[1], 1e-2)
    for _ in range(epochs):
        order = rng.permutation(len(fit))
        for s in range(0, len(order), batch):
            ids = order[s:s + batch]
            bucket = np.concatenate([rows[i][0] for i in ids])
            value = np.concatenate([rows[i][1] for i in ids])[:, None]
            doc = np.repeat(np.arange(len(ids)), [len(rows[i][0]) for i in ids])
            edge = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
            z = np.add.reduceat(model.weights[bucket] * value, edge, axis=0) + model.bias
            y = bits[fit[ids]]
            err = -y / (1 + np.exp(np.clip(y * z, -30, 30))) / len(ids)
            uniq, back = np.unique(bucket, return_inverse=True)
            grad = np.zeros((len(uniq), code.shape[1]), np.float32)
            np.add.at(grad, back, (err[doc] * value).astype(np.float32))
            sums[uniq] += grad * grad
            model.weights[uniq] -= rate * grad / np.sqrt(sums[uniq])
            g = err.sum(axis=0)
            bias_sums += g * g
            model.bias -= rate * g / np.sqrt(bias_sums)
    if held.any():
        margins, _ = model.margins([texts[i] for i in np.flatnonzero(held)], table)
        right = ((margins > 0) == (bits[held] > 0)).mean(axis=0)
        model.trust = np.maximum(2 * right - 1, 0.05)
        model.trust *= len(model.trust) / model.trust.sum()
    return model


def training_sample(docs: DataFrame, per_language: int = 1500, longest: int = 5000) -> tuple[list[str], list[str]]:
    """At most ``per_language`` texts of each language (all if fewer) from ids
    whose crc32 modulo 4 is not 2, the first by a hash of the id.  Of a text
    longer than ``longest`` characters a stretch at a hash-placed position is
    taken; of an id's texts in a language the least, so rows that share an id
    are one text.  The bound holds for any corpus."""
    usable = docs.select("doc_id", "text", "lang") \
        .where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull()) \
        .where(F.pmod(id_crc("doc_id"), F.lit(4)) != 2)
    ids = written(usable.groupBy("lang", "doc_id").agg(F.xxhash64("doc_id").alias("h")), "language-ids")
    counts = written(ids.groupBy("lang").agg(F.count("*").alias("n")), "languages")
    # hashes are even: about four times as many as are needed pass this, then the first are taken
    near = ids.join(counts.withColumnRenamed("lang", "of"), F.col("lang") == F.col("of")) \
        .where(F.pmod("h", F.lit(_DRAWS)) < F.lit(4 * per_language + 100) / F.col("n") * _DRAWS)
    first = Window.partitionBy("lang").orderBy(F.pmod("h", F.lit(_DRAWS)), "doc_id")
    drawn = near.withColumn("place", F.row_number().over(first)).where(F.col("place") <= per_language) \
        .select(F.col("doc_id").alias("drawn_id"), F.col("lang").alias("drawn_lang"))
    if counts.count() <= BROADCAST_LANGUAGES:               # then the sample has a bounded number of ids
        drawn = F.broadcast(drawn)
    rows = usable.join(drawn, (F.col("doc_id") == F.col("drawn_id")) & (F.col("lang") == F.col("drawn_lang"))) \
        .select("doc_id", "lang", window_of(F.col("text"), "doc_id", longest).alias("text")) \
        .groupBy("doc_id", "lang").agg(F.min("text").alias("text")).toArrow()
    ids = rows.column("doc_id").to_numpy()
    hashed, langs = np.array([zlib.crc32(b"%d" % i) for i in ids], np.int64), np.array(rows.column("lang").to_pylist(), object)
    order = sorted(range(len(ids)), key=lambda k: (hashed[k], ids[k], langs[k]))
    rows = rows.take(pa.array(order, pa.int64()))
    return rows.column("text").to_pylist(), rows.column("lang").to_pylist()


def predict(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, ``lang_pred``, ``score`` and ``ambiguous`` of every row, from its
    whole text alone."""
    shared = broadcast_object(docs.sparkSession, model)

    def run(batches):
        model, table = worker_state(f"langid {hash(shared.value)}", lambda: (unpacked(shared), letter_table()))
        for batch in batches:
            for part in pylist_batches(batch, "text", 1_000_000):
                margins, found = model.margins(part.column(1).to_pylist(), table)
                if model.languages:
                    best, score, close = model.decode(margins)
                    names = np.array(model.languages, object)[best]
                else:
                    names, score, close = np.full(len(found), UNKNOWN, object), np.zeros(len(found)), found < 0
                none = found == 0
                names = np.where(none, UNKNOWN, names)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(names.tolist(), pa.string()), pa.array(np.where(none, 0.0, score)),
                     pa.array(close & ~none)], ["doc_id", "lang_pred", "score", "ambiguous"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")) \
        .mapInArrow(run, "doc_id long, lang_pred string, score double, ambiguous boolean")


def identify(docs: DataFrame, per_language: int = 1500, longest: int = 5000) -> DataFrame:
    """Learn from ``docs`` (text, non-null lang) and predict every row:
    ``doc_id, held_out, lang_pred, score, ambiguous``.

    Null texts and texts without a letter are ``und`` with score 0.  Repeated
    rows are predicted alike; rows without an id are predicted and not held
    out; one language only is always predicted; without any labelled row all
    are ``und``; an empty table gives no rows; other columns are ignored.
    """
    model = train(*training_sample(docs, per_language, longest))
    held_out = F.coalesce(F.pmod(id_crc("doc_id"), F.lit(4)) == 2, F.lit(False))
    return predict(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "ambiguous")
