"""Toxicity: a convolutional text classifier over hashed word embeddings.

Words are hashed (the word and, for longer words, its stem of four letters)
into 2^24 embedding buckets, of which those seen in several training texts
have a row and the rest are zero; filters of widths 1 to 3 slide over the
whole text, each filter keeps its maximum, and a logistic layer gives a logit.
The network is trained in numpy on the driver, on a bounded sample of labelled
documents; scoring is one pass over the documents in Spark tasks.

The logit's decision threshold is calibrated by language on a part of the
sample that the training does not see.  The language is read from the text's
function words, never from a column.  Scores are shifted so that each
language's threshold becomes the score 0.7.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.llm.tables import (_give_back, broadcast_object, fresh, id_crc, pylist_batches, unpacked, window_of,
                                 worker_state)

WIDTHS = (1, 2, 3)
BUCKETS = 1 << 24
STEM = 4
LEAST_TEXTS = 2                            # of the training sample, for a bucket to have a row
DIM = 16
FILTERS = 8
PAD = 2                                    # zero rows between texts: the widest filter less one
CUT = 0.7

# Frequent function words by language.
FUNCTION_WORDS = {
    "en": "the of and to is in that it for was on are with as this be by from".split(),
    "de": "der die und das ist nicht mit den von ein eine zu für auf dem im".split(),
    "fr": "le les des et est une dans pour qui sur pas au du par ne il".split(),
    "es": "el los las y del se por con una para su lo al más como".split(),
}
GROUPS = (*FUNCTION_WORDS, "other")

_WORD = re.compile(r"[^\W_]+")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def word_buckets(word: str) -> tuple[int, int]:
    """Buckets of the word and of its stem (bucket 0, always zero, if short)."""
    own = 1 + zlib.crc32(word.encode("utf-8", "surrogatepass")) % (BUCKETS - 1)
    if len(word) <= STEM:
        return own, 0
    return own, 1 + zlib.crc32(b"^" + word[:STEM].encode("utf-8", "surrogatepass")) % (BUCKETS - 1)


@dataclass
class ToxicityModel:
    """``buckets``: those with a row, sorted; ``embedding``: a zero row and
    their rows; ``filters`` by width: [width, DIM, FILTERS]; ``bias``, ``out``
    over all filters; ``thresholds``: logits by text language, ``other`` as
    the default."""

    buckets: np.ndarray
    embedding: np.ndarray
    filters: list[np.ndarray]
    bias: np.ndarray
    out: np.ndarray
    out_bias: float
    thresholds: dict[str, float] = field(default_factory=dict)
    constant: float | None = None          # set when there is nothing to learn from

    def rows(self, buckets: np.ndarray) -> np.ndarray:
        """Embedding rows of ``buckets`` (0 where a bucket has none)."""
        if not len(self.buckets):
            return np.zeros(buckets.shape, np.int64)
        at = np.minimum(np.searchsorted(self.buckets, buckets), len(self.buckets) - 1)
        return np.where(self.buckets[at] == buckets, at + 1, 0)

    def projection(self) -> np.ndarray:
        """[DIM, sum of widths x FILTERS]: every filter row side by side."""
        return np.concatenate([f[o] for f in self.filters for o in range(len(f))], axis=1)

    def pooled(self, projected: np.ndarray, starts: np.ndarray, pads: np.ndarray) -> list[np.ndarray]:
        """Filter activations by width, before pooling, with pads at zero."""
        out, at = [], 0
        for k, width in enumerate(WIDTHS):
            act = projected[:, at:at + FILTERS].copy()
            for o in range(1, width):
                act[:-o] += projected[o:, at + o * FILTERS:at + (o + 1) * FILTERS]
            at += width * FILTERS
            act += self.bias[k * FILTERS:(k + 1) * FILTERS]
            np.maximum(act, 0, out=act)
            act[pads] = 0
            out.append(act)
        return out

    def score(self, logits: np.ndarray, groups: np.ndarray) -> np.ndarray:
        """Scores of 0 to 1; the threshold of a text's language scores 0.7."""
        cut = np.array([self.thresholds.get(g, self.thresholds["other"]) for g in GROUPS])[groups]
        return 1 / (1 + np.exp(-np.clip(logits - cut + np.log(CUT / (1 - CUT)), -30, 30)))


def _layout(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(first row of each text, pad rows, rows) of texts laid end to end with
    PAD rows after each."""
    starts = np.concatenate([[0], np.cumsum(lengths + PAD)])
    pads = (starts[1:, None] - 1 - np.arange(PAD)).ravel()
    return starts[:-1], pads, int(starts[-1])


class TextScorer:
    """Scores lists of texts; the projected rows of words are remembered (up
    to ``limit`` words), so a known word costs one look-up."""

    def __init__(self, model: ToxicityModel, limit: int = 150_000, window: int = 100_000):
        self.model, self.limit, self.window = model, limit, window
        self.project = model.projection().astype(np.float32)
        self.function = {w: g for g, ws in enumerate(FUNCTION_WORDS.values()) for w in ws}
        self._forget()

    def _forget(self) -> None:
        self.row: dict[str, int] = {}
        self.rows = np.zeros((1, self.project.shape[1]), np.float32)   # row 0: padding
        self.group = np.zeros(1, np.int8)

    def _learn(self, words: set[str]) -> None:
        new = [w for w in words if w not in self.row]
        if not new:
            return
        if len(self.row) + len(new) > self.limit and self.row:
            self._forget()
            new = list(words)
        at = self.model.rows(np.array([word_buckets(w) for w in new]))
        rows = (self.model.embedding[at[:, 0]] + self.model.embedding[at[:, 1]]) @ self.project
        self.row.update(zip(new, range(len(self.rows), len(self.rows) + len(new))))
        self.rows = np.concatenate([self.rows, rows])
        self.group = np.concatenate([self.group, np.array([self.function.get(w, -1) + 1 for w in new], np.int8)])

    def _pool(self, texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        self._learn(set().union(*texts))
        starts, pads, n = _layout(np.array([len(t) for t in texts]))
        at = np.zeros(n, np.int64)
        get = self.row.__getitem__
        for s, t in zip(starts.tolist(), texts):
            at[s:s + len(t)] = list(map(get, t))
        acts = self.model.pooled(self.rows[at], starts, pads)
        maxima = np.concatenate([np.maximum.reduceat(a, starts, axis=0) for a in acts], axis=1)
        doc = np.repeat(np.arange(len(texts)), np.diff(np.r_[starts, n]))
        votes = np.bincount(doc * 5 + self.group[at], minlength=5 * len(texts)).reshape(-1, 5)[:, 1:]
        return maxima, votes

    def logits(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(logits, language groups) of whole texts; very long ones go through
        in overlapping windows and keep the maximum over them."""
        maxima = np.zeros((len(texts), len(WIDTHS) * FILTERS), np.float32)
        votes = np.zeros((len(texts), 4), np.int64)
        held, owners, size = [], [], 0

        def flush():
            nonlocal held, owners, size
            if held:
                m, v = self._pool(held)
                np.maximum.at(maxima, owners, m)
                np.add.at(votes, owners, v)
            held, owners, size = [], [], 0
        for i, text in enumerate(texts):
            words = words_of(text)
            for a in range(0, max(1, len(words) - PAD), self.window):
                held.append(words[a:a + self.window + PAD])
                owners.append(i)
                size += len(held[-1])
                if size >= self.window:
                    flush()
        flush()
        groups = np.where(votes.max(axis=1, initial=0) > 0, votes.argmax(axis=1), len(GROUPS) - 1)
        return maxima @ self.model.out + self.model.out_bias, groups


def train(texts: list[str], labels: np.ndarray, epochs: int = 8, batch: int = 64, rate: float = 0.05,
          seed: int = 7) -> ToxicityModel:
    """Train the network and calibrate its thresholds.

    Every fifth text of each class is kept for calibration.  The first
    embedding dimension starts from each bucket's association with the label
    (a signed, damped z-score of the documents holding it); all parameters are
    then trained together (Adagrad, classes weighted equally).  Without both
    labels the model scores 0 throughout.
    """
    labels = np.asarray(labels, np.int64)
    rng = np.random.default_rng(seed)
    rank = np.zeros(len(labels), np.int64)
    for y in (0, 1):
        rank[labels == y] = np.arange((labels == y).sum())
    fit = np.flatnonzero(rank % 5 != 4)
    if len(set(labels[fit].tolist())) < 2:
        empty = [np.zeros((w, DIM, FILTERS), np.float32) for w in WIDTHS]
        return ToxicityModel(np.zeros(0, np.int64), np.zeros((1, DIM), np.float32), empty, np.zeros(len(WIDTHS) * FILTERS, np.float32),
                             np.zeros(len(WIDTHS) * FILTERS, np.float32), 0.0, {"other": 0.0}, 0.0)
    known: dict[str, tuple[int, int]] = {}
    docs = []
    for i in fit:
        pairs = [known.get(w) or known.setdefault(w, word_buckets(w)) for w in words_of(texts[i])]
        docs.append(np.array(pairs, np.int32).reshape(-1, 2))
    del known, pairs                                        # each form goes before the next one is made
    y = labels[fit]

    per_text = [np.unique(d) for d in docs]
    buckets, where = np.unique(np.concatenate(per_text), return_inverse=True)
    total = np.bincount(where, minlength=len(buckets))
    toxic = np.bincount(where, np.repeat(y, [len(u) for u in per_text]), len(buckets))
    del per_text, where
    enough = (total >= LEAST_TEXTS) & (buckets > 0)
    share, total, toxic = y.mean(), total[enough], toxic[enough]
    z = (toxic - total * share) / np.sqrt(total * share * (1 - share) + 1)
    model = ToxicityModel(
        buckets[enough], (rng.standard_normal((1 + len(z), DIM)) * 0.02).astype(np.float32),
        [(rng.standard_normal((w, DIM, FILTERS)) * 0.1).astype(np.float32) for w in WIDTHS],
        np.zeros(len(WIDTHS) * FILTERS, np.float32), np.full(len(WIDTHS) * FILTERS, 0.2, np.float32), -2.0)
    for i, d in enumerate(docs):
        docs[i] = model.rows(d).astype(np.int32)
    _give_back()
    model.embedding[1:, 0] = np.sign(z) * np.log1p(np.abs(z))
    model.embedding[0] = 0
    for f in model.filters:
        f[:, 0, :] = np.abs(f[:, 0, :]) + 0.3
    sums = {k: np.full_like(v, 1e-3) for k, v in
            (("e", model.embedding), ("b", model.bias), ("o", model.out), *((w, f) for w, f in zip(WIDTHS, model.filters)))}
    bias_sum = 1e-3
    weight = np.where(y == 1, 0.5 / max(share, 1e-9), 0.5 / max(1 - share, 1e-9))

    for _ in range(epochs):
        order = rng.permutation(len(docs))
        for s in range(0, len(order), batch):
            ids = order[s:s + batch]
            starts, pads, n = _layout(np.array([len(docs[i]) for i in ids]))
            rows = np.zeros((n, 2), np.int64)
            for at, i in zip(starts, ids):
                rows[at:at + len(docs[i])] = docs[i]
            x = model.embedding[rows[:, 0]] + model.embedding[rows[:, 1]]
            acts = model.pooled(x @ model.projection(), starts, pads)
            maxima = np.concatenate([np.maximum.reduceat(a, starts, axis=0) for a in acts], axis=1)
            p = 1 / (1 + np.exp(-np.clip(maxima @ model.out + model.out_bias, -30, 30)))
            err = ((p - y[ids]) * weight[ids] / len(ids)).astype(np.float32)
            grad_max = err[:, None] * model.out * (maxima > 0)
            g = maxima.T @ err
            sums["o"] += g * g
            model.out -= rate * g / np.sqrt(sums["o"])
            bias_sum += float(err.sum()) ** 2
            model.out_bias -= rate * float(err.sum()) / bias_sum ** 0.5
            grad_rows, grad_at = [], []
            doc = np.repeat(np.arange(len(ids)), np.diff(np.r_[starts, n]))
            for k, width in enumerate(WIDTHS):
                part = grad_max[:, k * FILTERS:(k + 1) * FILTERS]
                top = maxima[:, k * FILTERS:(k + 1) * FILTERS]
                pos, col = np.nonzero((acts[k] == top[doc]) & (acts[k] > 0))
                _, one = np.unique(doc[pos] * FILTERS + col, return_index=True)
                pos, col = pos[one], col[one]                       # first maximum of each text and filter
                g = part[doc[pos], col]
                grad = np.zeros_like(model.filters[k])
                for o in range(width):
                    inside = np.minimum(pos + o, n - 1)
                    np.add.at(grad[o].T, col, x[inside] * g[:, None])
                    grad_rows.append(model.filters[k][o].T[col] * g[:, None])
                    grad_at.append(inside)
                sums[width] += grad * grad
                model.filters[k] -= rate * grad / np.sqrt(sums[width])
                gb = np.bincount(col, g, FILTERS).astype(np.float32)
                sums["b"][k * FILTERS:(k + 1) * FILTERS] += gb * gb
                model.bias[k * FILTERS:(k + 1) * FILTERS] -= \
                    rate * gb / np.sqrt(sums["b"][k * FILTERS:(k + 1) * FILTERS])
            at, g = np.concatenate(grad_at), np.concatenate(grad_rows)
            both = np.concatenate([rows[at, 0], rows[at, 1]])
            uniq, back = np.unique(both, return_inverse=True)
            ge = np.zeros((len(uniq), DIM), np.float32)
            np.add.at(ge, back, np.concatenate([g, g]))
            keep = uniq > 0
            uniq, ge = uniq[keep], ge[keep]
            sums["e"][uniq] += ge * ge
            model.embedding[uniq] -= rate * ge / np.sqrt(sums["e"][uniq])
    del docs, sums
    held = np.flatnonzero(rank % 5 == 4)
    logits, groups = TextScorer(model).logits([texts[i] for i in (held if len(held) else fit)])
    model.thresholds = calibrated(logits, groups, labels[held] if len(held) else y)
    _give_back()
    return model


def calibrated(logits: np.ndarray, groups: np.ndarray, labels: np.ndarray, least: int = 20) -> dict[str, float]:
    """Thresholds by language group: the logit at which a logistic curve,
    fitted to the held-out logits (Platt's smoothed targets), says one half.
    Groups with fewer than ``least`` texts of a class take the overall
    threshold (key ``other``)."""
    def best(z, y):
        z, positive, negative = z.astype(float), int(y.sum()), int(len(y) - y.sum())
        target = np.where(y == 1, (positive + 1) / (positive + 2), 1 / (negative + 2))
        middle, spread = z.mean(), max(z.std(), 1e-6)
        x = np.stack([(z - middle) / spread, np.ones(len(z))], axis=1)
        w = np.zeros(2)
        for _ in range(50):                                           # Newton with a little ridge
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2), x.T @ (target - p) - 1e-3 * w)
            w += step
            if np.abs(step).max() < 1e-9:
                break
        cut = middle - spread * w[1] / w[0] if w[0] > 1e-6 else z.max()
        return float(np.clip(cut, z.min(), z.max()))
    overall = best(logits, labels) if 0 < labels.sum() < len(labels) else 0.0
    out = {"other": overall}
    for g, name in enumerate(GROUPS[:-1]):
        y = labels[groups == g]
        if min(y.sum(), len(y) - y.sum()) >= least:
            out[name] = best(logits[groups == g], y)
    return out


def training_sample(docs: DataFrame, labels: DataFrame, positives: int = 3000, negatives: int = 6000,
                    longest: int = 8_000) -> tuple[list[str], np.ndarray]:
    """At most ``positives`` + ``negatives`` labelled texts, drawn by a hash of
    the id, from ids whose crc32 modulo 3 is not 1.  Of a text longer than
    ``longest`` characters a stretch at a hash-placed position is taken; of an
    id's texts the least.  The bound holds for any corpus."""
    usable = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1)) \
        .where(F.pmod(id_crc("doc_id"), F.lit(3)) != 1).groupBy("doc_id").agg(F.max("toxic").alias("y"))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    drawn = usable.where("y = 1").orderBy(*order).limit(positives) \
        .union(usable.where("y = 0").orderBy(*order).limit(negatives)).withColumnRenamed("doc_id", "labelled_id")
    rows = docs.where(F.col("text").isNotNull()).join(F.broadcast(drawn), F.col("doc_id") == F.col("labelled_id")) \
        .select("doc_id", window_of(F.col("text"), "doc_id", longest).alias("text"), "y") \
        .groupBy("doc_id", "y").agg(F.min("text").alias("text")).toArrow()
    ids = rows.column("doc_id").to_numpy()
    order = np.lexsort([ids, np.array([zlib.crc32(b"%d" % i) for i in ids], np.int64)])
    rows = rows.take(pa.array(order))
    return rows.column("text").to_pylist(), rows.column("y").to_numpy().astype(np.int64)


def _scored(docs: DataFrame, model: ToxicityModel, name: str) -> DataFrame:
    """The rows of ``docs`` with the score of their ``text`` in a last column
    ``name``."""
    from pyspark.sql import types as T
    shared, at = broadcast_object(docs.sparkSession, model), docs.columns.index("text")

    def run(batches):
        scorer = worker_state(f"toxicity {hash(shared.value)}", lambda: TextScorer(unpacked(shared)))
        for batch in batches:
            for part in pylist_batches(batch, "text", 2_000_000):
                if scorer.model.constant is not None:
                    values = np.full(part.num_rows, scorer.model.constant)
                else:
                    values = scorer.model.score(*scorer.logits(part.column(at).to_pylist()))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(values.astype(float))], [*part.schema.names, name])

    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())])
    return docs.mapInArrow(run, schema)


def scores(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, ``score`` and ``predicted`` (1 if the score is at least 0.7) of
    every row, from its whole text alone."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return _scored(rows, model, "score").select("doc_id", "score", (F.col("score") >= CUT).cast("int").alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame, **sample) -> DataFrame:
    """``docs`` without the rows predicted toxic, by a model learnt from
    ``labels``; the rows are scored in passing, nothing is joined back."""
    name = fresh(docs.columns, "score")
    rows = _scored(docs, train(*training_sample(docs, labels, **sample)), name)
    return rows.where(F.col(f"`{name}`") < CUT).select([F.col(f"`{c}`") for c in docs.columns])


def classify(docs: DataFrame, labels: DataFrame, **sample) -> DataFrame:
    """Learn from ``labels`` (doc_id, toxic) and score every row of ``docs``:
    ``doc_id, held_out, score, predicted``.

    Null and empty texts score as a text without words.  Repeated rows are
    scored alike; rows without an id are scored and not held out; without
    labels of both classes all scores are 0; an empty table gives no rows;
    other columns are ignored.
    """
    model = train(*training_sample(docs, labels, **sample))
    held_out = F.coalesce(F.pmod(id_crc("doc_id"), F.lit(3)) == 1, F.lit(False))
    return scores(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")
