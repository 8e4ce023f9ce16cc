"""Language-model scoring by cross-entropy difference.

Two bigram models with the same vocabulary and smoothing: one of the target
documents, one of the background (all documents).  The background's counts
are scaled to the target's total, so the two differ in what they have seen
and in nothing else.  A document's score is its mean loss per token under the
background less that under the target: positive texts read like the target.

Words, contexts and (context, word) pairs are counted over all tokens of all
documents, each under a key of 62 hashed bits (3.5 billion different pairs
have 1.3 colliding ones to expect), so the tables grow with the corpus.
Probability of a word w after h, with c the (scaled) counts, n their total and
V the number of different words, at least ``WORDS``:

    p1(w) = (c(w) + ADD) / (n + ADD * V)
    p(w | h) = (c(h, w) + PRIOR * p1(w)) / (c(h) + PRIOR)

c(h) counts h as a context; a document's first word has context 0.

1. Texts are tokenized once, where they are read, and written as blocks of
   about ``BLOCK_BYTES`` of text: the block's words and each token's place
   among them.  A block is consecutive rows, so no id or text is hot.
2. A block sends its different keys and their counts to at most ``FAN``
   ranges of keys.  If there are more blocks than that, groups of blocks add
   up what they got and send it on to finer ranges, level by level, until all
   blocks of a range have met: each node has about as many senders as
   receivers, and keys that many blocks share shrink on the way.
3. The totals go back the same way, each in the order it was asked for.
4. Each block lays the totals beside its keys and scores its documents.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.llm.tables import pylist_batches, worker_state, written

WORDS = 1 << 18
ADD = 0.1
PRIOR = 5.0
BLOCK_BYTES = 6_000_000
BLOCK_ROWS = 200_000
FAN = 256
BROADCAST_TARGETS = 1_000_000    # ids of 8 bytes; more are joined by a shuffle
_WORD = re.compile(r"[^\W_]+")
_KIND = np.uint64(3)             # the lowest bits of a key: 1 word, 2 context, 3 pair
_BLOCK = "block long, ids array<long>, lengths array<long>, wanted array<boolean>, words binary, places binary"
_SENT = "node long, part long, child long, keys binary, background binary, target binary"
_TOLD = "child long, part long, background binary, target binary, words long, n_background long, n_target long"


class WordIds(dict):
    """Word to its 64-bit hash without the bits of the kind, remembered up to
    ``limit`` words."""

    limit = 200_000

    def __missing__(self, word: str) -> int:
        import xxhash
        if len(self) >= self.limit:
            self.clear()
        self[word] = i = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass")) & ~3
        return i


def packed(values: np.ndarray) -> bytes:
    """Whole numbers by bytes of equal weight, lowest first, as many as the
    largest number has; the first byte tells how many.  Compressed here, as
    the codecs of shuffles do not code single bytes by their frequency."""
    import zstandard
    width = max(1, (int(values.max()).bit_length() + 7) // 8) if len(values) else 1
    planes = values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
    return zstandard.ZstdCompressor(level=1).compress(bytes([width]) + planes.T.tobytes())


def opened(value: bytes) -> np.ndarray:
    import zstandard
    value = zstandard.ZstdDecompressor().decompress(value)
    width = value[0]
    planes = np.frombuffer(value, np.uint8, offset=1).reshape(width, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :width] = planes.T
    return out.view("<u8").ravel()


def block_table(rows: list[tuple], names: str) -> pa.Table:
    """Rows as an Arrow table of a Spark schema text."""
    kinds = {"long": pa.int64(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64()), "array<boolean>": pa.list_(pa.bool_())}
    fields = [f.split(" ") for f in names.split(", ")]
    return pa.Table.from_arrays([pa.array([r[k] for r in rows], kinds[kind]) for k, (_, kind) in enumerate(fields)],
                                [name for name, _ in fields])


def blocks(docs: DataFrame) -> DataFrame:
    """Tokenized blocks of the rows of ``docs`` (doc_id, text, wanted)."""
    def run(batches):
        from pyspark import TaskContext
        known, number = worker_state("lm words", WordIds), TaskContext.get().partitionId() << 32
        ids, wanted, tokens, held = [], [], [], 0

        def row():
            words, places = np.unique(np.concatenate(tokens), return_inverse=True)
            return block_table([(number, ids, [len(t) for t in tokens], wanted, packed(np.diff(words, prepend=np.uint64(0))),
                                 packed(places))], _BLOCK).to_batches()[0]
        for whole in batches:
            for batch in pylist_batches(whole, "text", 1_000_000):
                for i, text, mark in zip(*[batch.column(k).to_pylist() for k in range(3)]):
                    found = _WORD.findall(text.lower()) if text else []
                    ids.append(i)
                    wanted.append(mark)
                    tokens.append(np.fromiter(map(known.__getitem__, found), np.uint64, len(found)))
                    held += len(text or "")
                    if held >= BLOCK_BYTES or len(ids) >= BLOCK_ROWS:
                        yield row()
                        ids, wanted, tokens, held, number = [], [], [], 0, number + 1
        if ids:
            yield row()

    return docs.select("doc_id", "text", "wanted").mapInArrow(run, _BLOCK)


class Keys:
    """The different keys of a block in order, and where its tokens have theirs."""

    def __init__(self, lengths: np.ndarray, words: np.ndarray, places: np.ndarray):
        self.places, n = places, len(words)
        self.before = np.empty_like(places)                  # place of the context; n: none
        self.before[1:] = places[:-1]
        self.before[(np.cumsum(lengths) - lengths)[lengths > 0]] = n
        heads = np.append(words, np.uint64(0))
        pairs, self.pairs = np.unique(heads[self.before] * np.uint64(0x9E3779B97F4A7C15) + words[places] | _KIND, return_inverse=True)
        self.sizes = n, n + 1, len(pairs)
        self.used = np.concatenate([np.ones(n, bool), np.bincount(self.before, minlength=n + 1) > 0, np.ones(len(pairs), bool)])
        keys = np.concatenate([words | np.uint64(1), heads | np.uint64(2), pairs])[self.used]
        self.order = np.argsort(keys)
        self.keys = keys[self.order]

    def counts(self, tokens=slice(None)) -> np.ndarray:
        """How often each key comes among ``tokens``."""
        kinds = zip((self.places, self.before, self.pairs), self.sizes)
        return np.concatenate([np.bincount(place[tokens], minlength=n) for place, n in kinds])[self.used][self.order]

    def at_tokens(self, totals: np.ndarray):
        """The totals of the keys of each token's word, context and pair."""
        every = np.zeros(len(self.used))
        every[np.flatnonzero(self.used)[self.order]] = totals
        ends = np.cumsum(self.sizes)[:-1]
        return [kind[place] for kind, place in zip(np.split(every, ends), (self.places, self.before, self.pairs))]


def keys_of(lengths: np.ndarray, words: bytes, places: bytes) -> Keys:
    return Keys(lengths, np.cumsum(opened(words), dtype=np.uint64), opened(places).astype(np.int64))


def cut(keys: np.ndarray, parts: int) -> list[tuple[int, slice]]:
    """(number of the range, its keys) of sorted keys under ``parts`` ranges."""
    part = ((keys >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(keys)]
    return [(int(part[a]), slice(a, b)) for a, b in zip(cuts, cuts[1:]) if b > a]


def sent_rows(node: int, child: int, keys, background, target, parts: int) -> list[tuple]:
    return [(node, p, child, packed(np.diff(keys[s], prepend=np.uint64(0))), packed(background[s]), packed(target[s]))
            for p, s in cut(keys, parts)]


def block_counts(table: DataFrame, groups: int, parts: int) -> DataFrame:
    """What each block sends: a row for each of ``parts`` ranges that it has
    keys of, to the ``node`` of its group of blocks."""
    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                block, _, lengths, wanted, words, places = (c[k].as_py() for c in batch.columns)
                lengths = np.array(lengths, np.int64)
                found = keys_of(lengths, words, places)
                some = np.repeat(np.array(wanted, bool), lengths)
                node = (block * 0x9E3779B97F4A7C15 & (1 << 64) - 1) * groups >> 64
                rows = sent_rows(node, block, found.keys, found.counts(), found.counts(some), parts)
                for a in range(0, len(rows), 64):
                    yield from block_table(rows[a:a + 64], _SENT).to_batches()

    return table.mapInArrow(run, _SENT)


def children(rows: pa.Table):
    """(child, its keys, their counts by name) of a node's rows."""
    for k in range(rows.num_rows):
        yield (rows.column("child")[k].as_py(), np.cumsum(opened(rows.column("keys")[k].as_py()), dtype=np.uint64),
               [opened(rows.column(name)[k].as_py()).astype(np.int64) for name in ("background", "target")])


def merged(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """A node's different keys, and their counts added up over its children."""
    keys = np.unique(np.concatenate([keys for _, keys, _ in children(rows)]))
    counts = np.zeros((2, len(keys)), np.int64)
    for _, own, values in children(rows):
        at = np.searchsorted(keys, own)
        for total, value in zip(counts, values):
            total[at] += value
    return keys, counts


def sent_on(sent: DataFrame, fan: int, parts: int) -> DataFrame:
    """What the nodes of a level send to those of the next."""
    def run(rows):
        keys, counts = merged(rows)
        node = rows.column("node")[0].as_py()
        return block_table(sent_rows(node // fan, node, keys, *counts, parts), _SENT)

    return sent.groupBy("node", "part").applyInArrow(run, _SENT)


def answer_rows(rows: pa.Table, keys: np.ndarray, counts: np.ndarray) -> list[tuple]:
    part = rows.column("part")[0].as_py()
    return [(child, part, *[packed(c[np.searchsorted(keys, own)]) for c in counts], None, None, None)
            for child, own, _ in children(rows)]


def totals(sent: DataFrame) -> DataFrame:
    """The answers of the last level; besides, a row without a child for each
    range: its different ``words`` and their tokens in ``n_background`` and
    ``n_target``."""
    def run(rows):
        keys, counts = merged(rows)
        word = keys & _KIND == 1
        return block_table(answer_rows(rows, keys, counts) + [(None, None, None, None, int(word.sum()), *map(int, counts[:, word].sum(1)))], _TOLD)

    return sent.groupBy("node", "part").applyInArrow(run, _TOLD)


def told_counts(told: pa.Table, n: int) -> np.ndarray:
    """Totals of ``n`` keys, from the answers for their ranges."""
    told = told.sort_by("part")
    counts = np.array([np.concatenate([np.zeros(0, np.uint64), *map(opened, told.column(name).to_pylist())])
                       for name in ("background", "target")]).astype(np.int64)
    if counts.shape[1] != n:
        raise RuntimeError("the answers are not for the keys that were sent")
    return counts


def passed_back(sent: DataFrame, answers: DataFrame, fan: int) -> DataFrame:
    """The answers of a level, from those that its nodes got from the next."""
    def run(rows, told):
        keys = np.unique(np.concatenate([keys for _, keys, _ in children(rows)]))
        return block_table(answer_rows(rows, keys, told_counts(told, len(keys))), _TOLD)

    answers = answers.where("child is not null") \
        .select(F.col("child").alias("node"), F.floor(F.col("part") / fan).alias("coarse"), "part", "background", "target")
    return sent.groupBy("node", "part").cogroup(answers.groupBy("node", "coarse")).applyInArrow(run, _TOLD)


def score(table: DataFrame, answers: DataFrame, words: int, n_background: int, n_target: int) -> DataFrame:
    """``doc_id, n_tokens, target_loss, background_loss, score`` of every row
    of the blocks in ``table``, from the ``answers`` to each.  Both models are
    the background's if there is no target token."""
    scale = n_target / n_background if n_target else 1.0
    n, vocabulary = float(n_target or n_background), max(WORDS, words)

    def run(block, told):
        _, ids, lengths, _, words, places = (c[0] for c in block.columns)
        lengths = np.array(lengths.as_py(), np.int64)
        out, full = np.zeros((2, len(lengths))), lengths > 0
        if full.any():
            found = keys_of(lengths, words.as_py(), places.as_py())
            counts = told_counts(told, len(found.keys))
            for k in range(2):
                count = counts[1] if k and n_target else counts[0] * (1.0 if k else scale)
                word, head, pair = found.at_tokens(count)
                one = (word + ADD) / (n + ADD * vocabulary)
                loss = -np.log((pair + PRIOR * one) / (head + PRIOR))
                out[k, full] = np.add.reduceat(loss, (np.cumsum(lengths) - lengths)[full]) / lengths[full]
        return pa.Table.from_arrays(
            [ids.values, pa.array(lengths), pa.array(out[1]), pa.array(out[0]), pa.array(out[0] - out[1])],
            ["doc_id", "n_tokens", "target_loss", "background_loss", "score"])

    return table.groupBy("block").cogroup(answers.groupBy("child")) \
        .applyInArrow(run, "doc_id long, n_tokens long, target_loss double, background_loss double, score double")


def score_against(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Score every row of ``docs`` with the documents that ``labels`` call
    good (quality 1) as the target.

    A null or empty text has no token, losses and score 0.  Repeated rows are
    counted and scored as often as they come; rows without an id belong to
    the background and are scored; without a target every score is 0; an
    empty table gives no rows; other columns are ignored.
    """
    targets = labels.where("quality = 1 and doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.lit(True).alias("wanted")) \
        .distinct()
    if targets.count() <= BROADCAST_TARGETS:
        targets = F.broadcast(targets)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .join(targets, "doc_id", "left").select("doc_id", "text", F.coalesce("wanted", F.lit(False)).alias("wanted"))
    table = written(blocks(rows), "lm-blocks")
    levels, n = 1, max(1, table.count())
    while FAN ** levels < n:
        levels += 1
    fan = 2
    while fan ** levels < n:
        fan += 1
    sent = block_counts(table, fan ** (levels - 1), fan)
    below = []
    for level in range(1, levels):
        below.append(written(sent, "lm-sent"))
        sent = sent_on(below[-1], fan, fan ** (level + 1))
    last = written(totals(sent), "lm-totals")
    sums = last.where("child is null").agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("words", "n_background", "n_target")]).first()
    answers = last.where("child is not null")
    for sent in reversed(below):
        answers = passed_back(sent, answers, fan)
    return score(table, answers.select("child", "part", "background", "target"), *sums)
