"""Sequence packing: dominance reduction, then best fit on what remains.

Documents become token pieces of at most ``capacity`` tokens; pieces are
packed whole into as few sequences as possible.

The packing only depends on how many pieces have each length, so the instance
is a histogram of at most ``capacity`` counts, whatever the corpus size.  On
it the driver

1. fixes sets of at most three lengths by Martello-Toth dominance: a set that
   holds the largest piece and whose members can replace, one for one or one
   for several, the members of every other feasible set with that piece can be
   used in an optimal packing, so as many copies of it as the counts allow are
   fixed and the instance shrinks;
2. packs the remainder by best fit, lengths falling, many equal bins at a time.

Both give runs: "``bins`` sequences starting at number ``first``, each with
``times`` pieces of this length from offset ``offset`` on".  Their number is
bounded by the capacity.  The pieces of each length are numbered by a
distributed rank and take their places from the runs.
"""

from __future__ import annotations

import unicodedata
import zlib
from array import array
from bisect import bisect_left, bisect_right
from collections import defaultdict
from itertools import chain, islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardline.llm.tables import pylist_batches, shuffle_partitions, without_gc, worker_state, written

CAPACITY = 4096
END_ID = 1
_MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


class PieceIds(dict):
    """Token ids (little-endian uint32 bytes) of strings without white space,
    remembered up to about ``limit`` entries (then forgotten and learnt anew).

    Tokens never span white space, so a text's ids are those of its parts.
    """

    def __init__(self, tokenizer_path: str, limit: int = 600_000):
        super().__init__()
        from tokenizers import Tokenizer, normalizers
        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        self.plain = Tokenizer.from_str(self.tokenizer.to_str())     # for what is normalised already
        self.plain.normalizer = normalizers.Sequence([])
        self.limit = limit
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True

    def learn(self, new: list[str]) -> dict[str, bytes]:
        """Learn these parts, each given once and none known; returns their ids."""
        if len(self) + len(new) > self.limit:
            self.clear()
        # letters and then marks are tokens of their own: each is learnt once
        whole, words, more, tails, closed = [], [], set(), set(), []
        for part in new:
            if part.isalpha():
                words.append(part)
                continue
            letters = part.rstrip(_MARKS)
            # not where a letter normalises to one and a mark, which the marks after it would join
            if not letters.isalpha() or not (letters.isascii() or unicodedata.normalize("NFC", letters).lower().isalpha()):
                whole.append(part)
                continue
            tail = part[len(letters):]
            more.add(letters)
            tails.add(tail)
            closed.append((part, letters, tail))
        # what is learnt here is looked up in a small table of its own, most of it never again
        more.difference_update(words)
        known = {part: self[part] for part in more | tails if part in self}
        whole += tails.difference(known)
        words += more.difference(known)
        fresh: dict[str, bytes] = {}
        for i in range(0, len(words), 20_000):
            whole += self._learn_words(words[i:i + 20_000], fresh)
        for i in range(0, len(whole), 20_000):
            some = whole[i:i + 20_000]
            for part, enc in zip(some, self.tokenizer.encode_batch_fast(some, add_special_tokens=False)):
                fresh[part] = array("I", enc.ids).tobytes()
        known.update(fresh)
        for part, letters, tail in closed:
            fresh[part] = known[letters] + known[tail]
        self.update(fresh)
        return fresh

    def _learn_words(self, words: list[str], fresh: dict[str, bytes]) -> list[str]:
        """Put the ids of words of letters into ``fresh``, from one encoding of
        all of them: a word ends with a token that closes a word.  If that does
        not give one part per word (letters that normalise to something else),
        all are returned."""
        text = " ".join(words)
        done = text == text.lower() and unicodedata.is_normalized("NFC", text)
        tokenizer = self.plain if done else self.tokenizer
        ids = np.array(tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
        cuts = (np.flatnonzero(self.ends[ids]) + 1) * 4
        if len(cuts) != len(words):
            return words
        held, ends = ids.tobytes(), cuts.tolist()
        fresh.update(zip(words, map(held.__getitem__, map(slice, [0, *ends], ends))))
        return []

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian bytes.

        The tokenizer lower-cases character by character; doing it first
        makes more parts alike.  Not where it could differ: capital sigma
        depends on its neighbours here, special tokens are read before
        lower-casing, and so is a letter that only its lower case composes
        with the mark after it (the tokenizer composes first)."""
        split = []
        for t in texts:
            if "\u03a3" not in t and "<|" not in t:
                low = t.lower()
                if t.isascii() or unicodedata.normalize("NFC", low) == unicodedata.normalize("NFC", t).lower():
                    t = low
            # str.split() also cuts at the separators 1C to 1F, which are no white space to the tokenizer
            plain = t.isprintable() or not any(c in t for c in "\x1c\x1d\x1e\x1f")
            split.append(t.split() if plain else t.replace("\n", " ").split(" "))
        # the parts of this slice have a small table of their own, which stays in the processor's cache
        own = dict.fromkeys(chain.from_iterable(split))
        own = dict(zip(own, map(self.get, own)))
        if new := [part for part, ids in own.items() if ids is None]:
            own.update(self.learn(new))
        get = own.__getitem__
        return [b"".join(map(get, parts)) for parts in split]


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, with_ids: bool = False,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The pieces of every document: id, ``piece``, ``start``, ``length``,
    ``ids_crc32`` and, on request, the ids as bytes.

    A document's ids are its text's ids and then id 1; only documents longer
    than ``capacity`` are cut, into pieces of ``capacity`` ids and a last one.
    A null or empty text is the one id 1.
    """
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    end, width = np.array([END_ID], "<u4").tobytes(), 4 * capacity

    def run(batches):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        known = worker_state(f"pieces {tokenizer_path}", lambda: PieceIds(tokenizer_path))
        for batch in batches:
            for part in pylist_batches(batch, "text"):
                rows = []
                with without_gc():
                    encoded = known.encode([t or "" for t in part.column(1).to_pylist()])
                for doc, ids in zip(part.column(0).to_pylist(), encoded):
                    ids += end
                    for k in range(-(-len(ids) // width)):
                        piece = ids[k * width:(k + 1) * width]
                        rows.append((doc, k, k * capacity, len(piece) // 4, zlib.crc32(piece), piece)[:len(columns)])
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], columns)

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")) \
        .mapInArrow(run, schema)


class _Lengths:
    """The instance: counts by length, with the lengths in order."""

    def __init__(self, counts: dict[int, int]):
        self.count = {int(k): int(v) for k, v in counts.items() if v}
        self.sorted = sorted(self.count)

    def take(self, length: int, n: int) -> None:
        self.count[length] -= n
        if not self.count[length]:
            del self.count[length]
            self.sorted.pop(bisect_left(self.sorted, length))

    def largest(self, room: int, used: tuple = ()) -> int | None:
        """Largest length within ``room`` of which a piece beyond ``used`` is left."""
        for i in range(bisect_right(self.sorted, room) - 1, -1, -1):
            if self.count[self.sorted[i]] > used.count(self.sorted[i]):
                return self.sorted[i]
        return None

    def smallest(self, n: int, used: tuple = ()) -> list[int]:
        """The ``n`` smallest pieces beyond ``used``."""
        some = (x for x in self.sorted for _ in range(min(n, self.count[x] - used.count(x))))
        return list(islice(some, n))


def dominating_set(left: _Lengths, big: int, capacity: int) -> tuple[int, ...] | None:
    """A set holding one piece of length ``big`` that dominates every other
    feasible set with it, or None.  Sets of up to three pieces are tried."""
    room = capacity - big
    best = left.largest(room, (big,))
    if best is None:
        return (big,)                                    # nothing fits beside it
    if best == room:
        return (big, best)                               # it fills the sequence: it replaces any other company
    low = left.smallest(3, (big,))
    if len(low) < 2 or low[0] + low[1] > room:
        return (big, best)                               # only one more fits: the largest replaces any other
    if len(low) == 3 and sum(low) <= room:
        return None                                      # four or more pieces are feasible: no rule
    # At most two more fit.  Over all feasible pairs x >= y: the largest sum, and the largest y.
    top_sum, top_low = 0, 0
    i, j = 0, len(left.sorted) - 1
    lengths, extra = left.sorted, (big,)

    def pair(y, x):
        return left.count[y] - extra.count(y) >= (2 if x == y else 1) and left.count[x] - extra.count(x) >= 1
    while i <= j:
        y, x = lengths[i], lengths[j]
        if y + x > room:
            j -= 1
            continue
        if pair(y, x):
            top_sum, top_low = max(top_sum, x + y), max(top_low, y)
        elif (x2 := left.largest(room - y, (big, y))) is not None and x2 >= y:
            top_sum, top_low = max(top_sum, x2 + y), max(top_low, y)
        i += 1
    if best >= top_sum:
        return (big, best)                               # one piece replaces any feasible pair
    second = left.largest(room - best, (big, best))
    if second is not None and second >= top_low:
        return (big, best, second)                       # it replaces any pair piece by piece
    return None


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[pd.DataFrame, dict]:
    """Runs for the pieces counted by length, and a summary.

    Columns of the runs: ``length``, ``rank`` (of the first of its pieces
    among those of the length), ``bins``, ``times``, ``first`` (sequence
    number of the first bin), ``offset``.  The summary has the sequences fixed
    by dominance, all sequences, and the volume bound.
    """
    left = _Lengths(counts)
    ranks: defaultdict[int, int] = defaultdict(int)
    runs, sequences = [], 0

    def emit(length: int, bins: int, times: int, first: int, offset: int) -> None:
        runs.append((length, ranks[length], bins, times, first, offset))
        ranks[length] += bins * times

    # 1. dominance, from the longest length down; a fixed set can make the next one possible
    for big in sorted(left.count, reverse=True):
        while left.count.get(big):
            found = dominating_set(left, big, capacity)
            if not found:
                break
            need = {x: found.count(x) for x in found}
            if len(found) == 1 or sum(found) == capacity:
                bins = min(left.count[x] // n for x, n in need.items())
            else:                                        # the rule may stop to hold when a length runs out
                bins = max(1, min((left.count[x] - 3) // n for x, n in need.items()))
            offset = 0
            for x in found:
                emit(x, bins, 1, sequences, offset)
                offset += x
            for x, n in need.items():
                left.take(x, bins * n)
            sequences += bins
    fixed = sequences

    # 2. best fit, lengths falling; open[r] lists (first, bins) with r tokens of room
    open_: dict[int, list[tuple[int, int]]] = {}
    rooms: list[int] = []

    def put(room: int, first: int, bins: int) -> None:
        if room and bins:
            if room not in open_:
                open_[room] = []
                rooms.insert(bisect_left(rooms, room), room)
            open_[room].append((first, bins))

    for length in sorted(left.count, reverse=True):
        n = left.count[length]
        while n:
            i = bisect_left(rooms, length)
            if i < len(rooms):
                room = rooms[i]
                first, bins = open_[room].pop()
                if not open_[room]:
                    del open_[room]
                    rooms.pop(i)
            else:
                room, first, bins = capacity, sequences, -(-n // (capacity // length))
                sequences += bins
            each = room // length                        # best fit fills a bin before it goes on to the next
            full = min(bins, n // each)
            if full:
                emit(length, full, each, first, capacity - room)
                put(room - each * length, first, full)
                n -= full * each
            rest = bins - full
            if rest and 0 < n < each:
                emit(length, 1, n, first + full, capacity - room)
                put(room - n * length, first + full, 1)
                n, full, rest = 0, full + 1, rest - 1
            put(room, first + full, rest)
    frame = pd.DataFrame(runs, columns=["length", "rank", "bins", "times", "first", "offset"], dtype="int64")
    tokens = sum(k * v for k, v in counts.items())
    return frame, {"fixed": fixed, "sequences": sequences, "volume_bound": -(-tokens // capacity)}


def ranked(pieces: DataFrame) -> DataFrame:
    """``pieces`` with ``n``, a number from 0 within each length.

    Each length is dealt over many parts; a part is numbered on its own and
    starts at the sum of the counts of the parts before it, so a length that
    holds most rows is not numbered in one task.
    """
    spark = pieces.sparkSession
    parts = shuffle_partitions(spark)
    dealt = pieces.withColumn("part", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(parts)).cast("int"))
    sizes = dealt.groupBy("length", "part").agg(F.count("*").alias("size"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("length", "part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("begin"))
    within = Window.partitionBy("length", "part").orderBy("doc_id", "piece", "ids_crc32")
    own = dealt.withColumn("n", F.row_number().over(within) - 1)
    return own.join(starts, ["length", "part"]).withColumn("n", F.col("n") + F.col("begin")).drop("part", "begin")


def place(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Give every row of ``pieces`` (columns ``doc_id, piece, length,
    ids_crc32`` at least) its ``sequence_id`` and ``offset``.

    The histogram and the runs are bounded by ``capacity``; the runs are
    broadcast on that ground.  No rows in, no rows out.
    """
    spark = pieces.sparkSession
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    runs, _ = plan(counts, capacity)
    runs = spark.createDataFrame(
        runs.rename(columns={"length": "run_length"}),
        "run_length long, rank long, bins long, times long, first long, offset long")
    inside = (F.col("length") == F.col("run_length")) & (F.col("n") >= F.col("rank")) \
        & (F.col("n") < F.col("rank") + F.col("bins") * F.col("times"))
    k = F.col("n") - F.col("rank")
    return ranked(pieces).join(F.broadcast(runs), inside) \
        .withColumn("sequence_id", F.expr("first + (n - rank) div times")) \
        .withColumn("offset", F.col("offset") + k % F.col("times") * F.col("length")) \
        .select(*pieces.columns, "sequence_id", "offset")


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """Pack whole documents: one row per piece with ``doc_id, piece, start,
    length, ids_crc32, sequence_id, offset``.

    Null and empty texts are one end id; repeated rows are packed as often as
    they come; rows without an id are packed like others; an empty table gives
    no rows; other columns are ignored.  Tokenizing is done once, into a table
    in the shared folder that both the histogram and the placement read.
    """
    return place(written(token_pieces(docs, tokenizer_path, capacity, False, id_col, text_col), "pieces"), capacity)


def sequences(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The packed sequences themselves: ``sequence_id``, ``length`` and the
    ids as bytes, from pieces made ``with_ids``.  A group holds one sequence."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "length", "ids")))
    joined = F.aggregate(parts, F.lit(b"").cast("binary"), lambda acc, x: F.concat(acc, x["ids"]))
    return place(pieces, capacity).groupBy("sequence_id").agg(
        F.sum("length").alias("length"), joined.alias("ids"))
