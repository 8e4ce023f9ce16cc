"""SimHash near-duplicates with bit-sliced distance comparison.

A text's fingerprint is the bitwise majority of the XXH64 values (seed 42) of
its word shingles.  Two fingerprints are linked when at most ``radius`` bits
differ; a component is everything reachable over links.

Candidates: the 64 bits are cut into ``radius + 2`` blocks.  Up to ``radius``
differing bits leave at least two blocks untouched, so two linked
fingerprints agree on at least one *pair* of blocks; each fingerprint is put
into one bucket per pair of blocks.  This is exact for every input.

Comparison: inside a bucket the fingerprints are stored as bit planes (plane
b holds bit b of 64 fingerprints per machine word).  XOR of two planes gives
64 bit differences at once, which carry-save counters add up; words whose 64
lanes have all passed the radius are abandoned.  A bucket yields a spanning
forest of its links, never its pairs.  Buckets over ``tile`` fingerprints are
cut into tiles, and each pair of tiles is a unit of work of its own.

Equal fingerprints are collapsed before anything else, so copies cost one row.
"""

from __future__ import annotations

from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.llm.components import connected_components
from wardline.llm.tables import pylist_batches, shuffle_partitions, worker_state, written

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_SEED = 42


def fingerprint(text: str | None, words: int = 4) -> int:
    """The 64-bit fingerprint of one text.

    A-Z are lower-cased, words are runs without ASCII white space, shingles
    are ``words`` words joined by one space, repeats included.  Fewer words:
    the whole sequence is the one shingle.  No word (or null): 0.
    """
    tokens = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not tokens:
        return 0
    if len(tokens) <= words:
        shingles, n = iter([b" ".join(tokens)]), 1
    else:
        shingles, n = map(b" ".join, zip(*(tokens[i:] for i in range(words)))), len(tokens) - words + 1
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(_SEED)), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for i in range(0, n, 65536):
        part = hashes[i:i + 65536].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, words: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and the fingerprint ``fp`` (as a signed long) of every row."""
    def run(batches):
        worker_state("simhash", lambda: None)      # lets an earlier operator's cache go
        for batch in batches:
            for part in pylist_batches(batch, "text"):
                fps = np.array([fingerprint(t, words) for t in part.column(1).to_pylist()], np.uint64)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(fps.view(np.int64))], ["id", "fp"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "id long, fp long")


def bit_planes(fps: np.ndarray) -> np.ndarray:
    """[64, words] planes of uint64: bit i of word w in plane b is bit b of
    fingerprint 64 w + i; lanes past the end are zero."""
    n = len(fps)
    bits = np.zeros((-(-n // 64) * 64, 64), np.uint8)
    bits[:n] = np.unpackbits(fps.astype(np.uint64).view(np.uint8).reshape(n, 8), axis=1, bitorder="little")
    return np.ascontiguousarray(np.packbits(bits.T, axis=1, bitorder="little")).view(np.uint64)


def lanes_within(difference, lanes: np.ndarray, radius: int, check_every: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """Lanes with at most ``radius`` differing bits.

    ``difference(b, at)`` gives the XOR of plane ``b`` for the words ``at``;
    ``lanes`` are the words' lanes to compare.  Returns (word indices, lane
    masks) of the words in which a lane remains.
    """
    at = np.flatnonzero(lanes)
    alive = lanes[at].copy()
    counters = np.zeros((radius.bit_length(), len(at)), np.uint64)
    for b in range(64):
        if not len(at):
            break
        carry = difference(b, at)
        for c in counters:                       # carry-save: add one bit to 64 counters at a time
            c_old = c.copy()
            np.bitwise_xor(c, carry, out=c)
            carry = carry & c_old
        alive &= ~carry                          # the counter ran over
        if b % check_every == check_every - 1 or b == 63:
            alive &= ~_above(counters, radius)
            keep = alive != 0
            if not keep.all():                   # all 64 lanes past the radius: the word is abandoned
                at, alive, counters = at[keep], alive[keep], np.ascontiguousarray(counters[:, keep])
    return at, alive


def _above(counters: np.ndarray, radius: int) -> np.ndarray:
    """Lanes whose counter is over ``radius`` (most significant bit first)."""
    above = np.zeros_like(counters[0])
    equal = ~above
    for k in range(len(counters) - 1, -1, -1):
        if radius >> k & 1:
            equal &= counters[k]
        else:
            above |= equal & counters[k]
            equal &= ~counters[k]
    return above


def _lane_pairs(at: np.ndarray, alive: np.ndarray) -> np.ndarray:
    """Positions (64 word + lane) of the set lanes."""
    bits = np.unpackbits(alive.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    word, lane = np.nonzero(bits)
    return at[word] * 64 + lane


class _Forest:
    """Minimum-label forest over row positions, fed with arrays of links."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            la, lb = self.label[a], self.label[b]
            apart = la != lb
            a, b, la, lb = a[apart], b[apart], la[apart], lb[apart]
            if not len(a):
                return
            np.minimum.at(self.label, np.maximum(la, lb), np.minimum(la, lb))
            while True:
                up = self.label[self.label]
                if np.array_equal(up, self.label):
                    break
                self.label = up


def bucket_links(units: np.ndarray, fps: np.ndarray, radius: int, small: int = 96) -> tuple[np.ndarray, np.ndarray]:
    """Spanning-forest links among rows with equal ``units`` (rows sorted by
    unit): (fingerprints, fingerprint of the tree's first row)."""
    n = len(fps)
    first = np.flatnonzero(np.r_[True, units[1:] != units[:-1]])
    sizes = np.diff(np.r_[first, n])
    used = np.repeat(sizes > 1, sizes)
    units, fps = units[used], fps[used]
    n = len(fps)
    if not n:
        return fps, fps
    sizes = sizes[sizes > 1]
    first = np.cumsum(sizes) - sizes
    end = np.repeat(first + sizes, sizes)
    forest = _Forest(n)
    planes = bit_planes(fps)
    words = planes.shape[1]
    padded = np.hstack([planes, np.zeros((64, small // 64 + 3), np.uint64)])
    little = np.repeat(sizes <= small, sizes)
    lane = np.zeros(words * 64, bool)
    for d in range(1, int(sizes[sizes <= small].max(initial=1))):
        # row i against row i + d of its bucket: the planes against themselves, shifted by d lanes
        lane[:n] = little & (np.arange(n) + d < end)
        mask = np.packbits(lane, bitorder="little").view(np.uint64)
        q, r = np.divmod(d, 64)

        def shifted(b, at, q=q, r=np.uint64(r)):
            low = padded[b, at + q]
            if r:
                low = low >> r | padded[b, at + q + 1] << (np.uint64(64) - r)
            return planes[b, at] ^ low
        i = _lane_pairs(*lanes_within(shifted, mask, radius))
        forest.link(i, i + d)
    for start, size in zip(first[sizes > small].tolist(), sizes[sizes > small].tolist()):
        # one row against 64 rows a word: all queries of a block at once
        tile = bit_planes(fps[start:start + size])
        width = tile.shape[1]
        full = np.full(width * 64, False)
        full[:size] = True
        full = np.packbits(full, bitorder="little").view(np.uint64)
        step = max(1, 200_000 // width)
        for q0 in range(0, size, step):
            ask = fps[start + q0:start + min(size, q0 + step)]
            asked = np.where(ask[:, None] >> np.arange(64, dtype=np.uint64) & np.uint64(1), ~np.uint64(0), np.uint64(0))

            def against(b, at):
                return tile[b, at % width] ^ asked[at // width, b]
            lanes = np.tile(full, (len(ask), 1))
            lanes[:, :q0 // 64] = 0              # earlier rows have asked these already
            hit = _lane_pairs(*lanes_within(against, lanes.ravel(), radius))
            row, other = np.divmod(hit, width * 64)
            forest.link(start + q0 + row, start + other)
    moved = forest.label != np.arange(n)
    return fps[moved], fps[forest.label[moved]]


def links(distinct: DataFrame, radius: int = 4, tile: int = 4096) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``fp``: at most one per
    fingerprint and bucket, connecting everything within ``radius`` bits.
    The true closest pairs are all connected; no bucket is cut short."""
    spark = distinct.sparkSession
    cuts = np.linspace(0, 64, radius + 3).round().astype(int).tolist()
    blocks = list(zip(cuts, cuts[1:]))

    def block(lo: int, hi: int):
        return F.shiftrightunsigned("fp", lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1).cast("long"))
    keys = F.array(*[
        F.struct(F.lit(k).alias("t"), (F.shiftleft(block(*x), y[1] - y[0]) + block(*y)).alias("v"))
        for k, (x, y) in enumerate(combinations(blocks, 2))])
    rows = distinct.select("fp", F.explode(keys).alias("k")).select("fp", "k.t", "k.v")
    big = rows.groupBy("t", "v").count().where(F.col("count") > tile) \
        .select("t", "v", F.ceil(F.col("count") / tile).cast("int").alias("tiles"))
    mine = F.pmod(F.xxhash64("fp", F.lit(7)), F.col("tiles")).cast("int")
    units = rows.join(big, ["t", "v"], "left").select(
        "fp", "t", "v", mine.alias("i"),
        F.explode(F.sequence(F.lit(0), F.coalesce(F.col("tiles"), F.lit(1)) - 1)).alias("j"))
    units = units.select("fp", F.xxhash64("t", "v", F.least("i", "j"), F.greatest("i", "j")).alias("unit"))
    n = shuffle_partitions(spark)

    def run(batches):
        held = []

        def flush(final: bool):
            nonlocal held
            unit = np.concatenate([x[0] for x in held])
            fp = np.concatenate([x[1] for x in held])
            cut = len(unit) if final else int(np.searchsorted(unit, unit[-1]))
            held = [(unit[cut:], fp[cut:])]
            a, b = bucket_links(unit[:cut], fp[:cut].view(np.uint64), radius)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

        for batch in batches:
            held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy()))
            if sum(len(x[0]) for x in held) >= 200_000:
                yield flush(False)
        if held:
            yield flush(True)

    return (units.select("unit", "fp").repartition(n, "unit").sortWithinPartitions("unit", "fp")
            .mapInArrow(run, "a long, b long").distinct())


def near_duplicates(docs: DataFrame, words: int = 4, radius: int = 4, id_col: str = "doc_id",
                    text_col: str = "text", tile: int = 4096) -> DataFrame:
    """One row per row of ``docs``: id, ``fingerprint`` (16 hex digits),
    ``component_id`` (smallest id reachable over links, itself included).

    Null, empty and blank texts have fingerprint zero and are linked like any
    other.  Repeated rows give repeated rows.  A row without an id gets its
    component's smallest id (null only if no row of it has one).  An empty
    table gives an empty result; other columns are ignored.
    """
    fps = written(fingerprints(docs, words, id_col, text_col), "simhash-fp")
    reps = fps.groupBy("fp").agg(F.min("id").alias("rep"))
    edges = links(reps.select("fp"), radius, tile)
    member = connected_components(edges)
    smallest = reps.join(member, reps.fp == member.node).groupBy("label").agg(F.min("rep").alias("least"))
    by_fp = reps.join(member.join(smallest, "label").select(F.col("node").alias("fp"), "least"), "fp", "left") \
        .select("fp", F.coalesce("least", "rep").alias("component_id"))
    by_fp = written(by_fp, "simhash-component")
    return fps.join(by_fp, "fp").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, words: int = 4, radius: int = 4) -> DataFrame:
    """``docs`` without near-duplicates: of each component the document with
    the smallest id stays.  Repeated rows of that id are one document and
    leave one row.  Rows without an id cannot be told apart and stay."""
    found = near_duplicates(docs.select("doc_id", "text"), words, radius)
    found = written(found.select("doc_id", (F.col("doc_id") == F.col("component_id")).alias("stays")), "simhash-keep")
    # what goes grows with the corpus: it is never broadcast, so the plan is the same at every size
    gone = found.where(~F.col("stays")).select("doc_id").distinct().hint("shuffle_hash")
    kept = docs.join(gone, "doc_id", "left_anti").select([F.col(f"`{c}`") for c in docs.columns])
    repeated = found.where(F.col("stays")).groupBy("doc_id").count().where("count > 1")
    if repeated.isEmpty():
        return kept
    again = kept.join(repeated.select("doc_id"), "doc_id", "left_semi").select(docs.columns).dropDuplicates(["doc_id"])
    return kept.join(repeated.select("doc_id"), "doc_id", "left_anti").select(docs.columns).unionByName(again)
