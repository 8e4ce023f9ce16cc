"""Vector codes: product quantisation in whole numbers.

A vector's components become integers ``floor(scale * x)``; the vector is cut
into equal parts, and each part is coded by the nearest entry of its position's
codebook.  The codebooks come from a fixed number of rounds of assigning all
parts and averaging them (rounded down), so they and the codes are exact: no
floating point after the first step.

The nearest entry is found after an integer Walsh-Hadamard transform of the
zero-padded part and entries, of width ``N``: distances between transforms are
``N`` times those between the originals.  Squared differences are added up
coefficient by coefficient in sequency order (slow changes first, where most
of the energy lies); an entry is out as soon as its sum so far exceeds the
whole distance of some other entry.

Every round is one scan that sends at most ``parts x entries`` sums a task;
the codebooks (``entries`` vectors) are the only thing broadcast or held by
the driver.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.llm.tables import broadcast_object, unpacked, written

LARGEST = 1 << 30            # integers beyond this magnitude are set to it
_SLICE = 4096                # vectors compared at a time


def sequency(width: int) -> np.ndarray:
    """Places of the Walsh functions of ``width`` (a power of two) in the
    naturally ordered transform, fewest sign changes first."""
    rows = np.arange(width)
    bits = np.array([[bin(i & j).count("1") & 1 for j in rows] for i in rows])
    return np.argsort((np.diff(bits, axis=1) != 0).sum(1), kind="stable")


def walsh(x: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform of integer rows, zero-padded to a power of
    two, coefficients in sequency order."""
    width = 1 << max(0, x.shape[1] - 1).bit_length()
    out = np.zeros((len(x), width), x.dtype)
    out[:, :x.shape[1]] = x
    step = 1
    while step < width:
        pairs = out.reshape(len(x), -1, 2, step)
        out = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(len(x), width)
        step *= 2
    return out[:, sequency(width)]


def nearest_entry(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every row of ``x`` the first of the nearest rows of ``book`` and
    the squared distance to it.  Both hold integers; sums that could leave 64
    bits are made with Python integers."""
    if not len(x):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    width = 1 << max(0, x.shape[1] - 1).bit_length()
    most = max(int(np.abs(x).max(initial=0)), int(np.abs(book).max(initial=0)))
    if 4 * most * most * width ** 3 >= 1 << 63:
        x, book = x.astype(object), book.astype(object)
    wx, wb = walsh(x), walsh(book)

    def square(v):
        return v * v
    sums = square(wx[:, :1] - wb[:, 0])
    best = square(wx - wb[sums.argmin(1)]).sum(1)              # the whole distance of the best start
    rows, entries = np.nonzero(sums <= best[:, None])
    sums = sums[rows, entries]
    for k in range(1, width):
        sums = sums + square(wx[rows, k] - wb[entries, k])
        if k & (k - 1) == 0 and k + 1 < width:                 # a better bound now and then
            first = np.flatnonzero(np.diff(rows, prepend=-1))
            low = np.repeat(np.minimum.reduceat(sums, first), np.diff(np.append(first, len(rows))))
            lead = np.flatnonzero(sums == low)
            lead = lead[np.flatnonzero(np.diff(rows[lead], prepend=-1))]
            best = np.minimum(best, square(wx - wb[entries[lead]]).sum(1))
        left = sums <= best[rows]
        rows, entries, sums = rows[left], entries[left], sums[left]
    first = np.flatnonzero(np.diff(rows, prepend=-1))
    least = np.minimum.reduceat(sums, first)
    lead = np.flatnonzero(sums == np.repeat(least, np.diff(np.append(first, len(rows)))))
    lead = lead[np.flatnonzero(np.diff(rows[lead], prepend=-1))]
    return entries[lead], least // width


def part_width(dimension: int, parts: int) -> int:
    return -(-dimension // parts)


def as_parts(column, scale: int, dimension: int, parts: int) -> np.ndarray:
    """(rows, parts, width) integers of a list column without nulls; a last
    part that is too short ends in zeros."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dimension)
    whole = np.clip(np.floor(scale * values), -LARGEST, LARGEST).astype(np.int64)
    out = np.zeros((len(whole), parts * part_width(dimension, parts)), np.int64)
    out[:, :dimension] = whole
    return out.reshape(len(whole), parts, -1)


def usable(vectors: DataFrame, vec_col: str, dimension: int | None = None) -> DataFrame:
    """Rows whose vector is not null and holds finite numbers only."""
    v = F.col(vec_col)
    sound = v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf"))))
    return vectors.where(sound if dimension is None else sound & (F.size(v) == dimension))


def first_book(vectors: DataFrame, dimension: int, parts: int, entries: int, scale: int) -> np.ndarray:
    """(parts, entries, width) integers of the smallest ids (columns ``id``,
    ``v``); of rows that share an id the one with the least vector.  Every
    task sends at most ``entries`` rows."""
    def smallest(batches):
        held: dict = {}
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            edge = max(held) if len(held) >= entries else None
            near = np.flatnonzero(ids <= edge) if edge is not None else np.arange(len(ids))
            if len(np.unique(ids[near])) > entries:
                near = near[ids[near] <= np.unique(ids[near])[entries - 1]]
            for i, v in zip(ids[near].tolist(), batch.column(1).take(pa.array(near)).to_pylist()):
                held[i] = min(held.get(i, v), v)
            held = dict(sorted(held.items())[:entries])
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int64()),
                                              pa.array(list(held.values()), pa.list_(pa.float64()))], ["id", "v"])
    rows = vectors.where(F.col("id").isNotNull()).select("id", "v").mapInArrow(smallest, "id long, v array<double>") \
        .groupBy("id").agg(F.min("v").alias("v")).orderBy("id").limit(entries).collect()
    column = pa.array([r.v for r in rows], pa.list_(pa.float64()))
    return as_parts(column, scale, dimension, parts).transpose(1, 0, 2)


def improved(vectors: DataFrame, book: np.ndarray, dimension: int, scale: int) -> np.ndarray:
    """One round: all parts go to their nearest entries, and every entry that
    got any becomes their mean, rounded down component by component."""
    parts, entries, width = book.shape
    shared = broadcast_object(vectors.sparkSession, book)

    def totals(batches):
        book = unpacked(shared)
        sums = np.zeros((parts, entries, width + 1), np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, _SLICE):
                x = as_parts(batch.column(0).slice(at, _SLICE), scale, dimension, parts)
                x = np.concatenate([x, np.ones((len(x), parts, 1), np.int64)], axis=2)
                for p in range(parts):
                    np.add.at(sums[p], nearest_entry(x[:, p, :width], book[p])[0], x[:, p])
        at = np.flatnonzero(sums[:, :, width].repeat(width + 1))
        if len(at):
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(sums.reshape(-1)[at])], ["at", "total"])
    rows = vectors.select("v").mapInArrow(totals, "at long, total long").groupBy("at").agg(F.sum("total").alias("total")).collect()
    sums = np.zeros(parts * entries * (width + 1), np.int64)
    for r in rows:
        sums[r["at"]] = r["total"]
    sums = sums.reshape(parts, entries, width + 1)
    n = sums[:, :, width:]
    return np.where(n > 0, sums[:, :, :width] // np.maximum(n, 1), book)


def encoded(vectors: DataFrame, book: np.ndarray, dimension: int, scale: int) -> DataFrame:
    """``id``, ``label`` and the ``code`` and ``error`` of each vector."""
    parts, _, width = book.shape
    shared = broadcast_object(vectors.sparkSession, book)

    def run(batches):
        book = unpacked(shared)
        for batch in batches:
            for at in range(0, batch.num_rows, _SLICE):
                some = batch.slice(at, _SLICE)
                x = as_parts(some.column(0), scale, dimension, parts)
                found = [nearest_entry(x[:, p], book[p]) for p in range(parts)]
                codes = np.stack([e for e, _ in found], axis=1).astype(np.uint8).tobytes().hex()
                error = [min(e, (1 << 63) - 1) for e in sum(d.astype(object) for _, d in found).tolist()]
                yield pa.RecordBatch.from_arrays(
                    [some.column(1), some.column(2),
                     pa.array([codes[i:i + 2 * parts] for i in range(0, len(codes), 2 * parts)], pa.string()),
                     pa.array(error, pa.int64())], ["id", "label", "code", "error"])
    schema = vectors.select("id", "label").schema.add("code", "string").add("error", "long")
    return vectors.select("v", "id", "label").mapInArrow(run, schema)


def compress(vectors: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2, scale: int = 256,
             id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """One row per usable vector: ``vec_id, code, error, label_error,
    codebooks_sha256``.

    Vectors that are null, or hold null or non-finite components, are left
    out.  The codebooks start with the smallest ids (one row each: of rows that
    share an id the least vector) and have fewer entries when there are fewer
    ids.  The dimension is that of the smallest id with a vector that is not
    empty; vectors of another length, and all if no id is known, keep their
    row with null code and error.  A dimension that ``parts`` does not divide is
    filled with zeros.  Integers beyond 2^30 count as 2^30, errors beyond 64 bits
    as the largest long.  Repeated rows count each; rows without an id or label
    are coded like others, labels that are null count as one; other columns
    are ignored; an empty table gives no rows.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hexadecimal digits a part: 1 to 256 entries")
    sound = usable(vectors, vec_col).select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("label"),
        F.col(vec_col).cast("array<double>").alias("v"))
    dimension = sound.where(F.col("id").isNotNull() & (F.size("v") > 0)) \
        .agg(F.min_by(F.size("v"), F.struct("id", "v"))).head()[0]
    if dimension is None:
        coded = sound.select("id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
        book = np.zeros((parts, 0, 0), np.int64)
    else:
        same = sound.where(F.size("v") == dimension)
        book = first_book(same, dimension, parts, entries, scale)
        for _ in range(rounds):
            book = improved(same, book, dimension, scale)
        other = sound.where(F.size("v") != dimension).select(
            "id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
        coded = encoded(same, book, dimension, scale).unionByName(other)
    digest = hashlib.sha256(",".join(map(str, book.reshape(-1).tolist())).encode()).hexdigest()
    coded = written(coded, "codes")
    total, most = F.sum(F.col("error").cast("decimal(20,0)")), F.lit((1 << 63) - 1)
    totals = coded.groupBy(F.col("label").alias("of")).agg(
        F.when(total > most, most).otherwise(total.cast("long")).alias("label_error"))
    return coded.join(totals, F.col("label").eqNullSafe(F.col("of"))).select(
        F.col("id").alias("vec_id"), "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
