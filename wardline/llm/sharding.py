"""Contiguous shards with the smallest possible largest shard.

Rows that share a text are one atomic group.  The groups are put in order (by
smallest id, then text hash) and cut into at most ``shards`` consecutive runs
so that the largest run is as small as it can be: the smallest feasible
capacity is found by binary search, each capacity checked greedily, and the
cuts are where the greedy check makes them.

A group that alone forces the capacity gets a shard of its own where that
leaves enough shards for the others; they are then cut with a smaller capacity
of their own, again and again, so one very large group does not leave the
other shards uneven.

Running sums of the group sizes are made range by range in Spark.  The search
needs no more than where the sums lie near the cuts: the driver holds a bounded
number of cells (runs of consecutive groups with their first and last sum),
brackets the capacity with them, and looks closer only where a cut can still
fall, until the bracket holds one number.
"""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardline.llm.tables import shuffle_partitions, written

CELLS = 1 << 15


class Sums:
    """Running sums of the ordered groups, known as finely as was asked for.

    A cell ``(begin, end, last, n, width)`` stands for ``n`` consecutive
    groups from sum ``begin`` to ``end``, the last of size ``last``; their
    begins share the quotient by ``width``, a power of two, so that finer cells
    lie inside coarser ones.  A cut falls on the end of a group.
    """

    def __init__(self, groups: DataFrame, total: int, split: list[int], cells: int):
        self.groups, self.limit = groups, cells
        self.split = sorted(split)                       # sums at which cells always end
        self.cells = self._fetch([(0, total)], 1 << (-(-total // cells) - 1).bit_length())
        self._index()

    def _index(self) -> None:
        self.begins = [c[0] for c in self.cells]

    def _fetch(self, windows: list[tuple[int, int]], width: int) -> list[tuple]:
        """Cells of the groups that begin in one of ``windows`` (disjoint)."""
        begin = F.col("begin")
        inside = F.lit(False)
        for a, b in windows:
            inside = inside | ((begin >= a) & (begin < b))
        piece = sum((begin >= x).cast("int") for x in [a for a, _ in windows] + self.split)
        rows = self.groups.where(inside).groupBy(piece.alias("piece"), F.expr(f"begin div {width}").alias("cell")).agg(
            F.min("begin").alias("b"), F.max(begin + F.col("total")).alias("e"),
            F.max_by("total", "begin").alias("last"), F.count("*").alias("n"))
        return sorted((r.b, r.e, r["last"], r.n, width) for r in rows.select("b", "e", "last", "n").collect())

    def look_closer(self, ranges: list[tuple[int, int]]) -> bool:
        """Replace the cells of several groups that meet one of ``ranges`` by
        finer ones; False if there are none."""
        chosen = set()
        for a, b in ranges:
            i = max(0, bisect_right(self.begins, a) - 1)
            while i < len(self.cells) and self.cells[i][0] <= b:
                if self.cells[i][3] > 1:
                    chosen.add(i)
                i += 1
        if not chosen:
            return False
        windows: list[list[int]] = []
        for i in sorted(chosen):
            if windows and windows[-1][1] == self.cells[i][0]:
                windows[-1][1] = self.cells[i][1]
            else:
                windows.append([self.cells[i][0], self.cells[i][1]])
        spans = sum(self.cells[i][1] - self.cells[i][2] - self.cells[i][0] + 1 for i in chosen)
        width = min(1 << max(0, (spans // self.limit).bit_length() - 1), min(self.cells[i][4] for i in chosen) // 2)
        finer = self._fetch([tuple(w) for w in windows], width)
        self.cells = sorted([c for i, c in enumerate(self.cells) if i not in chosen] + finer)
        self._index()
        return True

    def cut(self, at: int, low: bool) -> int:
        """The last cut at or before ``at``: a lower or an upper bound of it,
        the same once its cell holds one group."""
        i = bisect_right(self.begins, at) - 1
        begin, end, last = self.cells[i][:3]
        if at >= end:
            return end
        return begin if low else max(begin, min(at, end - last))

    def greedy(self, part: tuple[int, int], capacity: int, most: int, low: bool) -> list[int] | None:
        """Cuts of ``part`` when every shard takes all it can; None if it is
        not done with ``most`` shards."""
        at, end = part
        cuts = []
        while at < end:
            to = end if at + capacity >= end else self.cut(at + capacity, low)
            if to <= at or len(cuts) == most:
                return None
            cuts.append(to)
            at = to
        return cuts

    def fits(self, parts: list[tuple[int, int]], shards: int, capacity: int, low: bool) -> bool:
        for part in parts:
            cuts = self.greedy(part, capacity, shards, low)
            if cuts is None:
                return False
            shards -= len(cuts)
        return True

    def doubt(self, parts: list[tuple[int, int]], shards: int, small: int, large: int) -> list[tuple[int, int]]:
        """Ranges in which cuts can fall for capacities from ``small`` to ``large``."""
        out = []
        for at, end in parts:
            low = high = at
            for _ in range(shards):
                if low >= end:
                    break
                low = end if low + small >= end else self.cut(low + small, True)
                high = end if high + large >= end else self.cut(high + large, False)
                out.append((low, high))
        return out

    def enough(self, parts: list[tuple[int, int]], shards: int, capacity: int) -> bool:
        """Do the parts fit into the shards?"""
        while True:
            if self.fits(parts, shards, capacity, True):
                return True
            if not self.fits(parts, shards, capacity, False) \
                    or not self.look_closer(self.doubt(parts, shards, capacity, capacity)):
                return False

    def smallest(self, problems: list[tuple[list[tuple[int, int]], int]], least: int) -> list[int]:
        """The smallest feasible capacity of each problem (parts, shards);
        none is below ``least``, and parts are not empty.  All problems look
        closer in the same job."""
        found: list[int | None] = [None] * len(problems)
        while None in found:
            ranges = []
            for k, (parts, shards) in enumerate(problems):
                if found[k] is not None:
                    continue
                whole = max(b - a for a, b in parts)
                if shards < len(parts):
                    raise ValueError("fewer shards than parts")
                high = _first(lambda c: self.fits(parts, shards, c, True), least, whole)
                low = _first(lambda c: self.fits(parts, shards, c, False), least, whole)
                if low == high:
                    found[k] = high
                else:
                    ranges += self.doubt(parts, shards, low, high)
            if ranges and not self.look_closer(ranges):
                raise AssertionError("cells of one group leave no doubt")
        return found

    def cuts(self, parts: list[tuple[tuple[int, int], int]], capacities: list[int]) -> list[list[int]]:
        """The greedy cuts of each part (with its number of shards)."""
        while True:
            ranges, out = [], []
            for (part, shards), c in zip(parts, capacities):
                low, high = (self.greedy(part, c, shards, x) for x in (True, False))
                out.append(high)
                if low != high:
                    ranges += self.doubt([part], shards, c, c)
            if not ranges:
                return out
            self.look_closer(ranges)


def _first(holds, low: int, high: int) -> int:
    """The smallest number from ``low`` to ``high`` for which ``holds``; it
    does for ``high`` and from some number on."""
    while low < high:
        mid = (low + high) // 2
        if holds(mid):
            high = mid
        else:
            low = mid + 1
    return low


def minimax_cuts(groups: DataFrame, shards: int, cells: int = CELLS) -> list[int]:
    """The sums at which the shards after the first begin.  ``groups`` has
    ``begin`` (sum of the sizes before) and ``total`` (size, at least 1)."""
    total = groups.agg(F.max(F.col("begin") + F.col("total"))).head()[0]
    if total is None:
        return []
    # only the largest groups can force a capacity: a bounded list
    top = [(r.total, r.begin) for r in groups.orderBy(F.desc("total"), "begin").limit(shards).collect()]
    sums = Sums(groups, total, [x for size, begin in top for x in (begin, begin + size)], cells)
    parts, left, alone = [(0, total)], shards, []
    for size, begin in top:
        if not parts or left < 2 or size * left < sum(b - a for a, b in parts):
            break
        rest = [p for p in parts if not p[0] <= begin < p[1]]
        rest += [(a, b) for p in parts if p[0] <= begin < p[1] for a, b in ((p[0], begin), (begin + size, p[1])) if a < b]
        if not sums.enough(sorted(rest), left - 1, size):
            break
        parts, left = sorted(rest), left - 1
        alone.append(begin)
    starts = list(alone)
    if parts:
        least = next((size for size, begin in top if begin not in alone), 1)
        capacity = sums.smallest([(parts, left)], least)[0]
        while True:                                      # how many shards each part takes at that capacity
            low, high = ([sums.greedy(p, capacity, left, x) for p in parts] for x in (True, False))
            if None not in low and [len(c) for c in low] == [len(c) for c in high]:
                break
            sums.look_closer(sums.doubt(parts, left, capacity, capacity))
        own = [len(c) for c in low]
        for _ in range(left - sum(own)):                 # those left over go where shards are largest
            k = max(range(len(parts)), key=lambda i: (parts[i][1] - parts[i][0]) / own[i])
            own[k] += 1
        capacities = sums.smallest([([p], k) for p, k in zip(parts, own)], 1)
        for part, cuts in zip(parts, sums.cuts(list(zip(parts, own)), capacities)):
            starts += [part[0], *cuts[:-1]]
    return sorted(starts)[1:]


def ordered_groups(sized: DataFrame) -> DataFrame:
    """``key``, ``total`` and ``begin`` (sum of the sizes before) of the
    groups of rows (columns ``key, size, doc_id``), by smallest id and key."""
    spark = sized.sparkSession
    groups = written(sized.groupBy("key").agg(F.min("doc_id").alias("first"), F.sum("size").alias("total")), "groups")
    # written: the bounds of the ranges come from a sample, and their numbers are used twice
    ranges = written(groups.repartitionByRange(shuffle_partitions(spark), "first", "key")
                     .withColumn("range", F.spark_partition_id()), "ranges")
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)     # a row for each range
    offsets = ranges.groupBy("range").agg(F.sum("total").alias("sum")) \
        .select("range", F.coalesce(F.sum("sum").over(before), F.lit(0)).alias("offset"))
    within = Window.partitionBy("range").orderBy("first", "key").rowsBetween(Window.unboundedPreceding, -1)
    own = ranges.withColumn("begin", F.coalesce(F.sum("total").over(within), F.lit(0)))
    return written(own.join(F.broadcast(offsets), "range")
                   .select("key", "total", (F.col("begin") + F.col("offset")).alias("begin")), "sums")


def assign(docs: DataFrame, shards: int = 40, overhead: int = 16, cells: int = CELLS, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, size, text_crc32, law, shard,
    slot, grown_shard``.

    A row's size is the UTF-8 bytes of its text plus ``overhead`` (at least 1).
    Rows with equal texts share a shard; null and empty texts are equal.  The
    law is ``bytes``, so ``grown_shard`` is null.  Shards are numbered in the
    order of their groups; with fewer groups than shards the last numbers stay
    unused.  Slots count a shard's rows from 0, by input partition and then
    group and id.  Rows without an id and repeated rows are dealt like others;
    other columns are ignored; an empty table gives no rows.
    """
    if overhead < 1 or shards < 1:
        raise ValueError("overhead and shards are at least 1")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    sized = written(docs.select(
        F.col(id_col).cast("long").alias("doc_id"), (F.octet_length(text) + F.lit(overhead)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.unhex(F.md5(text.cast("binary"))).alias("key"),
        F.spark_partition_id().alias("dealt")), "sized")
    groups = ordered_groups(sized)
    starts = minimax_cuts(groups, shards, cells)
    shard = sum(((F.col("begin") >= x).cast("int") for x in starts), F.lit(0))
    # a group of very many rows is split by the adaptive join: nothing above it needs its rows together
    placed = written(sized.join(groups.select("key", "begin", shard.alias("shard")), "key").drop("key"), "placed")
    counts = placed.groupBy("shard", "dealt").agg(F.count("*").alias("rows"))
    before = Window.partitionBy("shard").orderBy("dealt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "dealt", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"))
    within = Window.partitionBy("shard", "dealt").orderBy("begin", "doc_id")
    return placed.withColumn("own", F.row_number().over(within) - 1).join(offsets, ["shard", "dealt"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("own") + F.col("offset")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
