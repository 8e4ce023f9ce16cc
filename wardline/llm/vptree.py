"""Nearest neighbours by cosine with vantage-point trees, one per shard.

On unit vectors the Euclidean distance orders like the cosine and obeys the
triangle inequality.  A tree node keeps a vantage point and the range of its
distances to each child's points; with the query's distance to the vantage
point, the range bounds how near any point of the child can be.  A child is
passed over when that bound is over ``factor`` times the distance of the
worst neighbour found so far: factor 1 is the exact search, smaller factors
skip more and may miss neighbours.

Vectors are dealt over shards by hash, a tree per shard is built once and
written; queries are dealt into blocks, and every block meets every shard
(a join on the shard number).  A task holds one tree and one block.  Shards'
best are merged per query.  Equal vectors are one point with its smallest ids,
and equal query vectors are searched once, so copies cost nothing extra.
"""

from __future__ import annotations

import math
import pickle
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardline.llm.tables import written

LEAF = 128
ROUNDING = 1e-11        # cosines closer than this may be equal


@dataclass
class VPTree:
    """Points in tree order; nodes as parallel arrays.  A node covers points
    ``begin`` to ``end``; an inner node's vantage point is its first point,
    ``near``/``far`` its children, ``range_`` [node, child, low/high] their
    distances to the vantage point."""

    vectors: np.ndarray                    # as given, in tree order
    unit: np.ndarray
    ids: list
    begin: np.ndarray
    end: np.ndarray
    children: np.ndarray
    range_: np.ndarray

    @classmethod
    def build(cls, vectors: np.ndarray, ids: list, leaf: int = LEAF) -> VPTree:
        vectors = np.asarray(vectors, np.float64)
        unit = unit_rows(vectors)
        order = np.arange(len(vectors))
        begin, end, children, ranges = [], [], [], []

        def node(a, b):
            begin.append(a)
            end.append(b)
            children.append((-1, -1))
            ranges.append(((0.0, 0.0), (0.0, 0.0)))
            return len(begin) - 1
        todo = [node(0, len(order))] if len(order) else []
        while todo:
            k = todo.pop()
            a, b = begin[k], end[k]
            if b - a <= leaf:
                continue
            # vantage point: the point farthest from the node's first one, which spreads distances
            here = order[a:b]
            pick = int(np.argmin(unit[here] @ unit[here[0]]))
            here[[0, pick]] = here[[pick, 0]]
            d = distances(unit[here[0]][None], unit[here[1:]])[0]
            sort = np.argsort(d, kind="stable")
            here[1:], d = here[1:][sort], d[sort]
            half = len(d) // 2
            kids = node(a + 1, a + 1 + half), node(a + 1 + half, b)
            children[k], ranges[k] = kids, ((d[0], d[half - 1]), (d[half], d[-1]))
            todo += kids
        return cls(vectors[order], unit[order], [ids[i] for i in order], np.array(begin, int), np.array(end, int),
                   np.array(children, int).reshape(-1, 2), np.array(ranges, float).reshape(-1, 2, 2))

    def search(self, queries: np.ndarray, k: int, factor: float = 1.0) -> tuple[np.ndarray, np.ndarray, int]:
        """The ``k`` nearest points of each query: positions (-1: none) and
        cosines, unordered; and the number of cosines taken.  Where points that
        did not find room tie with the last one (within rounding), all that tie
        are compared by exact score and smallest id."""
        unit = unit_rows(np.asarray(queries, np.float64))
        n = len(unit)
        found = np.full((n, k), -1)
        cos = np.full((n, k), -np.inf)
        lost = np.full(n, -np.inf)                       # the best cosine that found no room
        taken = 0

        def offer(who, points, values):
            if values.shape[1] > k + 1:
                part = np.argpartition(-values, k, axis=1)[:, :k + 1]
                points, values = points[part], np.take_along_axis(values, part, 1)
            else:
                points = np.broadcast_to(points, values.shape)
            both = np.concatenate([cos[who], values], axis=1)
            top = np.argpartition(-both, k, axis=1)
            lost[who] = np.maximum(lost[who], np.take_along_axis(both, top[:, k:k + 1], 1)[:, 0])
            top = top[:, :k]
            cos[who] = np.take_along_axis(both, top, 1)
            found[who] = np.take_along_axis(np.concatenate([found[who], points], axis=1), top, 1)

        def visit(node, who):
            nonlocal taken
            a, b = self.begin[node], self.end[node]
            if self.children[node, 0] < 0:
                # each query meets each leaf once, so nothing is offered twice
                values = unit[who] @ self.unit[a:b].T
                taken += values.size
                offer(who, np.arange(a, b), values)
                return None
            values = unit[who] @ self.unit[a]
            taken += len(who)
            return np.sqrt(np.maximum(0, 2 - 2 * values)), values

        if not len(self.begin):
            return found, cos, 0
        # first descent: every query goes to the leaf whose ranges suit it best, for a first bound
        home = np.full(n, -1)
        todo = [(0, np.arange(n))]
        while todo:
            node, who = todo.pop()
            got = visit(node, who)
            if got is None:
                home[who] = node
                continue
            offer(who, np.array([self.begin[node]]), got[1][:, None])
            near = got[0] <= (self.range_[node, 0, 1] + self.range_[node, 1, 0]) / 2
            todo += [(self.children[node, c], w) for c, w in ((1, who[~near]), (0, who[near])) if len(w)]
        # second pass: the whole tree, but for the home leaves and what the bound excludes
        todo = [(0, np.arange(n))]
        while todo:
            node, who = todo.pop()
            if self.children[node, 0] < 0:
                who = who[home[who] != node]
                if len(who):
                    visit(node, who)
                continue
            d, values = visit(node, who)
            new = ~(found[who] == self.begin[node]).any(axis=1)
            if new.any():
                offer(who[new], np.array([self.begin[node]]), values[new][:, None])
            worst = np.sqrt(np.maximum(0, 2 - 2 * cos[who].min(axis=1)))
            for c in (1, 0):
                low, high = self.range_[node, c]
                bound = np.maximum(np.maximum(d - high, low - d), 0)
                stay = who[bound <= factor * worst + 1e-9]
                if len(stay):
                    todo.append((self.children[node, c], stay))
        tied = np.flatnonzero(np.isfinite(lost) & (lost >= cos.min(axis=1) - ROUNDING))
        if len(tied):
            taken += self._settle(np.asarray(queries, np.float64), unit, tied, found, cos, k, factor)
        return found, cos, taken

    def _settle(self, queries, unit, tied, found, cos, k: int, factor: float) -> int:
        """Of the points within rounding of the last kept cosine of the
        queries ``tied``, or better, keep the ``k`` first by exact score and
        smallest id.  Returns the number of cosines taken."""
        least = cos.min(axis=1) - ROUNDING
        smallest = np.array([i[0] for i in self.ids])
        kept = {int(q): (np.zeros(0, int), np.zeros(0)) for q in tied}
        taken, todo = 0, [(0, tied)]

        def keep(who, points, values):
            for q, row in zip(who.tolist(), values >= least[who, None]):
                if row.any():
                    at = np.concatenate([kept[q][0], points[row]])
                    score = np.concatenate([kept[q][1], cosine(np.repeat(queries[q][None], row.sum(), 0), self.vectors[points[row]])])
                    first = np.lexsort([smallest[at], -score])[:k]
                    kept[q] = at[first], score[first]
        while todo:
            node, who = todo.pop()
            a, b = self.begin[node], self.end[node]
            inner = self.children[node, 0] >= 0
            points = np.arange(a, a + 1 if inner else b)
            values = unit[who] @ self.unit[points].T
            taken += values.size
            keep(who, points, values)
            if inner:
                d, radius = np.sqrt(np.maximum(0, 2 - 2 * values[:, 0])), np.sqrt(np.maximum(0, 2 - 2 * least[who]))
                for c in (1, 0):
                    low, high = self.range_[node, c]
                    stay = who[np.maximum(np.maximum(d - high, low - d), 0) <= factor * radius + 1e-9]
                    if len(stay):
                        todo.append((self.children[node, c], stay))
        for q, (at, score) in kept.items():
            found[q], cos[q] = -1, -np.inf
            found[q, :len(at)], cos[q, :len(at)] = at, score
        return taken


def unit_rows(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1; first by their largest entry, so that very
    large or very small entries neither overflow nor vanish."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0, 2 - 2 * (a @ b.T)))


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of equal rows of ``a`` and ``b`` in double precision."""
    a, b = np.asarray(a, np.float64), np.asarray(b, np.float64)
    plain = (a * b).sum(axis=1) / np.sqrt((a * a).sum(axis=1) * (b * b).sum(axis=1))
    odd = ~np.isfinite(plain)
    if odd.any():
        plain[odd] = (unit_rows(a[odd]) * unit_rows(b[odd])).sum(axis=1)
    return plain


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``id``, ``vec`` (doubles), ``dim`` and ``key`` (equal for equal vectors)
    of the rows that take part."""
    vec = F.col(vec_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), vec.alias("vec")).where("id is not null and vec is not null")
    bad = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.where(~F.coalesce(bad, F.lit(True)) & F.exists("vec", lambda x: x != 0))
    # 0.0 and -0.0 are one value
    rows = rows.withColumn("vec", F.transform("vec", lambda x: x + F.lit(0.0)))
    return rows.select("id", "vec", F.size("vec").alias("dim"),
                       F.concat_ws("-", F.hex(F.xxhash64("vec")), F.hex(F.xxhash64("vec", F.lit(1)))).alias("key"))


def points(rows: DataFrame, k: int) -> DataFrame:
    """One row per distinct vector: ``key, vec, dim`` and its ``k`` + 1
    smallest ids (more cannot be among the nearest of any query).  The rank
    filter is applied before the shuffle, so a vector that a third of the rows
    share sends a few rows per task."""
    by = Window.partitionBy("key").orderBy("id")
    few = rows.withColumn("r", F.dense_rank().over(by)).where(F.col("r") <= k + 1)
    return few.groupBy("key").agg(F.any_value("vec").alias("vec"), F.any_value("dim").alias("dim"),
                                  F.array_sort(F.collect_set("id")).alias("ids"))


def nearest(vectors: DataFrame, queries: F.Column, k: int = 5, factor: float = 1.0, id_col: str = "vec_id",
            vec_col: str = "embedding", shard_rows: int = 16_384, block_rows: int = 8_192) -> DataFrame:
    """The ``k`` nearest other rows of every row that ``queries`` (a condition
    on ``id``) selects: ``query_id, rank, vec_id, score``.

    Vectors that are null, empty, zero, or hold null or non-finite components
    take no part, nor do rows without an id; vectors of different lengths are
    never compared.  Ties go to the smaller id.  Repeated rows count once; an
    id with several vectors is a query (and a candidate) with each of them.
    Fewer candidates than ``k``: all of them.  Empty in, empty out.
    """
    rows = usable(vectors, id_col, vec_col)
    base = written(points(rows, k), "ann-points")
    asked = written(rows.where(queries).select("id", "key", "vec", "dim").distinct(), "ann-queries")
    shards = base.groupBy("dim").agg(F.ceil(F.count("*") / shard_rows).cast("int").alias("shards"))
    blocks = asked.groupBy("dim").agg(F.ceil(F.approx_count_distinct("key") / block_rows).cast("int").alias("blocks"))

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = VPTree.build(np.array(pdf["vec"].tolist()), [list(x) for x in pdf["ids"]])
        return pd.DataFrame({"dim": pdf["dim"].iloc[:1], "shard": pdf["shard"].iloc[:1], "tree": [pickle.dumps(tree.__dict__)]})

    def block(pdf: pd.DataFrame) -> pd.DataFrame:
        held = pickle.dumps((pdf["key"].tolist(), np.array(pdf["vec"].tolist())))
        return pd.DataFrame({"dim": pdf["dim"].iloc[:1], "block": pdf["block"].iloc[:1], "queries": [held]})

    def search(batches):
        for batch in batches:
            for tree, held in zip(batch.column(0), batch.column(1)):
                tree, (keys, vecs) = VPTree(**pickle.loads(tree.as_py())), pickle.loads(held.as_py())
                at, _, _ = tree.search(vecs, k + 1, factor)
                who, col = np.nonzero(at >= 0)
                exact = cosine(vecs[who], tree.vectors[at[who, col]])
                out = [(keys[q], i, s) for q, p, s in zip(who.tolist(), at[who, col].tolist(), exact.tolist())
                       for i in tree.ids[p]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), (pa.string(), pa.int64(), pa.float64()))] if out else
                    [pa.array([], t) for t in (pa.string(), pa.int64(), pa.float64())], ["key", "vec_id", "score"])

    dealt = base.join(shards, "dim").withColumn("shard", F.pmod(F.xxhash64("key", F.lit(2)), "shards").cast("int"))
    trees = written(dealt.select("key", "vec", "dim", "ids", "shard").groupBy("dim", "shard")
                    .applyInPandas(build, "dim int, shard int, tree binary"), "ann-trees")
    distinct = asked.dropDuplicates(["key"]).join(blocks, "dim") \
        .withColumn("block", F.pmod(F.xxhash64("key", F.lit(3)), F.greatest("blocks", F.lit(1))).cast("int"))
    packed = distinct.select("key", "vec", "dim", "block").groupBy("dim", "block") \
        .applyInPandas(block, "dim int, block int, queries binary")
    units = packed.join(shards, "dim").select("dim", "queries", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"))
    # the blocks move to the trees, and a task searches its shards where they are
    hits = units.join(trees, ["dim", "shard"]).select("tree", "queries") \
        .mapInArrow(search, "key string, vec_id long, score double")
    best = Window.partitionBy("key").orderBy(F.desc("score"), "vec_id")
    top = hits.groupBy("key", "vec_id").agg(F.max("score").alias("score")) \
        .withColumn("r", F.row_number().over(best)).where(F.col("r") <= k + 1) \
        .groupBy("key").agg(F.array_sort(F.collect_list(F.struct("r", "vec_id", "score"))).alias("top"))
    own = asked.select("id", "key").join(top, "key") \
        .select("id", F.explode(F.filter("top", lambda x: x["vec_id"] != F.col("id"))).alias("x"))
    # k or k + 1 rows for an id with one vector (the rule); with several, a candidate's best score counts
    merged = own.groupBy("id", "x.vec_id").agg(F.max("x.score").alias("score"))
    rank = Window.partitionBy("id").orderBy(F.desc("score"), "vec_id")
    return merged.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= k) \
        .select(F.col("id").alias("query_id"), F.col("rank").cast("int"), "vec_id", "score")
