"""Boosted trees of both heads, trained level by level on histograms (M2).

The method is that of MLlib's GBTClassifier: regression trees on the gradient
of the log loss, variance as impurity, a drawn share of the rows per round and
of the features per node, split points at about equal weights of the rows (of all,
where MLlib takes a sample).  What differs is how rows are held: in blocks of bin numbers,
two features in one 16-bit number, and of all heads at once.  One pass serves a
level of every head's tree and adds up, of two siblings, only the one with fewer
rows; the other is the parent less that.  A task returns its sums, as wide as
features, bins and nodes of the level; the driver chooses the splits.

Draws depend on the seed, the round and a block's number, so a layout of the
rows gives the same trees again, and the first trees do not depend on how many
follow.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, functions as F

from ..session import cut_lineage, remove_table
from .fit import quoted

MAX_BINS = 32            # five bits a feature
SPLIT_ROWS = 10_000      # up to so many rows, or values near split points, are looked at on the driver
EDGES = 2048             # ranges that the values of a feature are first counted in
FINER = 64               # parts of a range that may hold a split point, in the next pass
BLOCK_ROWS = 32_768
CHECKPOINT_ROUNDS = 50


@dataclass
class Target:
    """One head to be trained: its rows, its 0/1 label and the weight of a positive row."""

    rows: DataFrame
    label: str
    weight: float = 1.0


@dataclass
class Tree:
    """Nodes in heap order (children of i: 2i+1, 2i+2): feature (-1: leaf), the
    last bin that goes left and its threshold, gain, and weight and sum of rows."""

    feature: np.ndarray
    cut: np.ndarray
    threshold: np.ndarray
    gain: np.ndarray
    weight: np.ndarray
    total: np.ndarray

    def kids(self) -> np.ndarray:
        """Both children of every node, side by side; a leaf is its own."""
        i = np.arange(len(self.feature))
        return np.where(self.feature[:, None] < 0, i[:, None], 2 * i[:, None] + [1, 2]).ravel()

    def values(self) -> np.ndarray:
        return np.divide(self.total, self.weight, out=np.zeros(len(self.total)), where=self.weight > 0)


def split_points(values: np.ndarray, weights: np.ndarray, bins: int = MAX_BINS) -> np.ndarray:
    """Thresholds of one feature: between all neighbouring values where these
    are few, else where the weight so far comes nearest to equal shares."""
    seen = ~np.isnan(values)
    distinct, at = np.unique(values[seen], return_inverse=True)
    if len(distinct) < 2:
        return np.zeros(0)
    with np.errstate(invalid="ignore"):
        middle = distinct[:-1] / 2 + distinct[1:] / 2
    middle = np.where(np.isnan(middle), distinct[:-1], middle)           # between the infinities
    if len(middle) < bins:
        return middle
    held = np.cumsum(np.bincount(at, weights[seen]))
    stride = held[-1] / bins
    target, out = stride, []
    for k in range(len(middle)):
        if len(out) < bins - 1 and abs(held[k] - target) < abs(held[k + 1] - target):
            out.append(middle[k])
            target += stride
    return np.array(out)


def _labelled(target: Target, features) -> DataFrame:
    x = ", ".join(f"double({quoted(c)})" for c in features)
    label = quoted(target.label)
    return target.rows.selectExpr(
        f"array({x}) AS x", f"CASE WHEN {label} IN (0, 1) THEN int({label}) ELSE raise_error('a label must be 0 or 1') END AS y")


def _counts(rows: DataFrame, edges: list[np.ndarray], inside: list[np.ndarray] | None = None) -> list[np.ndarray]:
    """Of each feature the rows without and with a positive label, by code: 2i + 1
    is the value ``edges[i]``, 2i what lies below it (and above the edge before).
    One pass; columns code, rows, rows.  With ``inside``, codes to look into: the
    same by value, for the values of these codes."""
    width = len(edges)
    ends = [np.append(e, np.nan) for e in edges]

    def run(batches):
        held = [np.zeros((2, 2 * len(e) + 1), np.int64) if inside is None else [] for e in edges]
        for batch in batches:
            every = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, width)
            y = batch.column(1).to_numpy() == 1
            for f in range(width):
                x = every[:, f] + 0.0                                            # one zero only
                seen = ~np.isnan(x)
                x, own = x[seen], y[seen]
                at = np.searchsorted(edges[f], x)
                code = 2 * at + (ends[f][at] == x)
                if inside is None:
                    held[f][1] += np.bincount(code[own], minlength=held[f].shape[1])
                    held[f][0] += np.bincount(code[~own], minlength=held[f].shape[1])
                else:
                    near = inside[f][code]
                    held[f].append((x[near], own[near]))
        for f in range(width):
            if inside is None:
                key = np.flatnonzero(held[f].any(0))
                n0, n1 = held[f][:, key]
            elif held[f]:
                x, own = (np.concatenate(c) for c in zip(*held[f]))
                key, at = np.unique(x, return_inverse=True)
                n0, n1 = (np.bincount(at[own == k], minlength=len(key)) for k in (False, True))
            else:
                continue
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(key), f), pa.int32()), pa.array(key.astype(float)),
                                              pa.array(n0, pa.int64()), pa.array(n1, pa.int64())], ["f", "k", "n0", "n1"])
    got = rows.mapInArrow(run, "f int, k double, n0 long, n1 long").groupBy("f", "k").agg(
        F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).toArrow()
    f, table = got.column("f").to_numpy(), np.stack([got.column(c).to_numpy().astype(float) for c in ("k", "n0", "n1")], 1)
    return [(own := table[f == i])[own[:, 0].argsort()] for i in range(width)]


def _near(weights: np.ndarray, bins: int = MAX_BINS) -> np.ndarray:
    """Which of the ranges, in order and none empty, can hold a value that a
    split point lies beside; every value of the others is away from all."""
    n = len(weights)
    if n <= bins + 1:
        return np.ones(n, bool)
    held, out, last = np.cumsum(weights), np.zeros(n, bool), -2
    for target in held[-1] / bins * np.arange(1, bins):
        at = min(int(np.searchsorted(held, target * (1 - 1e-9), "right")), n - 1)   # where the weight passes it, but for rounding
        last = max(min(int(np.searchsorted(held, target * (1 + 1e-9), "right")), n - 1), last + 1)   # a point is after the one before
        out[max(at - 1, 0):last + 2] = True
    return out


def _ordered(x: np.ndarray) -> np.ndarray:
    """Integers in the order of the doubles, and (below) back."""
    bits = np.asarray(x, float).view(np.int64)
    return np.where(bits < 0, np.int64(-2 ** 63) - bits, bits)


def _doubles(k: np.ndarray) -> np.ndarray:
    return np.where(k < 0, np.int64(-2 ** 63) - k, k).view(float)


def _parts(lo: float, hi: float) -> np.ndarray:
    """Edges that cut the open range between two doubles."""
    a, b = (int(v) for v in _ordered(np.array([lo, hi])))
    return _doubles(np.array(sorted({a + (b - a) * i // FINER for i in range(1, FINER)} - {a, b}), np.int64))


def _splits(rows: DataFrame, n_rows: int, width: int, weight: float, seed: int) -> list[np.ndarray]:
    """:func:`split_points` of every feature over all rows.

    Passes count the rows in ranges of values; a range that a split point may lie
    in or beside is cut finer in the next one, until few values are left in
    these.  Then their values are counted one by one; the others stand together
    as one for each range, which no split point touches.  The first edges come
    from some of the rows, and have no part in the result."""
    some = rows.sample(fraction=SPLIT_ROWS / n_rows, seed=seed) if n_rows > SPLIT_ROWS else rows
    got = some.toArrow()                                                     # about SPLIT_ROWS rows
    x = got.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
    if n_rows <= SPLIT_ROWS:
        w = np.where(got.column("y").to_numpy() == 1, weight, 1.0)
        return [split_points(x[:, f], w) for f in range(width)]
    edges = [np.sort(x[~np.isnan(x[:, f]), f] + 0.0) for f in range(width)]
    edges = [np.unique(e[::max(1, len(e) // EDGES)]) for e in edges]         # with every value that many rows have
    while True:
        counts = _counts(rows, edges)
        near = [_near(c[:, 1] + weight * c[:, 2]) & (c[:, 0] % 2 == 0) for c in counts]
        if sum(c[k, 1:].sum() for c, k in zip(counts, near)) <= SPLIT_ROWS * width:
            break
        finer = []
        for e, c, k in zip(edges, counts, near):
            around = np.concatenate([[-np.inf], e, [np.inf]])
            new = [_parts(around[int(i) // 2], around[int(i) // 2 + 1]) for i in c[k, 0]]
            finer.append(np.unique(np.concatenate([e, *new])))
        if all(len(a) == len(b) for a, b in zip(edges, finer)):              # nothing lies between neighbouring doubles
            break
        edges = finer
    inside = [np.isin(np.arange(2 * len(e) + 1), c[k, 0]) for e, c, k in zip(edges, counts, near)]
    values = _counts(rows, edges, inside)
    out = []
    for e, c, k, v in zip(edges, counts, near, values):
        rest = c[~k].copy()
        code = rest[:, 0].astype(int)
        around = np.concatenate([[-np.inf], e, [np.inf]])
        # a value for each code: its own, or one between its edges
        stands = [around[i // 2 + 1] if i % 2 else _doubles(np.array([sum(map(int, _ordered(around[i // 2:i // 2 + 2]))) // 2]))[0] for i in code]
        every = np.concatenate([np.column_stack([stands, rest[:, 1:]]) if len(rest) else rest, v])
        out.append(split_points(every[:, 0], every[:, 1] + weight * every[:, 2]))
    return out


def _blocks(rows: DataFrame, head: int, splits: list[np.ndarray]) -> DataFrame:
    """The rows as blocks: labels, and bin numbers of features 2p and 2p+1 as
    one number, pair by pair.  A missing feature is in the last bin."""
    width, limit = len(splits), BLOCK_ROWS

    def run(batches):
        from pyspark import TaskContext
        part, number, held, size = TaskContext.get().partitionId(), 0, [], 0

        def packed():
            x, y = (np.concatenate(c) for c in zip(*held))
            codes = np.zeros((-(-width // 2), len(x)), np.uint16)
            for f in range(width):
                codes[f // 2] |= (np.searchsorted(splits[f], x[:, f]) << (0 if f % 2 else 5)).astype(np.uint16)
            return pa.RecordBatch.from_arrays(
                [pa.array([head], pa.int32()), pa.array([part], pa.int32()), pa.array([number], pa.int32()),
                 pa.array([y.astype(np.int8).tobytes()], pa.binary()), pa.array([codes.tobytes()], pa.binary())],
                ["head", "part", "number", "y", "codes"])
        for batch in batches:
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, width)
            held.append((x, batch.column(1).to_numpy()))
            size += batch.num_rows
            if size >= limit:
                yield packed()
                number, held, size = number + 1, [], 0
        if size:
            yield packed()
    return rows.mapInArrow(run, "head int, part int, number int, y binary, codes binary")


def _walk():
    """A function for tasks: the node that every row of a block reaches."""
    def walk(codes, feature, cut, kids, depth):
        n = codes.shape[1]
        at, row, flat = np.zeros(n, np.int64), np.arange(n), codes.ravel()
        base, shift = np.maximum(feature, 0) // 2 * n, np.where(feature % 2 == 1, 0, 5)
        for _ in range(depth):
            cell = flat[base[at] + row] >> shift[at] & 31
            at = kids[2 * at + (cell > cut[at])]
        return at
    return walk


def _level_sums(state, growing, wanted, depth: int, m: int, weights, rate: float, seed: int, width: int) -> list:
    """Per head, over the drawn rows in the wanted nodes: weights and sums by
    feature, node and bin.  ``wanted``: of a head a node's place, -1 for none."""
    walk, trees = _walk(), [(t.feature, t.cut, t.kids()) for t in growing]
    places = [int(w.max(initial=-1)) + 1 for w in wanted]
    pairs = -(-width // 2)

    def run(blocks):
        sums = [np.zeros((2, pairs, k * 1024)) for k in places]
        for (h, part, number), (codes, y, _, r) in blocks:
            if not places[h]:
                continue
            take = np.random.default_rng([seed, m, h, part, number]).random(len(y), np.float32) < rate
            place = wanted[h][walk(codes, *trees[h], depth)]
            rows = np.flatnonzero(take & (place >= 0))
            place = place[rows] * 1024
            w = np.where(y[rows] == 1, weights[h], 1.0)
            s = w * r[rows]
            for p in range(pairs):
                cell = place + codes[p][rows]
                sums[h][0, p] += np.bincount(cell, w, places[h] * 1024)
                sums[h][1, p] += np.bincount(cell, s, places[h] * 1024)
        out = []
        for k, both in zip(places, sums):
            both = both.reshape(2, pairs, k, 32, 32)
            out.append(np.stack([both.sum(4), both.sum(3)], 2).reshape(2, 2 * pairs, k, 32)[:, :width])
        yield out
    got = state.mapPartitions(run).collect()                                  # one a task, in their order
    return [sum(x[h] for x in got) for h in range(len(growing))]


def _next_state(state, trees, rates, depth: int):
    """The rows after a round: margin, and the gradient the next tree is fitted to."""
    walk = _walk()
    held = [(t.feature, t.cut, t.kids(), rate * t.values()) for t, rate in zip(trees, rates)]

    def run(blocks):
        for key, (codes, y, margin, _) in blocks:
            feature, cut, kids, value = held[key[0]]
            margin = margin + value[walk(codes, feature, cut, kids, depth)]
            sign = 2.0 * y - 1
            yield key, (codes, y, margin, 4 * sign / (1 + np.exp(np.minimum(2 * sign * margin, 700))))
    return state.mapPartitions(run, preservesPartitioning=True)


def _best(w: np.ndarray, s: np.ndarray, allowed: np.ndarray, n_splits: np.ndarray, least: float):
    """The best split of a node from its weights and sums by (feature, bin):
    feature, bin, gain, and weight and sum on the left; None without a gain."""
    total_w, total_s = w[0].sum(), s[0].sum()
    wl, sl = w.cumsum(1)[:, :-1], s.cumsum(1)[:, :-1]
    wr, sr = total_w - wl, total_s - sl
    ok = (wl >= least) & (wr >= least) & allowed[:, None] & (np.arange(wl.shape[1]) < n_splits[:, None])
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = np.where(ok, (sl * sl / wl + sr * sr / wr - total_s * total_s / total_w) / total_w, -1.0)
    # the first of equals, such as those at bins that are empty but for rounding
    f, b = divmod(int((gain >= gain.max() - 1e-9 * abs(gain.max())).argmax()), gain.shape[1])
    if gain[f, b] <= 1e-12 * max((total_s / total_w) ** 2, 1e-12):           # rounding is no gain
        return None
    return f, b, gain[f, b], wl[f, b], sl[f, b]


def fit(targets: list[Target], features, rounds: int, depth: int, step: float, rate: float, share: float,
        seed: int) -> list[list[Tree]]:
    """The trees of every target, ``rounds`` each; the first counts fully, the
    others by ``step``.  ``rate`` of the rows are drawn per round, ``share``
    of the features per node."""
    features, sc = list(features), targets[0].rows.sparkSession.sparkContext
    width, weights, splits, blocks = len(features), [t.weight for t in targets], [], None
    for h, target in enumerate(targets):
        rows = _labelled(target, features)
        splits.append(_splits(rows, target.rows.count(), width, target.weight, seed))
        own = _blocks(rows, h, splits[h])
        blocks = own if blocks is None else blocks.unionByName(own)
    n_splits = [np.array([len(x) for x in s]) for s in splits]
    blocks = cut_lineage(blocks, "boost-rows")
    parts = max(1, min(sc.defaultParallelism, blocks.count()))

    def ready(held):
        for key, (codes, y) in sorted(held, key=lambda e: e[0]):
            y = np.frombuffer(y, np.int8)
            yield key, (np.frombuffer(codes, np.uint16).reshape(-1, len(y)), y, np.zeros(len(y)), 2.0 * y - 1)
    state = blocks.rdd.map(lambda b: ((b.head, b.part, b.number), (bytes(b.codes), bytes(b.y)))) \
        .partitionBy(parts, lambda k: k[0] + k[1] + k[2]).mapPartitions(ready, preservesPartitioning=True)
    state.persist(StorageLevel.MEMORY_AND_DISK)
    ensembles, size, before, saved = [[] for _ in targets], 2 ** (depth + 1) - 1, None, None
    n_allowed = max(1, int(np.ceil(share * width)))
    for m in range(rounds):
        growing = [Tree(np.full(size, -1), np.zeros(size, np.int64), np.zeros(size), np.full(size, -1.0), np.zeros(size), np.zeros(size))
                   for _ in targets]
        cells: list[dict] = [{} for _ in targets]                            # of the level's live nodes: weights and sums
        few: list[dict] = [{0: (0, None)} for _ in targets]                  # node to be added up: its place, and its sibling
        for level in range(depth):
            wanted = [np.full(size, -1) for _ in targets]
            for h, nodes in enumerate(few):
                for node, (place, _) in nodes.items():
                    wanted[h][node] = place
            if not any(few):
                break
            sums = _level_sums(state, growing, wanted, level, m, weights, rate, seed, width)
            if before is not None:                                           # this round's rows are held by now
                before.unpersist()
                before = None
                if state.getCheckpointFile():
                    if saved:
                        remove_table(saved)
                    saved = state.getCheckpointFile()
            for h, tree in enumerate(growing):
                live = {}
                for node, (place, sibling) in few[h].items():
                    live[node] = sums[h][:, :, place]
                    if sibling is not None:
                        live[sibling] = cells[h][(node - 1) // 2] - live[node]
                cells[h], few[h] = live, {}
                if 0 in live:
                    tree.weight[0], tree.total[0] = live[0][:, 0].sum(1)
                for node in sorted(live):
                    if tree.weight[node] <= 0:                               # a round that drew no row
                        continue
                    allowed = np.zeros(width, bool)
                    allowed[np.random.default_rng([seed, m, h, node]).choice(width, min(n_allowed, width), replace=False)] = True
                    found = _best(*live[node], allowed, n_splits[h], min(1.0, weights[h]) / 2)
                    if found is None:
                        continue
                    f, b, gain, wl, sl = found
                    tree.feature[node], tree.cut[node], tree.threshold[node], tree.gain[node] = f, b, splits[h][f][b], gain
                    left, right = 2 * node + 1, 2 * node + 2
                    tree.weight[left], tree.total[left] = wl, sl
                    tree.weight[right], tree.total[right] = tree.weight[node] - wl, tree.total[node] - sl
                    small, large = (left, right) if tree.weight[left] <= tree.weight[right] else (right, left)
                    few[h][small] = (len(few[h]), large)
        for h, tree in enumerate(growing):
            ensembles[h].append(tree)
        if m + 1 < rounds:
            after = _next_state(state, growing, [step if m else 1.0] * len(targets), depth).persist(StorageLevel.MEMORY_AND_DISK)
            if (m + 1) % CHECKPOINT_ROUNDS == 0:
                after.checkpoint()
            before, state = state, after
    state.unpersist()
    if saved:
        remove_table(saved)
    return ensembles


def round_losses(rows: DataFrame, features, label: str, ensemble: list[list[tuple]], depth: int) -> list[float]:
    """Mean log loss over the rows after each tree, in one pass.  A tree is its
    nodes' (feature, threshold, left, right, weighted prediction), the root first; a
    missing value goes right.  NaN for no rows."""
    table = np.array([nodes + [(-1, 0.0, 0, 0, 0.0)] * (max(map(len, ensemble)) - len(nodes)) for nodes in ensemble], "f8")
    width, n_trees = len(list(features)), len(ensemble)
    part = _labelled(Target(rows, label), features)

    def run(batches):
        count, losses = 0, np.zeros(n_trees)
        feature, threshold, value = table[:, :, 0].astype(int), table[:, :, 1], table[:, :, 4]
        own = np.arange(table.shape[1])
        kids = np.where(feature[:, :, None] < 0, own[None, :, None], table[:, :, 2:4].astype(int)).reshape(n_trees, -1)
        feature = np.maximum(feature, 0)
        for batch in batches:
            every = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, width)
            signs = 2.0 * batch.column(1).to_numpy() - 1
            count += batch.num_rows
            for i in range(0, batch.num_rows, 4096):                         # stays in the processor's cache
                flat, sign = every[i:i + 4096].ravel(), signs[i:i + 4096]
                start, margin = np.arange(len(sign)) * width, np.zeros(len(sign))
                for t in range(n_trees):
                    at = np.zeros(len(sign), int)
                    for _ in range(depth):
                        at = kids[t][2 * at + ~(flat[start + feature[t][at]] <= threshold[t][at])]
                    margin += value[t][at]
                    losses[t] += np.logaddexp(0, -2 * sign * margin).sum()
        yield pa.RecordBatch.from_arrays([pa.array([count], pa.int64()), pa.array([losses.tolist()], pa.list_(pa.float64()))], ["n", "l"])
    got = part.mapInArrow(run, "n long, l array<double>").collect()           # one row a task
    n = sum(r.n for r in got)
    return (np.sum([r.l for r in got], axis=0) / n).tolist() if n else [float("nan")] * n_trees


def contributions(x: np.ndarray, ensemble: list[list[tuple]], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each row (of features, a missing one NaN) and feature, what the steps of
    its paths that split on the feature change in the nodes' values, and whether
    any does; the last column is the value of the roots.  Trees as in
    :func:`round_losses`."""
    n, width = x.shape
    part, met = np.zeros((n, width + 1)), np.zeros((n, width + 1), bool)
    met[:, -1] = True
    for nodes in ensemble:
        feature, threshold, left, right, value = (np.array(c) for c in zip(*nodes))
        at = np.zeros(n, int)
        part[:, -1] += value[0]
        for _ in range(depth):
            rows = np.flatnonzero(feature[at] >= 0)
            here = at[rows]
            f = feature[here]
            to = np.where(x[rows, f] <= threshold[here], left[here], right[here]).astype(int)   # NaN goes right
            part[rows, f] += value[to] - value[here]
            met[rows, f] = True
            at[rows] = to
    return part, met
