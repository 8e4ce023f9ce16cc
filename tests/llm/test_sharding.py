import random
import zlib

import pytest
from cases import AWKWARD, documents

from wardline.llm import sharding


def plain_greedy(sizes, capacity):
    """Lists of consecutive sizes, each filled as far as it goes; None if one does not fit."""
    out = []
    for s in sizes:
        if s > capacity:
            return None
        if out and sum(out[-1]) + s <= capacity:
            out[-1].append(s)
        else:
            out.append([s])
    return out


def plain_capacity(parts, shards):
    """Smallest feasible capacity, trying the sums of all runs in rising order."""
    runs = sorted({sum(p[i:j]) for p in parts for i in range(len(p)) for j in range(i + 1, len(p) + 1)})
    for c in runs:
        cut = [plain_greedy(p, c) for p in parts]
        if None not in cut and sum(map(len, cut)) <= shards:
            return c, [len(x) for x in cut]


def plain_shards(sizes, shards):
    """Sizes of the shards in order, by the stated rules on whole lists."""
    at = [sum(sizes[:i]) for i in range(len(sizes))]
    parts, left, alone = [list(range(len(sizes)))], shards, []
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], at[i])):
        if not parts or left < 2 or sizes[i] * left < sum(sizes[j] for p in parts for j in p):
            break
        rest = [q for p in parts for q in (([j for j in p if j < i], [j for j in p if j > i]) if i in p else (p,)) if q]
        cut = [plain_greedy([sizes[j] for j in p], sizes[i]) for p in rest]
        if None in cut or sum(map(len, cut)) > left - 1:
            break
        parts, left = rest, left - 1
        alone.append(i)
    out = {at[i]: sizes[i] for i in alone}
    if parts:
        lists = [[sizes[j] for j in p] for p in parts]
        _, own = plain_capacity(lists, left)
        for _ in range(left - sum(own)):
            own[max(range(len(own)), key=lambda k: sum(lists[k]) / own[k])] += 1
        for p, part, k in zip(parts, lists, own):
            begin = at[p[0]]
            for run in plain_greedy(part, plain_capacity([part], k)[0]):
                out[begin] = sum(run)
                begin += sum(run)
    return [out[b] for b in sorted(out)]


@pytest.mark.parametrize("seed", range(8))
def test_cuts_are_the_plain_ones(spark, seed):
    rng = random.Random(seed)
    n, shards = rng.choice([(1, 4), (3, 5), (60, 7), (90, 4), (120, 12)])
    sizes = [rng.choice([1, 2, 3, 17, 40]) if rng.random() < 0.9 else rng.randint(50, 900) for _ in range(n)]
    if seed % 2:
        sizes[rng.randrange(n)] = 2 * sum(sizes)                             # one group holds two thirds
    rows, begin = [], 0
    for s in sizes:
        rows.append((begin, s))
        begin += s
    groups = spark.createDataFrame(rows, "begin long, total long")
    cuts = [0, *sharding.minimax_cuts(groups, shards, cells=rng.choice([3, 8, 1000])), begin]
    assert [b - a for a, b in zip(cuts, cuts[1:])] == plain_shards(sizes, shards)


def dealt(df):
    rows = df.collect()
    shards = {}
    for r in rows:
        shards.setdefault(r.shard, []).append(r)
    for own in shards.values():
        assert sorted(r.slot for r in own) == list(range(len(own)))
    return rows, shards


def test_whole_table(spark):
    rng = random.Random(3)
    texts = AWKWARD + [f"text {rng.randint(0, 250)} " * rng.randint(1, 9) for _ in range(400)] + ["the same"] * 300
    df = documents(spark, texts, [(None, "the same", None, None, 1), (None, None, None, None, None)])
    rows, shards = dealt(sharding.assign(df.repartition(5), shards=10, cells=20))
    want = [(i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in df.select("doc_id", "text").collect()]
    key = str
    assert sorted(((r.doc_id, r.size, r.text_crc32) for r in rows), key=key) == sorted(want, key=key)
    assert {(r.law, r.grown_shard) for r in rows} == {("bytes", None)}
    homes, first, total = {}, {}, {}
    for r in rows:
        homes.setdefault(r.text_crc32, set()).add(r.shard)
        total[r.text_crc32] = total.get(r.text_crc32, 0) + r.size
        first[r.text_crc32] = min(first.get(r.text_crc32, 1 << 60), (1 << 60) if r.doc_id is None else r.doc_id)
    assert all(len(x) == 1 for x in homes.values())
    order = sorted(total, key=lambda c: (first[c] if first[c] < 1 << 60 else -1))
    assert [sum(r.size for r in shards[k]) for k in sorted(shards)] == plain_shards([total[c] for c in order], 10)


def test_few_and_no_rows(spark):
    assert sharding.assign(documents(spark, ["a"]).where("false")).collect() == []
    rows, shards = dealt(sharding.assign(documents(spark, ["a", "b", "a"]).where("doc_id is not null"), shards=40))
    assert len(rows) == 4 and sorted(shards) == [0, 1]
    with pytest.raises(ValueError):
        sharding.assign(documents(spark, ["a"]), overhead=0)
