import numpy as np
import pytest
import xxhash
from cases import AWKWARD, documents

from wardline.llm import simhash
from wardline.llm.components import connected_components


def plain_fingerprint(text, k=4):
    table = {c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
    low = "".join(table.get(c, c) for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        low = low.replace(c, " ")
    words = [w for w in low.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    counts = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), seed=42)
        for b in range(64):
            counts[b] += h >> b & 1
    return sum(1 << b for b in range(64) if counts[b] * 2 > len(shingles))


def plain_components(fps, radius):
    """Label of each position: smallest position reachable over links."""
    n, label = len(fps), list(range(len(fps)))
    changed = True
    while changed:
        changed = False
        for i in range(n):
            for j in range(n):
                if bin(int(fps[i]) ^ int(fps[j])).count("1") <= radius and label[j] < label[i]:
                    label[i], changed = label[j], True
    return label


@pytest.mark.parametrize("text", [t for t in AWKWARD if t is None or len(t) < 100] + ["A B c\x0bd\x0cE é\xa0f g", "x " * 300])
def test_fingerprint_matches_plain_loops(text):
    assert simhash.fingerprint(text) == plain_fingerprint(text)


def near_fingerprints(rng, n, groups, flips):
    centres = rng.integers(0, 2 ** 63, groups, dtype=np.uint64)
    out = []
    for _ in range(n):
        x = int(centres[rng.integers(groups)])
        for b in rng.integers(0, 64, rng.integers(0, flips + 1)):
            x ^= 1 << int(b)
        out.append(x)
    return np.array(out, np.uint64)


@pytest.mark.parametrize("radius", [1, 2, 3, 4, 7])
@pytest.mark.parametrize("size", [2, 63, 65, 200])
def test_bit_sliced_lanes_match_popcount(radius, size):
    rng = np.random.default_rng(size + radius)
    fps = near_fingerprints(rng, size, 3, 6)
    planes = simhash.bit_planes(fps)
    ask = fps[0]
    lanes = np.packbits(np.arange(planes.shape[1] * 64) < size, bitorder="little").view(np.uint64)
    mask = [~np.uint64(0) if int(ask) >> b & 1 else np.uint64(0) for b in range(64)]
    at, alive = simhash.lanes_within(lambda b, k: planes[b, k] ^ mask[b], lanes, radius)
    want = [i for i in range(size) if bin(int(ask) ^ int(fps[i])).count("1") <= radius]
    assert sorted(simhash._lane_pairs(at, alive).tolist()) == want


@pytest.mark.parametrize("small", [4, 96])
def test_bucket_links_connect_what_is_within_the_radius(small):
    rng = np.random.default_rng(5)
    fps = np.unique(near_fingerprints(rng, 300, 20, 5))
    units = np.sort(rng.integers(0, 9, len(fps)))
    a, b = simhash.bucket_links(units, fps, 4, small=small)
    parent = {int(f): int(f) for f in fps}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for x, y in zip(a.tolist(), b.tolist()):
        parent[root(x)] = root(y)
    for u in np.unique(units):
        own = fps[units == u]
        label = plain_components(own, 4)
        roots = [root(int(f)) for f in own]
        assert all((label[i] == label[j]) == (roots[i] == roots[j]) for i in range(len(own)) for j in range(len(own)))


def test_links_find_every_pair_across_buckets(spark):
    """Whole search against all pairs, with tiles so small that every bucket
    of the dense group is cut."""
    rng = np.random.default_rng(11)
    fps = np.unique(np.concatenate([near_fingerprints(rng, 400, 40, 6), near_fingerprints(rng, 200, 1, 7)]))
    df = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long")
    label = dict(connected_components(simhash.links(df, 4, tile=8)).collect())
    want = plain_components(fps, 4)
    own = [label.get(int(x), int(x)) for x in fps.view(np.int64)]
    groups = {}
    for w, o in zip(want, own):
        assert groups.setdefault(w, o) == o
    assert len(set(groups.values())) == len(groups)


def test_near_duplicates_of_awkward_rows(spark):
    docs = documents(spark, AWKWARD)
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == len(AWKWARD) + 2
    by_id = {r.doc_id: r for r in got if r.doc_id is not None}
    for i, t in enumerate(AWKWARD):
        assert by_id[i].fingerprint == f"{plain_fingerprint(t):016x}"
    assert by_id[0].component_id == by_id[1].component_id == by_id[2].component_id == 0
    assert by_id[5].component_id == by_id[6].component_id == 5
    assert [r.component_id for r in got if r.doc_id is None] == [None]


def test_empty_table(spark):
    empty = documents(spark, ["a"]).limit(0)
    assert simhash.near_duplicates(empty).count() == 0
    assert simhash.keep_one(empty).columns == empty.columns


def test_keep_one_leaves_one_of_each_group(spark):
    docs = documents(spark, AWKWARD)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    ids = sorted((r.doc_id for r in kept.collect()), key=lambda x: (x is None, x))
    assert ids == [0, 3, 4, 5, 7, 8, 9, None]


def test_components_of_chains_stars_and_cycles(spark):
    chain = [(i, i + 1) for i in range(0, 60)]
    star = [(100, i) for i in range(101, 160)]
    cycle = [(200 + i, 200 + (i + 1) % 7) for i in range(7)]
    df = spark.createDataFrame(chain + star + cycle + [(300, 300), (0, 1)], "a long, b long")
    label = dict(connected_components(df).collect())
    assert all(label[i] == 0 for i in range(61)) and all(label[i] == 100 for i in range(100, 160))
    assert all(label[200 + i] == 200 for i in range(7)) and 300 not in label
