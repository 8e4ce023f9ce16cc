import hashlib
import random
import zlib

import pytest

from wardline.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string"


def plain(rows, block, heads):
    """The trie by dictionaries of whole rebuilt sequences."""
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            key = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
            own.setdefault(c, []).append((turn is not None, turn or 0, key, role, text))
    own = {c: [(r, x) for *_, r, x in sorted(t)] for c, t in own.items()}
    nodes = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % heads
        whole = own.get(c - c % block, [])[:h] + turns[h:]
        for d in range(len(whole) + 1):
            node = nodes.setdefault(tuple(whole[:d]), {"members": [], "ends": []})
            node["members"].append(c)
            if d == len(whole):
                node["ends"].append(c)
    out = []
    for path, node in nodes.items():
        under = [(p, n) for p, n in nodes.items() if p[:len(path)] == path]
        out.append((min(node["members"]), len(path), min(nodes[path[:-1]]["members"]) if path else None, len(node["members"]),
                    sum(len(p) == len(path) + 1 for p, _ in under),
                    sum(all(q[:-1] != p or not q for q in nodes) for p, _ in under),
                    sum((len(n["members"]) - 1) * len(p[-1][1]) for p, n in under if p),
                    hashlib.sha256(",".join(map(str, sorted(node["ends"]))).encode()).hexdigest()))
    return sorted(out, key=str)


def run(spark, rows, **how):
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS conv", "'x' AS fp", "2 AS depth", "3 AS part", "4 AS ord")
    got = trie.prefix_trie(df.repartition(3), **how)
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted((tuple(r) for r in got.select(*names).collect()), key=str)


@pytest.mark.parametrize("seed", range(3))
def test_same_as_whole_sequences(spark, seed):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(240), 90):
        rows += [(c, k if rng.random() < 0.95 else None, rng.choice(["user", "bot", None]), rng.choice(["a", "bb", "", None, "ünï😀"]))
                 for k in range(rng.randint(1, 9))]
    rows += [rows[0], (None, 1, "user", "no conversation"), (3, 1, "user", "tie"), (3, 1, "user", "another tie")]
    assert run(spark, rows, block=10, heads=6) == plain(rows, 10, 6)


def test_one_conversation_and_one_turn_hold_most_rows(spark):
    rows = [(c, 0, "user", "the same first turn") for c in range(1, 150)]
    rows += [(c, 1, "bot", f"answer {c % 3}") for c in range(1, 150)]
    rows += [(200, k, "user", f"turn {k % 2}") for k in range(300)]          # many ranges long
    assert run(spark, rows, block=100, heads=6) == plain(rows, 100, 6)


def test_conversations_without_turns_left(spark):
    rows = [(c, 0, "user", "x") for c in (101, 102, 205, 313)]               # no base, one turn: most are empty
    got = run(spark, rows, block=100, heads=6)
    assert got == plain(rows, 100, 6) and any(r[1] == 0 for r in got)
    assert run(spark, []) == [] and run(spark, [(None, 0, "user", "x")]) == []


def test_another_base_when_fingerprints_collide(spark):
    rows = [(c, k, "user", f"{c % 7} {k}") for c in range(40) for k in range(4)]
    want = plain(rows, 100, 6)
    assert run(spark, rows, bases=(0, 0x1B873593CC9E2D51)) == want           # 0: only the last turn counts
    with pytest.raises(ArithmeticError):
        run(spark, rows, bases=(0,))


def test_long_lists_of_ids(spark):
    df = spark.range(1000).selectExpr("1L AS depth", "id % 2 AS fp", "id AS conv")
    got = {r.fp: r.ends_sha256 for r in trie.id_digests(df, chunk=7).collect()}
    assert got == {k: hashlib.sha256(",".join(map(str, range(k, 1000, 2))).encode()).hexdigest() for k in (0, 1)}
