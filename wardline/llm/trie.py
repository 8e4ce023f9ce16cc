"""Prefix trie of conversations that are rebuilt from a shared head and their
own suffix, without building them.

A sequence of turns has a fingerprint in a monoid: the product of ``x -> x * B
+ h(turn)`` modulo 2^61 - 1.  Products of neighbouring runs combine (``a`` then
``b`` of ``m`` turns is ``a * B^m + b``), and a known head divides out, so every
prefix of a rebuilt conversation has its fingerprint from three stored numbers:
the product of the base's head, and the products of the own turns up to the
head's length and up to the prefix's end.  Texts are read once, for the digests
of their turns.

Members of a prefix group share depth and fingerprint.  Their equality is
verified: each refers to its stored last turn (128 more bits of its digest) and
to the group of its first ``d - 1`` turns, and all must agree; if any group
fails, everything is worked out again with another ``B``.

A conversation's products are a scan over range partitions of (conversation,
turn) with carries between them, so a conversation of any length is spread over
tasks.  Sums over subtrees need no walk: a node belongs to its smallest
member, the nodes of one owner are a run of depths of its own path, and the
subtree of a node is what its members own from its depth on.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.llm.tables import shuffle_partitions, written
from wardline.operators.sequence import running_in_group

PRIME = (1 << 61) - 1
CHUNK = 4096                 # ids in one piece of text on the way to a digest


def turn_digests(conversations: DataFrame) -> DataFrame:
    """``conv, turn, digest, chars`` of every turn with a conversation."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    whole = F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary")
    return conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv"), "turn", F.unhex(F.sha2(whole, 256)).alias("digest"),
        F.length(text).cast("long").alias("chars"))


def products(turns: DataFrame, base: int) -> DataFrame:
    """Every turn with its place ``ord`` in its conversation (from 0), the
    products ``before`` it and up to it (``fp``), ``t1, t2`` and ``chars``."""
    spark = turns.sparkSession

    def scan(batches):
        from pyspark import TaskContext
        part, conv, n, fp = TaskContext.get().partitionId(), None, 0, 0
        for batch in batches:
            words = np.frombuffer(b"".join(batch.column(1).to_pylist()), "<u8").reshape(-1, 4)
            place, before, after = [], [], []
            for c, x in zip(batch.column(0).to_pylist(), (words[:, 0] % np.uint64(PRIME)).tolist()):
                if c != conv:
                    conv, n, fp = c, 0, 0
                place.append(n)
                before.append(fp)
                n, fp = n + 1, (fp * base + x) % PRIME
                after.append(fp)
            yield pa.RecordBatch.from_arrays(
                [pa.array([part] * len(place), pa.int32()), batch.column(0), *[pa.array(x, pa.int64()) for x in (place, before, after)],
                 *[pa.array(words[:, k].view("<i8")) for k in (1, 2)], batch.column(2)],
                ["part", "conv", "ord", "before", "fp", "t1", "t2", "chars"])

    order = ["conv", F.col("turn").asc_nulls_first(), "digest"]
    scanned = written(
        turns.repartitionByRange(shuffle_partitions(spark), *order).sortWithinPartitions(*order)
        .select("conv", "digest", "chars")
        .mapInArrow(scan, "part int, conv long, ord long, before long, fp long, t1 long, t2 long, chars long"), "products")

    # a conversation goes on in the next range only from the end of its range: two rows a range at most
    ranges = scanned.groupBy("part").agg(F.min("conv").alias("lo"), F.max("conv").alias("hi")).orderBy("part").collect()
    split = sorted({a.hi for a, b in zip(ranges, ranges[1:]) if a.hi == b.lo})
    if not split:
        return scanned.drop("part")
    totals = scanned.where(F.col("conv").isin(split)).groupBy("conv", "part").agg(
        F.max("ord").alias("last"), F.max_by("fp", "ord").alias("fp")).orderBy("conv", "part").collect()
    carry, at, n, fp = {}, None, 0, 0
    for r in totals:
        if r.conv != at:
            at, n, fp = r.conv, 0, 0
        carry[r.part, r.conv] = (n, fp)
        n, fp = n + r["last"] + 1, (fp * pow(base, r["last"] + 1, PRIME) + r.fp) % PRIME

    def go_on(batches):
        for batch in batches:
            rows = batch.to_pydict()
            for i, key in enumerate(zip(rows["part"], rows["conv"])):
                if found := carry.get(key):
                    n, fp = found
                    shift = fp * pow(base, rows["ord"][i], PRIME)
                    rows["before"][i] = (shift + rows["before"][i]) % PRIME
                    rows["fp"][i] = (shift * base + rows["fp"][i]) % PRIME
                    rows["ord"][i] += n
            yield pa.RecordBatch.from_pydict(rows, schema=batch.schema)
    return written(scanned.mapInArrow(go_on, scanned.schema), "products").drop("part")


def rebuilt(turns: DataFrame, block: int, heads: int) -> DataFrame:
    """How each conversation is put together: ``head`` turns of its block's
    first conversation (their rows in ``from_base``), then its own from
    ``h`` on; ``length`` in all, and the ``seed`` by which the products of its
    own turns differ from those of the rebuilt ones."""
    first = F.when(F.col("ord") < heads - 1, F.struct("ord", "before", "fp", "t1", "t2", "chars"))
    convs = written(turns.groupBy("conv").agg(F.count("*").alias("n"), F.sort_array(F.collect_list(first)).alias("own")), "heads")
    base = convs.select(F.col("conv").alias("base"), F.col("n").alias("base_n"), F.col("own").alias("base_own"))
    h = F.crc32(F.col("conv").cast("string").cast("binary")) % heads
    j = convs.select("conv", "n", "own", h.cast("int").alias("h"), (F.col("conv") - F.col("conv") % block).alias("base")) \
        .join(base, "base", "left").withColumn("head", F.least("h", F.coalesce("base_n", F.lit(0))).cast("int"))

    def product(rows, n):
        return F.coalesce(F.get(rows, n - 1)["fp"], F.lit(0))
    return j.select(
        "conv", "h", "head", (F.col("head") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length"),
        F.pmod(product("base_own", F.col("head")) - product("own", F.col("h")), F.lit(PRIME)).alias("seed"),
        F.when(F.col("head") > 0, F.slice("base_own", 1, F.col("head"))).alias("from_base"))


def members(turns: DataFrame, convs: DataFrame, base: int) -> DataFrame:
    """A row for each conversation and prefix of it that is not empty:
    ``conv, depth, fp, before`` (the prefix's and its parent's fingerprint),
    the last turn's ``t1, t2, chars``, and ``ends`` (1 for the whole)."""
    def suffix(batches):
        for batch in batches:
            rows = batch.to_pydict()
            fps, befores = [], []
            for fp, before, m, seed in zip(rows["fp"], rows["before"], rows["m"], rows["seed"]):
                shift = seed and seed * pow(base, m - 1, PRIME)
                befores.append((before + shift) % PRIME)
                fps.append((fp + shift * base) % PRIME)
            rows |= {"fp": fps, "before": befores}
            yield pa.RecordBatch.from_pydict({k: rows[k] for k in names}, schema=pa.schema([batch.schema.field(k) for k in names]))

    names = ["conv", "depth", "fp", "before", "t1", "t2", "chars", "ends"]
    head = convs.where("head > 0").select("conv", "length", F.explode("from_base").alias("r")).select(
        "conv", (F.col("r.ord") + 1).alias("depth"), *[f"r.{k}" for k in names[2:7]],
        (F.col("r.ord") + 1 == F.col("length")).cast("int").alias("ends"))
    m = F.col("ord") + 1 - F.col("h")
    # a conversation of very many turns is split by the adaptive join: what follows takes rows one by one
    own = turns.join(convs.drop("from_base"), "conv").where("ord >= h").select(
        "conv", (m + F.col("head")).alias("depth"), "fp", "before", "t1", "t2", "chars",
        (m + F.col("head") == F.col("length")).cast("int").alias("ends"), m.alias("m"), "seed")
    return head.unionByName(own.mapInArrow(suffix, own.drop("m", "seed").schema))


def id_digests(ends: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """``depth, fp`` with the SHA-256 of the decimal ids (column ``conv``),
    ascending and comma-joined.

    A digest is sequential by its nature: ids become pieces of text in range
    partitions, and one task streams a group's pieces through the digest in
    constant memory, ``chunk`` ids at a time."""
    def pieces(batches):
        key, ids = None, []
        for batch in batches:
            for depth, fp, conv in zip(*[c.to_pylist() for c in batch.columns]):
                if ids and (key != (depth, fp) or len(ids) == chunk):
                    yield one(key, ids)
                    ids = []
                key = (depth, fp)
                ids.append(conv)
        if ids:
            yield one(key, ids)

    def one(key, ids):
        return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in (
            (key[0], pa.int64()), (key[1], pa.int64()), (ids[0], pa.int64()), (",".join(map(str, ids)), pa.string()))],
            ["depth", "fp", "first", "ids"])

    def digest(batches):
        key, state = None, None
        for batch in batches:
            out = []
            for depth, fp, ids in zip(*[c.to_pylist() for c in batch.columns]):
                if key != (depth, fp):
                    if state:
                        out.append((*key, state.hexdigest()))
                    key, state = (depth, fp), hashlib.sha256()
                else:
                    state.update(b",")
                state.update(ids.encode())
            if out:
                yield table(out)
        if state:
            yield table([(*key, state.hexdigest())])

    def table(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), (pa.int64(), pa.int64(), pa.string()))],
                                          ["depth", "fp", "ends_sha256"])
    n = shuffle_partitions(ends.sparkSession)
    texts = ends.select("depth", "fp", "conv").repartitionByRange(n, "depth", "fp", "conv") \
        .sortWithinPartitions("depth", "fp", "conv").mapInArrow(pieces, "depth long, fp long, first long, ids string")
    return texts.repartition(n, "depth", "fp").sortWithinPartitions("depth", "fp", "first").select("depth", "fp", "ids") \
        .mapInArrow(digest, "depth long, fp long, ends_sha256 string")


def prefix_trie(conversations: DataFrame, block: int = 100, heads: int = 6, bases: tuple[int, ...] = (
        0x1B873593CC9E2D51, 0x0F51AFD7ED558CCD, 0x04CEB9FE1A85EC53, 0x1E3779B97F4A7C15)) -> DataFrame:
    """One row per node of the trie of rebuilt conversations: ``conv_id,
    depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256``.

    Conversation ``c`` is the first ``h = crc32(c) % heads`` turns of
    conversation ``c - c % block`` (as many as there are) and then its own after
    its first ``h``.  Turns go by ``turn``, null first, those with an equal
    ``turn`` by the SHA-256 of role and text, so repeated rows are repeated
    turns.  A null role or text is empty.  Rows without ``conv_id`` belong to no
    conversation and are left out; other columns are ignored; no conversations
    give no rows, not even a root.
    """
    digests = written(turn_digests(conversations), "turns")
    for base in bases:
        turns = products(digests, base)
        convs = written(rebuilt(turns, block, heads), "rebuilt")
        rows = written(members(turns, convs, base), "members")
        same = [F.min(c) != F.max(c) for c in ("before", "t1", "t2", "chars")]
        nodes = written(rows.groupBy("depth", "fp").agg(
            F.min("conv").alias("conv_id"), F.count("*").alias("n_convs"), F.sum("ends").alias("n_ends"),
            F.min("before").alias("before"), F.min("chars").alias("chars"),
            (same[0] | same[1] | same[2] | same[3]).alias("mixed")), "nodes")
        if not nodes.where("mixed").limit(1).count():
            return _described(rows, nodes, convs)
    raise ArithmeticError("prefix groups of different turns under every base")


def _described(rows: DataFrame, nodes: DataFrame, convs: DataFrame) -> DataFrame:
    """The nodes with their parents, children, subtree sums and ends."""
    saved = (F.col("n_convs") - 1) * F.col("chars")
    leaf = (F.col("n_ends") == F.col("n_convs")).cast("long")
    # what each conversation owns, and of it what lies at a node's depth or deeper
    owned = nodes.groupBy(F.col("conv_id").alias("conv")).agg(F.sum(saved).alias("owned"), F.max(leaf).alias("leaf"))
    deeper = running_in_group(nodes.withColumn("up", -F.col("depth")), "conv_id", ["up"], {"below": saved})
    sums = rows.select("conv", "depth", "fp").join(owned, "conv", "left").groupBy("depth", "fp").agg(
        F.sum("owned").alias("all_owned"), F.min_by("owned", "conv").alias("own"), F.sum("leaf").alias("n_leaves"))
    children = nodes.groupBy((F.col("depth") - 1).alias("depth"), F.col("before").alias("fp")).agg(F.count("*").alias("n_children"))
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("fp").alias("before"), F.col("conv_id").alias("parent"))
    ends = id_digests(rows.where("ends = 1").select("depth", "fp", "conv").unionByName(
        convs.where("length = 0").select(F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("fp"), "conv")))
    all_ = convs.agg(F.min("conv").alias("conv_id"), F.count("*").alias("n_convs"))
    forest = nodes.agg(F.sum(saved).alias("saved_tokens"), F.sum(leaf).alias("n_leaves"))
    none = F.lit(None).cast("long")
    root = all_.where("n_convs > 0").select(
        F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("fp"), "conv_id", none.alias("parent_conv_id"),
        "n_convs", F.coalesce(forest.select("n_leaves").scalar(), F.lit(1)).alias("n_leaves"),
        F.coalesce(forest.select("saved_tokens").scalar(), F.lit(0)).alias("saved_tokens"))
    top = all_.select("conv_id").scalar()
    inner = deeper.join(parents, ["depth", "before"], "left").join(sums, ["depth", "fp"]).select(
        "depth", "fp", "conv_id", F.when(F.col("depth") == 1, top).otherwise(F.col("parent")).alias("parent_conv_id"),
        "n_convs", "n_leaves", (F.col("all_owned") - F.col("own") + F.col("below")).alias("saved_tokens"))
    empty = F.lit(hashlib.sha256(b"").hexdigest())
    return root.unionByName(inner).join(children, ["depth", "fp"], "left").join(ends, ["depth", "fp"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"), "n_leaves",
        "saved_tokens", F.coalesce("ends_sha256", empty).alias("ends_sha256"))
