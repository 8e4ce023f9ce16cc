"""Shared plumbing: reading tables, intermediate tables, Arrow row access.

Intermediate tables go to the folder that the session names in
``spark.checkpoint.dir`` (every executor sees it) and are removed when the
driver process ends.
"""

from __future__ import annotations

import atexit
import contextlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.session import ensure_checkpoint_dir

_MADE: list[str] = []


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One input table, by any path that Spark can read."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, removed at the end of the process."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/wardline-llm/{name}-{uuid.uuid4().hex}"
    _MADE.append(path)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and go on from the written table: later passes and
    lost executors read it instead of running the upstream plan again."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def filesystem(path: str):
    """(file system, path in it) of a shared path, for files that Spark's
    writers do not make."""
    from pyarrow import fs
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path if "://" in path else f"file://{path}")


@atexit.register
def _remove_made() -> None:
    for path in _MADE:
        try:
            system, inside = filesystem(path)
            system.delete_dir(inside)
        except (OSError, ValueError, pa.ArrowException):
            continue


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def id_crc(id_col: str) -> F.Column:
    """crc32 of the id's decimal text: the fold key of the held-out splits."""
    return F.crc32(F.col(id_col).cast("string").cast("binary"))


def window_of(text: F.Column, id_col: str, longest: int) -> F.Column:
    """A text of at most ``longest`` characters: itself, or a stretch of it at
    a place given by a hash of the id.  Bounds what a model is trained on
    without leaving long texts out."""
    spare = F.length(text) - F.lit(longest)
    start = F.pmod(F.xxhash64(id_col), F.greatest(spare, F.lit(0)) + 1).cast("int") + 1
    return F.when(spare > 0, F.substr(text, start, F.lit(longest))).otherwise(text)


def fresh(columns: list[str], name: str) -> str:
    """``name``, with underscores added until no column is called that."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def broadcast_object(spark: SparkSession, value):
    """Broadcast an object of this package (bounded by its own parameters);
    tasks read it with :func:`unpacked`."""
    from pyspark import cloudpickle
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def unpacked(shared):
    import pickle
    return pickle.loads(shared.value)


@contextlib.contextmanager
def without_gc():
    """No cycle collector inside: code that makes many strings and lists but
    no reference cycles would have it walk over them again and again."""
    import gc
    on = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if on:
            gc.enable()


def _give_back() -> None:
    """Return freed memory to the system, where the allocator can."""
    import ctypes
    import gc
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):          # another C library
        return


def worker_state(key: str, make):
    """``make()``, once per Python worker process: later tasks of the same
    stage find it again.  For caches only.  A worker keeps one at a time: the
    next operator's tasks let the last one's go."""
    import sys
    import types
    held = sys.modules.setdefault("_wardline_worker_state", types.SimpleNamespace(key=None, value=None))
    if held.key != key:
        held.key, held.value = None, None
        _give_back()
        held.value = make()
        held.key = key
    return held.value


def pylist_batches(batch: pa.RecordBatch, size_col: str, budget: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """Cut a record batch so that the strings of ``size_col`` in each slice
    hold at most ``budget`` bytes (a longer single text is a slice of its own)."""
    import numpy as np
    import pyarrow.compute as pc
    if batch.num_rows == 0:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(size_col))), 0)
    groups = np.cumsum(sizes.to_numpy(zero_copy_only=False).astype(np.int64)) // budget
    cuts = [0, *(np.flatnonzero(np.diff(groups)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield batch.slice(a, b - a)
