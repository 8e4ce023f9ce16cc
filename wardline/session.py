"""Session construction and lineage helpers."""

from __future__ import annotations

import atexit
import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every pipeline relies on: timestamps are wall-clock (NTZ) values,
# so the session zone is pinned; AQE re-plans joins and coalesces partitions.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "wardline", extra: dict | None = None) -> SparkSession:
    """Return the active session or build one with :data:`BASE_CONF`.

    ``master`` is only applied when a new local session is created (tests,
    bench); on a cluster the submit command decides.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's ``spark.checkpoint.dir``; only when it is unset
    (local tests) create a private scratch folder for it."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir() if hasattr(sc, "getCheckpointDir") else None
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not re.match(r"local(\[|$)", str(sc.master)):       # local-cluster has executors of its own
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        configured = tempfile.mkdtemp(prefix="wardline-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        try:
            spark.conf.set("spark.checkpoint.dir", configured)
        except Exception:  # some deployments refuse core keys at run time
            pass
    sc.setCheckpointDir(configured)
    return configured


_TABLES: list[str] = []


def table_path(spark: SparkSession, name: str) -> str:
    """A new path for an intermediate table in the shared folder; what is
    written there is removed by :func:`drop_tables`, at the latest when the
    driver process ends."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/wardline-tables/{name}-{uuid.uuid4().hex}"
    _TABLES.append(path)
    return path


def remove_table(path: str) -> None:
    """Remove one table or checkpoint in the shared folder."""
    from pyarrow import fs
    uri = "file:///" + path[5:].lstrip("/") if path.startswith("file:") else path
    try:
        system, inside = fs.FileSystem.from_uri(uri if "://" in uri else f"file://{uri}")
        system.delete_dir(inside)
    except (OSError, ValueError):      # gone already, or a store that only Spark reaches
        pass


def drop_tables(since: int = 0) -> None:
    """Remove the intermediate tables made since number ``since`` (see
    :func:`tables_made`); for callers that have taken their results."""
    while len(_TABLES) > since:
        remove_table(_TABLES.pop())


def tables_made() -> int:
    return len(_TABLES)


atexit.register(drop_tables)


def cut_lineage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Materialise ``df`` as a parquet table in the shared checkpoint folder
    and continue from that table.

    Used before a fitted transform makes several passes over the same input:
    the upstream plan runs once, later passes read only the columns they
    need, and an executor loss re-reads the table instead of recomputing the
    lineage.
    """
    path = table_path(df.sparkSession, name)
    df.write.mode("error").parquet(path)
    return df.sparkSession.read.parquet(path)


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin a file scan that has fewer files than the session has
    shuffle partitions, before CPU-heavy per-row work (regex, tokenizing).

    A table of many files is returned unchanged, so no shuffle is added where
    the scan is parallel already; so is anything above a shuffle, which has
    its partitions from there.  Nothing runs while this decides.
    """
    target = min_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    files = len(df.inputFiles())
    return df.repartition(target) if 0 < files < min(target, 8) else df
