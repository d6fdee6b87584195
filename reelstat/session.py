"""Session helpers: a local session for tests/bench and the checkpoint folder rule."""

from __future__ import annotations

import os
import tempfile
from contextlib import contextmanager
from weakref import WeakKeyDictionary

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "reelstat") -> SparkSession:
    """A local session configured like a small cluster (AQE on, UI off, UTC)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and model tables.

    ``spark.checkpoint.dir`` of the session (Spark names its context's checkpoint
    folder from it), else the folder set on the context. Only a local-mode
    session with neither gets a fresh scratch folder, set on the context alone:
    the setting itself cannot change in a running session.
    """
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not path:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder for this cluster")
        path = tempfile.mkdtemp(prefix="reelstat-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path.rstrip("/")


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder."""
    return os.path.join(checkpoint_dir(spark), *parts)


def materialize(df, name: str):
    """Cut lineage by writing ``df`` once as parquet under the checkpoint folder and reading it back.

    One job (``DataFrame.checkpoint`` computes its input twice unless cached),
    columnar and prunable on read, and on shared storage so a lost executor
    does not replay the plan that built it. Its shuffle files go when it ends.
    """
    import uuid

    spark = df.sparkSession
    path = scratch_path(spark, "reelstat-tables", f"{name}-{uuid.uuid4().hex}")
    with settings(spark, SHUFFLES_GO):
        df.write.parquet(path)
    out = spark.read.parquet(path)
    _WRITTEN[out] = path
    return out


# shuffle files are deleted at the end of the job that made them, not when the driver happens to collect its garbage
SHUFFLES_GO = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}

_WRITTEN: WeakKeyDictionary = WeakKeyDictionary()  # where the tables of ``materialize`` lie


def forget(*tables) -> None:
    """Delete the files of ``materialize``d tables that nothing reads any more: their successors are written."""
    for df in tables:
        path = _WRITTEN.pop(df, None)
        if path is not None:
            spark = df.sparkSession
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]):
    """SQL settings for the jobs started inside the block; the session's own are put back after it."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


# Folders this library creates under the checkpoint folder (scratch: safe to remove between jobs).
SCRATCH_FOLDERS = ("reelstat-tables", "reelstat-scratch", "reelstat-runs", "reelstat-streams")


def clear_scratch(spark, root: str | None = None, keep_runs: bool = True) -> list[str]:
    """Remove this library's scratch folders under the checkpoint folder (or ``root``).

    Fit runs (``reelstat-runs``: saved models, logs) are kept unless
    ``keep_runs`` is False. Call it between jobs, never while a job still
    reads a written table. Returns the folders removed.
    """
    from pyarrow import fs as pafs

    base = (root or checkpoint_dir(spark)).rstrip("/")
    filesystem, path = (pafs.FileSystem.from_uri(base) if "://" in base else (pafs.LocalFileSystem(), base))
    removed = []
    for name in SCRATCH_FOLDERS:
        if keep_runs and name == "reelstat-runs":
            continue
        target = f"{path}/{name}"
        if filesystem.get_file_info(target).type == pafs.FileType.Directory:
            filesystem.delete_dir(target)
            removed.append(target)
    return removed
