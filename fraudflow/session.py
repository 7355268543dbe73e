"""Spark session helpers.

The library never creates a session behind the caller's back: every
function takes the caller's ``SparkSession`` or DataFrame.  ``get_spark`` is
the convenience used by tests, ``bench.py`` and the command-line jobs.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar
from functools import lru_cache

from pyspark.sql import SparkSession

_SCRATCH: ContextVar[str | None] = ContextVar("scratch", default=None)

# AQE re-plans joins from measured shuffle sizes (broadcast when the real
# output is small), coalesces small shuffle partitions and splits skewed
# ones.  Explicit broadcasts in the library are only for proven bounds.
_DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.showConsoleProgress": "false",
    # window state grows with keys x open windows: keep it off the JVM heap
    # (RocksDB spills to local disk, checkpoints to spark.checkpoint.dir)
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
# Local runs (tests, bench): few cores, tiny files.  On a cluster the
# shuffle width stays as the deployment sets it (sized to the data: a few
# hundred MB per partition), and AQE coalesces what turns out small.
_LOCAL_CONF = {
    "spark.sql.shuffle.partitions": "8",
}


def get_spark(master: str | None = None, app: str = "fraudflow",
              conf: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the library is tuned for."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in {**_DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(k, v)
    if master and master.startswith("local"):
        builder = builder.config("spark.driver.memory",
                                 os.environ.get("FRAUDFLOW_DRIVER_MEMORY", "8g"))
        # fixed when the session starts: no web page for local runs
        builder = builder.config("spark.ui.enabled", (conf or {}).get("spark.ui.enabled", "false"))
    spark = builder.getOrCreate()
    if spark.sparkContext.master.startswith("local"):
        for k, v in _LOCAL_CONF.items():
            if k not in (conf or {}):
                spark.conf.set(k, v)
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names a shared file system folder and is
    used as is.  Only when it is unset (local tests) a folder of our own is
    created and registered.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder: checkpoints, "
                               "stream state and intermediate tables must survive "
                               "the loss of any executor")
        d = tempfile.mkdtemp(prefix="fraudflow-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


#: records a batch that one state partition takes in
STATE_RECORDS = 10_000


def stream_session(spark: SparkSession, records: int | None = None) -> SparkSession:
    """A session of a stream's own, its state partitions sized to the cluster's cores and,
    if a batch has at most ``records`` records, to those.

    A state partition costs a task and a file or two in each batch.  In a local folder
    the checkpoints are renamed into place by way of the file system, as the file
    context starts a process for each look at a file there.
    """
    own, width = spark.newSession(), spark.sparkContext.defaultParallelism
    if records:
        width = min(width, -(-records // STATE_RECORDS))
    own.conf.set("spark.sql.shuffle.partitions", str(width))
    own.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    if ensure_checkpoint_dir(spark).startswith(("file:", "/")):
        own.conf.set("spark.sql.streaming.checkpointFileManagerClass",
                     "org.apache.spark.sql.execution.streaming.checkpointing.FileSystemBasedCheckpointFileManager")
    return own


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint folder.

    Used for intermediate tables, stream sinks and stream checkpoints so
    they live on the cluster's shared storage, never on one machine.
    """
    base = _SCRATCH.get() or ensure_checkpoint_dir(spark).rstrip("/") + "/fraudflow-work"
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def scratch(spark: SparkSession, name: str):
    """Work paths asked for inside lie below one folder, which is removed at the end.

    What is to outlast it must be written to a path asked for outside.
    """
    folder = work_path(spark, name)
    token = _SCRATCH.set(folder)
    try:
        yield folder
    finally:
        _SCRATCH.reset(token)
        remove(spark, folder)


@lru_cache(maxsize=2)
def _path_class(jvm):
    """Looked up once: each part of a name is a call."""
    return jvm.org.apache.hadoop.fs.Path


def _file_system(spark: SparkSession, path: str):
    p = _path_class(spark.sparkContext._jvm)(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists on the file system that Spark reads it from."""
    p, fs = _file_system(spark, path)
    return fs.exists(p)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, none if it isn't there."""
    p, fs = _file_system(spark, path)
    return [f.getPath().getName() for f in fs.listStatus(p)] if fs.exists(p) else []


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder of the library's own."""
    p, fs = _file_system(spark, path)
    fs.delete(p, True)


def put_bytes(spark: SparkSession, path: str, content: bytes) -> None:
    """Write a small file in place of one that may be there."""
    p, fs = _file_system(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(content))
    finally:
        out.close()


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """``put_bytes`` of a text."""
    put_bytes(spark, path, text.encode())


def publish(spark: SparkSession, staged: str, path: str) -> None:
    """Rename a finished folder to ``path`` unless that is there already.

    On file systems with an atomic rename, readers see all of it or nothing,
    and what was published once is never replaced.
    """
    src, fs = _file_system(spark, staged)
    dst, _ = _file_system(spark, path)
    if fs.exists(dst):
        fs.delete(src, True)
        return
    fs.mkdirs(dst.getParent())
    if not fs.rename(src, dst):
        raise OSError(f"cannot rename {staged} to {path}")
