"""Session settings shared by batch and streaming code.

Every event time in this library is a UTC wall-clock value, so the session time
zone is pinned to UTC; casts between TIMESTAMP_NTZ (what the tables store) and
TIMESTAMP (what watermarks need) are then lossless.
"""

from __future__ import annotations

import atexit
import os
import re
import uuid
import warnings
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

_UTC = "UTC"


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the queries rely on (idempotent)."""
    conf = spark.conf
    if conf.get("spark.sql.session.timeZone", None) != _UTC:
        conf.set("spark.sql.session.timeZone", _UTC)
    conf.set("spark.sql.adaptive.enabled", "true")
    conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    return spark


@contextmanager
def setting(spark: SparkSession, key: str, value: str):
    """A runtime setting for the actions inside the block."""
    previous = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if previous is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, previous)


def use_rocksdb_state(spark: SparkSession) -> None:
    """Keep streaming state in RocksDB (off-heap, spills to local disk, checkpointed).

    Must be set before a query's first run; the provider is pinned by its checkpoint.
    """
    spark.conf.set("spark.sql.streaming.stateStore.providerClass",
                   "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints, stream state and written intermediate tables.

    Read from the session (``spark.checkpoint.dir``); on a cluster this must be
    storage that driver and executors share, and this raises if the session names none.
    A local session, whose driver and executors are one process, gets a folder in its warehouse.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir is not set; point it at shared storage (HDFS/S3/...)")
        root = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_sensorlake_checkpoints"
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


class ScratchOwner:
    """Deletes the folders that ``scratch_path`` made inside its block::

        with scratch(spark):
            first_close_pairs(events).write.parquet(target)

    A result is lazy, so it must be written (or collected) before the block ends.
    Streaming callbacks run in threads of their own, outside of any block.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []
        # kept: a session that was stopped has neither any more
        self._jvm, self._conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()

    def __enter__(self) -> ScratchOwner:
        self._token = _OWNER.set(self)
        return self

    def __exit__(self, *_) -> None:
        _OWNER.reset(self._token)
        self.delete()

    def delete(self) -> None:
        while self.paths:
            path = self._jvm.org.apache.hadoop.fs.Path(self.paths.pop())
            path.getFileSystem(self._conf).delete(path, True)


_OWNER: ContextVar[ScratchOwner | None] = ContextVar("scratch_owner", default=None)
_UNOWNED: list[ScratchOwner] = []       # one a session: folders made outside of any block


def scratch(spark: SparkSession) -> ScratchOwner:
    return ScratchOwner(spark)


@atexit.register
def _delete_unowned() -> None:
    """When the driver program ends, nobody can read what it made outside of a block."""
    for owner in _UNOWNED:
        try:
            owner.delete()
        except Exception as e:      # the session's JVM may be gone
            warnings.warn(f"scratch folders are left under {owner.paths}: {e}", stacklevel=1)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint root; deleted with its ``scratch`` block, or
    when the driver program ends."""
    path = f"{checkpoint_root(spark)}/sensorlake/{name}-{uuid.uuid4().hex}"
    owner = _OWNER.get()
    if owner is None:
        owner = next((o for o in _UNOWNED if o.spark is spark), None)
        if owner is None:
            owner = ScratchOwner(spark)
            _UNOWNED.append(owner)
    owner.paths.append(path)
    return path


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "sensorlake") -> SparkSession:
    """Session for tests and the local bench (``local[cpus]``).

    Sets ``spark.checkpoint.dir`` only when the environment leaves it unset.
    """
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", _UTC)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", os.environ.get("SENSORLAKE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.conf.get("spark.checkpoint.dir", None) and spark.sparkContext.getCheckpointDir() is None:
        # a local session only, whose driver and executors are one process
        fallback = os.environ.get("SENSORLAKE_CHECKPOINT_DIR", "/tmp/sensorlake-checkpoints")
        spark.sparkContext.setCheckpointDir(fallback)
    return configure(spark)


#: Plans without statistics (a stream's batch, say) are given enormous sizes, which say nothing.
_NO_ESTIMATE = 1 << 60


def estimated_bytes(df) -> int | None:
    """Catalyst's size estimate of a DataFrame's plan (file sizes for scans); None for a plan without statistics."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return size if size < _NO_ESTIMATE else None


_SIZE_UNITS = {"": 1, "b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20,
               "g": 1 << 30, "gb": 1 << 30, "t": 1 << 40, "tb": 1 << 40}


def size_bytes(text: str) -> int:
    """'64m' / '128MB' / '1g' / '1048576' -> bytes (Spark's size-string convention)."""
    t = text.strip().lower()
    digits = t.rstrip("abcdefghijklmnopqrstuvwxyz")
    return int(float(digits) * _SIZE_UNITS[t[len(digits):].strip()])


def advisory_bytes(spark: SparkSession) -> int:
    return size_bytes(spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64m"))


def partitions_for_size(spark: SparkSession, size: int | None) -> int:
    """One partition per advisory partition size, and enough for all cores; the session's shuffle
    partitions where the size isn't known."""
    shuffle = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if size is None:
        return shuffle
    return max(min(spark.sparkContext.defaultParallelism, shuffle), -(-size // max(advisory_bytes(spark), 1)))


def delete_path(spark: SparkSession, path: str) -> bool:
    """Recursively delete a folder this library wrote (any Hadoop-compatible file system)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.delete(hpath, True))


def _listed(spark: SparkSession, path: str):
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.listStatus(hpath) if fs.exists(hpath) else []


def child_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in ``path``; none if there is no such folder."""
    return sorted(s.getPath().getName() for s in _listed(spark, path) if s.isDirectory())


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders and data files in ``path``."""
    names = (s.getPath().getName() for s in _listed(spark, path))
    return sorted(n for n in names if not n.startswith(("_", ".")))


def path_exists(spark: SparkSession, path: str) -> bool:
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return bool(hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hpath))


def move_folder(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder; ``target`` must not exist, the folder it is to stand in is made."""
    old, new = (spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p) for p in (source, target))
    fs = old.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(new):
        raise FileExistsError(target)
    fs.mkdirs(new.getParent())
    if not fs.rename(old, new):
        raise OSError(f"{source} could not be moved to {target}")
