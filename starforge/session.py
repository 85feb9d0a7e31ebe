"""Session helpers.

The library never hard-codes a cluster layout. It reads what the session
already says (shuffle partitions, checkpoint folder) and only fills in a
value where none is set, which is the case in local tests.
"""

from __future__ import annotations

import logging
import os
import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

_log = logging.getLogger("starforge")

# Settings every job of the toolkit relies on. AQE re-plans joins from runtime
# sizes (a lookup side that turns out small becomes a broadcast) and splits
# skewed shuffle partitions of joins.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(
    app: str = "starforge",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the toolkit defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for staged tables, stream checkpoints and landings.

    Taken from the session (``spark.checkpoint.dir`` or the context's
    checkpoint dir). Only when neither is set and the master is local (tests)
    a fresh local folder is created and registered, so later calls agree on
    it; on a cluster a missing setting is an error, never a local folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return (sc.getCheckpointDir() or conf_dir).rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors (staged tables, stream checkpoints)")
    local = tempfile.mkdtemp(prefix="starforge-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(local)
    return (sc.getCheckpointDir() or local).rstrip("/")


def scratch_path(spark: SparkSession, *parts: str, unique: bool = True) -> str:
    """A path below the checkpoint root; unique per call unless told not to be."""
    root = checkpoint_root(spark)
    tail = "/".join(p.strip("/") for p in parts if p)
    if unique:
        tail = f"{tail}/{uuid.uuid4().hex}" if tail else uuid.uuid4().hex
    return f"{root}/{tail}"


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


# Staging scopes, per thread: a scope lists the staged paths to remove when
# its ``staging()`` block ends. Worker threads adopt their caller's scope.
_LOCAL = threading.local()


def _scopes() -> list[list[str]]:
    if not hasattr(_LOCAL, "stack"):
        _LOCAL.stack = []
    return _LOCAL.stack


def current_scope() -> list[str] | None:
    stack = _scopes()
    return stack[-1] if stack else None


@contextmanager
def adopt_scope(scope: list[str] | None):
    """Run a block of a worker thread inside the caller's staging scope."""
    if scope is None:
        yield
        return
    _scopes().append(scope)
    try:
        yield
    finally:
        _scopes().pop()


def stage(df, name: str):
    """Write ``df`` as parquet below the checkpoint root and read it back.

    Cuts the lineage (a lost executor recomputes from the staged files, not
    from the sources) and freezes values that must agree between several
    branches of one plan, such as range-partition ids. Inside ``staging()``
    the files are removed when the block ends.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "stage", name)
    df.write.mode("overwrite").parquet(path)
    scope = current_scope()
    if scope is not None:
        scope.append(path)
    return spark.read.parquet(path)


@contextmanager
def staging(spark: SparkSession):
    """Remove every table staged inside the block when it ends well (the
    DataFrames read from them must not be used afterwards).

    If the block fails, the staged tables are kept and their paths logged:
    a failed overwrite can be redone from the staged copy, which may be the
    only complete version of the partitions it was replacing.
    """
    scope: list[str] = []
    _scopes().append(scope)
    try:
        yield scope
    except BaseException:
        _scopes().pop()
        if scope:
            _log.warning("kept staged tables after a failure: %s", ", ".join(scope))
        raise
    else:
        _scopes().pop()
        for path in list(scope):
            remove_path(spark, path)


# Rows that one task holds in a sort. A bound in rows: ordered rows of few different
# values shrink to some bytes each in a shuffle, so a partition of the advisory
# size may hold tens of times that size in memory.
TASK_ROWS = 1 << 19


def task_count(staged) -> int:
    """Partitions in which a staged (or stored) frame has about ``TASK_ROWS`` rows each; the count reads file footers."""
    return max(1, -(-staged.count() // TASK_ROWS))


def remove_path(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def scale_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings sized from the data, for a cluster run.

    * ``spark.sql.files.maxPartitionBytes``: scan splits of the target size;
    * ``spark.sql.shuffle.partitions``: enough that one shuffle partition of
      the full input is about the target size (at least two waves of tasks);
      AQE coalesces the small ones at runtime
      (``advisoryPartitionSizeInBytes``) and splits skewed join partitions;
    * the broadcast threshold stays a size check (64 MB), never a hint on data
      whose size grows with the input.

    Example: 100 TB on 1,000 executors x 8 cores: 409,600 partitions of 256 MB
    for a shuffle of the whole input. Most shuffles here carry projected and
    partially aggregated rows, far less than the input, and AQE coalesces.
    """
    parts = max(2 * total_cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
    }
