"""Published tables as parquet snapshots below one root folder.

A table is a folder of snapshots ``snap-000001``, ``snap-000002``...; the
current one is the highest with a ``_COMMITTED`` marker, created once the
snapshot's write job has committed (so a failed write is never current; the
job's own ``_SUCCESS`` is not kept by dynamic partition overwrites). This is a publish convention on
plain parquet, not a table format:

* ``append``   - new files into the current snapshot (insert-only merges);
* ``replace``  - a new snapshot (rewrites). It may read the current one, since
                 it writes elsewhere; readers switch when the commit lands;
* ``overwrite_partitions`` - replace only the partitions present in the
                 data (dynamic partition overwrite), from a staged copy so the
                 job never reads what it overwrites.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import remove_path, stage, staging, task_count

SNAP_PREFIX = "snap-"
COMMIT_MARK = "_COMMITTED"
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def _hadoop_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence test through the session's Hadoop file system."""
    p, fs = _hadoop_path(spark, path)
    return bool(fs.exists(p))


def touch(spark: SparkSession, path: str) -> None:
    p, fs = _hadoop_path(spark, path)
    fs.create(p, True).close()


def partition_dir(cols: Sequence[str], values: Sequence) -> str:
    """Hive-style partition folder (``year=2024/month=1``), as the writer names it."""
    parts = []
    for c, v in zip(cols, values):
        text = NULL_PARTITION if v is None else str(v)
        parts.append(f"{c}={text}")
    return "/".join(parts)


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    p, fs = _hadoop_path(spark, path)
    if not fs.exists(p):
        return []
    return [st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory()]


def list_files(spark: SparkSession, path: str) -> list[str]:
    p, fs = _hadoop_path(spark, path)
    return [st.getPath().getName() for st in fs.listStatus(p) if st.isFile()] if fs.exists(p) else []


def data_files(spark: SparkSession, path: str) -> list[str]:
    """Names of a folder's data files and partition folders, sorted; one listing, names only."""
    p, fs = _hadoop_path(spark, path)
    jvm = spark.sparkContext._jvm
    paths = jvm.org.apache.hadoop.fs.FileUtil.stat2Paths(fs.listStatus(p))
    # one string for the whole folder instead of a call per file
    names = [f.rsplit("/", 1)[-1] for f in jvm.org.apache.commons.lang3.ArrayUtils.toString(paths).strip("{}").split(",")]
    return sorted(n for n in names if n and not n.startswith(("_", ".")))


def _sorted_ranges(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """Staged rows in sorted ranges of a bounded number of rows, one per task.

    The tasks follow from the row count: a partition value with most of the rows (the
    closed rows of a history) is dealt to many tasks, small ones share one. The
    row's place in the staged files splits rows that are equal in ``order``.
    """
    placed = rows.withColumn("_place", F.monotonically_increasing_id())
    return placed.repartitionByRange(task_count(rows), *order, "_place").sortWithinPartitions(*order).drop("_place")


class TableStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    # -- layout
    def table_dir(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _snap_dir(self, name: str, version: int) -> str:
        return f"{self.table_dir(name)}/{SNAP_PREFIX}{version:06d}"

    def versions(self, name: str) -> list[int]:
        out = []
        for d in list_dirs(self.spark, self.table_dir(name)):
            if d.startswith(SNAP_PREFIX) and path_exists(self.spark, f"{self.table_dir(name)}/{d}/{COMMIT_MARK}"):
                out.append(int(d[len(SNAP_PREFIX):]))
        return sorted(out)

    def current_version(self, name: str) -> int | None:
        v = self.versions(name)
        return v[-1] if v else None

    def exists(self, name: str) -> bool:
        return self.current_version(name) is not None

    def location(self, name: str) -> str:
        v = self.current_version(name)
        if v is None:
            raise FileNotFoundError(f"table {name} has no committed snapshot under {self.root}")
        return self._snap_dir(name, v)

    def partition_values(self, name: str, column: str, under: str = "") -> list[str]:
        """Values of a partition column present in the current snapshot
        (folder listing, no data read)."""
        base = self.location(name) + (f"/{under}" if under else "")
        return [d.split("=", 1)[1] for d in list_dirs(self.spark, base) if d.startswith(f"{column}=")]

    def files_version(self, name: str, under: str = "") -> str:
        """Digest of the data files' names (new with every write) of the current
        snapshot, or of the partition folder ``under`` it. A listing per folder."""
        base = self.location(name) + (f"/{under}" if under else "")
        names = [base.rsplit("/", 1)[-1]]
        for d in data_files(self.spark, base):
            names.append(self.files_version(name, f"{under}/{d}" if under else d) if "=" in d else d)
        return hashlib.sha256("\n".join(names).encode()).hexdigest()

    def partition_versions(self, name: str, column: str) -> dict[str, str]:
        """``files_version`` per value of the (first) partition column."""
        return {v: self.files_version(name, f"{column}={v}") for v in self.partition_values(name, column)}

    def marks(self, name: str, prefix: str) -> list[str]:
        """Marker files of the current snapshot (hidden from readers by their underscore)."""
        return [f for f in list_files(self.spark, self.location(name)) if f.startswith(prefix)]

    def mark(self, name: str, mark: str) -> None:
        touch(self.spark, f"{self.location(name)}/{mark}")

    def unmark(self, name: str, mark: str) -> None:
        remove_path(self.spark, f"{self.location(name)}/{mark}")

    def drop_partition(self, name: str, cols: Sequence[str], values: Sequence) -> None:
        remove_path(self.spark, f"{self.location(name)}/{partition_dir(cols, values)}")

    def partition_columns(self, name: str) -> list[str]:
        """Partition columns of the current snapshot, read off the folder names."""
        cols: list[str] = []
        base = self.location(name)
        while True:
            subs = [d for d in list_dirs(self.spark, base) if "=" in d and not d.startswith(("_", "."))]
            if not subs:
                return cols
            cols.append(subs[0].split("=", 1)[0])
            base = f"{base}/{subs[0]}"

    # -- read
    def read(self, name: str, merge_schema: bool = False) -> DataFrame:
        """Current snapshot. ``merge_schema`` reads every file footer (only
        needed after a feed grew a column), so it is off by default."""
        return self.spark.read.option("mergeSchema", str(merge_schema).lower()).parquet(self.location(name))

    # -- write
    def _write(
        self, df: DataFrame, path: str, mode: str, partition_by: Sequence[str], dynamic: bool = False, sort: Sequence[str] = (), staged: bool = False
    ) -> None:
        if sort:
            with staging(self.spark):
                rows = df if staged else stage(df, "sorted")
                self._write_files(_sorted_ranges(rows, [*partition_by, *sort]), path, mode, partition_by, dynamic)
            return
        if partition_by:
            # rows of one partition value together (few files per partition),
            # large values split by AQE into advisory-sized tasks
            df = df.hint("rebalance", *partition_by)
        self._write_files(df, path, mode, partition_by, dynamic)

    def _write_files(self, df: DataFrame, path: str, mode: str, partition_by: Sequence[str], dynamic: bool) -> None:
        w = df.write.mode(mode)
        if partition_by:
            w = w.partitionBy(*partition_by)
        # per-write option: a new snapshot never keeps what a failed attempt
        # left in its folder, whatever the session's setting is
        w = w.option("partitionOverwriteMode", "dynamic" if dynamic else "static")
        w.parquet(path)

    def create(
        self, name: str, df: DataFrame, partition_by: Sequence[str] = (), sort: Sequence[str] = (), marks: Sequence[str] = ()
    ) -> None:
        """First snapshot (S9 first run, S10 overwrite); rows of a file ordered by ``sort``.

        ``marks`` are marker files set before the snapshot becomes current.
        """
        v = (self.current_version(name) or 0) + 1
        self._write(df, self._snap_dir(name, v), "overwrite", partition_by, sort=sort)
        for m in marks:
            touch(self.spark, f"{self._snap_dir(name, v)}/{m}")
        touch(self.spark, f"{self._snap_dir(name, v)}/{COMMIT_MARK}")

    def append(self, name: str, df: DataFrame, partition_by: Sequence[str] = (), sort: Sequence[str] = ()) -> None:
        if not self.exists(name):
            return self.create(name, df, partition_by, sort)
        self._write(df, self.location(name), "append", partition_by, sort=sort)

    def replace(self, name: str, df: DataFrame, partition_by: Sequence[str] = ()) -> None:
        """Write the new content as the next snapshot."""
        self.create(name, df, partition_by)

    def vacuum(self, name: str, keep: int = 2) -> list[int]:
        """Remove all but the newest ``keep`` committed snapshots (and any
        uncommitted folder older than them). ``keep >= 2`` leaves the
        previous snapshot to readers that started before the last switch."""
        keep = max(keep, 1)
        committed = self.versions(name)
        if len(committed) <= keep:
            return []
        oldest_kept = committed[-keep]
        removed = []
        for d in list_dirs(self.spark, self.table_dir(name)):
            if d.startswith(SNAP_PREFIX) and int(d[len(SNAP_PREFIX):]) < oldest_kept:
                remove_path(self.spark, f"{self.table_dir(name)}/{d}")
                removed.append(int(d[len(SNAP_PREFIX):]))
        return sorted(removed)

    def overwrite_partitions(
        self, name: str, df: DataFrame, partition_by: Sequence[str], touched: DataFrame | None = None, sort: Sequence[str] = ()
    ) -> None:
        """Replace the partitions present in ``df`` in the current snapshot.

        ``df`` is staged first (it is usually computed from the very
        partitions it replaces); the overwrite then reads the staged copy.
        ``touched`` lists the partitions ``df`` was computed for; those left
        without rows are removed (a dynamic overwrite never visits them). Their
        number is bounded by the partitions a batch touches.
        """
        if not self.exists(name):
            return self.create(name, df, partition_by, sort)
        with staging(self.spark):
            staged = stage(df, f"overwrite-{name}")
            emptied = []
            if touched is not None:
                parts = list(partition_by)
                present = staged.select(*parts).distinct().alias("p")
                t = touched.select(*parts).distinct().alias("t")
                same = [F.col(f"t.{c}").eqNullSafe(F.col(f"p.{c}")) for c in parts]
                emptied = [partition_dir(parts, list(r)) for r in t.join(present, same, "left_anti").collect()]
            self._write(staged, self.location(name), "overwrite", partition_by, dynamic=True, sort=sort, staged=True)
            # after the write: a failure in between leaves stale rows that a
            # re-run of the batch removes, never lost ones
            for d in emptied:
                remove_path(self.spark, f"{self.location(name)}/{d}")

