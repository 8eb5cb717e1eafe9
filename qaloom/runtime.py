"""Session helpers: default session, shared scratch folder, lineage cuts.

Iterative operators never use ``localCheckpoint`` (its blocks die with their executor).
They write a table below the folder the cluster names in ``spark.checkpoint.dir``;
every executor sees that folder, so a lost executor costs a re-read and nothing else.
"""

from __future__ import annotations

import importlib.metadata
import logging
import os
import platform
import tempfile
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def local_session(app: str = "qaloom", cores: str = "*", partitions: int = 8) -> SparkSession:
    """A session for tests and the bench; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("QALOOM_DRIVER_MEMORY", "8g"))
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a temporary one only on a local master."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    known = spark.sparkContext._jsc.sc().getCheckpointDir()
    if known.isDefined():
        return str(known.get()).rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = "file://" + tempfile.mkdtemp(prefix="qaloom-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


class Scratch:
    """Tables of one run of an operator, in the shared folder.

    ``put`` writes a frame and reads it back, which cuts the lineage and gives the
    optimizer true sizes, so a join is broadcast only below
    ``spark.sql.autoBroadcastJoinThreshold``. ``drop`` frees what a later round replaced.
    Tables an operator's result still reads stay until ``release`` or the cluster clears them.
    """

    #: The folders of this process that were not released yet, oldest first.
    roots: list[str] = []

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/qaloom-{name}-{uuid.uuid4().hex}"
        self.count = 0
        Scratch.roots.append(self.root)

    def put(self, df: DataFrame) -> DataFrame:
        self.count += 1
        path = f"{self.root}/{self.count}"
        df.write.mode("overwrite").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch = path
        return out

    def drop(self, *frames: DataFrame | None) -> None:
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for df in frames:
            path = getattr(df, "_scratch", None)
            if path:
                p = jvm.org.apache.hadoop.fs.Path(path)
                p.getFileSystem(conf).delete(p, True)


def release(spark: SparkSession, since: int = 0) -> None:
    """Deletes the scratch folders made since ``len(Scratch.roots)`` was ``since``.

    For whoever has written or read the results: frames that still read them fail afterwards.
    """
    gone, Scratch.roots[since:] = Scratch.roots[since:], []
    for root in gone:
        fs, p = hadoop_path(spark, root)
        fs.delete(p, True)


class Progress:
    """Logs how far a loop of known length has come, and how long the rest may take."""

    def __init__(self, name: str, total: int):
        self.name, self.total, self.done, self.began = name, total, 0, time.time()

    def step(self) -> None:
        self.done += 1
        if self.total > 1:
            spent = time.time() - self.began
            logging.getLogger("qaloom").info("%s %d/%d, %.1f s, about %.1f s left", self.name, self.done, self.total, spent, spent / self.done * (self.total - self.done))


#: Packages that parts of the library use: those it needs, then those that only one part asks for.
NEEDED, OPTIONAL = ("pyspark", "pyarrow", "pandas", "numpy", "pyyaml", "xxhash", "regex"), ("openpyxl", "xlrd", "matplotlib", "tiktoken", "onnxruntime")


def environment(spark: SparkSession | None = None) -> dict:
    """A record of interpreter, machine, cluster and package versions (None where not installed)."""

    def version(name: str) -> str | None:
        try:
            return importlib.metadata.version(name)
        except importlib.metadata.PackageNotFoundError:
            return None

    out = {"python": platform.python_version(), "platform": platform.platform(), "cores": os.cpu_count(), "needed": {n: version(n) for n in NEEDED}, "optional": {n: version(n) for n in OPTIONAL}}
    if spark is not None:
        out |= {"spark": spark.version, "master": spark.sparkContext.master, "parallelism": spark.sparkContext.defaultParallelism}
    return out


def workers(n_jobs: int | None, available: int) -> int:
    """Tasks to spread over: all where -1, 0 or unset, else at least 1 and at most what there is."""
    return available if n_jobs in (-1, 0, None) else max(1, min(int(n_jobs), available))


def hadoop_path(spark: SparkSession, path: str):
    """The file system of a path and the path on it."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = hadoop_path(spark, path)
    return fs.exists(p)


def require(df: DataFrame, *columns: str) -> None:
    """Raise when a needed column is absent."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}; the table has {df.columns}")


#: A key is hot from this many rows on, and only if it holds more than one row in ``HOT_SHARE``.
HOT_ROWS, HOT_SHARE = 1_000_000, 10_000


def join_sized(rows: DataFrame, groups: DataFrame, on: list[str], size: str, total: int, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``rows`` joined with ``groups``, which has one row per key and the key's number of rows in ``size``.

    Of ``total`` rows fewer than ``HOT_SHARE`` keys can hold more than one in ``HOT_SHARE``
    each, so the hot keys are broadcast, whatever the data, and their rows stay where they
    lie; the other keys are shuffled, none with more than that share.
    """
    least = max(hot_rows, total // HOT_SHARE)
    if total <= least:
        return rows.join(groups.drop(size), on)
    hot = groups.filter(F.col(size) > least).drop(size)
    cold = rows.join(F.broadcast(hot.select(*on)), on, "left_anti")
    return rows.join(F.broadcast(hot), on).unionByName(cold.join(groups.filter(F.col(size) <= least).drop(size), on))
