"""Session helpers: local sessions for tests/bench, and the shared checkpoint folder."""

from __future__ import annotations

import os
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_open = threading.local()  # the thread's ``passing`` block


def local_session(cores: str | int = "*", shuffle_partitions: int = 8, app: str = "strata",
                  driver_memory: str | None = None) -> SparkSession:
    """A local session for tests and the bench. On a cluster the caller owns the session."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", driver_memory or os.environ.get("STRATA_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables and lineage cuts.

    Taken from the session: the context's checkpoint folder, else
    ``spark.checkpoint.dir``, else a folder under ``spark.sql.warehouse.dir`` (the
    file system that holds the tables). Never a machine-local temporary folder:
    what one executor writes, the others and the driver must be able to read.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf:
        conf = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_strata_scratch"
        unshared(sc.master, conf)
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


def unshared(master: str, folder: str) -> None:
    """Raise if several machines would each write to a folder of their own: the master is not local, nobody named a
    shared folder, and the default lies in the local file system."""
    on_disk = folder.startswith(("file:", "/"))
    if on_disk and not master.startswith("local"):
        raise ValueError(f"{folder} is local to each machine: set spark.checkpoint.dir to a folder that all of them share")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder, for written intermediate tables."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/strata-{name}-{uuid.uuid4().hex[:12]}"


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: the plan is cut, columns
    can still be pruned and filters pushed, and a lost executor costs no recomputation."""
    if getattr(_open, "scratch", None):
        return _open.scratch.store(df, name)
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of intermediate files that this library wrote, in whatever file system it lies."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder (none if it is absent), in whatever file system it lies."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(x.getPath().getName() for x in fs.listStatus(at)) if fs.exists(at) else []


class Scratch:
    """Stored tables that are removed together: ``with Scratch(spark) as s: df = s.store(df, "name")``. Frames that
    read them must not be used after the block; what is to stay is stored elsewhere."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def __enter__(self) -> Scratch:
        return self

    def store(self, df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(self.spark, name)
        self.paths.append(path)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def keep_last(self, n: int = 1) -> None:
        """Remove all but the last ``n`` tables."""
        while len(self.paths) > n:
            remove(self.spark, self.paths.pop(0))

    def __exit__(self, *_) -> None:
        self.keep_last(0)


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """Tables that ``store`` writes inside the block, in its own thread, are removed at its end: for measures of which
    numbers alone are kept. No frame made inside may be read after it."""
    outer = getattr(_open, "scratch", None)
    with Scratch(spark) as _open.scratch:
        try:
            yield
        finally:
            _open.scratch = outer


def cut_lineage(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read back: survives the loss of an executor, and later
    steps read only the columns they need."""
    return store(df, "cut")


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
