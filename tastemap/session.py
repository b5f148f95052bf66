"""Spark session helpers.

The library never owns the cluster configuration: jobs take the session they are
given. ``get_session`` is a convenience for tests, benches and notebooks; it only
fills settings that are still unset, so a cluster's own values always win.
"""

from __future__ import annotations

import gc
import os
import tempfile
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from threading import Lock

from pyspark.sql import DataFrame, SparkSession

# Settings applied only when the session does not already carry a value.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "tastemap", driver_memory: str | None = None) -> SparkSession:
    """``driver_memory`` only matters for a local session started here (in local
    mode the driver JVM is the executor); on a cluster it is the launcher's job."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    if driver_memory:
        builder = builder.config("spark.driver.memory", driver_memory)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.ui.enabled", "false")  # static: cannot be set later
    spark = builder.getOrCreate()
    given = {k for k, _ in spark.sparkContext.getConf().getAll()}
    for key, value in _DEFAULTS.items():
        if key not in given:
            spark.conf.set(key, value)
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and scratch tables: the one given to
    ``SparkContext.setCheckpointDir``, else ``spark.checkpoint.dir``. On a cluster one of
    them is required; a local session without gets a private folder.
    """
    sc = spark.sparkContext
    folder = sc.getCheckpointDir()
    if folder:  # Spark appends a folder of its own to the one it was given
        return os.path.dirname(folder.rstrip("/"))
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="tastemap-ckpt-")
        spark.conf.set("spark.checkpoint.dir", folder)
    sc.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for intermediate tables."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, name)


_CLEANED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"  # Spark 4.1; older ones do not read it
_cleaning: dict[str, tuple[int, str | None]] = {}
_cleaning_lock = Lock()


@contextmanager
def shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """Queries begun inside delete their shuffle files when they end. Otherwise these stay on the executors'
    disks until the driver's JVM happens to collect garbage. Threads may be inside at the same time."""
    session = str(spark._jsparkSession.sessionUUID())
    with _cleaning_lock:
        inside, before = _cleaning.get(session, (0, None))
        if not inside:
            before = spark.conf.get(_CLEANED, None)
            spark.conf.set(_CLEANED, "true")
        _cleaning[session] = inside + 1, before
    try:
        yield
    finally:
        with _cleaning_lock:
            inside, before = _cleaning.pop(session)
            if inside > 1:
                _cleaning[session] = inside - 1, before
            elif before is None:
                spark.conf.unset(_CLEANED)
            else:
                spark.conf.set(_CLEANED, before)


def sweep(spark: SparkSession) -> None:
    """Have Spark delete the shuffle files and caches of RDDs that nothing refers to any more, in the
    background. The query that has just ended is referred to until its listeners have been told."""
    gc.collect()
    time.sleep(1)
    spark._jvm.System.gc()


def materialize(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` once as a parquet table under the shared checkpoint folder and
    read it back: computed a single time, lineage cut, columnar to re-read. The shuffle
    files of the write are deleted at its end."""
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    with shuffles_deleted(df.sparkSession):
        df.write.partitionBy(*partition_by).parquet(path)
    record_scratch(df.sparkSession, path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def discard(table: DataFrame) -> None:
    """Delete a table that ``materialize`` wrote; nothing may read it any more."""
    spark = table.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(table.scratch_path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    _written[:] = [x for x in _written if x[1] != table.scratch_path]


def record_scratch(spark: SparkSession, path: str) -> None:
    """Remember a scratch table for ``clean_up``."""
    _written.append((spark, path))


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder that was written by Spark is there."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


_written: list[tuple[SparkSession, str]] = []


def clean_up(spark: SparkSession) -> int:
    """Delete the scratch tables written through this session; returns how many. For callers
    that have read all results built on them."""
    own = [x for x in _written if x[0] is spark]
    for entry in own:
        path = spark._jvm.org.apache.hadoop.fs.Path(entry[1])
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        _written.remove(entry)
    return len(own)
