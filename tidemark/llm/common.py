"""Shared helpers: tables, the shared folder, and file access from executors."""

from __future__ import annotations

import atexit
import ctypes
import tempfile
import uuid
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Words are runs of anything but the six ASCII white-space characters.  ``bytes.split()`` cuts at the same bytes.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``, or a local one of our own where that is unset (tests)."""
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None)
    held = sc._jsc.sc().getCheckpointDir()
    if base is None and held.isDefined():
        base = held.get()
    if base is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="tidemark-")
    if held.isEmpty():
        sc.setCheckpointDir(base)
    return base


_made: dict[str, SparkSession] = {}


def scratch(spark: SparkSession, tag: str) -> str:
    """A fresh folder name under the shared folder; removed when asked (``remove``, ``drop``, ``released``) or the driver's Python ends."""
    path = f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    _made[path] = spark
    return path


def remove(path: str) -> None:
    """Delete a folder that ``scratch`` named."""
    spark = _made.pop(path, None)
    try:
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    except Exception:  # the JVM may have ended before  # noqa: BLE001
        pass


@atexit.register
def _remove_all() -> None:
    for path in list(_made):
        remove(path)


def drop(*tables: DataFrame) -> None:
    """Delete settled tables that nothing reads any more."""
    for df in tables:
        if path := getattr(df, "_settled_at", None):
            remove(path)


@contextmanager
def released():
    """Delete at the end whatever was made inside, but for the settled tables and folders that are put on the list this yields."""
    before, keep = set(_made), []
    yield keep
    kept = {x if isinstance(x, str) else x._settled_at for x in keep}
    for path in list(_made):
        if path not in before and path not in kept:
            remove(path)


def settled(df: DataFrame) -> DataFrame:
    """Cut the lineage: the rows as a written table in the shared folder.

    A checkpoint would carry the plan's constraints along, whose inference on aliased columns fills the driver's memory.
    """
    path = scratch(df.sparkSession, "settled")
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._settled_at = path
    return out


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage of a small table of many partitions with a reliable checkpoint in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def scan_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate for the plan, without running anything."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def slices(batches, rows: int = 1000):
    """Batches cut smaller, so that a task holds a thousand texts as Python objects at a time."""
    for batch in batches:
        for i in range(0, batch.num_rows, rows):
            yield batch.slice(i, rows)


def lean(run):
    """An Arrow function that gives memory back to the system when a task's batches are through: workers live on, and an executor's memory is shared with them."""

    def through(batches):
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL(None).malloc_trim(0)
        except AttributeError:  # not glibc
            pass

    return through


def open_fs(uri: str):
    """(pyarrow file system, path) for any URI that pyarrow knows: file, hdfs, s3, gs."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri else f"file://{uri}" if uri.startswith("/") else uri.replace("file:/", "file:///", 1))
