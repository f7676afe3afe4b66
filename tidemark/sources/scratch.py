"""Folders for intermediate tables that all executors share."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch(spark: SparkSession) -> str:
    """A fresh folder below ``spark.checkpoint.dir`` (a local one where that is unset and Spark runs in one process); removed when the driver's Python ends."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = "file://" + tempfile.gettempdir()
    path = f"{base}/tidemark-{uuid.uuid4().hex}"
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()

    def remove() -> None:
        try:
            target = jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(conf).delete(target, True)
        except Exception:  # the JVM may have ended before  # noqa: BLE001
            pass

    atexit.register(remove)
    return path
