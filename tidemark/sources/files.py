"""Small files through the Hadoop file system: any store Spark reads will do."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


class Exists(RuntimeError):
    """Another writer has made the file in the meantime."""


class Files:
    """Files below a folder; paths are relative to it, or whole."""

    def __init__(self, spark: SparkSession, root: str):
        self.root = root.rstrip("/")
        self.jvm, self.conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        self.fs = self.path("").getFileSystem(self.conf)

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(name if "://" in name or name.startswith(("/", "file:")) else f"{self.root}/{name}".rstrip("/"))

    def exists(self, name: str) -> bool:
        return self.fs.exists(self.path(name))

    def children(self, name: str, recursive: bool = False) -> list[tuple[str, int, float]]:
        """(path below the given one, bytes, modified) of files."""
        at = self.path(name)
        if not self.fs.exists(at):
            return []
        base, out = self.fs.makeQualified(at).toString().rstrip("/"), []
        it = self.fs.listFiles(at, recursive)
        while it.hasNext():
            s = it.next()
            out.append((s.getPath().toString()[len(base) + 1 :], s.getLen(), s.getModificationTime() / 1000))
        return out

    def read(self, name: str) -> str:
        stream = self.fs.open(self.path(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        """Write over what is there."""
        out = self.fs.create(self.path(name), True)
        out.write(bytearray(text.encode()))
        out.close()

    def create(self, name: str, text: str) -> None:
        """Make a file that isn't there yet, whole or not at all.

        The text is written under another name and given its own by a rename that fails if there is one: at once on HDFS, ABFS and local disks.
        An object store without that needs one writer at a time.
        """
        temp = self.path(f"{name}.{uuid.uuid4().hex}.tmp")
        out = self.fs.create(temp, False)
        out.write(bytearray(text.encode()))
        out.close()
        if self.fs.exists(self.path(name)) or not self.fs.rename(temp, self.path(name)):
            self.fs.delete(temp, False)
            raise Exists(name)

    def delete(self, name: str, recursive: bool = False) -> bool:
        return self.fs.delete(self.path(name), recursive)
