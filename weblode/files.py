"""Small files and renames on the storage that Spark uses."""

from __future__ import annotations

import time

from pyspark.sql import SparkSession


class Files:
    """The file system that holds a folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self.system = self._path(folder).getFileSystem(spark._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self.system.exists(self._path(path))

    def age(self, path: str) -> float:
        return time.time() - self.system.getFileStatus(self._path(path)).getModificationTime() / 1000

    def rename(self, source: str, target: str) -> bool:
        self.system.mkdirs(self._path(target).getParent())
        return self.system.rename(self._path(source), self._path(target))

    def delete(self, path: str) -> None:
        self.system.delete(self._path(path), True)

    def names(self, path: str) -> list[tuple[str, bool]]:
        """(name, is a folder) of the entries of a folder."""
        return [(e.getPath().getName(), e.isDirectory()) for e in self.system.listStatus(self._path(path))]

    def count(self, path: str) -> int:
        """Files below a folder, at any depth."""
        return self.system.getContentSummary(self._path(path)).getFileCount()

    def uri(self, path: str) -> str:
        """The path with its scheme."""
        return self.system.makeQualified(self._path(path)).toString()

    def write(self, path: str, text: str) -> None:
        out = self.system.create(self._path(path), False)
        try:
            out.write(bytearray(text, "utf-8"))
        finally:
            out.close()

    def read(self, spark: SparkSession, path: str) -> str:
        stream = self.system.open(self._path(path))
        try:
            return bytes(spark._jvm.org.apache.hadoop.io.IOUtils.readFullyToByteArray(stream)).decode()
        finally:
            stream.close()
