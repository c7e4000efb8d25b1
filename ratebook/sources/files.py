"""Small files and folders of the shared storage, through the file system Spark itself uses."""

from __future__ import annotations

from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Files:
    def __init__(self, spark: SparkSession):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._conf = spark._jsc.hadoopConfiguration()

    def _at(self, path: str):
        at = self._path(path)
        return at.getFileSystem(self._conf), at

    def exists(self, path: str) -> bool:
        system, at = self._at(path)
        return system.exists(at)

    def names(self, path: str) -> list[str]:
        """Names in a folder, none if there is no folder."""
        system, at = self._at(path)
        if not system.exists(at):
            return []
        return sorted(status.getPath().getName() for status in system.listStatus(at))

    def parts(self, path: str, column: str) -> dict[str, str]:
        """Value of the partition column -> folder, as a partitioned write left them."""
        prefix = f"{column}="
        return {
            unquote(name.removeprefix(prefix)): f"{path}/{name}"
            for name in self.names(path)
            if name.startswith(prefix)
        }

    def bytes(self, path: str) -> int:
        system, at = self._at(path)
        return system.getContentSummary(at).getLength()

    def age(self, path: str, now: float) -> float:
        """Seconds since the file was written."""
        system, at = self._at(path)
        return now - system.getFileStatus(at).getModificationTime() / 1000

    def create(self, path: str) -> bool:
        """An empty file, only if nothing is there: one of several callers gets True."""
        system, at = self._at(path)
        system.mkdirs(at.getParent())
        try:
            system.create(at, False).close()
        except Py4JJavaError as failure:
            if not system.exists(at):
                raise failure
            return False
        return True

    def remove(self, path: str) -> None:
        system, at = self._at(path)
        system.delete(at, True)
