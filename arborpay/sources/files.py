"""Empty files as durable facts: created exclusively, listed, deleted; their names say all."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Files:
    """Files of whatever store a path is in."""

    def __init__(self, spark: SparkSession):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._conf = spark._jsc.hadoopConfiguration()

    def _at(self, path: str):
        at = self._path(path)
        return at.getFileSystem(self._conf), at

    def exists(self, path: str) -> bool:
        fs, at = self._at(path)
        return fs.exists(at)

    def names(self, folder: str) -> list[str]:
        """Names in a folder but hidden ones; none if there is no folder."""
        fs, at = self._at(folder)
        found = [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []
        return sorted(n for n in found if n[0] not in "._")

    def create(self, path: str, replace: bool = False) -> bool:
        """Create an empty file; False if it is there and isn't to be replaced. Of several creators one gets True."""
        fs, at = self._at(path)
        try:
            fs.create(at, replace).close()
        except Py4JJavaError:
            if not replace and fs.exists(at):
                return False
            raise
        return True

    def delete(self, path: str) -> None:
        fs, at = self._at(path)
        fs.delete(at, True)

    def age(self, path: str, probe: str) -> float:
        """Seconds since a file was written, by the store's clock: a probe file is written to ask it."""
        fs, at = self._at(path)
        self.create(probe, replace=True)
        return (fs.getFileStatus(self._path(probe)).getModificationTime() - fs.getFileStatus(at).getModificationTime()) / 1000

    def claim(self, folder: str) -> int:
        """The next number of a folder, which no one else gets."""
        number = max((int(n) for n in self.names(folder)), default=0) + 1
        while not self.create(f"{folder}/{number:012d}"):
            number += 1
        return number
