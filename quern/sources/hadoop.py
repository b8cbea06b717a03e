"""Files and folders of any store that Spark writes to, through Hadoop's file systems, from the driver."""

from __future__ import annotations

import time

from pyspark.sql import SparkSession


class Store:
    """A few operations on paths; each finds its path's own file system."""

    def __init__(self, spark: SparkSession) -> None:
        self._path, self._conf = spark.sparkContext._jvm.org.apache.hadoop.fs.Path, spark.sparkContext._jsc.hadoopConfiguration()

    def _of(self, path: str):
        at = self._path(path)
        return at.getFileSystem(self._conf), at

    def exists(self, path: str) -> bool:
        fs, at = self._of(path)
        return fs.exists(at)

    def names(self, path: str) -> list[str]:
        """Names of what is in a folder, in order; none if it isn't there."""
        fs, at = self._of(path)
        return sorted(x.getPath().getName() for x in fs.listStatus(at)) if fs.exists(at) else []

    def files(self, path: str) -> list[tuple[str, int, int]]:
        """(path, size, modification time) of a file, or of all files beneath a folder, in order."""
        fs, at = self._of(path)
        found, each = [], fs.listFiles(at, True)
        while each.hasNext():
            x = each.next()
            found.append((x.getPath().toString(), x.getLen(), x.getModificationTime()))
        return sorted(found)

    def make(self, path: str) -> None:
        fs, at = self._of(path)
        fs.mkdirs(at)

    def move(self, path: str, to: str) -> None:
        """Renames; what is at the new path must not be there."""
        fs, at = self._of(path)
        if not fs.rename(at, self._path(to)):
            raise OSError(f"{path} can't be renamed to {to}")

    def delete(self, path: str) -> None:
        fs, at = self._of(path)
        fs.delete(at, True)

    def in_turn(self, paths: list[str]) -> None:
        """Gives files the times of seconds gone by, each a later one than the file before."""
        now = int(time.time()) * 1000
        for k, path in enumerate(paths):
            (fs, at), then = self._of(path), now - 1000 * (len(paths) - k)
            fs.setTimes(at, then, -1)
            if fs.getFileStatus(at).getModificationTime() != then:
                raise OSError(f"the time of {path} can't be set")

    def read(self, path: str) -> str:
        fs, at = self._of(path)
        with_stream = fs.open(at)
        try:
            return bytes(with_stream.readAllBytes()).decode()
        finally:
            with_stream.close()

    def write(self, path: str, text: str) -> None:
        """The text is at path when it is whole: written beside it, then renamed."""
        fs, at = self._of(path)
        part = self._path(at.getParent(), f".{at.getName()}.part")
        out = fs.create(part, True)
        out.write(bytearray(text.encode()))
        out.close()
        fs.delete(at, False)
        if not fs.rename(part, at):
            raise OSError(f"{path} can't be written")
