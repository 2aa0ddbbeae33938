"""Folder operations on a path's own file system (local, HDFS, object store), on the
driver and on names only: no data passes through here."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Storage:
    def __init__(self, spark: SparkSession, root: str):
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.root = root.rstrip("/")
        self._fs = self._path("").getFileSystem(self._conf)

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def exists(self, name: str = "") -> bool:
        return bool(self._fs.exists(self._path(name)))

    def children(self, name: str = "") -> list[str]:
        """Names in a folder, ascending; none if it is not there."""
        if not self.exists(name):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._path(name)))

    def files(self, name: str) -> dict[str, int]:
        """Bytes of every data file below a folder, by its path relative to that folder."""
        out, base = {}, self._fs.makeQualified(self._path(name)).toString().rstrip("/") + "/"
        if not self.exists(name):
            return out
        it = self._fs.listFiles(self._path(name), True)
        while it.hasNext():
            f = it.next()
            rel = f.getPath().toString()[len(base):]
            if not rel.rsplit("/", 1)[-1].startswith(("_", ".")):
                out[rel] = f.getLen()
        return out

    def move(self, name: str, to: str) -> None:
        """Rename; fails if the target is there already."""
        if self.exists(to):
            raise FileExistsError(f"{self.root}/{to}")
        target = self._path(to)
        self._fs.mkdirs(target.getParent())
        if not self._fs.rename(self._path(name), target):
            raise OSError(f"cannot move {name} to {to} in {self.root}")

    def remove(self, name: str) -> None:
        self._fs.delete(self._path(name), True)

    def remove_if_empty(self, name: str) -> None:
        if self.exists(name) and not self.children(name):
            self._fs.delete(self._path(name), False)

    def read_text(self, name: str) -> str:
        stream = self._fs.open(self._path(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write_new(self, name: str, text: str) -> None:
        """Write a file that must not be there yet."""
        try:
            stream = self._fs.create(self._path(name), False)
        except Exception as e:
            if self.exists(name):
                raise FileExistsError(f"{self.root}/{name}") from e
            raise
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
