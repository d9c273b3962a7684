"""Folder operations on the driver, through the Hadoop file system that Spark itself writes with."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Folders:
    def __init__(self, spark: SparkSession):
        self._jvm = spark._jvm
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._conf = spark._jsc.hadoopConfiguration()

    def _open(self, uri: str):
        path = self._path(uri)
        return path.getFileSystem(self._conf), path

    def qualified(self, uri: str) -> str:
        """The URI with scheme and host, so that a task resolves it as Spark does."""
        fs, path = self._open(uri)
        return fs.makeQualified(path).toString()

    def exists(self, uri: str) -> bool:
        fs, path = self._open(uri)
        return fs.exists(path)

    def make(self, uri: str) -> None:
        fs, path = self._open(uri)
        fs.mkdirs(path)

    def delete(self, uri: str) -> None:
        fs, path = self._open(uri)
        fs.delete(path, True)

    def rename(self, source: str, target: str) -> None:
        fs, path = self._open(source)
        if not fs.rename(path, self._path(target)):
            raise OSError(f"cannot rename {source} to {target}")

    def create_new(self, uri: str, text: str) -> None:
        """Write a small file that must not be there yet."""
        fs, path = self._open(uri)
        if fs.exists(path):
            raise FileExistsError(uri)
        try:
            out = fs.create(path, False)
        except Exception as error:
            if "AlreadyExists" in str(error):
                raise FileExistsError(uri) from error
            raise
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

    def read_text(self, uri: str) -> str:
        fs, path = self._open(uri)
        stream = fs.open(path)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def children(self, uri: str) -> list[tuple[str, bool, int]]:
        """Name, kind and time of change (milliseconds) of everything directly in a folder that is known to be small."""
        fs, path = self._open(uri)
        return [(c.getPath().getName(), c.isDirectory(), c.getModificationTime()) for c in fs.listStatus(path)]

    def first_child(self, uri: str, hidden: tuple[str, ...] = ("_", ".")) -> tuple[str, bool] | None:
        """Name and kind of the first child that is not hidden; stops reading the folder there."""
        fs, path = self._open(uri)
        children = fs.listStatusIterator(path)
        while children.hasNext():
            child = children.next()
            name = child.getPath().getName()
            if not name.startswith(hidden):
                return name, child.isDirectory()
        return None
