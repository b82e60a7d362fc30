"""Small files beside the data, in whatever store the path names: written whole or not at all."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


class Files:
    """The files below one path. For records of what has been written, not for data."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.root = root.rstrip("/")
        self._fs = self._path("").getFileSystem(self._conf)

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def put(self, name: str, text: str, replace: bool = True) -> None:
        """Write a file: readers see all of it or none. Without ``replace`` an existing one is an error."""
        target, made = self._path(name), self._path(f"{name}.{uuid.uuid4().hex}.tmp")
        out = self._fs.create(made, True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        rename = self._jvm.org.apache.hadoop.fs.Options.Rename
        wanted = self._jvm.java.lang.reflect.Array.newInstance(rename.NONE.getClass(), 1)
        wanted[0] = rename.OVERWRITE if replace else rename.NONE
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self._conf)
        try:
            context.rename(self._fs.makeQualified(made), self._fs.makeQualified(target), wanted)
        except Exception as error:
            self._fs.delete(made, False)
            if self._fs.exists(target) and not replace:
                raise FileExistsError(f"{self.root}/{name}") from error
            raise

    def get(self, name: str) -> str | None:
        """The text of a file, None if there is none."""
        path = self._path(name)
        if not self._fs.exists(path):
            return None
        stream = self._fs.open(path)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def names(self, folder: str = "") -> list[str]:
        """The whole files of a folder, in order."""
        path = self._path(folder)
        if not self._fs.exists(path):
            return []
        found = [status.getPath().getName() for status in self._fs.listStatus(path) if status.isFile()]
        return sorted(name for name in found if not name.endswith((".tmp", ".crc")))

    def folders(self, folder: str = "") -> list[str]:
        """The folders of a folder, in order."""
        path = self._path(folder)
        if not self._fs.exists(path):
            return []
        return sorted(status.getPath().getName() for status in self._fs.listStatus(path) if status.isDirectory())

    def remove(self, name: str = "") -> None:
        self._fs.delete(self._path(name), True)


def escaped(spark: SparkSession, name: str) -> str:
    """A name as Spark writes it in a partition directory; also good as a file name."""
    return spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(name)
