"""Small files on whatever file system the paths name, through Hadoop: state, manifests and reports."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


class Files:
    """Whole small files by path; paths without a scheme are of the default file system."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _at(self, path: str):
        p = self._jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self._conf)

    def exists(self, path: str) -> bool:
        p, fs = self._at(path)
        return fs.exists(p)

    def names(self, folder: str) -> list[str]:
        """Names in a folder, sorted; none if it is missing."""
        p, fs = self._at(folder)
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

    def read(self, path: str) -> str:
        p, fs = self._at(path)
        stream = fs.open(p)
        try:
            return bytes(self._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode("utf-8")
        finally:
            stream.close()

    def _create(self, path: str, text: str, overwrite: bool) -> None:
        p, fs = self._at(path)
        stream = fs.create(p, overwrite)
        try:
            stream.write(bytearray(text.encode("utf-8")))
        finally:
            stream.close()

    def write(self, path: str, text: str) -> None:
        """A file in place of what was there: readers see the old text or the new one."""
        tmp = f"{path}.{uuid.uuid4().hex}.tmp"
        self._create(tmp, text, False)
        self.delete(path)
        self._rename(tmp, path)

    def create(self, path: str, text: str) -> bool:
        """A file that must not exist before; False if it does. Of two writers one succeeds."""
        folder, _, name = path.rpartition("/")
        tmp = f"{folder}/.{name}.{uuid.uuid4().hex}.tmp"
        self._create(tmp, text, False)
        done = not self.exists(path) and self._rename(tmp, path)
        if not done:
            self.delete(tmp)
        return done

    def _rename(self, source: str, target: str) -> bool:
        p, fs = self._at(source)
        return fs.rename(p, self._at(target)[0])

    def replace(self, source: str, target: str) -> None:
        """A file or folder moved to ``target`` in place of what is there; nothing if ``source`` is gone (moved before)."""
        if self.exists(source):
            self.delete(target)
            self._rename(source, target)

    def delete(self, path: str) -> None:
        p, fs = self._at(path)
        fs.delete(p, True)
