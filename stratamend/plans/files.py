"""Small files and folders through Hadoop's file systems, so that any store Spark reaches will do."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession


class Files:
    def __init__(self, spark: SparkSession):
        self.spark, self.jvm = spark, spark.sparkContext._jvm

    def _at(self, path: str):
        p = self.jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def exists(self, path: str) -> bool:
        fs, p = self._at(path)
        return fs.exists(p)

    def read(self, path: str) -> str | None:
        fs, p = self._at(path)
        if not fs.exists(p):
            return None
        stream = fs.open(p)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def _beside(self, fs, path: str, text: str):
        """A hidden file of its own name with ``text``."""
        head, _, name = path.rpartition("/")
        tmp = self.jvm.org.apache.hadoop.fs.Path(f"{head}/.{name}-{uuid.uuid4().hex}")
        out = fs.create(tmp, True)
        out.write(bytearray(text.encode()))
        out.close()
        return tmp

    def create(self, path: str, text: str) -> bool:
        """Makes a file, whole from the first moment; False if there is one, wherever the store renames atomically."""
        fs, p = self._at(path)
        tmp = self._beside(fs, path, text)
        try:
            if fs.getUri().getScheme() == "file":  # a link is exclusive on a local disk, a rename isn't
                try:
                    os.link(tmp.toUri().getPath(), p.toUri().getPath())
                except FileExistsError:
                    return False
                return True
            return not fs.exists(p) and fs.rename(tmp, p)
        finally:
            fs.delete(tmp, False)

    def size(self, path: str) -> int:
        fs, p = self._at(path)
        return fs.getContentSummary(p).getLength() if fs.exists(p) else 0

    def replace(self, path: str, text: str) -> None:
        """Writes beside ``path`` and renames over it: a reader sees the old text or the new, wherever the store renames atomically."""
        fs, p = self._at(path)
        tmp = self._beside(fs, path, text)
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(p.toUri() if p.toUri().getScheme() else fs.getUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        options = self.spark.sparkContext._gateway.new_array(self.jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = self.jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        context.rename(fs.makeQualified(tmp), fs.makeQualified(p), options)

    def folder(self, path: str) -> None:
        fs, p = self._at(path)
        fs.mkdirs(p)

    def delete(self, path: str) -> None:
        fs, p = self._at(path)
        fs.delete(p, True)

    def children(self, path: str) -> list[str]:
        fs, p = self._at(path)
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []
