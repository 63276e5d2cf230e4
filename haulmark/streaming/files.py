"""The file system of a table's path, as Spark's jobs see it."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Files:
    """Listing, small files, and putting a name in place if nobody has it."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm = spark._jvm
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(path).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())

    def names(self, path: str) -> list[str]:
        place = self._path(path)
        return sorted(f.getPath().getName() for f in self._fs.listStatus(place)) if self._fs.exists(place) else []

    def found(self, pattern: str) -> list[str]:
        return [f.getPath().toString() for f in self._fs.globStatus(self._path(pattern)) or []]

    def changed(self, path: str) -> float:
        """When a file or folder was last changed, in seconds of the epoch."""
        return self._fs.getFileStatus(self._path(path)).getModificationTime() / 1000

    def make(self, path: str) -> None:
        self._fs.mkdirs(self._path(path))

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)

    def rename(self, path: str, to: str) -> bool:
        return self._fs.rename(self._path(path), self._path(to))

    def text(self, path: str) -> str:
        stream = self._fs.open(self._path(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def put_if_absent(self, path: str, text: str) -> bool:
        """A whole small file under a name that must be free; False if it is taken.

        Either all of the text is there or nothing. It is written under another name and
        linked (local file system) or renamed (others), which HDFS refuses for a name in use. On
        a store whose rename replaces files, there is no such refusal.
        """
        folder, name = path.rsplit("/", 1)
        draft = f"{folder}/.{name}-{uuid.uuid4().hex}"
        out = self._fs.create(self._path(draft), False)
        out.write(bytearray(text, "utf-8"))
        out.close()
        uri = lambda p: self._fs.makeQualified(self._path(p)).toUri()
        if uri(draft).getScheme() != "file":
            done = self._fs.rename(self._path(draft), self._path(path))
            if not done:
                self.delete(draft)
            return done
        nio = self._jvm.java.nio.file
        try:
            nio.Files.createLink(nio.Paths.get(uri(path)), nio.Paths.get(uri(draft)))
            return True
        except Py4JJavaError as error:
            if "FileAlreadyExists" in error.java_exception.getClass().getName():
                return False
            raise
        finally:
            self.delete(draft)
