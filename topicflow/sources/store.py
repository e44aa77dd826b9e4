"""Small files beside a log, on whatever store holds it: whole reads, and a create that only one writer wins.

Spark reads and writes the data; what is here is a few kilobytes per publish. It goes through Hadoop's public
FileSystem and FileContext classes, as Spark's own checkpoints do, so every store that Spark can name works. ``create``
needs a store whose rename fails when the target exists (HDFS and its like; on a mounted file system a hard link).
"""

from __future__ import annotations

import os
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Store:
    """Paths are relative to ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        sc = spark.sparkContext
        self._gateway, self._hadoop, self._conf = sc._gateway, sc._jvm.org.apache.hadoop.fs, sc._jsc.hadoopConfiguration()
        self.root = root.rstrip("/")
        top = self._hadoop.Path(self.root)
        self._fs = top.getFileSystem(self._conf)
        self._local = self._fs.getUri().getScheme() == "file"
        self._top = top.toUri().getPath()

    def _path(self, name: str):
        return f"{self._top}/{name}" if self._local else self._hadoop.Path(f"{self.root}/{name}")

    def read(self, name: str) -> str | None:
        """The file's text, None if there is none."""
        if self._local:
            try:
                with open(self._path(name), encoding="utf-8") as f:
                    return f.read()
            except FileNotFoundError:
                return None
        path = self._path(name)
        if not self._fs.exists(path):
            return None
        stream = self._fs.open(path)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def replace(self, name: str, text: str) -> None:
        """Write the file, in place of one that is there."""
        if self._local:
            part = self._write_part(name, text)
            os.replace(part, self._path(name))
        else:
            self._write(self._path(name), text)

    def create(self, name: str, text: str) -> bool:
        """Write the file whole if there is none; False, and nothing written, if another writer was first."""
        if self._local:
            part = self._write_part(name, text)
            try:
                os.link(part, self._path(name))
            except FileExistsError:
                return False
            finally:
                os.unlink(part)
            return True
        folder, _, last = name.rpartition("/")
        part, path = self._path(f"{folder}/.{last}.{uuid.uuid4().hex}"), self._path(name)
        self._write(part, text)
        context = self._hadoop.FileContext.getFileContext(path.toUri(), self._conf)
        plain = self._gateway.new_array(self._hadoop.Options.Rename, 0)
        try:
            context.rename(part, path, plain)
        except Py4JJavaError as e:
            self._fs.delete(part, False)
            if e.java_exception.getClass().getSimpleName() != "FileAlreadyExistsException":
                raise
            return False
        return True

    def names(self, folder: str) -> list[str]:
        """Names in a folder, none if it isn't there."""
        if self._local:
            try:
                return os.listdir(self._path(folder))
            except FileNotFoundError:
                return []
        path = self._path(folder)
        return [s.getPath().getName() for s in self._fs.listStatus(path)] if self._fs.exists(path) else []

    def delete(self, folder: str) -> None:
        self._fs.delete(self._hadoop.Path(f"{self.root}/{folder}"), True)

    def _write_part(self, name: str, text: str) -> str:
        folder, last = os.path.split(self._path(name))
        os.makedirs(folder, exist_ok=True)
        part = f"{folder}/.{last}.{uuid.uuid4().hex}"
        with open(part, "w", encoding="utf-8") as f:
            f.write(text)
        return part

    def _write(self, path, text: str) -> None:
        stream = self._fs.create(path, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
