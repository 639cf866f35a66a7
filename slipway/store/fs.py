"""File-system calls through Hadoop's FileSystem, so the store works on any
file system the cluster can write (HDFS, object stores, local disk)."""

from __future__ import annotations

import os
import uuid
from urllib.parse import unquote, urlparse

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class FS:
    def __init__(self, spark: SparkSession):
        self._jvm = spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()

    def _path(self, p: str):
        return self._jvm.org.apache.hadoop.fs.Path(p)

    def _fs(self, jpath):
        return jpath.getFileSystem(self._conf)

    def qualify(self, p: str) -> str:
        jp = self._path(p)
        return str(self._fs(jp).makeQualified(jp).toString())

    def exists(self, p: str) -> bool:
        jp = self._path(p)
        return bool(self._fs(jp).exists(jp))

    def list_dirs(self, p: str) -> list[str]:
        """Names of the sub-directories of ``p`` (empty if ``p`` is absent)."""
        jp = self._path(p)
        fs = self._fs(jp)
        if not fs.exists(jp):
            return []
        return [str(s.getPath().getName()) for s in fs.listStatus(jp) if s.isDirectory()]

    def list_files(self, p: str) -> list[str]:
        """Names of the files in ``p`` (none if ``p`` is absent)."""
        jp = self._path(p)
        fs = self._fs(jp)
        if not fs.exists(jp):
            return []
        return [str(s.getPath().getName()) for s in fs.listStatus(jp) if s.isFile()]

    def has_data(self, p: str) -> bool:
        """A committed directory holds at least one visible file."""
        jp = self._path(p)
        fs = self._fs(jp)
        if not fs.exists(jp):
            return False
        return any(s.isFile() and not str(s.getPath().getName()).startswith(("_", "."))
                   for s in fs.listStatus(jp))

    def size(self, p: str) -> int:
        """Bytes of the files below ``p``."""
        jp = self._path(p)
        return int(self._fs(jp).getContentSummary(jp).getLength())

    def modified_ms(self, p: str) -> int:
        """Last modification time of ``p`` in epoch milliseconds."""
        jp = self._path(p)
        return int(self._fs(jp).getFileStatus(jp).getModificationTime())

    def delete(self, p: str) -> bool:
        jp = self._path(p)
        return bool(self._fs(jp).delete(jp, True))

    def read_text(self, p: str) -> str | None:
        """The whole text of a small file; None if there is none."""
        jp = self._path(p)
        fs = self._fs(jp)
        if not fs.exists(jp):
            return None
        stream = fs.open(jp)
        try:
            return self._jvm.java.lang.String(stream.readAllBytes(), "UTF-8")
        finally:
            stream.close()

    def create_new(self, p: str, text: str) -> bool:
        """Create ``p`` with this text, all at once; False if it exists already.

        The text is written to a file beside it first. A local file system
        then links it, which fails if the name is taken; others rename it
        without overwriting, which HDFS does as one step. An object store
        whose rename is a copy does not give that guarantee.
        """
        jp = self._path(p)
        fs = self._fs(jp)
        fs.mkdirs(jp.getParent())
        part = f"{p.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}"
        out = fs.create(self._path(part), False)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        try:
            if fs.getUri().getScheme() == "file":
                os.link(unquote(urlparse(part).path), unquote(urlparse(p).path))
            else:
                none = self._jvm.org.apache.hadoop.fs.Options.Rename.NONE
                options = self._jvm.java.lang.reflect.Array.newInstance(none.getClass(), 1)
                options[0] = none
                context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(jp.toUri(), self._conf)
                context.rename(self._path(part), jp, options)
        except FileExistsError:
            return False
        except Py4JJavaError as exc:
            if "FileAlreadyExists" not in str(exc.java_exception):
                raise
            return False
        finally:
            fs.delete(self._path(part), False)
        return True

    def move(self, src: str, dst: str) -> None:
        """Rename a folder; nothing to do if another process has done it."""
        a, b = self._path(src), self._path(dst)
        fs = self._fs(a)
        fs.mkdirs(b.getParent())
        if fs.exists(b):
            return
        try:
            done = fs.rename(a, b)
        except Py4JJavaError:
            done = False
        if not done and not fs.exists(b):
            raise OSError(f"{src} could not be moved to {dst}")
