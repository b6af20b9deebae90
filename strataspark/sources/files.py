"""Small files in any file system that Spark knows: existence, whole contents, replacing in one step, listing, removal."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyarrow.fs import FileSystem
from pyspark.sql import SparkSession


def opened(path: str) -> tuple[FileSystem, str]:
    """For tasks, which have no JVM at hand: Arrow's file system of a path or URI, and the path in it."""
    return FileSystem.from_uri(path)


class Files:
    def __init__(self, spark: SparkSession):
        self.jvm, self.conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()

    def _at(self, path: str):
        at = self.jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.conf), at

    def exists(self, path: str) -> bool:
        fs, at = self._at(path)
        return fs.exists(at)

    def read(self, path: str) -> bytes:
        fs, at = self._at(path)
        source = fs.open(at)
        try:
            return bytes(self.jvm.org.apache.commons.io.IOUtils.toByteArray(source))
        finally:
            source.close()

    def replace(self, path: str, content: bytes) -> None:
        """K7: written beside, then renamed over the old file, which is there until the new one is."""
        fs, part = self._at(f"{path}.part")
        out = fs.create(part, True)
        out.write(bytearray(content))
        out.close()
        options = self.jvm.org.apache.hadoop.fs.Options.Rename
        flags = self._array(options, [options.OVERWRITE])
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(part.toUri(), self.conf)
        context.rename(part, self._at(path)[1], flags)

    def create(self, path: str, content: bytes) -> bool:
        """A file that appears whole, or not at all if there is one already: False. Of several writers one succeeds."""
        fs, part = self._at(f"{path}.{uuid.uuid4().hex}")
        out = fs.create(part, False)
        out.write(bytearray(content))
        out.close()
        at = self._at(path)[1]
        try:
            if fs.getUri().getScheme() == "file":  # its rename looks first and renames then; a link cannot be made twice
                local = self.jvm.java.nio.file.Paths
                self.jvm.java.nio.file.Files.createLink(local.get(at.toUri().getPath(), self._array(self.jvm.java.lang.String, [])), local.get(part.toUri().getPath(), self._array(self.jvm.java.lang.String, [])))
            else:
                options = self.jvm.org.apache.hadoop.fs.Options.Rename
                self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(part.toUri(), self.conf).rename(part, at, self._array(options, [options.NONE]))
        except Py4JJavaError as e:
            if not fs.exists(at):
                raise
            if not e.java_exception.getClass().getSimpleName().startswith("FileAlreadyExists"):
                raise
            return False
        finally:
            fs.delete(part, False)
        return True

    def _array(self, kind, values):
        from pyspark import SparkContext

        out = SparkContext._gateway.new_array(kind, len(values))
        for k, value in enumerate(values):
            out[k] = value
        return out

    def folder(self, path: str) -> None:
        fs, at = self._at(path)
        fs.mkdirs(at)

    def remove(self, path: str) -> bool:
        """Whether there was something to remove."""
        fs, at = self._at(path)
        return fs.exists(at) and fs.delete(at, True)

    def names(self, path: str) -> list[str]:
        """Names in a folder, sorted; none if it is not there."""
        fs, at = self._at(path)
        return sorted(x.getPath().getName() for x in fs.listStatus(at)) if fs.exists(at) else []
