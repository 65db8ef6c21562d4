"""Small files and folders of the store that Spark writes to, through Hadoop's
file system interface: only names and metadata pass through the driver."""

from __future__ import annotations

from pyspark.errors.exceptions.captured import UnsupportedOperationException
from pyspark.sql import SparkSession


class Files:
    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._conf = spark._jsc.hadoopConfiguration()

    def _at(self, path: str):
        p = self._hadoop.Path(path)
        return p.getFileSystem(self._conf), p

    def exists(self, path: str) -> bool:
        fs, p = self._at(path)
        return fs.exists(p)

    def names(self, path: str) -> list[str]:
        """Names in a folder, in order; none if there is no such folder."""
        fs, p = self._at(path)
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

    def size(self, path: str) -> int:
        fs, p = self._at(path)
        return fs.getFileStatus(p).getLen()

    def read(self, path: str) -> str:
        fs, p = self._at(path)
        stream = fs.open(p)
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, path: str, text: str) -> None:
        """Overwrite a file."""
        self.write_bytes(path, text.encode())

    def write_bytes(self, path: str, raw: bytes) -> None:
        fs, p = self._at(path)
        stream = fs.create(p, True)
        try:
            stream.write(bytearray(raw))
        finally:
            stream.close()

    def append(self, path: str, parts: list[str], buffer: int = 1 << 20) -> None:
        """Put the bytes of other files at the end of a file, in order. A store
        that can join files by itself does; else they are copied through a
        buffer into a new file that takes the place of the first."""
        fs, p = self._at(path)
        parts = [q for q in parts if self.size(q)]
        if not parts:
            return
        array = self.spark.sparkContext._gateway.new_array(self._hadoop.Path, len(parts))
        for i, q in enumerate(parts):
            array[i] = self._hadoop.Path(q)
        try:
            fs.concat(p, array)
            return
        except UnsupportedOperationException:
            pass
        joined = f"{path}.joined"
        out = fs.create(self._hadoop.Path(joined), True)
        copy = self.spark._jvm.org.apache.hadoop.io.IOUtils.copyBytes
        try:
            for q in [path, *parts]:
                part = fs.open(self._hadoop.Path(q))
                try:
                    copy(part, out, buffer, False)
                finally:
                    part.close()
        finally:
            out.close()
        self.move(joined, path, replace=True)

    def move(self, source: str, target: str, replace: bool = False) -> None:
        """Rename; an existing target is an error unless it may be replaced."""
        kinds = self._hadoop.Options.Rename
        gateway = self.spark.sparkContext._gateway
        options = gateway.new_array(kinds, 1)
        options[0] = kinds.OVERWRITE if replace else kinds.NONE
        p = self._hadoop.Path(source)
        fs = self._hadoop.FileContext.getFileContext(p.getFileSystem(self._conf).getUri(), self._conf)
        fs.rename(p, self._hadoop.Path(target), options)

    def delete(self, path: str) -> None:
        fs, p = self._at(path)
        fs.delete(p, True)
