"""Small steps on the file system that holds the tables, whichever it is."""

from pyspark.sql import SparkSession

#: Of Parquet files; unlike snappy it shortens hashes as text, which ids are.
COMPRESSION = "zstd"


class Files:
    """Folders and small text files under one path, through Hadoop's file system."""

    def __init__(self, spark: SparkSession, root: str):
        self._jvm = spark.sparkContext._jvm
        self._root = self._path(root)
        self._fs = self._root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(self._root, name) if name else self._root

    def exists(self, name: str = "") -> bool:
        return self._fs.exists(self._at(name))

    def names(self, name: str = "") -> list[str]:
        """Names directly below, or none when there is no such folder."""
        at = self._at(name)
        return sorted(s.getPath().getName() for s in self._fs.listStatus(at)) if self._fs.exists(at) else []

    def make(self, name: str) -> None:
        """The folder, if it is not there yet."""
        self._fs.mkdirs(self._at(name))

    def delete(self, name: str = "") -> None:
        self._fs.delete(self._at(name), True)

    def move(self, name: str, to: str) -> None:
        if not self._fs.rename(self._at(name), self._at(to)):
            raise OSError(f"{name} could not be moved to {to}")

    def write(self, name: str, text: str) -> None:
        """Appears whole: written beside its place and moved there."""
        part = f"{name}.part"
        out = self._fs.create(self._at(part), True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        self._fs.delete(self._at(name), False)
        self.move(part, name)

    def read(self, name: str) -> str | None:
        at = self._at(name)
        if not self._fs.exists(at):
            return None
        size = self._fs.getFileStatus(at).getLen()
        stream = self._fs.open(at)
        try:
            return bytes(self._jvm.org.apache.commons.io.IOUtils.toByteArray(stream, size)).decode()
        finally:
            stream.close()
