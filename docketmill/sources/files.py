"""Files and folders of whatever store the session's paths name."""

from __future__ import annotations

from pyspark.sql import SparkSession


class StoredPath:
    """A file or folder, by the file system that Spark itself uses for it."""

    def __init__(self, spark: SparkSession, path: str):
        self._spark, self.path = spark, path
        self._hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
        self._fs = self._hadoop.getFileSystem(spark._jsc.hadoopConfiguration())

    def inside(self, name: str) -> StoredPath:
        return StoredPath(self._spark, f"{self.path.rstrip('/')}/{name}")

    def exists(self) -> bool:
        return self._fs.exists(self._hadoop)

    def children(self) -> list[str]:
        """Names of what a folder holds; none if there is no folder."""
        found = self._fs.listStatus(self._hadoop) if self.exists() else []
        return [s.getPath().getName() for s in found]

    def create(self, text: str = "") -> None:
        """Write a file that is there whole or not at all."""
        beside = self._hadoop.suffix(".part")
        stream = self._fs.create(beside, True)
        stream.write(bytearray(text.encode()))
        stream.close()
        if not self._fs.rename(beside, self._hadoop):
            raise FileExistsError(self.path)

    def text(self) -> str:
        return self._spark.read.text(self.path, wholetext=True).first()[0]

    def delete(self) -> None:
        self._fs.delete(self._hadoop, True)
