"""Folders whose content is replaced as a whole, while others read it.

A version is a data folder that is written first and then named by an empty marker file, whose
creation is the swap: readers take the marker with the highest number, so they see the old
version or the new one. The version before stays until the next swap, for readers that
have begun. One writer at a time.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession, types as T

_MARKER = re.compile(r"v(\d+)\.(data-[0-9a-f]+)")


class Folder:
    """A folder on the file system that Spark writes to."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def names(self, below: str = "") -> list[str]:
        """Names of what lies in the folder, or in one below it; none where it is not there."""
        where = self._path(f"{self.path}/{below}" if below else self.path)
        if not self._fs.exists(where):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(where))

    def matching(self, pattern: str) -> list[str]:
        """Full paths below the folder that fit a pattern of file names."""
        return sorted(s.getPath().toString()
                      for s in self._fs.globStatus(self._path(f"{self.path}/{pattern}")) or [])

    def ensure(self) -> None:
        self._fs.mkdirs(self._path(self.path))

    def mark(self, name: str) -> None:
        """An empty file; fails where it is there already."""
        self._fs.create(self._path(f"{self.path}/{name}"), False).close()

    def remove(self, name: str = "") -> None:
        self._fs.delete(self._path(f"{self.path}/{name}" if name else self.path), True)


class Versions:
    """The versions below one folder."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.folder = spark, Folder(spark, path)

    def _markers(self) -> list[tuple[int, str]]:
        found = [_MARKER.fullmatch(n) for n in self.folder.names("_versions")]
        return sorted((int(m[1]), m[2]) for m in found if m)

    def current(self) -> str | None:
        """Folder of the current version."""
        markers = self._markers()
        return f"{self.folder.path}/{markers[-1][1]}" if markers else None

    def new(self) -> str:
        """Folder for a version that is not there yet."""
        return f"{self.folder.path}/data-{uuid.uuid4().hex}"

    def publish(self, data: str) -> None:
        """Make a written folder the current version; only the one before it stays."""
        markers = self._markers()
        number = markers[-1][0] + 1 if markers else 1
        name = data.rsplit("/", 1)[1]
        self.folder.mark(f"_versions/v{number:08d}.{name}")
        for old, kept in markers[:-1]:
            self.folder.remove(kept)
            self.folder.remove(f"_versions/v{old:08d}.{kept}")

    def read(self, schema: T.StructType) -> DataFrame:
        data = self.current()
        if data is None:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(data)

    def write(self, rows: DataFrame) -> None:
        data = self.new()
        rows.write.parquet(data)
        self.publish(data)
