"""A few file operations on the table's own file system (local, HDFS, object store).

They run on the driver and handle names only, never rows; the JVM's Hadoop
client is used because it is the one that Spark itself writes with.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


class Files:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self.root = root.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._fs = self._at("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def exists(self, name: str = "") -> bool:
        return self._fs.exists(self._at(name))

    def names(self, folder: str = "") -> list[str]:
        """Names in a folder; none if it does not exist."""
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._at(folder))) if self.exists(folder) else []

    def read(self, name: str) -> str:
        stream = self._fs.open(self._at(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def publish(self, name: str, text: str) -> bool:
        """Bring a whole file into being under ``name`` in one step; False if there is one already."""
        folder, _, last = name.rpartition("/")
        draft = f"{folder}/_{last}-{uuid.uuid4().hex}"
        stream = self._fs.create(self._at(draft), False)
        stream.write(bytearray(text.encode()))
        stream.close()
        if not self.exists(name) and self.move(draft, name):
            return True
        self.delete(draft)
        return False

    def move(self, name: str, to: str) -> bool:
        self._fs.mkdirs(self._at(to.rpartition("/")[0]))
        return self._fs.rename(self._at(name), self._at(to))

    def delete(self, name: str = "") -> None:
        self._fs.delete(self._at(name), True)
