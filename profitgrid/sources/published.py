"""Tables that readers always see whole and that several runs may write.

Below a table's path ``parts/<name>`` are folders of Parquet files that never change, and ``commits/<number>`` is
a small file that lists the parts of one version. A write first stores its part; nobody sees it. Then it
publishes the next version by renaming a finished file into place, which fails if another run took the number:
it looks again at what is stored now, checks its keys against that and tries the next number. A run that fails
midway leaves the last version as it was.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

Parts = tuple[str, ...]


class Published:
    """The versions of the table at ``path``, on any file system that Hadoop knows."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        context = spark.sparkContext
        self._hadoop = context._jvm.org.apache.hadoop
        self._conf = context._jsc.hadoopConfiguration()
        self._gateway = context._gateway
        self._fs = self._at().getFileSystem(self._conf)

    def _at(self, *below: str):
        return self._hadoop.fs.Path("/".join([self.path, *below]))

    def version(self) -> tuple[int, Parts]:
        """Number and parts of the last version; 0 and none before the first."""
        folder = self._at("commits")
        if not self._fs.exists(folder):
            return 0, ()
        names = [status.getPath().getName() for status in self._fs.listStatus(folder)]
        numbers = [int(n) for n in names if n.isdigit()]
        if not numbers:
            return 0, ()
        stream = self._fs.open(self._at("commits", f"{max(numbers):012d}"))
        try:
            text = self._hadoop.io.IOUtils.readFullyToByteArray(stream)
        finally:
            stream.close()
        return max(numbers), tuple(bytes(text).decode().split())

    def publish(self, number: int, parts: Parts) -> bool:
        """Make ``parts`` version ``number``. False if that version is there already."""
        draft, final = self._at("commits", f"draft-{uuid.uuid4().hex}"), self._at("commits", f"{number:012d}")
        stream = self._fs.create(draft, False)
        try:
            stream.write(bytearray("\n".join(parts).encode()))
        finally:
            stream.close()
        options = self._gateway.new_array(getattr(self._hadoop.fs, "Options$Rename"), 0)
        files = self._hadoop.fs.FileContext.getFileContext(self._at().toUri(), self._conf)
        try:
            files.rename(self._fs.makeQualified(draft), self._fs.makeQualified(final), options)
        except Py4JJavaError as error:
            self._fs.delete(draft, False)
            if "FileAlreadyExists" in error.java_exception.getClass().getName():
                return False
            raise
        return True

    def folder(self, part: str) -> str:
        return f"{self.path}/parts/{part}"

    def write(self, rows: DataFrame, partition_by: list[str] | None = None) -> str:
        """Store a part that no version lists yet and return its name."""
        name = uuid.uuid4().hex
        rows.write.partitionBy(*(partition_by or [])).parquet(self.folder(name))
        return name

    def read(self, parts: Parts, schema=None) -> DataFrame | None:
        """The rows of some parts, or None if there are none."""
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        frames = [reader.parquet(self.folder(p)) for p in parts]
        return reduce(DataFrame.unionByName, frames) if frames else None

    def commit(self, next_parts: Callable[[Parts], Parts]) -> Parts:
        """Publish what ``next_parts`` makes of the present parts. Whenever another run was first, ``next_parts``
        is asked again with the parts that there are then."""
        while True:
            number, parts = self.version()
            made = next_parts(parts)
            if self.publish(number + 1, made):
                return made

    def change(self, schema, next_parts: Callable[[Parts], Parts]) -> DataFrame:
        """The same; returns the table."""
        return self.read(self.commit(next_parts), schema)

    def remove_unlisted(self, versions: int = 2) -> int:
        """Delete the parts that none of the last versions lists, and return how many they were.

        For times without writers: a part whose version is not published yet is not listed either.
        """
        number, _ = self.version()
        listed: set[str] = set()
        for n in range(max(1, number - versions + 1), number + 1):
            stream = self._fs.open(self._at("commits", f"{n:012d}"))
            listed |= set(bytes(self._hadoop.io.IOUtils.readFullyToByteArray(stream)).decode().split())
            stream.close()
        folder = self._at("parts")
        stored = [s.getPath() for s in self._fs.listStatus(folder)] if self._fs.exists(folder) else []
        unlisted = [p for p in stored if p.getName() not in listed]
        for path in unlisted:
            self._fs.delete(path, True)
        return len(unlisted)
