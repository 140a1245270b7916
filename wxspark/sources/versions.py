"""Numbered versions of a folder's data, of which readers see the committed ones only."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Versions:
    """A version is whatever its writer put into folders that carry its number. It counts once an empty file of
    that number stands in ``committed``: creating an empty file is one step on any store, so a reader sees the version
    before or the whole new one. Nothing is overwritten or deleted, so what a reader has opened stays.

    There is one writer at a time; a second one that takes the same number is told so when it commits.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _at(self, name: str):
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def numbers(self) -> list[int]:
        """The committed versions, oldest first."""
        files, folder = self._at("committed")
        if not files.exists(folder):
            return []
        return sorted(int(s.getPath().getName()) for s in files.listStatus(folder) if s.getPath().getName().isdigit())

    def current(self) -> int | None:
        return max(self.numbers(), default=None)

    def next(self) -> int:
        return (self.current() or 0) + 1

    def commit(self, number: int) -> None:
        files, marker = self._at(f"committed/{number:010d}")
        if not files.createNewFile(marker):
            raise RuntimeError(f"version {number} of {self.path} has been committed by another writer")
