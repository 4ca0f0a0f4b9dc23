"""A log of small JSON documents in a shared folder: the newest one is the truth.

A commit writes a file beside the log and renames it to the next number.
A number that is taken is a conflict: the writer reads again and decides
anew.  One writer at a time is the normal case; a reader sees whole
documents only, and one that holds a number keeps its view.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


class ManifestConflict(RuntimeError):
    """Another writer committed first."""


class ManifestLog:
    """Numbered documents below ``path``; ``keep`` of them stay."""

    def __init__(self, spark: SparkSession, path: str, keep: int = 5):
        self.spark, self.path, self.keep = spark, path.rstrip("/"), keep
        self._fs_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path  # noqa: SLF001
        self._fs = self._fs_path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())  # noqa: SLF001

    def numbers(self) -> list[int]:
        """The numbers there, ascending."""
        at = self._fs_path(self.path)
        if not self._fs.exists(at):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(at)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def read(self, number: int) -> dict:
        """The document of a number."""
        stream = self._fs.open(self._fs_path(f"{self.path}/{number:012d}.json"))
        try:
            text = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")  # noqa: SLF001
        finally:
            stream.close()
        return json.loads(text)

    def latest(self) -> tuple[int, dict | None]:
        """The newest number and document (0 and None where there is none)."""
        found = self.numbers()
        return (found[-1], self.read(found[-1])) if found else (0, None)

    def commit(self, after: int, doc: dict) -> int:
        """Make ``doc`` the successor of ``after``."""
        target = self._fs_path(f"{self.path}/{after + 1:012d}.json")
        draft = self._fs_path(f"{self.path}/_{uuid.uuid4().hex}.tmp")
        out = self._fs.create(draft, False)
        try:
            out.write(bytearray(json.dumps(doc), "utf-8"))
        finally:
            out.close()
        # the check covers file systems whose rename replaces a file
        if self._fs.exists(target) or not self._fs.rename(draft, target):
            self._fs.delete(draft, False)
            raise ManifestConflict(f"{self.path}: number {after + 1} is taken")
        for number in self.numbers()[:-self.keep]:
            self._fs.delete(self._fs_path(f"{self.path}/{number:012d}.json"), False)
        return after + 1

    def kept(self) -> list[dict]:
        """All documents that readers may still use."""
        return [self.read(n) for n in self.numbers()]

    def folders(self, below: str) -> list[str]:
        """Names of the folders below one."""
        at = self._fs_path(below)
        if not self._fs.exists(at):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(at) if s.isDirectory())


def covered(intervals: list[list[int]], number: int) -> bool:
    """Whether a batch number is in one of the closed intervals."""
    return any(a <= number <= b for a, b in intervals)


def joined(intervals: list[list[int]]) -> list[list[int]]:
    """The same numbers as few closed intervals."""
    out: list[list[int]] = []
    for a, b in sorted(intervals):
        if out and a <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out
