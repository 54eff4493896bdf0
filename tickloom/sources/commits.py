"""A numbered commit log in a shared folder.

Data files are written first, under names nobody reads yet; a commit, a small
JSON file that names them, is published last.  A commit is written aside and renamed
to its number without overwriting, so it is seen whole or not at all, and of two
writers that want one number only the first gets it.  Files of a writer that
died are named by no commit and therefore never read.

Only metadata passes through the driver: one small file per commit.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


class CommitLog:
    """The commits of ``folder``, on any file system Spark can reach."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._jvm = spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")

    def _files(self):
        return self._path("_").getFileSystem(self._conf)

    def numbers(self) -> list[int]:
        """All commit numbers, ascending; a folder without commits has none."""
        files, folder = self._files(), self._jvm.org.apache.hadoop.fs.Path(self.folder)
        if not files.exists(folder):
            return []
        names = [s.getPath().getName() for s in files.listStatus(folder)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def has(self, number: int) -> bool:
        return self._files().exists(self._path(f"{number:012d}.json"))

    def read(self, number: int) -> dict:
        stream = self._files().open(self._path(f"{number:012d}.json"))
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def latest(self) -> tuple[int, dict] | None:
        numbers = self.numbers()
        return (numbers[-1], self.read(numbers[-1])) if numbers else None

    def publish(self, number: int, body: dict) -> bool:
        """Commit ``body`` as ``number``; False if that number is taken."""
        files, target = self._files(), self._path(f"{number:012d}.json")
        aside = self._path(f".{uuid.uuid4().hex}.tmp")
        out = files.create(aside, False)
        try:
            out.write(bytearray(json.dumps(body).encode("utf-8")))
        finally:
            out.close()
        fs = self._jvm.org.apache.hadoop.fs
        options = self.spark.sparkContext._gateway.new_array(fs.Options.Rename, 1)
        options[0] = fs.Options.Rename.NONE  # never overwrite
        try:
            fs.FileContext.getFileContext(files.getUri(), self._conf).rename(aside, target, options)
        except Exception as e:  # noqa: BLE001
            if files.exists(target):
                files.delete(aside, False)
                return False
            raise RuntimeError(f"commit {number} of {self.folder} could not be published") from e
        return True
