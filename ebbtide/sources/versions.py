"""A folder whose contents change in one step.

Data is written to a folder of its own (``new_data``) that no reader looks at.
``commit`` then adds one small numbered file, the manifest, that names the data
folders of the new version; it is written aside and renamed, and fails if the
number is taken. Readers go by the manifest with the highest number, so a job
that dies before its commit leaves the version before it as it was, and of two
jobs that start from one version only the first commits.

Works through Hadoop's file systems, so on every path that Spark writes to.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


class VersionTaken(RuntimeError):
    """Another job committed this version."""


class Versions:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._path("").getFileSystem(self._conf)

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}" if name else self.folder)

    def numbers(self) -> list[int]:
        """All committed versions, ascending."""
        at = self._path("_versions")
        if not self._fs.exists(at):
            return []
        names = (f.getPath().getName() for f in self._fs.listStatus(at))
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n.removesuffix(".json").isdigit())

    def read(self, number: int) -> dict:
        stream = self._fs.open(self._path(f"_versions/{number:012d}.json"))
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def current(self) -> tuple[int, dict]:
        """The newest version and its manifest; (0, {}) where there is none."""
        known = self.numbers()
        return (known[-1], self.read(known[-1])) if known else (0, {})

    def new_data(self) -> str:
        """A folder for the data of a version to come."""
        return f"{self.folder}/data/{uuid.uuid4().hex}"

    def commit(self, number: int, manifest: dict) -> None:
        """Makes ``manifest`` version ``number``; one writer only gets a number."""
        aside = self._path(f"_versions/_aside-{uuid.uuid4().hex}")
        out = self._fs.create(aside)
        out.write(bytearray(json.dumps(manifest, indent=1).encode()))
        out.close()
        options = self._jvm.org.apache.hadoop.fs.Options.Rename
        none = self.spark.sparkContext._gateway.new_array(options, 1)
        none[0] = options.NONE
        files = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self._conf)
        try:
            files.rename(aside, self._path(f"_versions/{number:012d}.json"), none)
        except Exception as e:
            self._fs.delete(aside, False)
            if "FileAlreadyExistsException" in str(e):
                raise VersionTaken(f"version {number} of {self.folder} is taken") from e
            raise

    def prune(self, keep: int = 2) -> None:
        """Deletes versions before the newest ``keep``, and data that none of these names.

        Not while another job writes to this folder: its data is not named yet.
        """
        known = self.numbers()
        kept = json.dumps([self.read(n) for n in known[-keep:]])
        for n in known[:-keep]:
            self._fs.delete(self._path(f"_versions/{n:012d}.json"), False)
        data = self._path("data")
        for f in self._fs.listStatus(data) if self._fs.exists(data) else []:
            if f.getPath().getName() not in kept:
                self._fs.delete(f.getPath(), True)
