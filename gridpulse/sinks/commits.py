"""Numbered commits: what a run has written counts once its commit file stands.

A run writes under names of its own and touches nothing that readers see.
Its last step creates one small file, ``<root>/_commits/<number>``, that
names the run.  File systems create a file once or fail, so of two runs that
started from the same state one commits and the other one raises; a run that
dies before leaves the state of the run before it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


class Commits:
    """The commits under one root folder."""

    def __init__(self, spark: SparkSession, root: str):
        jvm = spark.sparkContext._jvm
        self.spark, self.root = spark, root.rstrip("/")
        self._path = jvm.org.apache.hadoop.fs.Path
        self._text = jvm.org.apache.commons.io.IOUtils
        self.folder = self._path(f"{self.root}/_commits")
        self.fs = self.folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _numbers(self) -> list[int]:
        if not self.fs.exists(self.folder):
            return []
        return sorted(int(n) for f in self.fs.listStatus(self.folder) if (n := f.getPath().getName()).isdigit())

    def _run(self, number: int) -> str:
        stream = self.fs.open(self._path(self.folder, f"{number:09d}"))
        try:
            return self._text.toString(stream, "UTF-8")
        finally:
            stream.close()

    def last(self) -> tuple[int, str | None]:
        """Number and run of the newest commit; 0 and None if there is none."""
        numbers = self._numbers()
        return (numbers[-1], self._run(numbers[-1])) if numbers else (0, None)

    def after(self, number: int) -> list[str]:
        """The runs committed after that number, oldest first."""
        return [self._run(n) for n in self._numbers() if n > number]

    def new_run(self) -> str:
        """A name for a run that follows the newest commit."""
        return f"{self.last()[0] + 1:09d}-{uuid.uuid4().hex[:8]}"

    def add(self, run: str) -> None:
        """Commit ``run``; fails if another run has been committed since its name was given."""
        stream = self.fs.create(self._path(self.folder, run.split("-")[0]), False)
        try:
            stream.write(bytearray(run.encode()))
        finally:
            stream.close()

    def remove(self, name: str) -> None:
        """Delete a file or folder under the root that no reader uses."""
        self.fs.delete(self._path(f"{self.root}/{name}"), True)
