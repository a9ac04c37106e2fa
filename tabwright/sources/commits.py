"""An append-only log of numbered commits in a folder that all writers share.

Commit ``n`` is a folder of that name with one JSON file in it. A writer prepares the folder
under a name of its own and renames it; a rename never replaces a folder that holds a
file, so of two writers that want one number a single one gets it, and the other reads
what has been committed and tries the next. Numbers have no gaps and never change, and clocks play
no part. This needs a file system with an atomic rename (HDFS, a local or mounted disk, ABFS), as
Spark's own checkpoints do.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Digits of a commit's name.
DIGITS = 20


class CommitLog:
    """Commits of one kind of record; ``schema`` is that of the record, as DDL text."""

    def __init__(self, spark: SparkSession, path: str, schema: str):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        jvm = spark._jvm
        self._jpath = jvm.org.apache.hadoop.fs.Path
        self._fs = self._jpath(self.path).getFileSystem(spark._jsc.hadoopConfiguration())
        self._bytes = jvm.org.apache.commons.io.IOUtils

    def last(self) -> int:
        """The highest number committed, 0 if there is none."""
        folder = self._jpath(self.path)
        if not self._fs.exists(folder):
            return 0
        names = [s.getPath().getName() for s in self._fs.listStatus(folder)]
        return max((int(n) for n in names if n.isdigit()), default=0)

    def rows(self) -> DataFrame:
        """All commits: ``number`` and the columns of the record."""
        last = self.last()
        if not last:
            return self.spark.createDataFrame([], f"number long, {self.schema}")
        # names are fixed by the number, so what is read does not depend on a listing
        files = [f"{self._folder(n)}/commit.json" for n in range(1, last + 1)]
        return self.spark.read.schema(f"number long, {self.schema}").json(files)

    def append(self, record_of: Callable[[DataFrame], dict]) -> dict:
        """Commits the record that ``record_of`` makes of the commits so far, and returns it.

        After a conflict it is asked again, with the commits that came in between.
        """
        while True:
            number = self.last() + 1
            record = {"number": number, **record_of(self.rows())}
            if self._put(number, record):
                return record

    def _folder(self, number: int) -> str:
        return f"{self.path}/{number:0{DIGITS}d}"

    def _put(self, number: int, record: dict) -> bool:
        """True if this record, and no other, is now commit ``number``."""
        token = uuid.uuid4().hex
        mine, target = self._jpath(f"{self.path}/.new-{token}"), self._jpath(self._folder(number))
        out = self._fs.create(self._jpath(f"{mine}/commit.json"), False)
        try:
            out.write(bytearray(json.dumps({**record, "token": token}).encode()))
        finally:
            out.close()
        if not self._fs.exists(target):
            try:
                self._fs.rename(mine, target)
            except (Py4JJavaError, PySparkException):
                pass  # someone else was first; what counts is read below
        stored = self._read(f"{target}/commit.json")
        self._fs.delete(mine, True)
        return stored.get("token") == token

    def _read(self, file: str) -> dict:
        stream = self._fs.open(self._jpath(file))
        try:
            return json.loads(self._bytes.toString(stream, "UTF-8"))
        finally:
            stream.close()


def latest(rows: DataFrame, by: str, *columns: str) -> DataFrame:
    """Per value of ``by`` the columns of its highest number."""
    picked = F.max_by(F.struct(*columns), "number").alias("r")
    return rows.groupBy(by).agg(picked).select(by, *(F.col(f"r.{c}").alias(c) for c in columns))
