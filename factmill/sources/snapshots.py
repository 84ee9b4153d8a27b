"""Versioned tables as immutable Parquet snapshots and a manifest that is added whole.

A commit writes new snapshot folders first and then one manifest that names the folders of every
table, so that several tables change together or not at all. Rows can also be appended: the table
then has one folder more. Paths go through Hadoop's file system, so any store that Spark reads will do.
"""

from __future__ import annotations

import json
import tempfile
import time
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

from ..operators import scd2

#: Seconds after which a number that was claimed but never committed may be taken over.
ABANDONED = 3600


def scratch(spark: SparkSession) -> str:
    """A new folder's name under the shared checkpoint folder, for a store that one query needs; in a local session that has none, under a temporary one."""
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if sc._jsc.sc().getCheckpointDir().isDefined():
        root = sc._jsc.sc().getCheckpointDir().get()
    if not root and not (sc.master == "local" or sc.master.startswith("local[")):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return f"{root or tempfile.mkdtemp(prefix='factmill-')}/store-{uuid.uuid4().hex}"


class Conflict(RuntimeError):
    """Another commit came between."""


class Store:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._fs = self._path("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def manifests(self) -> list[int]:
        if not self._fs.exists(self._path("_log")):
            return []
        return sorted(int(s.getPath().getName().split(".")[0]) for s in self._fs.listStatus(self._path("_log")) if s.getPath().getName().endswith(".json"))

    def tables(self, at: int | None = None) -> dict[str, list[str]]:
        """Table names and their folders as of a commit, the last by default."""
        known = [at] if at is not None else self.manifests()
        if not known:
            return {}
        text = self.spark.read.text(f"{self.root}/_log/{known[-1]:010d}.json", wholetext=True).first()
        return json.loads(text[0])

    def exists(self, table: str) -> bool:
        return table in self.tables()

    def read(self, table: str, at: int | None = None) -> DataFrame:
        folders = self.tables(at)[table]
        reader = self.spark.read.option("mergeSchema", "true") if len(folders) > 1 else self.spark.read
        return reader.parquet(*[f"{self.root}/{f}" for f in folders])

    def commit(self, append: dict[str, DataFrame] | None = None, **tables: DataFrame) -> int:
        """Write a snapshot of each table, and more rows of those in append, and make all of it current at once; gives the commit's number.

        The number and the state that it builds on come from one reading of the log, before anything
        is written. If another commit takes the number meanwhile, this one fails with Conflict and
        changes nothing.
        """
        last = (self.manifests() or [-1])[-1]
        now = self.tables(last) if last >= 0 else {}
        for name, df in [*tables.items(), *(append or {}).items()]:
            folder = f"{name}/{uuid.uuid4().hex}"
            df.write.parquet(f"{self.root}/{folder}")
            now[name] = [folder] if name in tables else [*now.get(name, []), folder]
        self._publish(last + 1, now)
        return last + 1

    def _publish(self, number: int, now: dict[str, list[str]]) -> None:
        """Claim the number, which one writer alone can, and then let the manifest appear whole."""
        self._fs.mkdirs(self._path("_log"))
        claim, final = self._path(f"_log/{number:010d}.claim"), self._path(f"_log/{number:010d}.json")
        if self._fs.exists(claim) and not self._fs.exists(final) and time.time() - self._fs.getFileStatus(claim).getModificationTime() / 1000 > ABANDONED:
            self._fs.delete(claim, False)
        try:
            self._fs.create(claim, False).close()
        except (Py4JJavaError, PySparkException) as e:
            raise Conflict(f"commit {number} was made by someone else") from e
        draft = self._path(f"_log/.{uuid.uuid4().hex}")
        out = self._fs.create(draft, False)
        try:
            out.write(bytearray(json.dumps(now).encode()))
        finally:
            out.close()
        if not self._fs.rename(draft, final):
            raise Conflict(f"commit {number} couldn't be published")

    def staged(self, df: DataFrame) -> DataFrame:
        """df written once beside the tables and read back, so that what is made from it, model answers among it, is made from the same rows. clear() removes it."""
        folder = f"{self.root}/_staging/{uuid.uuid4().hex}"
        df.write.parquet(folder)
        return self.spark.read.parquet(folder)

    def clear(self) -> None:
        """Remove what was staged; only when nothing that reads it is still to run."""
        self._fs.delete(self._path("_staging"), True)

    def views(self, suffix: str = "_active") -> list[str]:
        """A temporary view of the live rows of each versioned table, and of all rows of the others."""
        names = []
        for table in self.tables():
            df = self.read(table)
            versioned = {"is_current", "doc_deleted"} <= set(df.columns)
            names.append(table + suffix if versioned else table)
            (scd2.live(df) if versioned else df).createOrReplaceTempView(names[-1])
        return names
