"""The folder that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``; where that is unset in a session of one machine (tests), a temporary one."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.gridloom.checkpoint.dir", None)
    if not found:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="gridloom-")
        spark.conf.set("spark.gridloom.checkpoint.dir", found)
    return found


#: The innermost open ``Scratch``.
_OPEN: ContextVar[Scratch | None] = ContextVar("scratch", default=None)


def fresh_path(spark: SparkSession, kind: str) -> str:
    """A new path in the shared folder; inside a ``Scratch`` its end removes what is there."""
    path = f"{shared_dir(spark)}/{kind}-{uuid.uuid4().hex}"
    if scratch := _OPEN.get():
        scratch.paths.append(path)
    return path


def kept(df: DataFrame) -> DataFrame:
    """A table as it is now: written to the shared folder and read back."""
    path = fresh_path(df.sparkSession, "kept")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Scratch:
    """Tables that a job keeps for as long as it runs: the end of the block removes all that were stored in it.

    ``keep`` stores one; operators store theirs in the shared folder as well.  Their results read such tables, so
    write a result inside the block: ``with Scratch(spark): operator(df).write.parquet(path)``.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.paths = spark, []

    def __enter__(self) -> Scratch:
        self._before = _OPEN.set(self)
        return self

    def __exit__(self, *failure) -> None:
        _OPEN.reset(self._before)
        removed(self.spark, *self.paths)

    def keep(self, df: DataFrame) -> DataFrame:
        return kept(df)


def file_system(spark: SparkSession, path: str):
    """Hadoop's path and its file system, of any kind that Spark knows."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def removed(spark: SparkSession, *paths: str) -> None:
    for path in paths:
        p, system = file_system(spark, path)
        system.delete(p, True)


def versions(spark: SparkSession, path: str) -> list[int]:
    """The finished versions below a path, ascending: folders ``v=<number>`` that Spark has marked as whole."""
    p, system = file_system(spark, path)
    if not system.exists(p):
        return []
    names = [s.getPath().getName() for s in system.listStatus(p) if s.isDirectory()]
    return sorted(int(n[2:]) for n in names if n[:2] == "v=" and n[2:].isdigit() and system.exists(file_system(spark, f"{path}/{n}/_SUCCESS")[0]))
