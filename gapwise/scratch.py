"""Lineage cuts: tables written to the shared folder named by ``spark.checkpoint.dir``."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_root(spark: SparkSession) -> str:
    """The session's checkpoint folder.

    The cluster names it in ``spark.checkpoint.dir``. Only a local master without that
    setting gets a temporary folder; on a cluster its absence is an error, because a
    machine-local folder would be lost with its machine.
    """
    context = spark.sparkContext
    folder = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        folder = tempfile.mkdtemp(prefix="gapwise-")
        context.setCheckpointDir(folder)
    return folder


TASKS_PER_CORE = 4  # of the tasks that write a narrow table


class Scratch:
    """Tables written by one job; superseded ones can be dropped as the job moves on."""

    def __init__(self, spark: SparkSession):
        self._spark = spark
        self._root = f"{scratch_root(spark).rstrip('/')}/gapwise-{uuid.uuid4().hex}"
        self._count = 0

    def new_path(self) -> str:
        self._count += 1
        return f"{self._root}/t{self._count}"

    def write(self, df: DataFrame) -> tuple[DataFrame, str]:
        """Write ``df`` as parquet; return the path and a frame of this session that reads it."""
        path = self.new_path()
        df.write.parquet(path)
        return self._spark.read.schema(df.schema).parquet(path), path

    def write_narrow(self, df: DataFrame) -> tuple[DataFrame, str]:
        """``write`` for rows of a few numbers: in a few files for each core, since every file costs time of its own."""
        return self.write(df.coalesce(TASKS_PER_CORE * self._spark.sparkContext.defaultParallelism))

    def drop(self, path: str) -> None:
        """Delete one table this object wrote."""
        if not path.startswith(self._root + "/"):
            raise ValueError(f"{path} was not written here")
        context = self._spark.sparkContext
        target = context._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(context._jsc.hadoopConfiguration()).delete(target, True)

    def keep_only(self, path: str) -> None:
        """Delete all tables of this object but one."""
        for count in range(1, self._count + 1):
            if (other := f"{self._root}/t{count}") != path:
                self.drop(other)
