"""Intermediate tables in the shared folder named by ``spark.checkpoint.dir``.

A written table survives the loss of executors, cuts lineage, and gives Catalyst
its true size, so a join with it is broadcast only when the files really are below
``spark.sql.autoBroadcastJoinThreshold`` and is shuffled otherwise.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


class Scratch:
    """A folder of intermediate tables belonging to one Spark application."""

    _open: dict[str, "Scratch"] = {}

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = f"{root.rstrip('/')}/pannier-{spark.sparkContext.applicationId}-{uuid.uuid4().hex[:8]}"

    @classmethod
    def of(cls, spark: SparkSession) -> "Scratch":
        """The application's scratch folder, created on first use."""
        app = spark.sparkContext.applicationId
        if app not in cls._open:
            cls._open[app] = cls(spark, shared_folder(spark))
        return cls._open[app]

    def path(self, label: str) -> str:
        """A path that has not been used before."""
        return f"{self.root}/{label}-{uuid.uuid4().hex[:8]}"

    def keep(self, df: DataFrame, label: str, partition_by: list[str] | None = None) -> DataFrame:
        """Write ``df`` once and return a scan of the written table."""
        path = self.path(label)
        writer = df.write.partitionBy(*partition_by) if partition_by else df.write
        writer.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def discard(self, *tables: DataFrame) -> None:
        """Delete tables that ``keep`` returned and that nothing reads again."""
        for df in tables:
            for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
                if self.root.split(":", 1)[-1].lstrip("/") in folder:
                    delete(self.spark, folder)

    def drop(self) -> None:
        """Delete the folder; tables kept in it can no longer be read."""
        delete(self.spark, self.root)
        Scratch._open.pop(self.spark.sparkContext.applicationId, None)


def _file_system(spark: SparkSession, path: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder, in whatever store the path names."""
    files, path = _file_system(spark, path)
    return files.exists(path)


def files_state(spark: SparkSession, paths: list[str]) -> str:
    """Lengths and times of the files at the paths and in folders there, as text."""
    states = []
    for path in paths:
        files, root = _file_system(spark, path)
        found = files.globStatus(root)
        for status in found or []:
            inside = files.listStatus(status.getPath()) if status.isDirectory() else [status]
            states += [f"{s.getPath()}:{s.getLen()}:{s.getModificationTime()}" for s in inside]
    return "\n".join(sorted(states))


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever store the path names."""
    files, path = _file_system(spark, path)
    files.delete(path, True)


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``, or else a folder in Spark's warehouse. Both must be shared by all executors."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return folder or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/pannier-scratch"
