"""Written intermediate tables in the cluster's shared folder.

A staged table cuts the lineage the durable way: it survives the loss of any
executor, it is computed once however often it is read, and, unlike a cached or
checkpointed frame, its scan reports its real size, so Catalyst broadcasts it in
a later join only when that size is under ``spark.sql.autoBroadcastJoinThreshold``
and shuffles otherwise. The row count taken while writing is exact, which lets a
caller size partitions, or decide on a broadcast, from a fact.

Whoever stages a table owns it. A ``Workspace`` groups the tables of one job and
drops them; what a returned frame still reads stays until its reader is done.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def shared_root(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir``, else the context's checkpoint folder.

    There is no fallback: a machine-local folder would lose rows on a cluster.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not configured:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return configured.rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that nothing has used before."""
    return f"{shared_root(spark)}/shelfscope-{label}-{uuid.uuid4().hex}"


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, in any store that Spark reads."""
    system, target = _file_system(spark, path)
    return system.exists(target)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder; none if there is no such folder."""
    system, target = _file_system(spark, path)
    return [status.getPath().getName() for status in system.listStatus(target)] if system.exists(target) else []


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a staged table; one that is gone already is no error."""
    system, target = _file_system(spark, path)
    system.delete(target, True)


@dataclass(frozen=True)
class Staged:
    """A written table and the figures observed while it was written."""

    frame: DataFrame
    rows: int
    figures: dict = field(default_factory=dict)
    path: str = ""

    def drop(self) -> None:
        """Delete the files. Frames that still read them fail from here on."""
        drop_path(self.frame.sparkSession, self.path)


def stage(
    df: DataFrame,
    label: str,
    partition_by: tuple[str, ...] = (),
    path: str | None = None,
    **figures: Column,
) -> Staged:
    """Write ``df``, count it on the way out, and return the frame to read.

    The counts ride on the tasks that write the files, whose results Spark takes
    exactly once, so a retried task or a lost executor cannot count a row twice.
    """
    spark = df.sparkSession
    target = path or fresh_path(spark, label)
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"), *(c.alias(n) for n, c in figures.items()))
    counted.write.mode("overwrite").partitionBy(*partition_by).parquet(target)
    values = seen.get
    return Staged(
        frame=spark.read.schema(df.schema).parquet(target).select(*df.columns),
        rows=values["rows"],
        figures={name: values[name] for name in figures},
        path=target,
    )


class Workspace:
    """One folder for the staged tables of a job.

    As a context manager it drops the whole folder at the end; without ``with`` the
    caller does, once nothing reads the tables any more.
    """

    def __init__(self, spark: SparkSession, label: str, path: str | None = None) -> None:
        self.spark = spark
        self.path = path or fresh_path(spark, label)

    def stage(self, df: DataFrame, name: str, **figures: Column) -> Staged:
        """Write ``df`` under this folder; every call uses a new place."""
        return stage(df, name, path=f"{self.path}/{name}-{uuid.uuid4().hex[:8]}", **figures)

    def drop(self) -> None:
        drop_path(self.spark, self.path)

    def __enter__(self) -> Workspace:
        return self

    def __exit__(self, *_) -> None:
        self.drop()
