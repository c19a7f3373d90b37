"""Parquet sinks.

A path must never be overwritten by a frame that reads it; write a merge result
to a new path and point the readers there.
"""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..operators.dedup import keyed_snapshot
from ..operators.merge import COMMIT_COLUMN
from ..specs import DatasetSpec
from ..staging import stage


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), constant: Collection[str] = ()) -> int:
    """Overwrite ``path`` and return the rows written, counted by the writing tasks.

    Partitioned tables are rebalanced on their partition columns first: each
    value goes to few files, and adaptive execution splits a value that holds
    much of the table instead of giving it to one task. Columns that hold one
    value in all rows (``constant``) are no reason to move a row.
    """
    varying = [c for c in partition_by if c not in constant]
    balanced = df.hint("rebalance", *varying) if varying else df
    seen = Observation()
    counted = balanced.observe(seen, F.count(F.lit(1)).alias("rows"))
    counted.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return seen.get["rows"]


def write_snapshot(df: DataFrame, spec: DatasetSpec, path: str) -> int:
    """Write the dataset's keyed table: one row per key, the latest."""
    return write_table(keyed_snapshot(df, spec), path, spec.partition_by, dict(spec.constants))


def write_quarantine(invalid: DataFrame, path: str, rows: int | None = None) -> bool:
    """Overwrite the quarantine, unless there is nothing to quarantine.

    With no bad rows the previous run's files stay. Unless their number is known, the bad
    rows are written and counted in the shared folder first, so the input is run once.
    """
    if rows is not None:
        if rows:
            invalid.write.mode("overwrite").parquet(path)
        return rows > 0
    found = stage(invalid, "quarantine")
    if found.rows:
        found.frame.write.mode("overwrite").parquet(path)
    found.drop()
    return found.rows > 0


def write_commit(df: DataFrame, path: str, instant: str) -> None:
    """Add one commit to a commit log, a table partitioned by commit time.

    Writing the same instant again replaces that commit and leaves the others, so
    a job that is retried does not add its rows twice.
    """
    commit = df.withColumn(COMMIT_COLUMN, F.lit(instant))
    commit.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        COMMIT_COLUMN
    ).parquet(path)
