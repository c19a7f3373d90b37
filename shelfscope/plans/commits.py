"""A commit log with full snapshots beside the commits.

The table at any instant is the last snapshot before it and the commits since, so what a
read costs depends on the commits between two snapshots, not on the age of the table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.merge import COMMIT_COLUMN, as_of, commit_timeline
from ..sinks import write_commit, write_table
from ..sources import read_commit_log
from ..staging import drop_path, folder_names, path_exists

#: Commits from one snapshot to the next.
EVERY = 16


class CommitLog:
    """Commits under ``path``, a partition each, and a snapshot in its ``_snapshots`` after every ``every`` of them.

    Instants are strings in the order of time. Writing an instant again replaces that
    commit and drops the snapshots from it on, so a job that is retried, or a commit that
    is corrected, leaves no trace of the first try.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], schema: T.StructType, every: int = EVERY) -> None:
        self.spark = spark
        self.path = path.rstrip("/")
        self.keys = list(keys)
        self.schema = schema
        self.every = every

    def append(self, rows: DataFrame, instant: str) -> None:
        """Add one commit, and a snapshot when it is time for one."""
        # First, so that no reader combines an old snapshot with a commit that replaced one in it.
        for later in (s for s in self.snapshots() if s >= instant):
            drop_path(self.spark, self._snapshot_path(later))
        write_commit(rows, self.path, instant)
        base = max((s for s in self.snapshots() if s <= instant), default="")
        since = [c for c in self.instants() if base < c <= instant]
        if len(since) >= self.every:
            self.snapshot(instant)

    def snapshot(self, instant: str) -> int:
        """Write the table as it stood at ``instant``; return its rows."""
        return write_table(self.as_of(instant), self._snapshot_path(instant))

    def instants(self) -> list[str]:
        """The commits, one short name each."""
        prefix = f"{COMMIT_COLUMN}="
        return sorted(name.removeprefix(prefix) for name in folder_names(self.spark, self.path) if name.startswith(prefix))

    def snapshots(self) -> list[str]:
        """The instants of complete snapshots."""
        names = folder_names(self.spark, f"{self.path}/_snapshots")
        return sorted(n for n in names if path_exists(self.spark, f"{self._snapshot_path(n)}/_SUCCESS"))

    def as_of(self, instant: str) -> DataFrame:
        """The table at ``instant``, each row with the commit it came by; older commits are not read."""
        base = max((s for s in self.snapshots() if s <= instant), default=None)
        commits = read_commit_log(self.spark, self.path, self.schema) if self.instants() else None
        fields = [*self.schema.fields, T.StructField(COMMIT_COLUMN, T.StringType())]
        if commits is None:
            return self.spark.createDataFrame([], T.StructType(fields))
        if base is not None:
            start = self.spark.read.schema(T.StructType(fields)).parquet(self._snapshot_path(base))
            commits = start.unionByName(commits.filter(F.col(COMMIT_COLUMN) > base))
        return as_of(commits, self.keys, instant)

    def timeline(self) -> DataFrame:
        """Commits in order with the rows each of them wrote."""
        return commit_timeline(read_commit_log(self.spark, self.path, self.schema))

    def _snapshot_path(self, instant: str) -> str:
        return f"{self.path}/_snapshots/{instant}"
