"""A keyed table in hash buckets, of which an upsert rewrites only those its batch touches.

The bucket is a partition column, a hash of the key (or of part of it), so the rows of a
bucket lie in files of their own. An upsert names the buckets of its batch, at most as
many numbers as there are buckets, reads those, merges, and overwrites those: the files
of all others stay as they are.

The merged buckets are first written beside the table as a pending change. From the
moment that write is complete, readers see the new version: pending buckets instead of
the table's. Only then are the table's own files replaced. A run that dies in between
loses nothing; the next one begins by replacing them again, from the same pending files.
One writer at a time; a reader that began before may have to be repeated.

Buckets should hold some hundred megabytes each: the table's size over 500 MB is a good
number. ``by`` decides what a batch touches: a batch of few sellers touches few buckets of
a table bucketed by seller, whereas keys spread at random touch one bucket each. All keys
together spread evenly; a single part does so only if no value of it holds much of the table.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.dedup import keyed_snapshot
from ..operators.merge import replace_keys
from ..sinks import write_table
from ..specs import DatasetSpec
from ..staging import drop_path, path_exists, stage
from .commits import CommitLog

BUCKET = "_bucket"
BUCKET_SUMMARY = "inserts bigint, updates bigint, total_rows bigint, touched_buckets int, buckets int"
_LAYOUT = "buckets int, by array<string>, columns string"


@dataclass(frozen=True)
class _Layout:
    """How the table is stored, and all columns that any batch brought."""

    buckets: int
    by: list[str]
    columns: T.StructType

    def bucket(self) -> Column:
        # A NULL key part hashes like any value.
        return F.pmod(F.xxhash64(*self.by), F.lit(self.buckets)).cast("int")


class BucketedTable:
    """A dataset's keyed table under ``path``: the latest row per key, in hash buckets."""

    def __init__(self, spark: SparkSession, spec: DatasetSpec, path: str) -> None:
        self.spark = spark
        self.spec = spec
        self.path = path.rstrip("/")
        # Scans pass over folders that begin with an underscore.
        self._pending_path = f"{self.path}/_pending"
        self._layout_path = f"{self.path}/_layout"

    def exists(self) -> bool:
        """Whether the table was created; its layout is written last."""
        return path_exists(self.spark, f"{self._layout_path}/_SUCCESS")

    def create(self, rows: DataFrame, buckets: int, by: Sequence[str] = ()) -> int:
        """Write ``rows`` as a new table, one row per key, over whatever is there; return their number."""
        if buckets < 1:
            raise ValueError("a table needs at least one bucket")
        snapshot = keyed_snapshot(rows, self.spec)
        layout = _Layout(buckets, list(by or self.spec.keys), snapshot.schema)
        written = write_table(snapshot.withColumn(BUCKET, layout.bucket()), self.path, (BUCKET,))
        self._save(layout)
        return written

    def read(self) -> DataFrame:
        """The table as the last complete upsert left it; columns that a row's batch lacked are NULL."""
        layout = self._layout()
        frame = self._scan(self.path, layout)
        if self._is_pending():
            changed = self._scan(self._pending_path, layout)
            frame = frame.filter(~F.col(BUCKET).isin(*self._buckets_of(changed))).unionByName(changed)
        return frame.drop(BUCKET)

    def upsert(self, incoming: DataFrame, log_path: str | None = None, instant: str | None = None) -> DataFrame:
        """Insert new keys and replace existing ones; return the summary, one row of ``BUCKET_SUMMARY``.

        ``incoming`` holds trusted rows of one batch, several per key or none. NULL equals NULL
        in a key. New columns are added to the table. The same batch again changes no row.
        With ``log_path`` the batch's rows also become the commit ``instant`` of a ``CommitLog``,
        which is written first: what the table shows, the log has.
        """
        self._finish()
        layout = self._layout()
        batch = stage(keyed_snapshot(incoming, self.spec).withColumn(BUCKET, layout.bucket()), f"{self.spec.name}-batch")
        touched = self._buckets_of(batch.frame)
        layout = self._with_columns(layout, batch.frame.drop(BUCKET).schema)
        if log_path is not None:
            CommitLog(self.spark, log_path, self.spec.keys, layout.columns).append(batch.frame.drop(BUCKET), instant)
        inserts = 0
        if touched:
            base = self._scan(self.path, layout).filter(F.col(BUCKET).isin(*touched))
            merged = replace_keys(base, batch.frame, [BUCKET, *self.spec.keys])
            # Both sides hold one row per key, so the counts say which keys were new.
            inserts = write_table(merged, self._pending_path, (BUCKET,)) - base.count()
            self._finish()
        total = self._scan(self.path, layout).count()
        summary = (inserts, batch.rows - inserts, total, len(touched), layout.buckets)
        batch.drop()
        return self.spark.createDataFrame([summary], BUCKET_SUMMARY)

    def _finish(self) -> None:
        """Put a complete pending change in place; an incomplete one never counted."""
        if self._is_pending():
            changed = self._scan(self._pending_path, self._layout())
            options = changed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            options.partitionBy(BUCKET).parquet(self.path)
        drop_path(self.spark, self._pending_path)

    def _is_pending(self) -> bool:
        return path_exists(self.spark, f"{self._pending_path}/_SUCCESS")

    def _buckets_of(self, frame: DataFrame) -> list[int]:
        return sorted(row[0] for row in frame.select(BUCKET).distinct().collect())

    def _scan(self, path: str, layout: _Layout) -> DataFrame:
        schema = T.StructType([*layout.columns.fields, T.StructField(BUCKET, T.IntegerType())])
        return self.spark.read.schema(schema).parquet(path).select(*schema.names)

    def _save(self, layout: _Layout) -> None:
        row = (layout.buckets, layout.by, layout.columns.json())
        self.spark.createDataFrame([row], _LAYOUT).coalesce(1).write.mode("append").json(self._layout_path)

    def _layout(self) -> _Layout:
        """One row for the table and one for each batch that brought new columns."""
        rows = self.spark.read.schema(_LAYOUT).json(self._layout_path).collect()
        columns = T.StructType()
        for schema in sorted((T.StructType.fromJson(json.loads(row.columns)) for row in rows), key=len):
            columns = _joined(columns, schema)
        return _Layout(rows[0].buckets, list(rows[0].by), columns)

    def _with_columns(self, layout: _Layout, schema: T.StructType) -> _Layout:
        columns = _joined(layout.columns, schema)
        if len(columns) > len(layout.columns):
            layout = _Layout(layout.buckets, layout.by, columns)
            # Before the files that have them: older files read as NULL.
            self._save(layout)
        return layout


def _joined(known: T.StructType, other: T.StructType) -> T.StructType:
    """All fields of both, the known ones first; a field cannot change its type."""
    fields = list(known.fields)
    for field in other.fields:
        if field.name not in known.names:
            fields.append(T.StructField(field.name, field.dataType))
        elif known[field.name].dataType != field.dataType:
            raise ValueError(f"column {field.name} is {known[field.name].dataType.simpleString()}, not {field.dataType.simpleString()}")
    return T.StructType(fields)
