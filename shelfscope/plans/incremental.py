"""Incremental upsert of a keyed table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.dedup import keyed_snapshot
from ..operators.merge import replace_keys
from ..sinks import write_table
from ..sources import added_columns, read_snapshot
from ..specs import DatasetSpec
from ..staging import stage

SUMMARY_SCHEMA = "inserts bigint, updates bigint, total_rows bigint"


def upsert_snapshot(
    spark: SparkSession,
    spec: DatasetSpec,
    base_path: str,
    incoming: DataFrame,
    target_path: str,
) -> DataFrame:
    """Write ``base`` with ``incoming`` upserted to a new folder; return the summary.

    ``incoming`` holds trusted rows of one batch. Columns that it adds are NULL for the
    keys it does not touch, and columns that earlier batches added stay, NULL for its
    own keys if it lacks them. The folder that is read is never the one written, so a
    failed run leaves the old version in place and can simply be repeated.

    The batch is written first, so the anti join knows its real size. The summary
    follows from three row counts (the base's from its file footers), as both
    sides hold one row per key; it costs no second join.
    """
    if target_path.rstrip("/") == base_path.rstrip("/"):
        raise ValueError("write the merged table to a new path, not over the one it reads")
    batch = stage(keyed_snapshot(incoming, spec), f"{spec.name}-batch")
    base = read_snapshot(spark, spec, base_path, added_columns(spark, spec, base_path))
    merged = replace_keys(base, batch.frame, spec.keys)
    total = write_table(merged, target_path, spec.partition_by, dict(spec.constants))
    inserts = total - base.count()
    return spark.createDataFrame([(inserts, batch.rows - inserts, total)], SUMMARY_SCHEMA)
