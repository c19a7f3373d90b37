"""Incremental keyed merges and reads of a commit log."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .dedup import first_per_key, latest_per_key

COMMIT_COLUMN = "commit_time"


def reconcile(older: DataFrame, newer: DataFrame) -> DataFrame:
    """Rows of both frames; a column only one of them has is NULL for the other."""
    return older.unionByName(newer, allowMissingColumns=True)


def without_keys(base: DataFrame, gone: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``base`` whose key ``gone`` does not have; a NULL key part equals a NULL."""
    return base.join(_named(gone, keys), _same_key(keys), "left_anti")


def _named(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.select(*(F.col(key).alias(f"_other_{key}") for key in keys))


def _same_key(keys: Sequence[str]) -> Column:
    """Null-safe equality, on which Spark still hashes, sorts or broadcasts."""
    return reduce(and_, (F.col(key).eqNullSafe(F.col(f"_other_{key}")) for key in keys))


def replace_keys(base: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``base`` without the keys of ``batch``, followed by ``batch``."""
    return reconcile(without_keys(base, batch, keys), batch)


def merge(
    base: DataFrame, incoming: DataFrame, keys: Sequence[str], order_by: str
) -> DataFrame:
    """Insert new keys and replace existing ones.

    ``base`` is a keyed table and is only filtered: it is not shuffled at all
    while the incoming keys are small enough to broadcast. Merging the same
    batch again changes nothing. NULL is a value like any other in a key.
    """
    kept = without_keys(base, incoming.select(*keys).distinct(), keys)
    return reconcile(kept, latest_per_key(incoming, keys, order_by))


def merge_summary(base: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: keys inserted, keys updated and table size after the merge.

    Both sides are reduced to their keys, in which NULL equals NULL. The base is probed
    as the streamed side of the join and each side sends one partial count per task.
    """
    arriving = incoming.select(*keys).distinct()
    known = _named(arriving, keys).withColumn("_arriving", F.lit(True))
    probed = base.select(*keys).join(known, _same_key(keys), "left")
    zero = F.lit(0).cast("long")
    table_side = probed.agg(
        F.count(F.lit(1)).alias("base_rows"),
        F.count("_arriving").alias("updates"),
    ).select("base_rows", "updates", zero.alias("arrivals"))
    batch_side = arriving.agg(F.count(F.lit(1)).alias("arrivals")).select(
        zero.alias("base_rows"), zero.alias("updates"), "arrivals"
    )
    totals = table_side.unionByName(batch_side).agg(
        F.sum("base_rows").alias("base_rows"),
        F.sum("updates").alias("updates"),
        F.sum("arrivals").alias("arrivals"),
    )
    inserts = F.col("arrivals") - F.col("updates")
    return totals.select(
        inserts.alias("inserts"), "updates", (F.col("base_rows") + inserts).alias("total_rows")
    )


def as_of(
    log: DataFrame, keys: Sequence[str], instant: str, commit_column: str = COMMIT_COLUMN
) -> DataFrame:
    """The table as it stood at ``instant``: the newest row per key up to then.

    The comparison prunes whole commits when the log is partitioned by commit.
    """
    seen = log.filter(F.col(commit_column) <= F.lit(instant))
    rest = [name for name in log.columns if name not in keys and name != commit_column]
    newest = [F.desc(commit_column), *(F.desc(name) for name in rest)]
    return first_per_key(seen, keys, newest)


def commit_timeline(log: DataFrame, commit_column: str = COMMIT_COLUMN) -> DataFrame:
    """Commits in order with the rows each of them wrote."""
    return (
        log.groupBy(commit_column)
        .agg(F.count(F.lit(1)).alias("rows_written"))
        .orderBy(commit_column)
    )
