"""Joins on a key that a few values dominate.

A shuffle sends all rows of a value to one task. A sketch over the keys, a small summary
per task, finds the values that hold more than a task's share; their rows stay where they
are and meet the few rows of the other side in a broadcast, and only the rest is shuffled.
NULL, which joins with nothing, is never shuffled. It needs no adaptive execution.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..staging import stage

#: Most values that are told apart, and counters the sketch keeps for that.
MOST_HEAVY, COUNTERS = 256, 8192
#: A value is heavy from this part of an even share of all tasks.
SHARE = 0.25
#: Rows of the other side that are broadcast for all heavy values together.
BROADCAST_ROWS = 100_000


def heavy_values(df: DataFrame, key: str) -> list:
    """Values of ``key`` with much more than their share of the rows, at most ``MOST_HEAVY`` of them.

    The counts are a sketch's upper bounds: they decide where a row is joined, not whether.
    """
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    top = F.expr(f"approx_top_k(`{key}`, {MOST_HEAVY}, {COUNTERS})").alias("top")
    found = df.filter(F.col(key).isNotNull()).agg(top, F.count(F.lit(1)).alias("rows")).first()
    least = SHARE * found["rows"] / tasks
    return [entry["item"] for entry in found["top"] or [] if entry["count"] > max(least, 1)]


def left_join_skewed(large: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """``large`` left-joined with ``other`` on ``key``, whichever values hold most of its rows."""
    heavy = heavy_values(large, key)
    hot = other.filter(F.col(key).isin(*heavy)) if heavy else other.filter(F.lit(False))
    few = stage(hot, "heavy-side")
    if few.rows > BROADCAST_ROWS:
        # Not the few rows that a broadcast is for: what is left is adaptive execution's.
        few.drop()
        return large.join(other, key, "left")
    is_heavy = F.coalesce(F.col(key).isin(*heavy), F.lit(True)) if heavy else F.col(key).isNull()
    stays = large.filter(is_heavy).join(F.broadcast(few.frame), key, "left")
    moves = large.filter(~is_heavy).join(other, key, "left")
    return stays.unionByName(moves)
