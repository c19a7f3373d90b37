"""The first rows of every group under a total order, for few rows and for many.

A filter on ``row_number()`` becomes a limit inside every task only up to
``spark.sql.optimizer.windowGroupLimitThreshold`` rows. Beyond it a window would bring a
whole group into one task, so the rank is found by sorting the table as a whole instead:
rows are range-partitioned by group and order, so a group that holds most rows has many
ranges; each range's rows are counted per group, and the counts of the ranges before it
are what a range's own numbers begin after. Ranges that begin after the last row wanted
are not read again.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..staging import stage

#: Rows of a range on average, whatever their group.
ROWS_PER_RANGE = 500_000
_THRESHOLD = "spark.sql.optimizer.windowGroupLimitThreshold"


def first_per_group(df: DataFrame, group: Sequence[str], ordering: Sequence[Column | str], n: int, rank: str = "rank") -> DataFrame:
    """The first ``n`` rows of each group with their ``rank``; NULL is a group like any other.

    ``ordering`` must be total up to equal rows.
    """
    limit = int(df.sparkSession.conf.get(_THRESHOLD))
    if 0 <= n <= limit:
        numbered = df.withColumn(rank, F.row_number().over(Window.partitionBy(*group).orderBy(*ordering)))
        return numbered.filter(F.col(rank) <= n)
    return _first_by_ranges(df, list(group), list(ordering), n, rank)


def _first_by_ranges(df: DataFrame, group: list[str], ordering: list[Column | str], n: int, rank: str) -> DataFrame:
    # Written first: the range partitioning looks at its input twice.
    rows = stage(df, "unranked")
    tasks = max(1, math.ceil(rows.rows / ROWS_PER_RANGE))
    ranges = rows.frame.repartitionByRange(tasks, *group, *ordering).withColumn("_range", F.spark_partition_id())
    sorted_rows = stage(ranges, "ranges").frame
    counts = sorted_rows.groupBy(*group, "_range").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    # One row per group and range: a group's ranges are as many as tasks hold it.
    offsets = counts.withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0))).filter(F.col("_before") < n)
    names = {c: f"_g{i}" for i, c in enumerate([*group, "_range"])}
    offsets = stage(offsets.select(*(F.col(c).alias(a) for c, a in names.items()), "_before"), "offsets").frame
    same = reduce(and_, (F.col(c).eqNullSafe(F.col(a)) for c, a in names.items()))
    placed = sorted_rows.join(offsets, same).drop(*names.values())
    inside = Window.partitionBy(*group, "_range").orderBy(*ordering)
    numbered = placed.withColumn(rank, (F.col("_before") + F.row_number().over(inside)).cast("int"))
    return numbered.filter(F.col(rank) <= n).drop("_range", "_before")
