"""Exact and keyed de-duplication.

The keyed forms rank rows inside each key and keep the first. Spark turns a
``row_number() = 1`` filter into a group limit on both sides of the exchange, so
every task sends at most one row per key and a key that holds a third of the
table costs its reducer one row per map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..specs import DatasetSpec


def drop_exact_duplicates(df: DataFrame) -> DataFrame:
    """Rows equal in every column collapse to one; repeats merge before the shuffle."""
    return df.dropDuplicates()


def first_per_key(df: DataFrame, keys: Sequence[str], ordering: Sequence[Column]) -> DataFrame:
    """The first row of every key under a total order."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*ordering))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: str) -> DataFrame:
    """The row with the largest ``order_by`` value of every key.

    Ties are settled by the remaining columns, largest first, so the outcome
    does not depend on how the rows were partitioned.
    """
    rest = [name for name in df.columns if name not in keys and name != order_by]
    return first_per_key(df, keys, [F.desc(name) for name in [order_by, *rest]])


def best_price_per_key(df: DataFrame, keys: Sequence[str] = ("seller_id", "item_id")) -> DataFrame:
    """Catalog rows with the highest price per key, then stock, name and category."""
    ordering = [F.desc("marketplace_price"), F.desc("stock_qty"), F.asc("item_name"), F.asc("category")]
    return first_per_key(df, keys, ordering)


def remove_duplicates(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Catalogs keep one row per key; sales lose only fully identical rows."""
    if spec.unique_by_key:
        return best_price_per_key(df, spec.keys)
    return drop_exact_duplicates(df)


def keyed_snapshot(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Rows of a keyed table: the latest row per key plus the constant columns.

    Columns the spec does not know, such as ones added later, are kept.
    """
    constants = {name: F.lit(value) for name, value in spec.constants}
    return latest_per_key(df, spec.keys, spec.order_by).withColumns(constants)
