"""CSV reports with a header row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..staging import stage

RECOMMENDATION_SCHEMA = (
    "seller_id string, item_id string, item_name string, category string, "
    "market_price double, expected_units_sold double, expected_revenue double"
)
GAP_SCHEMA = (
    "item_id string, item_name string, category string, total_units_sold bigint, "
    "market_price double, expected_units_sold double"
)


#: Blanks around a value and line breaks in it are data, on the way out and back.
_WRITE = {"header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
_READ = {**_WRITE, "multiLine": True}


def _write_csv(df: DataFrame, path: str, single_file: bool) -> None:
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").options(**_WRITE).csv(path)


def write_recommendations(recommendations: DataFrame, path: str, single_file: bool = False) -> None:
    """One file per range of sellers, in order; ``single_file`` forces one task."""
    _write_csv(recommendations, path, single_file)


def write_company_gap(gap: DataFrame, path: str, single_file: bool = False) -> bool:
    """Gap report by units sold; nothing is written when there is no gap."""
    found = stage(gap, "gap")
    if found.rows:
        _write_csv(found.frame.orderBy(F.desc("total_units_sold"), "item_id"), path, single_file)
    found.drop()
    return found.rows > 0


def read_recommendations(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RECOMMENDATION_SCHEMA).options(**_READ).csv(path)


def read_gap(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(GAP_SCHEMA).options(**_READ).csv(path)
