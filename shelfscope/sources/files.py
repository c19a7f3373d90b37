"""Scans of landing CSV files and of written tables."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.merge import COMMIT_COLUMN
from ..specs import DatasetSpec

CSV_OPTIONS = {
    "header": True,
    "ignoreLeadingWhiteSpace": True,
    "ignoreTrailingWhiteSpace": True,
}


def plain_path(path: Column) -> Column:
    """File paths reach us as ``file:/x``, ``file:///x`` and percent-encoded; one form of a reported path.

    Landing evaluates it per row: no decoding and no pattern where a path needs none.
    """
    decoded = F.when(F.contains(path, F.lit("%")), F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))).otherwise(path)
    local = F.concat(F.lit("file:/"), F.ltrim(F.substring(decoded, 7, 1 << 30), F.lit("/")))
    return F.when(F.startswith(decoded, F.lit("file:/")), local).otherwise(decoded)


def literal_path(path: str) -> str:
    """A path whose name is no pattern to Spark's readers."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def csv_glob(path: str) -> str:
    """One ``.csv`` file as it is, a folder as the pattern of its CSV files."""
    return path if path.endswith(".csv") else f"{path.rstrip('/')}/*.csv"


def scan_csv(spark: SparkSession, spec: DatasetSpec, path: str) -> DataFrame:
    """All-string rows of the dataset's CSV files; no schema inference pass."""
    return spark.read.schema(spec.landing_schema).options(**CSV_OPTIONS).csv(csv_glob(path))


def added_columns(spark: SparkSession, spec: DatasetSpec, path: str) -> list[T.StructField]:
    """Columns that the table's files have beyond the dataset's own, as batches added them."""
    return [f for f in spark.read.parquet(path).schema.fields if f.name not in spec.snapshot_schema.names]


def read_snapshot(
    spark: SparkSession, spec: DatasetSpec, path: str, extra: Sequence[T.StructField] = ()
) -> DataFrame:
    """The keyed table last written for the dataset.

    The schema is given, so partition values such as ``category=007`` keep their
    type and no footer is opened to find out about columns. ``extra`` names
    columns beyond the spec's; they are NULL where the files do not have them.
    """
    schema = T.StructType([*spec.snapshot_schema.fields, *extra])
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def read_evolved(spark: SparkSession, path: str) -> DataFrame:
    """A table whose files gained columns over time; older rows hold NULL."""
    return spark.read.option("mergeSchema", True).parquet(path)


def read_commit_log(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Every row of every commit; ``schema`` lists the table's own columns."""
    with_commit = T.StructType([*schema.fields, T.StructField(COMMIT_COLUMN, T.StringType())])
    return spark.read.schema(with_commit).parquet(path)
