"""Checks on the files themselves, before anything is loaded.

Header and row count come from one pass over the text lines. The pass carries
three integers per file through a hash aggregation, never the lines themselves,
and a large file is shared among as many tasks as it has splits.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..specs import WRONG_HEADER, DatasetSpec
from ..staging import stage
from .files import csv_glob, literal_path, plain_path, scan_csv

INVENTORY_SCHEMA = "path string, size_bytes bigint, is_empty boolean"


def _no_match(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


def file_inventory(spark: SparkSession, path: str) -> DataFrame:
    """``path, size_bytes, is_empty`` of every CSV file; no rows if there is none.

    Scans leave out zero-byte files, so the listing that Spark made for planning
    is joined to the sizes the scan reports. File names are all that passes
    through the driver, which holds them for any scan.
    """
    try:
        listed = spark.read.text(csv_glob(path)).inputFiles()
    except AnalysisException as error:
        if not _no_match(error):
            raise
        listed = []
    if not listed:
        return spark.createDataFrame([], INVENTORY_SCHEMA)
    names = spark.createDataFrame([(name,) for name in listed], "listed string").select(
        plain_path(F.col("listed")).alias("path")
    )
    # The path column of this source is not percent-encoded.
    sized = (
        spark.read.format("binaryFile")
        .load(csv_glob(path))
        .select(
            F.regexp_replace("path", r"^file:/+", "file:/").alias("path"),
            F.col("length").alias("size_bytes"),
        )
    )
    size = F.coalesce("size_bytes", F.lit(0).cast("bigint"))
    return names.join(sized, "path", "left").select(
        "path", size.alias("size_bytes"), (size == 0).alias("is_empty")
    )


def has_input(inventory: DataFrame, single_file: bool = False) -> bool:
    """Whether there is something to load.

    A folder needs at least one CSV file, empty or not; a single file must not be
    empty.
    """
    usable = inventory.filter(~F.col("is_empty")) if single_file else inventory
    return not usable.isEmpty()


def _profile(lines: DataFrame, spec: DatasetSpec) -> DataFrame:
    """``path, n_rows, header_ok`` of every file that has a line.

    The first line of a file is the one with the smallest id among the lines of its first
    block; the header is right if the smallest id among the lines equal to the expected
    header is that same id.
    """
    # Most lines are shorter than a header: their quotes need not be taken out to tell.
    long_enough = F.octet_length("value") >= len(spec.header_line.encode())
    expected = long_enough & (F.replace("value", F.lit('"'), F.lit("")) == F.lit(spec.header_line))
    # Numbered in a projection of its own: inside a condition the id would count
    # only the lines for which the condition is evaluated.
    numbered = lines.select(
        F.col("_metadata.file_path").alias("listed"),
        (F.col("_metadata.file_block_start") == 0).alias("first_block"),
        expected.alias("is_header"),
        F.monotonically_increasing_id().alias("line_id"),
    )
    marked = numbered.select(
        "listed",
        F.when(F.col("first_block"), F.col("line_id")).alias("line_id"),
        F.when(F.col("first_block") & F.col("is_header"), F.col("line_id")).alias("header_id"),
    )
    profile = marked.groupBy("listed").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.min("line_id").alias("first_id"),
        F.min("header_id").alias("header_id"),
    )
    return profile.select(
        plain_path(F.col("listed")).alias("path"),
        (F.col("n_lines") - 1).alias("n_rows"),
        F.col("first_id").eqNullSafe(F.col("header_id")).alias("header_ok"),
    )


def line_profile(spark: SparkSession, spec: DatasetSpec, path: str) -> DataFrame:
    """``path, n_rows, header_ok`` of every CSV file.

    ``n_rows`` counts physical lines below the first.
    """
    scanned = _profile(spark.read.text(csv_glob(path)), spec)
    return (
        file_inventory(spark, path)
        .join(scanned, "path", "left")
        .select(
            "path",
            F.coalesce("n_rows", F.lit(-1).cast("bigint")).alias("n_rows"),
            F.coalesce("header_ok", F.lit(False)).alias("header_ok"),
        )
    )


def headers_of(spark: SparkSession, spec: DatasetSpec, paths: Sequence[str]) -> DataFrame:
    """``path, header_ok`` of these files (paths in the form of ``plain_path``), as far as they have a line."""
    if not paths:
        return spark.createDataFrame([], "path string, header_ok boolean")
    return _profile(spark.read.text([literal_path(path) for path in paths]), spec).select("path", "header_ok")


def mark_wrong_headers(spark: SparkSession, spec: DatasetSpec, path: str) -> DataFrame:
    """Rows of the dataset's CSV files, and whether their file's header is wrong (``WRONG_HEADER``).

    The files are checked first, in a pass over their lines that keeps one row per file; the
    bad ones are written, so they are broadcast only if that table is small. With none, the
    scan is as it would be without the check.
    """
    bad = stage(header_contract(spark, spec, path).filter(~F.col("header_ok")).select("path"), "bad-headers")
    rows = scan_csv(spark, spec, path)
    if not bad.rows:
        bad.drop()
        return rows.withColumn(WRONG_HEADER, F.lit(False))
    marked = bad.frame.withColumn(WRONG_HEADER, F.lit(True))
    named = rows.select("*", plain_path(F.col("_metadata.file_path")).alias("path")).join(marked, "path", "left")
    return named.select(*spec.columns, F.coalesce(WRONG_HEADER, F.lit(False)).alias(WRONG_HEADER))


def header_contract(spark: SparkSession, spec: DatasetSpec, path: str) -> DataFrame:
    """Per file, whether its header is exactly the expected ordered list."""
    return line_profile(spark, spec, path).select("path", "header_ok")


def min_row_count(
    spark: SparkSession, spec: DatasetSpec, path: str, min_rows: int | None = None
) -> DataFrame:
    """Per file, its rows and whether they reach the minimum."""
    least = spec.min_rows if min_rows is None else min_rows
    return line_profile(spark, spec, path).select(
        "path", "n_rows", (F.col("n_rows") >= least).alias("enough_rows")
    )


def dataset_verdicts(spark: SparkSession, inputs: Mapping[DatasetSpec, str]) -> DataFrame:
    """Per dataset: files, failures and whether it is fit to load.

    A file whose header is wrong is not also counted as too short. A dataset
    without files fails.
    """
    verdicts = None
    for spec, path in inputs.items():
        short = F.col("n_rows") < spec.min_rows
        verdict = (
            _profile_or_empty(spark, spec, path)
            .agg(
                F.count("path").alias("n_files"),
                F.count_if(~F.col("header_ok")).alias("bad_headers"),
                F.count_if(F.col("header_ok") & short).alias("short_files"),
            )
            .select(
                F.lit(spec.name).alias("dataset"),
                "n_files",
                "bad_headers",
                "short_files",
                ((F.col("n_files") > 0) & (F.col("bad_headers") + F.col("short_files") == 0)).alias(
                    "passed"
                ),
            )
        )
        verdicts = verdict if verdicts is None else verdicts.unionByName(verdict)
    return verdicts


def _profile_or_empty(spark: SparkSession, spec: DatasetSpec, path: str) -> DataFrame:
    try:
        return line_profile(spark, spec, path)
    except AnalysisException as error:
        if not _no_match(error):
            raise
        return spark.createDataFrame([], "path string, n_rows bigint, header_ok boolean")
