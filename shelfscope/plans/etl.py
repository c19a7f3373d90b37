"""From landed strings to a trusted table, a quarantine and run metrics."""

from __future__ import annotations

import logging
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.clean import clean
from ..operators.dedup import remove_duplicates
from ..operators.quality import check_quality
from ..sinks import RunMetrics, write_quarantine, write_run_metrics, write_table
from ..sources import file_inventory, has_input, mark_wrong_headers
from ..specs import REASON_COLUMN, WRONG_HEADER, DatasetSpec, Rule
from ..staging import stage

logger = logging.getLogger(__name__)


def _checked(raw: DataFrame, spec: DatasetSpec, as_of: Column | None) -> DataFrame:
    """Cleaned rows with their reason; rows marked for their file's header break that rule first."""
    if WRONG_HEADER not in raw.columns:
        return check_quality(clean(raw, spec), spec, as_of)
    rule = Rule(WRONG_HEADER, lambda day: F.col(WRONG_HEADER))
    cleaned = raw.select(*(field.cleaned() for field in spec.fields), WRONG_HEADER)
    return check_quality(cleaned, replace(spec, rules=(rule, *spec.rules)), as_of)


def trusted_rows(raw: DataFrame, spec: DatasetSpec, as_of: Column | None = None) -> DataFrame:
    """Clean, keep the valid rows and de-duplicate, as one lazy frame."""
    checked = check_quality(clean(raw, spec), spec, as_of)
    valid = checked.filter(F.col(REASON_COLUMN) == "").drop(REASON_COLUMN)
    return remove_duplicates(valid, spec)


@dataclass(frozen=True)
class EtlRun:
    """Where a run wrote its table and what it counted."""

    table: DataFrame
    metrics: DataFrame


def run_etl(
    raw: DataFrame,
    spec: DatasetSpec,
    table_path: str,
    quarantine_path: str,
    as_of: Column | None = None,
    metrics_path: str | None = None,
    staging_path: str | None = None,
) -> EtlRun:
    """Run one dataset end to end, reading the raw rows exactly once.

    The checked rows are written once, split by outcome, with the counts taken
    on the way. Rows may come marked by ``sources.mark_wrong_headers``; those of a file
    with a wrong header go to the quarantine with that reason. The quarantine then reads only the bad part and the trusted table
    only the good part. ``staging_path`` names the folder for the split rows;
    by default a new one in the shared folder.
    """
    spark = raw.sparkSession
    metrics = RunMetrics(f"etl_{spec.name}")
    try:
        passed = F.col(REASON_COLUMN) == ""
        checked = _checked(raw, spec, as_of).withColumn("_passed", passed)
        split = stage(
            checked,
            f"{spec.name}-checked",
            partition_by=("_passed",),
            path=staging_path,
            valid=F.count_if(F.col("_passed")),
        )
        metrics.input_count = split.rows
        metrics.valid_count = split.figures["valid"]
        metrics.invalid_count = split.rows - metrics.valid_count

        invalid = split.frame.filter(~F.col("_passed")).drop("_passed")
        write_quarantine(invalid, quarantine_path, metrics.invalid_count)

        if metrics.valid_count:
            valid = split.frame.filter("_passed").drop("_passed", REASON_COLUMN)
            trusted = remove_duplicates(valid, spec)
            partition_by = tuple(c for c in spec.partition_by if c in spec.columns)
            metrics.output_count = write_table(trusted, table_path, partition_by)
            table = spark.read.schema(spec.typed_schema).parquet(table_path).select(*spec.columns)
        else:
            table = spark.createDataFrame([], spec.typed_schema)
    except Exception as error:
        metrics.add_error(f"{type(error).__name__}: {error}")
        _save(metrics.finish("FAILED").to_frame(spark), metrics_path)
        raise
    frame = metrics.finish().to_frame(spark)
    _save(frame, metrics_path)
    return EtlRun(table, frame)


def _save(metrics: DataFrame, path: str | None) -> None:
    """Metrics that cannot be saved must not fail, or hide the failure of, a run."""
    if path is None:
        return
    try:
        write_run_metrics(metrics, path)
    except Exception as error:
        logger.warning("run metrics were not saved: %s", error)


def run_etl_from_csv(
    spark: SparkSession,
    spec: DatasetSpec,
    input_path: str,
    table_path: str,
    quarantine_path: str,
    **options,
) -> EtlRun:
    """:func:`run_etl` over CSV files; raises when there is nothing to load.

    Headers are checked first: rows of a file whose header is not the dataset's would land
    in the wrong columns, so they go to the quarantine, and the other files load.
    """
    inventory = file_inventory(spark, input_path)
    if not has_input(inventory, single_file=input_path.endswith(".csv")):
        raise ValueError(f"no input for {spec.name} under {input_path}")
    raw = mark_wrong_headers(spark, spec, input_path)
    return run_etl(raw, spec, table_path, quarantine_path, **options)


def run_datasets(
    inputs: Mapping[DatasetSpec, DataFrame], root: str, as_of: Column | None = None
) -> dict[str, EtlRun]:
    """:func:`run_etl` for independent datasets at once, laid out under ``root``.

    The jobs are submitted together and share the executors, so the tail of one
    dataset does not leave the cluster idle. All of them finish, whatever happens to
    one; the first failure is raised afterwards.
    """

    def run(spec: DatasetSpec, raw: DataFrame) -> EtlRun:
        return run_etl(
            raw,
            spec,
            f"{root}/trusted/{spec.name}",
            f"{root}/quarantine/{spec.name}",
            as_of=as_of,
            # One folder each: two jobs must not commit into the same folder at once.
            metrics_path=f"{root}/metrics/{spec.name}",
            staging_path=f"{root}/checked/{spec.name}",
        )

    with ThreadPoolExecutor(max_workers=max(1, len(inputs))) as pool:
        started = {
            spec.name: pool.submit(inheritable_thread_target(raw.sparkSession)(run), spec, raw)
            for spec, raw in inputs.items()
        }
    return {name: future.result() for name, future in started.items()}
