"""From the landing folder to the keyed table in one run."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession

from ..specs import DatasetSpec
from ..staging import path_exists
from ..streaming import ingest_landing, landed_batches, read_landed
from .buckets import BUCKET_SUMMARY, BucketedTable
from .etl import run_etl
from .seen import UniqueRows

_DONE = "batch_id string"


@dataclass(frozen=True)
class LandingRun:
    """What one run took in: its micro-batches, the run's metrics and what the upsert did."""

    batches: list[str]
    metrics: DataFrame | None
    summary: DataFrame


def run_landing(
    spark: SparkSession, spec: DatasetSpec, root: str, buckets: int = 64, as_of: Column | None = None, archive: bool = True
) -> LandingRun:
    """Land new files of ``root``/landing, check them, and upsert the good rows into the keyed table.

    Layout under ``root``: landing/, archive/, bronze/, checkpoint/, quarantine/, trusted/ (a
    run's good rows), unique/ (the good rows of all runs, identical ones once: ``UniqueRows``),
    metrics/ (landing and ETL in one record), table/ (a ``BucketedTable``) and commits/ (its
    ``CommitLog``). Only micro-batches that no earlier run took in are
    read. A run that dies is repeated whole: rows land once, the upsert of the same rows
    changes nothing, the commit of the same batches replaces itself, and a batch counts as
    taken in when all of that is done. Rows of files with a wrong header, and rows that
    break a rule, are in the quarantine folder of the run's last batch.
    """
    places = {name: f"{root}/{name}" for name in ("bronze", "checkpoint", "table", "commits", "taken")}
    table = BucketedTable(spark, spec, places["table"])
    taken = _taken(spark, places["taken"])
    arrived = ingest_landing(
        spark, spec, f"{root}/landing", places["bronze"], places["checkpoint"], archive=f"{root}/archive" if archive else None
    )
    new = [b for b in landed_batches(spark, places["checkpoint"]) if b not in taken] if arrived else []
    if not table.exists():
        table.create(spark.createDataFrame([], spec.typed_schema), buckets)
    if not new:
        return LandingRun([], None, spark.createDataFrame([(0, 0, table.read().count(), 0, buckets)], BUCKET_SUMMARY))
    run = run_etl(
        read_landed(spark, spec, places["bronze"], places["checkpoint"], new),
        spec,
        f"{root}/trusted/batch_id={new[-1]}",
        f"{root}/quarantine/batch_id={new[-1]}",
        as_of=as_of,
        metrics_path=f"{root}/metrics",
    )
    # The trusted table was de-duplicated when it was written.
    UniqueRows(spark, f"{root}/unique").add(run.table, new[-1], distinct=True)
    summary = table.upsert(run.table, places["commits"], new[-1])
    done = spark.createDataFrame([(b,) for b in new], _DONE).coalesce(1)
    done.write.mode("append").json(places["taken"])
    return LandingRun(new, run.metrics, summary)


def _taken(spark: SparkSession, path: str) -> set[str]:
    """Micro-batches that are in the table, one short line each."""
    if not path_exists(spark, path):
        return set()
    return {row[0] for row in spark.read.schema(_DONE).json(path).distinct().collect()}
