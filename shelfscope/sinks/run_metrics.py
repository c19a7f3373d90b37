"""Figures of one run: counts, shares, status, duration and errors."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import percent

METRICS_SCHEMA = """
    pipeline_name string, start_time string, end_time string, duration_seconds double,
    status string,
    records struct<input_count: bigint, valid_count: bigint, invalid_count: bigint,
                   duplicate_count: bigint, output_count: bigint>,
    data_quality struct<valid_percentage: double, invalid_percentage: double>,
    errors array<struct<timestamp: string, message: string>>
"""
_RAW_SCHEMA = """
    pipeline_name string, start_time string, end_time string, duration_seconds double,
    status string, input_count bigint, valid_count bigint, invalid_count bigint,
    output_count bigint, errors array<struct<timestamp: string, message: string>>
"""


def _now() -> datetime:
    return datetime.now(timezone.utc)


@dataclass
class RunMetrics:
    """Collects what a run observed; the derived figures are columns of the frame."""

    pipeline_name: str
    started: datetime = field(default_factory=_now)
    ended: datetime | None = None
    status: str = "RUNNING"
    input_count: int = 0
    valid_count: int = 0
    invalid_count: int = 0
    output_count: int = 0
    errors: list[tuple[str, str]] = field(default_factory=list)

    def add_error(self, message: str) -> None:
        self.errors.append((_now().isoformat(), message))

    def finish(self, status: str = "SUCCESS") -> RunMetrics:
        self.ended = _now()
        self.status = status
        return self

    def to_frame(self, spark: SparkSession) -> DataFrame:
        """The metrics as one row."""
        ended = self.ended.isoformat() if self.ended else None
        seconds = round((self.ended - self.started).total_seconds(), 2) if self.ended else None
        raw = spark.createDataFrame(
            [
                (
                    self.pipeline_name,
                    self.started.isoformat(),
                    ended,
                    seconds,
                    self.status,
                    self.input_count,
                    self.valid_count,
                    self.invalid_count,
                    self.output_count,
                    self.errors,
                )
            ],
            _RAW_SCHEMA,
        )
        inputs = F.col("input_count")
        return raw.select(
            "pipeline_name",
            "start_time",
            "end_time",
            "duration_seconds",
            "status",
            F.struct(
                "input_count",
                "valid_count",
                "invalid_count",
                (F.col("valid_count") - F.col("output_count")).alias("duplicate_count"),
                "output_count",
            ).alias("records"),
            F.struct(
                percent(F.col("valid_count"), inputs).alias("valid_percentage"),
                percent(F.col("invalid_count"), inputs).alias("invalid_percentage"),
            ).alias("data_quality"),
            "errors",
        )


def write_run_metrics(metrics: DataFrame, path: str) -> None:
    """Append the run, a single row, to the metrics folder as one JSON file."""
    metrics.coalesce(1).write.mode("append").json(path)


def read_run_metrics(spark: SparkSession, path: str) -> DataFrame:
    """Every run saved in the folder or below it."""
    return spark.read.schema(METRICS_SCHEMA).option("recursiveFileLookup", True).json(path)


def run_summary(metrics: DataFrame) -> DataFrame:
    """One flat row per run: status, seconds, counts, shares, number of errors and the first one."""
    return metrics.select(
        "pipeline_name",
        "status",
        "duration_seconds",
        "records.*",
        "data_quality.*",
        F.size("errors").alias("n_errors"),
        F.get("errors", F.lit(0))["message"].alias("first_error"),
    )
