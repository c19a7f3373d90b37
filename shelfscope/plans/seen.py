"""Exact de-duplication over everything that ever landed, reading new rows only.

A row is known by a fingerprint of 128 bits over all its columns. A batch's rows are
compared with the fingerprints of all earlier batches, not with their rows: those are
streamed past the batch's own fingerprints, which are broadcast if they are small, so the
accumulated table is neither read nor shuffled for a small batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dedup import drop_exact_duplicates
from ..sinks import write_table
from ..staging import path_exists, stage

_PRINT = ("print_1", "print_2")
_SCHEMA = "print_1 bigint, print_2 bigint, batch_id string"


def with_fingerprint(rows: DataFrame) -> DataFrame:
    """``rows`` with two 64-bit hashes of all columns; NULLs and empty strings differ."""
    cells = F.struct(*(F.col(name) for name in rows.columns))
    presence = F.array(*(F.col(name).isNull() for name in rows.columns))
    return rows.withColumns(
        {_PRINT[0]: F.xxhash64(cells, presence), _PRINT[1]: F.xxhash64(F.lit(1), presence, cells)}
    )


class UniqueRows:
    """Distinct rows under ``path``/rows, a folder per batch, and their fingerprints beside them."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark = spark
        self.path = path.rstrip("/")

    def add(self, rows: DataFrame, batch: str, distinct: bool = False) -> int:
        """Keep the rows of a batch that no other batch has; return their number.

        ``distinct`` says that ``rows`` is a written table without equal rows: it is then
        neither shuffled nor written again, its fingerprints are taken as it is read.
        The same batch again replaces itself: its own fingerprints do not count, and they are
        written last, so a run that died between rows and fingerprints repeats both.
        """
        staged = [] if distinct else [stage(with_fingerprint(drop_exact_duplicates(rows)), "marked")]
        marked = with_fingerprint(rows) if distinct else staged[0].frame
        own = marked.select(*_PRINT)
        seen = self._fingerprints().filter(F.col("batch_id") != batch)
        known = stage(seen.join(own, list(_PRINT), "left_semi").select(*_PRINT).distinct(), "known")
        new = stage(marked.join(known.frame, list(_PRINT), "left_anti"), "new")
        write_table(new.frame.drop(*_PRINT), f"{self.path}/rows/batch_id={batch}")
        write_table(new.frame.select(*_PRINT), f"{self.path}/prints/batch_id={batch}")
        for used in (*staged, known, new):
            used.drop()
        return new.rows

    def read(self, schema) -> DataFrame:
        """All distinct rows; ``schema`` lists the table's columns."""
        if not path_exists(self.spark, f"{self.path}/rows"):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.path}/rows").select(*schema.names)

    def _fingerprints(self) -> DataFrame:
        path = f"{self.path}/prints"
        if not path_exists(self.spark, path):
            return self.spark.createDataFrame([], _SCHEMA)
        return self.spark.read.schema(_SCHEMA).parquet(path)
