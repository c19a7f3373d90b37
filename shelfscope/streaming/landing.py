"""Landing ingestion as a file stream that stops when it has caught up.

The file source remembers in its checkpoint which files it has read, so every run takes
only the new ones, however old they are. A micro-batch is one commit: its number is the
folder of its rows in bronze and of its lines in the ledger of deliveries, and both are
written before the checkpoint calls the batch done and before the source archives a file.
A run that dies half way is repeated with the same number and the same files; rows that
were written completely are kept, whatever has become of their files since. So every row
lands once. Bronze keeps accumulating.

The source's memory goes by the path, so a second file under a used name would be taken
for one that was read, and archived unread. The ledger has each file's path, modification
time and size from before the first batch reads it; a run stops before it reads or moves
anything if one of them comes with another time or size.

The ledger also has whether a file's header is the dataset's. Bronze keeps all rows as
they came; ``read_landed`` marks those of files with a wrong header, which an ETL run
sends to the quarantine.
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.files import CSV_OPTIONS, plain_path
from ..sources.preflight import headers_of
from ..specs import WRONG_HEADER, DatasetSpec
from ..staging import path_exists, stage

logger = logging.getLogger(__name__)

#: Longer than any file is old: without it, files a week older than the newest are skipped.
_ANY_AGE = "36500d"
_FILE_FIELDS = (("_path", T.StringType()), ("_time", T.TimestampType()), ("_size", T.LongType()))
_FILE_SCHEMA = T.StructType([T.StructField(*field) for field in _FILE_FIELDS])
_LEDGER_SCHEMA = T.StructType(
    [*_FILE_SCHEMA.fields, T.StructField("header_ok", T.BooleanType()), T.StructField("batch_id", T.StringType())]
)


def _listed(spark: SparkSession, source: str) -> DataFrame:
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").option("recursiveFileLookup", True).load(source)
    # The path column of this source is not percent-encoded.
    path = F.regexp_replace("path", r"^file:/+", "file:/")
    return files.select(path.alias("_path"), F.col("modificationTime").alias("_time"), F.col("length").alias("_size"))


def _ledger_path(checkpoint: str) -> str:
    return f"{checkpoint.rstrip('/')}-deliveries"


def read_deliveries(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Files seen and read: path, time, size, ``header_ok`` and the batch (NULL header: seen, not read with rows)."""
    path = _ledger_path(checkpoint)
    if not path_exists(spark, path):
        return spark.createDataFrame([], _LEDGER_SCHEMA)
    return spark.read.schema(_LEDGER_SCHEMA).parquet(path)


def _note_arrivals(spark: SparkSession, source: str, checkpoint: str) -> None:
    """Enter new files in the ledger before they are read; refuse a used name."""
    present = stage(_listed(spark, source), "deliveries")
    try:
        known = read_deliveries(spark, checkpoint)
        named = known.select("_path", F.col("_time").alias("time"), F.col("_size").alias("size")).distinct()
        differs = (F.col("_time") != F.col("time")) | (F.col("_size") != F.col("size"))
        repeated = present.frame.join(named, "_path").filter(differs).count()
        if repeated:
            raise ValueError(f"{repeated} files under {source} were delivered again under a used name")
        arrived = present.frame.join(known, "_path", "left_anti").withColumn("header_ok", F.lit(None).cast("boolean"))
        arrived.write.mode("overwrite").parquet(f"{_ledger_path(checkpoint)}/batch_id=seen-{uuid.uuid4().hex}")
    finally:
        present.drop()


def ingest_landing(
    spark: SparkSession,
    spec: DatasetSpec,
    source: str,
    bronze: str,
    checkpoint: str,
    archive: str | None = None,
    max_files_per_batch: int | None = None,
) -> bool:
    """Append the rows of new CSV files under ``source`` to ``bronze``, each exactly once.

    Returns False, with a warning, when the landing folder does not exist yet.
    With ``archive`` the source moves consumed files there; it does so while a
    later batch is planned, so the newest files stay until there is more data.
    Raises if a file was delivered again, with other content or another time, under a
    name that was used: give it a new name. The checkpoint belongs to its bronze folder.
    """
    reader = (
        spark.readStream.schema(spec.landing_schema)
        .options(**CSV_OPTIONS)
        .option("pathGlobFilter", "*.csv")
        .option("recursiveFileLookup", True)
        .option("maxFileAge", _ANY_AGE)
    )
    if archive is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    if max_files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
    try:
        landed = reader.csv(source)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        logger.warning("landing folder %s does not exist yet", source)
        return False
    if path_exists(spark, bronze) and not path_exists(spark, checkpoint):
        raise ValueError(f"{bronze} was written with another checkpoint than {checkpoint}")
    _note_arrivals(spark, source, checkpoint)
    rows = landed.select(
        *spec.columns,
        plain_path(F.col("_metadata.file_path")).alias("_path"),
        F.col("_metadata.file_modification_time").alias("_time"),
        F.col("_metadata.file_size").alias("_size"),
    )

    def land(batch: DataFrame, batch_id: int) -> None:
        own = batch.sparkSession
        folder = _batch_folder(bronze, batch_id)
        if not path_exists(own, f"{folder}/_SUCCESS"):
            batch.write.mode("overwrite").parquet(folder)
        _note_batch(own, spec, folder, checkpoint, batch_id)

    query = rows.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return True


def _batch_folder(bronze: str, batch_id: int) -> str:
    return f"{bronze.rstrip('/')}/batch_id={batch_id:010d}"


def _note_batch(spark: SparkSession, spec: DatasetSpec, folder: str, checkpoint: str, batch_id: int) -> None:
    """The batch's lines of the ledger: its files, from the rows that were written, and their headers."""
    files = stage(spark.read.schema(_FILE_SCHEMA).parquet(folder).distinct(), "batch-files")
    # Names of one batch's files; Spark's driver holds them for any scan.
    names = [row[0] for row in files.frame.select("_path").collect()]
    # A file that is gone (only after a run that died) has rows, but no header to check: it is not ok.
    checked = headers_of(spark, spec, [name for name in names if path_exists(spark, name)])
    lines = files.frame.join(checked.withColumnRenamed("path", "_path"), "_path", "left")
    noted = lines.withColumn("header_ok", F.coalesce("header_ok", F.lit(False)))
    noted.write.mode("overwrite").parquet(f"{_ledger_path(checkpoint)}/batch_id={batch_id:010d}")
    files.drop()


def landed_batches(spark: SparkSession, checkpoint: str) -> list[str]:
    """Numbers of the batches whose rows and ledger lines are complete, one per micro-batch so far."""
    found = read_deliveries(spark, checkpoint).filter("header_ok IS NOT NULL").select("batch_id").distinct()
    return sorted(row[0] for row in found.collect())


def read_landed(
    spark: SparkSession, spec: DatasetSpec, bronze: str, checkpoint: str, batches: Sequence[str] | None = None
) -> DataFrame:
    """Rows landed, as strings, each marked (``WRONG_HEADER``) if its file's header is wrong.

    ``batches`` limits the read to the folders of those micro-batches.
    """
    fields = [*spec.landing_schema.fields, *_FILE_SCHEMA.fields, T.StructField("batch_id", T.StringType())]
    frame = spark.read.schema(T.StructType(fields)).parquet(bronze)
    if batches is not None:
        frame = frame.filter(F.col("batch_id").isin(*batches))
    wrong = read_deliveries(spark, checkpoint).filter("header_ok = false").select("_path", "batch_id").distinct()
    if wrong.isEmpty():
        return frame.select(*spec.columns, F.lit(False).alias(WRONG_HEADER))
    marked = frame.join(wrong.withColumn(WRONG_HEADER, F.lit(True)), ["_path", "batch_id"], "left")
    return marked.select(*spec.columns, F.coalesce(WRONG_HEADER, F.lit(False)).alias(WRONG_HEADER))


def read_bronze(spark: SparkSession, spec: DatasetSpec, bronze: str) -> DataFrame:
    """All rows landed so far, as strings, whatever the header of their files."""
    fields = [*spec.landing_schema.fields, T.StructField("batch_id", T.StringType())]
    return spark.read.schema(T.StructType(fields)).parquet(bronze).select(*spec.columns)
