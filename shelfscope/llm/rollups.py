"""Token counts: additive totals kept up to date by signed deltas, committed once per batch.

A batch of changes (inserts, deletes, revisions) is turned into signed lines,
summed by source, language and tokenizer version, and written as one small delta
table under the batch's name. Writing the delta is repeatable: a run that died
halfway left no commit, and the next one overwrites what it wrote. The commit that
follows makes the delta count. A batch that is committed already is not applied
again, so a replay changes nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..staging import path_exists

DIMENSIONS = ("source", "lang", "tokenizer")
MEASURES = ("docs", "tokens")

#: A change: its id, the operation, and the counts before (delete, revise) and after (insert, revise).
COUNT = "struct<source:string,lang:string,tokenizer:string,tokens:bigint>"
CHANGE = f"change_id string, op string, old {COUNT}, new {COUNT}"
DELTA = "source string, lang string, tokenizer string, docs bigint, tokens bigint, batch string"


def counted(source: Column, lang: Column, tokenizer: Column, tokens: Column) -> Column:
    """One side of a change."""
    return F.struct(
        source.alias("source"), lang.alias("lang"), tokenizer.alias("tokenizer"), tokens.cast("bigint").alias("tokens")
    ).cast(COUNT)


def no_count() -> Column:
    return F.lit(None).cast(COUNT)


def changes_frame(df: DataFrame, op: str, key: Column, old: Column | None = None, new: Column | None = None) -> DataFrame:
    """Rows of the layout ``CHANGE`` from a frame and the expressions of their parts; a null key gives no id."""
    return df.select(
        F.concat(F.lit(op), F.lit(":"), key.cast("string")).alias("change_id"),
        F.lit(op).alias("op"),
        (no_count() if old is None else old).alias("old"),
        (no_count() if new is None else new).alias("new"),
    )


def signed_lines(changes: DataFrame) -> DataFrame:
    """The lines that changes add to the totals: -1 for what was counted before, +1 for what counts now.

    Rows of one change_id that say the same are one change, delivered again; a change
    without an id is taken as it comes. An insert counts only its new side, a delete
    only its old side, any other operation than insert, delete and revise nothing. A
    side that is null, or whose count is null, adds no tokens.
    """
    keyed = changes.select("change_id", "op", "old", "new")
    once = keyed.filter(F.col("change_id").isNotNull()).dropDuplicates().unionByName(keyed.filter(F.col("change_id").isNull()))
    sides = F.array(
        F.struct(F.when(F.col("op").isin("delete", "revise"), F.col("old")).alias("side"), F.lit(-1).alias("sign")),
        F.struct(F.when(F.col("op").isin("insert", "revise"), F.col("new")).alias("side"), F.lit(1).alias("sign")),
    )
    lines = once.select(F.inline(sides)).filter(F.col("side").isNotNull())
    return lines.select(
        *(F.col("side")[d].alias(d) for d in DIMENSIONS),
        F.col("sign").cast("bigint").alias("docs"),
        (F.coalesce(F.col("side")["tokens"], F.lit(0)) * F.col("sign")).cast("bigint").alias("tokens"),
    )


class TokenRollup:
    """Totals under one folder: ``deltas`` and ``commits``, each with a part per batch."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark = spark
        self.path = path

    def _part(self, table: str, batch: str) -> str:
        safe = "".join(c if c.isalnum() or c in "-_" else f"%{ord(c):x}" for c in batch)
        return f"{self.path}/{table}/part={safe}"

    def is_committed(self, batch: str) -> bool:
        return path_exists(self.spark, f"{self._part('commits', batch)}/_SUCCESS")

    def apply(self, batch: str, changes: DataFrame) -> bool:
        """Add a batch to the totals; False, and no change, if it was committed before.

        The sums are combined before the shuffle, so a source that holds most rows costs
        no more than any other.
        """
        if not batch:
            raise ValueError("a batch needs a name")
        if self.is_committed(batch):
            return False
        sums = signed_lines(changes).groupBy(*DIMENSIONS).agg(*(F.sum(m).alias(m) for m in MEASURES))
        delta = sums.filter((F.col("docs") != 0) | (F.col("tokens") != 0)).withColumn("batch", F.lit(batch))
        delta.write.mode("overwrite").parquet(self._part("deltas", batch))
        commit = self.spark.range(1).select(F.lit(batch).alias("batch"), F.current_timestamp().alias("committed_at"))
        commit.write.mode("overwrite").parquet(self._part("commits", batch))
        return True

    def _table(self, name: str, schema: str) -> DataFrame:
        if not path_exists(self.spark, f"{self.path}/{name}"):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.path}/{name}").select(*(c.split()[0] for c in schema.split(", ")))

    def commits(self) -> DataFrame:
        return self._table("commits", "batch string, committed_at timestamp")

    def totals(self) -> DataFrame:
        """Documents and tokens by source, language and tokenizer version; sums that are back to zero are left out."""
        committed = self._table("deltas", DELTA).join(self.commits().select("batch"), "batch", "left_semi")
        sums = committed.groupBy(*DIMENSIONS).agg(*(F.sum(m).alias(m) for m in MEASURES))
        return sums.filter((F.col("docs") != 0) | (F.col("tokens") != 0))
