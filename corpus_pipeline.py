"""A training-data pipeline over ``documents``: five stages, each on all that the one before kept.

Every stage takes (spark, docs, sf_dir), is written as Parquet and read again as the
next one's ``docs``. All but the last return the columns of ``documents``; columns that
the input has besides go through to the fourth stage, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfscope.llm import mixing, ngram_join, pii, quality
from shelfscope.llm.queries import MIXTURE, table, token_digests
from shelfscope.staging import Workspace


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop what the fixed rules or the list learned from ``labels`` reject."""
    rules = quality.learn_from(docs, table(spark, sf_dir, "labels"))
    judged = quality.judge_quality(docs.select(F.struct("*").alias("_row"), "text"), rules)
    return judged.filter("kept").select("_row.*")


def ngram_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep of each group of near-duplicates one row, of the smallest id; null ids come last.

    A row is known by its id and its text, so one id's other texts are rows of their own,
    and rows without an id are compared like all. Rows equal in both are copies: one stays.
    Texts without words link with nothing, and all stay.
    """
    row = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", F.xxhash64("text").alias("hash"))
    groups = ngram_join.jaccard_components(docs.select(row.alias("row"), "text"), key="row").filter("n_shingles > 0")
    space = Workspace(spark, "dedup")
    gone = space.stage(groups.filter("row != component_id").select(F.col("row").alias("_gone")).distinct(), "gone").frame
    copies = groups.filter("row = component_id").groupBy(F.col("row").alias("_copied")).count().filter("count > 1")
    repeated = space.stage(copies.select("_copied"), "repeated")
    kept = docs.withColumn("_row", row).join(gone, F.col("_row") == F.col("_gone"), "left_anti")
    if repeated.rows:
        again = F.col("_row") == F.col("_copied")
        single = kept.join(repeated.frame, again, "left_semi").dropDuplicates(["_row"])
        kept = kept.join(repeated.frame, again, "left_anti").unionByName(single)
    return kept.select(*docs.columns)


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data in the text by placeholders; a changed text gets its new length."""
    clean = pii.redact(pii.find_pii(docs.select(F.struct("*").alias("_row"), "text")))
    length = F.when(F.size("pii") > 0, F.char_length("text").cast("bigint")).otherwise(F.col("_row.n_chars"))
    changed = {"text": F.col("text"), "n_chars": length}
    return clean.select(*(changed.get(c, F.col("_row")[c]).alias(c) for c in docs.columns))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat documents to the target weights and shuffle them globally."""
    return mixing.mix_sources(docs, MIXTURE).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each row's text, their count, and digests of the ids and of what they decode to."""
    return token_digests(docs.select("doc_id", "lang", "source", "text"))


STAGES = [
    ("quality_rules", quality_rules),
    ("ngram_dedup", ngram_dedup),
    ("redact_pii", redact_pii),
    ("mix_sources", mix_sources),
    ("encode", encode),
]

#: No SQL: the rules are learned, and the token merges are iterative. Tests run a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's table is dropped once the next is written."""
    space = Workspace(spark, "pipeline")
    docs, last = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        written = space.stage(stage(spark, docs, sf_dir), name)
        if last is not None:
            last.drop()
        docs, last = written.frame, written
    return docs
