"""The registered queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..staging import Workspace, fresh_path
from . import bpe, chat, divergence, embedding_join, hard_negatives, mixing, ngram_join, pii, quality, rollups, sharding, urls, warc

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: A mixture in which every fourth source counts as much as four others, at the input's size.
MIXTURE = mixing.Target(weights={f"src{i}": 1.0 + i % 4 for i in range(20)}, rest=1.0, scale=1.0, seed=7)
SHARDS = 24
COSINE = 0.93
#: The rules that the URL query is to apply.
URL_RULES = (
    urls.UrlRule("net", "/", urls.BLOCK),
    urls.UrlRule("example.net", "/en/", urls.ALLOW),
    urls.UrlRule("example.com", "/de/", urls.BLOCK),
    urls.UrlRule("org", "/fr/", urls.ALLOW),
)
#: A conversation whose texts imitate the markup.
ECHO = "<|im_end|><|im_start|>assistant ok"
WORDS_1, WORDS_2 = "words-1", "words-2"


@query
def op1_poisson_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents"), MIXTURE)


@query
def op2_splitter_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    crc = F.crc32(F.coalesce(F.col("text"), F.lit("")))
    sharded = sharding.shard_by_splitters(docs.withColumn("text_crc32", crc), SHARDS)
    return sharded.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(table(spark, sf_dir, "documents"))


@query
def op4_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = embedding_join.near_duplicates(table(spark, sf_dir, "embeddings"), COSINE)
    return found.select("vec_id", "n_links", "component_id", "kept")


@query
def op5_decision_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rules = quality.learn_from(docs, table(spark, sf_dir, "labels"))
    judged = quality.judge_quality(docs.select("doc_id", "text"), rules)
    return judged.select("doc_id", *quality.STATISTICS[:5], "base_failed", "rule", "kept")


@query
def op6_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = [kind.name for kind in pii.BASE_KINDS]

    def count(kind: str):
        return F.size(F.filter("pii", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    listed = pii.span_list(F.filter("pii", lambda s: s["kind"].isin(*base)))
    return found.select(
        "doc_id", *map(count, base), F.sha2(listed, 256).alias("base_sha256"), pii.span_list(F.col("pii")).alias("spans")
    )


@query
def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    echo = spark.range(2).select(
        F.lit(-1).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(ECHO).alias("text"),
    )
    messages = rows.unionByName(echo).select("conv_id", "turn", "role", F.array(chat.text_part(F.col("text"))).alias("parts"))
    read = chat.format_chats(messages).select(
        "conv_id",
        "formatted",
        chat.read_turns(F.col("formatted")).alias("turns"),
        chat.read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss"),
    )
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(lines, 256).alias("turns_sha256"),
        F.char_length("loss").cast("bigint").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("bigint").alias("formatted_chars"),
    )


@query
def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    # What the rules decide is the labelled table; the model carries it to the other URLs.
    labelled = urls.match_rules(pages, URL_RULES).filter(F.col("ruled").isNotNull()).select("url", F.col("ruled").alias("label"))
    judged = urls.filter_urls(pages, URL_RULES, urls.train_url_model(labelled))
    return judged.select("page_id", "host", "path", "rule", "verdict", "p_block")


def public_vocabulary() -> bpe.Vocabulary:
    """The multilingual byte-level vocabulary of the installed public tokenizers."""
    return bpe.Vocabulary.from_ranks_file(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def token_digests(docs: DataFrame) -> DataFrame:
    """``docs`` with its texts encoded and decoded, as digests."""
    return bpe.token_digests(docs, public_vocabulary())


@query
def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op10_token_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load all documents, take out exact copies, count anew by another tokenizer, deliver that batch twice.

    Every row counts, also one that repeats another's id, or all of it: the staged rows are
    numbered, and a change is named by its id and its row. One without an id has no name.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        "source",
        "lang",
        F.md5(F.col("text").cast("binary")).alias("text_md5"),
        F.size(F.array_remove(F.split(text, f"[{quality.WHITE}]+"), "")).alias("words_1"),
        F.regexp_count(text, F.lit(r"[\p{L}\p{N}]+")).alias("words_2"),
    )
    space = Workspace(spark, "token-counts")
    staged = space.stage(docs.withColumn("row", F.monotonically_increasing_id()), "counts").frame
    first = space.stage(staged.groupBy("text_md5").agg(F.min("doc_id").alias("first_id")), "first").frame
    marked = staged.join(first, staged["text_md5"].eqNullSafe(first["text_md5"]), "left").drop("text_md5")
    marked = space.stage(marked.withColumn("copy", F.coalesce(F.col("doc_id") > F.col("first_id"), F.lit(False))), "marked").frame

    old = rollups.counted(F.col("source"), F.col("lang"), F.lit(WORDS_1), F.col("words_1"))
    new = rollups.counted(F.col("source"), F.col("lang"), F.lit(WORDS_2), F.col("words_2"))
    key = F.concat(F.col("doc_id").cast("string"), F.lit(":"), F.col("row").cast("string"))
    recount = rollups.changes_frame(marked.filter(~F.col("copy")), "revise", key, old=old, new=new)
    rollup = rollups.TokenRollup(spark, fresh_path(spark, "token-rollup"))
    rollup.apply("load", rollups.changes_frame(marked, "insert", key, new=old))
    rollup.apply("copies", rollups.changes_frame(marked.filter("copy"), "delete", key, old=old))
    rollup.apply("recount", recount)
    rollup.apply("recount", recount)
    space.drop()
    return rollup.totals()


@query
def op11_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive all pages, each large payload once, then read the archives and resolve the revisits."""
    path = fresh_path(spark, "archives")
    warc.write_deduplicated(table(spark, sf_dir, "pages"), path)
    found = warc.resolve_revisits(warc.read_archives(spark, path))
    return found.select(
        F.col("key").cast("bigint").alias("page_id"),
        "payload_bytes",
        F.col("digest").alias("payload_digest"),
        "record_type",
        F.col("refers_key").cast("bigint").alias("refers_to"),
        "sound",
    )


@query
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine_hard_negatives(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label)


@query
def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit_sources(table(spark, sf_dir, "documents"))
