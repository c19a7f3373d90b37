"""Embeddings, conversations, URLs, tokens and rollups, with their edge cases."""

import base64
import hashlib
import random

import duckdb  # noqa: F401
import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import pytest
import regex
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from shelfscope.llm import bpe, chat, embedding_join, quality, queries, rollups, urls
from shelfscope.llm.components import connected_components
from shelfscope.staging import Workspace, fresh_path

from . import brute

SF_DIR = "/root/testdata/sf0.001"


def _vectors():
    rng = np.random.default_rng(5)
    rows = []
    for label in (0, 1):
        for _ in range(12):
            base = rng.normal(size=6)
            for _ in range(rng.integers(1, 7)):
                rows.append(([float(x) for x in base + rng.normal(size=6) * 0.12], label))
    rows += [rows[0], rows[0], (rows[0][0], None), (None, 0), ([], 0), ([0.0] * 6, 0), ([1.0, None, 0, 0, 0, 0], 0)]
    rows += [([float("nan")] + [1.0] * 5, 0), ([float("inf")] + [1.0] * 5, 0), ([-0.0, 2.0, 0.0, 0.0, 0.0, 0.0], 1), ([0.0, 1e-200, 0, 0, 0, 0], 1)]
    return [(i, [None if x is None else float(x) for x in v] if v is not None else None, k) for i, (v, k) in enumerate(rows)]


@pytest.mark.parametrize("cell", [2048, 8])
def test_range_join_equals_brute_force(spark, monkeypatch, cell):
    monkeypatch.setattr(embedding_join, "CELL", cell)
    monkeypatch.setattr(embedding_join, "CHUNK", cell)
    rows = _vectors()
    sound = {
        i: (np.array(v) / np.abs(v).max(), k)
        for i, v, k in rows
        if k is not None and v and None not in v and np.isfinite(v).all() and np.any(v)
    }
    links = [
        (i, j)
        for i, (v, k) in sound.items()
        for j, (w, m) in sound.items()
        if i < j and k == m and v @ w / np.sqrt((v @ v) * (w @ w)) >= 0.93
    ]
    named = brute.components([i for i, _, _ in rows], links)
    degree = {i: sum(i in pair for pair in links) for i, _, _ in rows}
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("KEPT", F.lit("x"))
    got = embedding_join.near_duplicates(df, 0.93).collect()
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got} == {i: (degree[i], c, i == c) for i, c in named.items()}


def test_range_join_of_nothing(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert embedding_join.near_duplicates(empty, 0.93).count() == 0


def test_components_of_a_long_chain_with_hashed_ids(spark):
    rng = random.Random(4)
    chain = [rng.randrange(-(2**63), 2**63) for _ in range(2000)]
    links = [*zip(chain, chain[1:]), (1, 2), (3, 2), (7, 7)]
    with Workspace(spark, "components-test") as space:
        got = connected_components(spark.createDataFrame(links, "a long, b long"), space).collect()
    assert sorted(map(tuple, got)) == sorted([(n, min(chain)) for n in chain] + [(1, 1), (2, 1), (3, 1)])


def test_chat_reads_back_whatever_was_said(spark):
    said = ["<|im_end|>", "<\\|im_start|>", "<\\\\| <| \\", "", None, "a\nb", "🙂<|image|>"]
    rows = [(7, i, "assistant" if i % 2 else "user\n\x1b<|x", t) for i, t in enumerate(said)] + [(8, None, None, "x"), (8, None, None, "x")]
    messages = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").select(
        "*", F.array(chat.text_part(F.col("text"))).alias("parts"), F.lit("x").alias("formatted")
    )
    out = {
        r.conv_id: r
        for r in chat.format_chats(messages)
        .select("conv_id", chat.read_turns(F.col("formatted")).alias("turns"), chat.read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss"))
        .collect()
    }
    assert [(t.role, t.text) for t in out[7].turns] == [(r, t or "") for _, _, r, t in rows[:7]]
    assert out[7].loss == "".join(t or "" for t in said[1::2])
    assert [(t.role, t.text) for t in out[8].turns] == [("", "x")] * 2
    assert chat.format_chats(messages.limit(0)).count() == 0


def test_chat_flattens_attachments_in_order(spark):
    parts = [
        ("text", "see", None, None, None, None, None),
        ("image", None, "s3://a.png", 57, 28, None, None),
        ("audio", None, "b.wav", None, None, 1.5, None),
        ("document", None, "c.pdf", None, None, None, 2),
        ("image", None, None, None, None, None, None),
        ("other", "kept", None, None, None, None, None),
    ]
    df = spark.createDataFrame([(1, 0, "user", parts), (1, 1, "user", None)], f"conv_id long, turn long, role string, parts array<{chat.PART}>")
    row = chat.format_chats(df).first()
    assert "see<|image|><|audio|><|document|><|image|>kept<|im_end|>" in row.formatted
    assert [(a.type, a.ref, a.tokens) for a in row.attachments] == [
        ("image", "s3://a.png", 3), ("audio", "b.wav", 50), ("document", "c.pdf", 2048), ("image", None, 1),
    ]


URLS = [
    ("http://A.Net/x?y", "a.net", "/x", "net/"),
    ("https://b.example.net/en/1#t", "b.example.net", "/en/1", "example.net/en/"),
    ("http://example.com/de/", "example.com", "/de/", "example.com/de/"),
    ("http://notexample.com/de/", "notexample.com", "/de/", None),
    ("x://é.org/fr/ü", "é.org", "/fr/ü", "org/fr/"),
    ("http://a.net", "a.net", "", None),
    ("http://a.net?x=/y", "a.net", "", None),
    ("mailto:x", "", "", None),
    ("", "", "", None),
    (None, "", "", None),
]


def test_urls_are_split_and_ruled(spark):
    df = spark.createDataFrame([(i, u[0]) for i, u in enumerate(URLS)], "page_id long, url string").withColumn("HOST", F.lit(1))
    model = urls.train_url_model(df.select("url", F.lit("allow").alias("label")))
    rows = urls.filter_urls(df, queries.URL_RULES, model).orderBy("page_id").collect()
    assert [(r.host, r.path, r.rule) for r in rows] == [u[1:] for u in URLS]
    assert [r.verdict for r in rows[:3]] == ["block", "allow", "block"]
    assert urls.filter_urls(df.limit(0), queries.URL_RULES, model).count() == 0


def test_url_model_predicts_held_out_urls(spark):
    pages = queries.table(spark, "/root/testdata/sf0.01", "pages").select("url")
    ruled = urls.match_rules(pages, queries.URL_RULES).filter("ruled is not null").select("url", F.col("ruled").alias("label"))
    held = F.pmod(F.xxhash64("url"), F.lit(3)) == 0
    model = urls.train_url_model(ruled.filter(~held))
    judged = urls.filter_urls(ruled.filter(held), (), model)
    accuracy = judged.select(F.avg((F.col("verdict") == F.col("label")).cast("double"))).first()[0]
    assert accuracy >= 0.9


@pytest.fixture(scope="module")
def reference_encoder():
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.mark.parametrize("fold_from", [1, 2])
def test_bpe_equals_the_reference_encoder(spark, tmp_path, reference_encoder, fold_from):
    rng = random.Random(1)
    texts = [None, "", "  a  b\n\n x \t y  ", "a" * 3000 + " it's 'S 123 é漢字🙂\u00a0x ", " lead", "trail ", "<|endoftext|>", "\u2003wide\u2003 x"]
    texts += ["".join(rng.choice("abcdeé漢🙂 \n\t'.0") for _ in range(200)) for _ in range(12)]
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(99, "same row", "x")] * 3
    spark.createDataFrame(rows, "doc_id long, text string, token_ids string").repartition(4).write.parquet(str(tmp_path / "in"))
    docs = spark.read.parquet(str(tmp_path / "in"))
    vocabulary = queries.public_vocabulary()
    encoded = bpe.encode_texts(docs, vocabulary, fold_from=fold_from)
    out = encoded.select("doc_id", "token_ids", bpe.decode_ids(F.col("token_ids"), vocabulary).alias("bytes")).collect()
    assert len(out) == len(rows)
    by_id = {i: t or "" for i, t, _ in rows}
    for r in out:
        assert list(r.token_ids) == reference_encoder.encode_ordinary(by_id[r.doc_id])
        assert bytes(r.bytes) == by_id[r.doc_id].encode()


def _words_of(texts):
    block = bpe._Block([pa.array(texts, pa.string())], [pa.record_batch({"i": pa.array(range(len(texts)))})], queries.public_vocabulary())
    words, codes, lengths = block.words()
    ends = np.concatenate([[0], np.cumsum(lengths)])
    spelled = [words.take(pa.array(codes[a:b])).to_pylist() for a, b in zip(ends, ends[1:], strict=False)]
    return dict(zip(block.carried["i"].to_pylist(), spelled, strict=True))


def test_bpe_words_are_the_matches_of_the_pattern():
    rng = random.Random(2)
    texts = ["", None, " ", "a b", " a  b ", "x\u00a0 y", "don't 'tis it's' 's", "\u00d7 a\u00d7b \u00e9t\u00e9. \u6f22\u5b57! 12a a12 a_b, _a", "a\x1c b \x85 c"]
    texts += ["".join(rng.choice("abst' .,!\n\u00e9\u00d7\u6f22\u0416\u01305\u00a0\x1f\U0001f642") for _ in range(60)) for _ in range(300)]
    found = regex.compile(public_tokenizers.PATTERN)
    assert _words_of(texts) == {i: found.findall(t or "") for i, t in enumerate(texts)}


def test_bpe_spells_plain_words_without_a_scan(monkeypatch):
    monkeypatch.setattr(bpe._Block, "_scan", lambda self, part: 1 / 0)
    assert _words_of(["Only plain words, here."]) == {0: ["Only", " plain", " words", ",", " here", "."]}


def test_bpe_white_space_and_letters_for_arrow():
    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    white = [c for c in every if regex.match(r"\s", c)]
    assert pc.all(pc.match_substring_regex(pa.array(white), bpe._WHITE)).as_py()
    plain = pc.match_substring_regex(pa.array(every), bpe._PLAIN_PART).to_pylist()
    assert all(regex.fullmatch(r"\p{L}", c) for c, is_plain in zip(every, plain, strict=True) if is_plain)
    assert public_tokenizers.PATTERN == bpe.PLAIN_PATTERN


def test_bpe_over_some_blocks(spark, tmp_path, reference_encoder):
    """Every file is a block of its own, so that the words that they share are folded."""
    rng = random.Random(3)
    words = ["".join(rng.choice("abcde\u00e9\u6f22") for _ in range(rng.randint(1, 30))) for _ in range(40)] + ["z" * 64, "z" * 65, "\x00\x00"]
    rows = [(i, " ".join(rng.choice(words) for _ in range(50))) for i in range(20)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(str(tmp_path / "in"))
    docs = spark.read.parquet(str(tmp_path / "in"))
    digests = bpe.token_digests(docs, queries.public_vocabulary()).collect()
    given = bpe.encode_texts(docs, queries.public_vocabulary(), fold_from=1, give=("decoded", "ids_text", "n_tokens", "token_ids")).collect()
    ids = {i: reference_encoder.encode_ordinary(t) for i, t in rows}
    listed = {i: ",".join(map(str, one)) for i, one in ids.items()}
    assert {r.doc_id: (r.n_tokens, r.ids_text, list(r.token_ids), bytes(r.decoded)) for r in given} == {
        i: (len(ids[i]), listed[i], ids[i], t.encode()) for i, t in rows
    }
    assert {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in digests} == {
        (i, len(ids[i]), hashlib.sha256(listed[i].encode()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()) for i, t in rows
    }


def test_bpe_plans_hold_no_vocabulary(spark):
    """The driver keeps a plan's text for every query, and writes it anew at every update."""
    docs = spark.createDataFrame([(1, "some text")], "doc_id long, text string")
    plan = bpe.token_digests(docs, queries.public_vocabulary())._jdf.queryExecution()
    assert len(plan.analyzed().toString()) < 50_000
    assert len(plan.executedPlan().toString()) < 50_000


def test_rollup_is_additive_and_commits_once(spark):
    def side(source, tokens):
        return (source, "en", "v1", tokens)

    changes = [
        ("1", "insert", None, side("a", 10)),
        ("2", "insert", None, side(None, 5)),
        ("2", "insert", None, side(None, 5)),
        (None, "insert", None, side("a", 1)),
        ("4", "other", side("a", 3), side("a", 4)),
    ]
    rollup = rollups.TokenRollup(spark, fresh_path(spark, "rollup-test"))
    assert rollup.totals().count() == 0
    assert rollup.apply("b/1", spark.createDataFrame(changes, rollups.CHANGE))
    assert not rollup.apply("b/1", spark.createDataFrame(changes, rollups.CHANGE))
    revised = [("5", "revise", side("a", 10), side("b", 12)), ("6", "delete", side("a", 1), None), ("7", "insert", None, side("a", None))]
    assert rollup.apply("b2", spark.createDataFrame(revised, rollups.CHANGE))
    assert rollup.apply("none", spark.createDataFrame([], rollups.CHANGE))
    assert {(r.source, r.docs, r.tokens) for r in rollup.totals().collect()} == {("a", 1, 0), ("b", 1, 12), (None, 1, 5)}
    assert sorted(r.batch for r in rollup.commits().collect()) == ["b/1", "b2", "none"]


def test_uncommitted_delta_does_not_count(spark):
    rollup = rollups.TokenRollup(spark, fresh_path(spark, "rollup-test"))
    spark.createDataFrame([("a", "en", "v1", 1, 1, "x")], rollups.DELTA).write.parquet(rollup._part("deltas", "x"))
    assert rollup.totals().count() == 0


def test_pipeline_equals_brute_force(spark, reference_encoder):
    docs = queries.table(spark, SF_DIR, "documents")
    texts = {r.doc_id: r.text for r in docs.collect()}
    rules = quality.learn_from(docs, queries.table(spark, SF_DIR, "labels"))
    kept = corpus_pipeline.quality_rules(spark, docs, SF_DIR)
    assert kept.columns == docs.columns
    kept_ids = {r.doc_id for r in kept.select("doc_id").collect()}
    ruled = {r.doc_id for r in quality.judge_quality(docs, rules).filter("rule > 0").collect()}
    base = {i for i, t in texts.items() for n, _, _, _, k in [brute.statistics(t)] if n >= 50 and 100 * k <= 50 * n}
    assert kept_ids == base - ruled

    spark.conf.set("spark.sql.shuffle.partitions", "8")
    unique = corpus_pipeline.ngram_dedup(spark, kept, SF_DIR)
    named = brute.jaccard([(i, texts[i]) for i in kept_ids])
    assert {r.doc_id for r in unique.collect()} == {i for i, (_, c) in named.items() if i == c}

    clean = corpus_pipeline.redact_pii(spark, unique, SF_DIR)
    clean_texts = {r.doc_id: r.text for r in clean.collect()}
    assert not any(any(brute.pii(t).values()) for t in clean_texts.values())
    assert all(clean_texts[i] == texts[i] for i in clean_texts if "[" not in clean_texts[i])

    mixed = corpus_pipeline.mix_sources(spark, clean, SF_DIR)
    assert mixed.columns == docs.columns and {r.doc_id for r in mixed.collect()} <= set(clean_texts)

    for r in corpus_pipeline.encode(spark, clean, SF_DIR).collect():
        ids = reference_encoder.encode_ordinary(clean_texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), brute.sha(",".join(map(str, ids))))
        assert r.decoded_sha256 == brute.sha(clean_texts[r.doc_id])


def test_dedup_knows_a_row_by_its_id_and_text(spark):
    a, b = "one two three four five six seven eight", "quite another text of more than five words"
    rows = [(None, a), (None, a), (5, a), (7, a), (7, b), (5, a), (None, "something else that nobody else has said before"), (None, ""), (None, ""), (8, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.ngram_dedup(spark, docs, SF_DIR)
    assert kept.columns == docs.columns
    want = [(5, a), (7, b), (None, "something else that nobody else has said before"), (None, ""), (None, ""), (8, None)]
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted(want, key=repr)


def test_pipeline_stages_keep_extra_columns(spark):
    docs = queries.table(spark, SF_DIR, "documents").withColumn("kept", F.lit("mine")).withColumn("pii", F.lit("mine"))
    for stage in (corpus_pipeline.quality_rules, corpus_pipeline.redact_pii):
        out = stage(spark, docs, SF_DIR)
        assert out.columns == docs.columns and out.select("kept", "pii").distinct().collect() == [("mine", "mine")]
