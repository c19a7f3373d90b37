"""WARC archives, hard negatives and the divergence audit: edge cases and brute force."""

import gzip
import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfscope.llm import divergence, hard_negatives, queries, warc
from shelfscope.staging import fresh_path

# --- archives -------------------------------------------------------------------

LONG = "x\r\n\r\nWARC/1.1\r\n\n" * 200
PAGES = [
    (1, "http://a/1", LONG),
    (2, "http://a/2", LONG),
    (2, "http://a/2", LONG),
    (None, "http://a/3", LONG),
    (3, None, "é" * 500),
    (4, "", "é" * 500),
    (5, "http://a/5\r\nX-Evil: 1", "é" * 499),
    (6, "http://a/6", "é" * 499),
    (7, "http://a/7", None),
    (8, "http://a/8", ""),
    (9, "http://a/9", "ends with breaks\r\n\r\n\r\n"),
    (10, "http://a/10", "漢" * 400_000),
    (11, "http://a/11", "漢" * 400_000),
]
SCHEMA = "page_id long, url string, html string"


@pytest.fixture(scope="module")
def archived(spark):
    path = fresh_path(spark, "warc-test")
    pages = spark.createDataFrame(PAGES, SCHEMA).withColumn("DIGEST", F.lit("mine")).repartition(3)
    warc.write_deduplicated(pages, path)
    return path


def test_archives_hold_each_large_payload_once(spark, archived):
    records = warc.read_archives(spark, archived, payloads=True).collect()
    assert len(records) == len(PAGES) and len({r.record_id for r in records}) == len(PAGES)
    stored = Counter(bytes(r.payload) for r in records if r.record_type == "response")
    payloads = Counter((t or "").encode() for _, _, t in PAGES)
    assert stored == {p: 1 if len(p) >= 1000 else n for p, n in payloads.items()}
    assert all(r.sound for r in records if r.record_type == "response")
    assert {r.url for r in records if r.key == "3"} == {None} and {r.url for r in records if r.key == "4"} == {""}
    assert {r.url for r in records if r.key == "5"} == {"http://a/5%0D%0AX-Evil: 1"}


def test_revisits_resolve_to_the_largest_key(spark, archived):
    found = warc.resolve_revisits(warc.read_archives(spark, archived)).collect()
    got = sorted(((r.key, r.record_type, r.refers_key, r.payload_bytes, r.digest) for r in found), key=repr)
    want, seen = [], set()
    best = {}
    for key, _, text in PAGES:
        best[text] = max(best.get(text, -1), -1 if key is None else key)
    for key, _, text in PAGES:
        body = (text or "").encode()
        again = len(body) >= 1000 and (key != best[text] or (key, text) in seen)
        seen.add((key, text))
        name = None if key is None else str(key)
        want.append((name, "revisit" if again else "response", str(best[text]) if again else None, len(body), hashlib.sha1(body).hexdigest()))
    assert got == sorted(want, key=repr)


def test_archives_of_nothing_and_broken_ones(spark, tmp_path):
    path = fresh_path(spark, "warc-test")
    warc.write_deduplicated(spark.createDataFrame([], SCHEMA), path)
    assert warc.resolve_revisits(warc.read_archives(spark, path)).count() == 0
    with gzip.open(tmp_path / "cut.gz", "wb") as file:
        file.write(b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 100\r\n\r\nshort\r\n\r\n")
    with pytest.raises(Exception, match="inside a record"):
        warc.read_archives(spark, str(tmp_path)).collect()


def test_revisit_without_its_original(spark, tmp_path):
    head = b"WARC/1.0\r\nWARC-Type: %s\r\nWARC-Record-ID: <urn:uuid:%s>\r\nContent-Length: %d\r\n%s\r\n"
    block = b"HTTP/1.1 200 OK\r\n\r\n"
    refers = b"WARC-Refers-To: <urn:uuid:gone>\r\nWARC-Payload-Digest: sha1:0\r\n"
    # Two members, as other writers make one for each record.
    with open(tmp_path / "a.gz", "wb") as file:
        for kind, name, more in ((b"warcinfo", b"i", b""), (b"revisit", b"r", refers)):
            file.write(gzip.compress(head % (kind, name, len(block), more) + block + b"\r\n\r\n"))
    found = warc.resolve_revisits(warc.read_archives(spark, str(tmp_path))).collect()
    assert [(r.record_type, r.refers_key, r.payload_bytes, r.sound) for r in found] == [("revisit", None, None, None)]


# --- hard negatives -----------------------------------------------------------------


def _mined(rows, anchors, k, n, scale, least=30, most=90):
    """All answers by comparing everything with everything; rows are (id, vector, label)."""
    sound = [
        (i, [math.floor(scale * x) for x in v], label)
        for i, v, label in rows
        if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []

    def order(pair):
        return (-pair[0], pair[1] is None, pair[1] or 0)

    for a, (i, v, label) in enumerate(sound):
        if i not in anchors:
            continue
        scored = [(sum(x * y for x, y in zip(v, w, strict=True)), j, m) for b, (j, w, m) in enumerate(sound) if a != b and len(v) == len(w)]
        for own, positive, _ in sorted((s for s in scored if s[2] == label), key=order)[:k]:
            fits = sorted((s for s in scored if s[2] != label and least * own <= 100 * s[0] <= most * own), key=order)[:n]
            out += [(i, positive, rank, j, own, s) for rank, (s, j, _) in enumerate(fits, 1)]
    return out


def _vectors(n=260, width=12):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(0.2, 0.4, width)], int(rng.integers(3))) for i in range(n)]
    rows += [(i, rows[5][1], i % 3) for i in range(n, n + 40)]  # copies, so ties
    rows += [(7, rows[7][1], rows[7][2]), (None, rows[9][1], 0), (None, rows[9][1], 1), (900, None, 0), (901, rows[1][1], None)]
    rows += [(902, [None] + [1.0] * (width - 1), 0), (903, [float("nan")] * width, 1), (904, [float("inf")] * width, 1)]
    rows += [(905, [], 0), (906, [], 0), (907, [], 1), (908, [1.0, 2.0], 0), (909, [1.5, 2.0], 0), (910, [1.0, 1.0], 1), (911, [0.0] * width, 2)]
    return rows


@pytest.mark.parametrize(("rows_in", "anchors_in", "chunk"), [(4096, 1024, 128), (32, 8, 5)])
def test_hard_negatives_equal_brute_force(spark, monkeypatch, rows_in, anchors_in, chunk):
    monkeypatch.setattr(hard_negatives, "ROW_BLOCK", rows_in)
    monkeypatch.setattr(hard_negatives, "ANCHOR_BLOCK", anchors_in)
    monkeypatch.setattr(hard_negatives, "CHUNK", chunk)
    rows = _vectors()
    anchors = {0, 7, 20, 100, 262, 905, 908, 911, 903}
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("SCORE", F.lit("x"))
    mining = hard_negatives.Mining(positives=3, negatives=4, scale=64)
    got = hard_negatives.mine_hard_negatives(df.repartition(4), F.col("vec_id").isin(*anchors), mining=mining)
    want = _mined(rows, anchors, 3, 4, 64)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    assert len(want) > 60


def test_bounds_hold_and_drop_pairs():
    rng = np.random.default_rng(8)
    # Vectors with a level of their own: their means tell most of the score.
    a, v = (np.floor(256 * (rng.normal(0, 1, (n, 1)) + rng.normal(0, 0.1, (n, 64)))) for n in (20, 400))
    exact = a @ v.T
    for lower, upper in hard_negatives.segment_bounds(hard_negatives.summaries(a), hard_negatives.summaries(v), 64):
        assert (lower <= exact).all() and (exact <= upper).all()
    wide = np.full(20, np.inf)
    bounds = hard_negatives.segment_bounds(hard_negatives.summaries(a), hard_negatives.summaries(v), 64)
    alive = hard_negatives.surviving(bounds, np.arange(20), np.ones(exact.shape, dtype=bool), -wide, wide, 5)
    best = np.argsort(-exact, axis=1)[:, :5]
    assert np.take_along_axis(alive, best, axis=1).all()
    assert alive.mean() < 0.2


def test_scores_beyond_64_bits_are_an_error(spark):
    df = spark.createDataFrame([(0, [3e38, 1.0], 0), (1, [3e38, 1.0], 0)], "vec_id long, embedding array<double>, label int")
    with pytest.raises(Exception, match="64 bits"):
        hard_negatives.mine_hard_negatives(df, F.col("vec_id") == 0).count()


def test_hard_negatives_of_nothing(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert hard_negatives.mine_hard_negatives(empty, F.col("vec_id") % 100 == 0).count() == 0


# --- divergence ---------------------------------------------------------------------


def _audit(docs, least=3, top=200):
    docs = [tuple(x or "" for x in d) for d in docs]
    counts, seen = defaultdict(Counter), defaultdict(Counter)
    groups = {(lang, source) for _, lang, source in docs}
    for text, lang, source in docs:
        low = text.translate({c: c + 32 for c in range(65, 91)})
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low)
        counts[lang, source].update(terms)
        seen[lang].update(set(terms))
    out = []
    for lang, source in groups:
        kept = [t for t, n in seen[lang].items() if n >= least]

        def shares(own, kept=kept):
            total = sum(own[t] for t in kept) + len(kept)
            return {t: 1 + 10**9 * (own[t] + 1) // total for t in kept}

        own = counts[lang, source]
        p = shares(own)
        whole = Counter()
        for name, other in groups:
            if name == lang:
                whole.update(counts[name, other])
        pairs = []
        for name, other in groups:
            if name == lang and other != source:
                q = shares(counts[lang, other])
                pairs.append((sum((p[t] - q[t]) ** 2 // q[t] for t in kept), other))
        q = shares(whole)
        terms = [((p[t] - q[t]) ** 2 // q[t], t) for t in kept if own[t] > 0 and p[t] > q[t]]
        for part, items, most in (("pair", pairs, None), ("term", terms, top)):
            ranked = sorted(items, key=lambda x: (-x[0], x[1].encode()))[:most]
            out += [(lang, source, part, item, value, rank) for rank, (value, item) in enumerate(ranked, 1)]
    return out


def _documents():
    rng = np.random.default_rng(11)
    words = ["Alpha", "bêta", "GAMMA", "delta", "ÉPSILON", "zeta1eta", "theta_iota", "漢字", "kappa", "🙂", "a", "b", "c"]
    docs = []
    for i in range(160):
        text = " ".join(words[k] for k in rng.integers(0, len(words) - (i % 5), rng.integers(0, 30)))
        docs.append((text, ["en", "de", None][i % 3], f"s{i % 11}" if i % 13 else None))
    docs += [(None, "en", "s0"), ("", "fr", "empty"), (None, None, None), ("once", "it", "x"), ("", "it", "y"), ("", "it", None)]
    docs += [docs[0]] * 3 + [("word " * 5000 + "long" * 2000 + ".tail", "es", "big")] * 3 + [("word tail", "es", "small")]
    return docs


@pytest.mark.parametrize("small", [False, True])
def test_audit_equals_brute_force(spark, monkeypatch, small):
    if small:
        monkeypatch.setattr(divergence, "GROUP_BLOCK", 3)
        monkeypatch.setattr(divergence, "CELL_ENTRIES", 7)
        monkeypatch.setattr(divergence, "CHUNK_TERMS", 2)
    docs = _documents()
    df = spark.createDataFrame(docs, "text string, lang string, source string").withColumn("N", F.lit("x")).repartition(5)
    got = divergence.audit_sources(df).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(_audit(docs), key=repr)


def test_terms_are_counted_whole_across_pieces(monkeypatch):
    monkeypatch.setattr(divergence, "PIECE_BYTES", 16)
    text = ("ab " * 50 + "x" * 100 + " é漢 " + "tail").encode()
    assert b"".join(divergence._pieces(text)) == text
    terms = [t for piece in divergence._pieces(text) for t in divergence._TERM.findall(piece)]
    assert terms == divergence._TERM.findall(text)


def test_audit_of_nothing(spark):
    empty = spark.createDataFrame([], "text string, lang string, source string")
    assert divergence.audit_sources(empty).count() == 0


def test_queries_leave_the_session_as_it_was(spark):
    before = dict(spark.conf.getAll)
    for name in ("op9_byte_bpe", "op11_warc_revisits", "op12_hard_negatives", "op13_source_divergence"):
        queries.QUERIES[name](spark, "/root/testdata/sf0.001").count()
    assert dict(spark.conf.getAll) == before
