"""Operators on documents against brute force, and their edge cases."""

import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfscope.llm import mixing, ngram_join, pii, quality, queries, sharding

from . import brute

SF_DIR = "/root/testdata/sf0.001"
LAYOUT = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "long words here " * 20_000


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], LAYOUT)


@pytest.fixture(scope="module")
def edges(spark):
    rows = [(1, None, "a"), (2, "", "a"), (3, "one", None), (4, LONG, "a"), (5, LONG, "b"), (5, LONG, "b"), (None, "two words", "b")]
    return frame(spark, rows)


@pytest.fixture(scope="module")
def documents(spark):
    rows = queries.table(spark, SF_DIR, "documents").select("doc_id", "text").collect()
    return {r.doc_id: r.text for r in rows}


def test_mixing_reaches_its_weights_and_keeps_edge_rows(spark, edges):
    docs = spark.range(4000).select(
        F.col("id").alias("doc_id"), F.lit("x" * 10).alias("text"), F.when(F.col("id") % 4 == 0, "a").otherwise("b").alias("source")
    )
    mixed = mixing.mix_sources(docs, mixing.Target({"a": 3.0, "b": 1.0, "absent": 5.0}, seed=1))
    counts = {r["source"]: r["count"] for r in mixed.groupBy("source").count().collect()}
    assert counts["a"] == pytest.approx(3000, rel=0.1) and counts["b"] == pytest.approx(1000, rel=0.1)
    keys = [r.mix_key for r in mixed.collect()]
    assert keys == sorted(keys)
    clash = edges.withColumn("Copies", F.lit("x")).withColumn("mix_key", F.lit("x"))
    out = mixing.mix_sources(clash, mixing.Target({"a": 1.0}, rest=1.0, scale=60.0))
    assert dict(out.dtypes)["copies"] == "int" and out.filter("doc_id = 1").count() > 0 and out.filter("doc_id is null").count() > 0
    assert mixing.mix_sources(edges.limit(0), mixing.Target({"a": 1.0}, rest=1.0)).count() == 0


def test_high_rates_are_sums_of_draws_in_a_small_plan(spark):
    docs = spark.range(200).select(F.col("id").alias("doc_id"))
    rate, parts = 3000.0, math.ceil(3000.0 / mixing.MAX_MEAN)
    table = mixing.poisson_table(rate / parts)

    def drawn(j, i):
        number = int(hashlib.md5(f"draw{j}-5:{i}".encode()).hexdigest()[: mixing.DRAW_DIGITS], 16) / 16**mixing.DRAW_DIGITS
        return sum(p <= number for p in table)

    copies = docs.select("doc_id", mixing._copies(rate, 5, F.col("doc_id")).alias("copies"))
    assert len(copies._jdf.queryExecution().analyzed().toString()) < 20_000
    got = {r.doc_id: r.copies for r in copies.collect()}
    assert got == {i: sum(drawn(j, i) for j in range(parts)) for i in range(200)}
    assert sum(got.values()) / 200 == pytest.approx(rate, rel=0.01)


def test_poisson_table_is_the_distribution():
    table = mixing.poisson_table(2.5)
    assert table[3] == pytest.approx(sum(math.exp(-2.5) * 2.5**k / math.factorial(k) for k in range(4)))
    assert table[-1] == pytest.approx(1.0)


def test_shards_are_even_and_gapless(spark, documents, edges):
    rows = queries.op2_splitter_shards(spark, SF_DIR).collect()
    assert sorted(r.doc_id for r in rows) == sorted(documents)
    assert all(r.size == len(documents[r.doc_id].encode()) + 8 for r in rows)
    sums, slots = Counter(), {}
    for r in rows:
        sums[r.shard] += r.size
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(sums.values()) <= sum(sums.values()) / 24 + max(r.size for r in rows)
    out = sharding.shard_by_splitters(edges.withColumn("SHARD", F.lit("x")), 3).collect()
    assert len(out) == 7 and all(0 <= r.shard < 3 for r in out)
    assert sharding.shard_by_splitters(edges.limit(0), 3).count() == 0


def test_hot_text_is_cut_between_its_copies(spark):
    docs = frame(spark, [(i, "the same text" if i % 3 else f"text {i}", "a") for i in range(3000)])
    sizes = [r["sum(size)"] for r in sharding.shard_by_splitters(docs, 6).groupBy("shard").sum("size").collect()]
    assert len(sizes) == 6 and max(sizes) - min(sizes) <= 2 * 22


def _near_texts(seed):
    rng = random.Random(seed)
    texts = ["", None, "a b", "A  B", "a b c", "one two three four five", "One two\tthree four five", "one two three four six"]
    passage = [f"p{k}" for k in range(40)]
    for size in (6, 17, 18, 60, 200):
        base = [f"w{rng.randrange(10**6)}" for _ in range(size)]
        for _ in range(14):
            words = list(base)
            for _ in range(rng.randrange(0, 1 + size // 12)):
                words[rng.randrange(size)] = f"x{rng.randrange(10**6)}"
            texts.append(" ".join(words))
    texts += [" ".join([f"u{i}a", f"u{i}b", *passage, f"u{i}c"]) for i in range(40)]
    texts += [" ".join([*passage, *(f"v{i}-{k}" for k in range(30))]) for i in range(30)]
    return texts


def test_jaccard_components_equal_brute_force(spark, documents):
    docs = list(enumerate(_near_texts(3))) + [(1000, LONG), (1001, LONG.upper())]
    found = ngram_join.jaccard_components(frame(spark, [(i, t, "a") for i, t in docs]).withColumn("class", F.lit("x")))
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found.collect()} == brute.jaccard(docs)
    rows = queries.op3_ngram_jaccard(spark, SF_DIR).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == brute.jaccard(documents.items())


@pytest.mark.parametrize(("size", "most"), [(120, 9), (60, 6), (25, 3)])
def test_changes_of_one_text_are_not_all_paired(spark, monkeypatch, size, most):
    """Texts that share most shingles and are near the threshold or under it, the text they come from left out."""
    rng = random.Random(size)
    base, texts = [f"w{k}" for k in range(size)], []
    for i in range(160):
        words = list(texts[-1].split(" ") if i % 5 == 4 else base)
        for _ in range(rng.randrange(0 if i % 5 == 4 else 1, most + 1)):
            words[rng.randrange(size)] = f"x{rng.randrange(12) if i % 2 else rng.randrange(10**6)}"
        texts.append(" ".join(words))
    docs = list(enumerate(texts))
    verified, formed = ngram_join._verified, []

    def counted(pairs, lists, space):
        formed.append(space.stage(pairs, "counted").rows)
        return verified(pairs, lists, space)

    monkeypatch.setattr(ngram_join, "_verified", counted)
    found = ngram_join.jaccard_components(frame(spark, [(i, t, "a") for i, t in docs]))
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found.collect()} == brute.jaccard(docs)
    assert sum(formed) < 160 * 159 / 2 / 3


def test_jaccard_without_rows_or_ids(spark, edges):
    assert ngram_join.jaccard_components(edges.limit(0)).count() == 0
    named = ngram_join.jaccard_components(edges).collect()
    assert len(named) == 7
    assert {r.component_id for r in named if r.doc_id in (4, 5)} == {4}
    assert [r.component_id for r in named if r.doc_id is None] == [None]


def test_text_statistics_equal_brute_force(spark, documents):
    texts = dict(documents) | {
        10**6: None,
        10**6 + 1: "",
        10**6 + 2: " \n\t\x0b",
        10**6 + 3: "a b c a b c d\n\na b\n a b\n#|x é漢🙂",
        10**6 + 4: LONG,
        10**6 + 5: "a a a a a",
    }
    docs = frame(spark, [(i, t, "a") for i, t in texts.items()]).withColumn("N_Words", F.lit("x"))
    rows = quality.text_statistics(docs).collect()
    assert {r.doc_id: tuple(r[c] for c in quality.STATISTICS[:5]) for r in rows} == {i: brute.statistics(t) for i, t in texts.items()}


def test_decision_list_finds_planted_rules_and_keeps_clean_rows(spark):
    def text(i):
        words = [f"w{i}x{k}" for k in range(60 + i % 40)]
        return " ".join(w + "###" * (i % 5 == 0) for w in words)

    docs = frame(spark, [(i, text(i), "a") for i in range(600)])
    labels = spark.createDataFrame([(i, 0 if i % 5 == 0 else 1, 0) for i in range(400)], "doc_id long, quality int, toxic int")
    rules = quality.learn_from(docs, labels)
    assert rules.rules
    judged = quality.judge_quality(docs.filter("doc_id >= 400"), rules).collect()
    assert all(r.kept == (r.doc_id % 5 != 0) for r in judged)
    assert quality.learn_from(docs, labels.limit(0)).rules == ()
    assert quality.learn_from(docs, labels.filter("quality = 1")).rules == ()
    assert quality.judge_quality(docs.limit(0), rules).count() == 0


def test_decision_list_cuts_off_a_rare_bad_class(spark):
    def figures(i, bad, symbols):
        return (i, bad, 60 + i * 7 % 200, 5 * (60 + i * 7 % 200), symbols, 0, i % 9, 1 + i % 12)

    rows = [figures(i, i % 100 == 0, (9 + i % 7) * (i % 100 == 0)) for i in range(4000)]
    # Two in a hundred of the bad rows are of another kind, one word a line.
    rows += [(i, True, 300, 1500, 0, 0, 0, 300) for i in range(10_000, 10_020)] + [figures(i, True, 12) for i in range(20_000, 21_000)]
    layout = "doc_id long, bad boolean, " + ", ".join(f"{c} long" for c in quality.STATISTICS)
    for chosen in (rows[:4000], rows):
        labelled = spark.createDataFrame(chosen, layout)
        rules = quality.learn_decision_list(labelled)
        wrong = labelled.filter((rules.column() > 0) != F.col("bad"))
        assert rules.rules and wrong.count() == 0


TRICKY = [
    "a@b.com_x@y.z, a@b@c.d a.b+c%d@e-f.g.h. @x.y a@b",
    "1.2.3.4.5.6.7.8 256.1.1.1 001.02.3.255 1.2.3 999.1.2.3.4",
    "4111 1111 1111 1111 4111-1111-1111-1112 41111111111111111111111 5 55 4111  1111",
    "+1 (171) 555-2028 +12 +1234567890123456 ++49 30 1234567. +4930",
    "é漢🙂 x@y.zz 🙂 10.0.0.1 " * 3,
    "a" * 50_000 + "@" + "b." * 20_000 + "c " + "1" * 30_000,
    "",
    None,
]


def test_pii_spans_equal_brute_force(spark, documents):
    texts = dict(documents) | {10**6 + k: t for k, t in enumerate(TRICKY)}
    found = pii.find_pii(frame(spark, [(i, t, "a") for i, t in texts.items()]).withColumn("PII", F.lit("x")))
    for row in found.select("doc_id", "pii").collect():
        want = brute.pii(texts[row.doc_id])
        got = {k.name: [(s.start, s.end) for s in row.pii if s.kind == k.name] for k in pii.BASE_KINDS}
        assert got == want, row.doc_id


def test_added_kinds_need_their_checksum_or_context(spark):
    texts = [
        "IBAN GB82 WEST 1234 5698 7654 32 here",
        "GB82 WEST 1234 5698 7654 33",
        "my ssn: 123-45-6789",
        "part 123-45-6789",
        'token = "' + "0a1b" * 10 + '"',
        "0a1b" * 10,
    ]
    rows = pii.find_pii(frame(spark, [(i, t, "a") for i, t in enumerate(texts)])).orderBy("doc_id").collect()
    assert [[s.kind for s in r.pii] for r in rows] == [["iban"], [], ["ssn"], [], ["secret"], []]


def test_redaction_replaces_spans_and_nothing_else(spark):
    texts = ["🙂 a@b.co and 10.0.0.1!", "call 4111111111111111 now", "clean", "", None]
    redacted = pii.redact(pii.find_pii(frame(spark, [(i, t, "a") for i, t in enumerate(texts)]))).orderBy("doc_id")
    assert [r.text for r in redacted.collect()] == ["🙂 [EMAIL] and [IP]!", "call [CARD] now", "clean", "", None]


def test_account_numbers_end_where_their_country_says(spark):
    texts = [
        "BE68539007547034 BIC",
        "to BE68 5390 0754 7034 EUR 500",
        "ES91 2100 0418 4502 0005 1332 12 May",
        "GB82WEST12345698765432.",
        "BE68 5390 0754 7035 wrong sum",
        "ZZ68 5390 0754 7034 no such country",
    ]
    found = pii.find_pii(frame(spark, [(i, t, "a") for i, t in enumerate(texts)])).orderBy("doc_id").collect()
    spans = [[texts[i][s.start : s.end] for s in r.pii if s.kind == "iban"] for i, r in enumerate(found)]
    want = ["BE68539007547034", "BE68 5390 0754 7034", "ES91 2100 0418 4502 0005 1332", "GB82WEST12345698765432"]
    assert spans == [*([w] for w in want), [], []]


def _token_sets(rng, count):
    """Sets of numbers made of shared passages, near copies, and numbers of their own."""
    passages = [rng.sample(range(10**6), rng.randrange(2, 60)) for _ in range(6)]
    sets = []
    for _ in range(count):
        if sets and rng.random() < 0.5:
            base = set(rng.choice(sets))
            for x in rng.sample(sorted(base), min(len(base) - 1, rng.randrange(0, 1 + len(base) // 8))):
                base.discard(x)
            base |= {rng.randrange(10**6) for _ in range(rng.randrange(0, 1 + len(base) // 10))}
        else:
            base = {x for p in rng.sample(passages, rng.randrange(0, 4)) for x in p}
            base |= {rng.randrange(3000) for _ in range(rng.randrange(1, 60))}
        sets.append(frozenset(base))
    return list(set(sets))


@pytest.mark.parametrize(("seed", "limits"), [(1, (16, 256)), (2, (1, 3)), (3, (0, 0)), (4, (2, 8))])
def test_similar_sets_meet_at_a_key_that_lets_them(monkeypatch, seed, limits):
    monkeypatch.setattr(ngram_join, "FREQUENT", limits[0])
    monkeypatch.setattr(ngram_join, "VERY_FREQUENT", limits[1])
    sets = _token_sets(random.Random(seed), 220)
    holders = {}
    for i, members in enumerate(sets):
        for x in members:
            holders.setdefault(x, []).append(i)
    names = {}
    token = {x: names.setdefault(tuple(h), len(names) + 1) for x, h in holders.items() if len(h) > 1}
    often = {names[tuple(h)]: len(h) for h in holders.values() if len(h) > 1}
    indexed = []
    for members in sets:
        n = len(members)
        weights = Counter(token[x] for x in members if x in token)
        order = sorted(weights, key=lambda t: (often[t], t))
        columns = [np.array(c, dtype=t) for c, t in ((order, np.uint64), ([weights[t] for t in order], int), ([often[t] for t in order], int))]
        keys = {}
        for bucket in range(ngram_join._bucket(int(ngram_join.required_overlap(n))), ngram_join._bucket(n) + 1):
            found = ngram_join.index_keys(*columns, n, bucket)
            keys |= {k: (a, r) for k, a, r in zip(*(c.tolist() for c in found[:3]), strict=True)}
        indexed.append((n, sum(weights.values()), keys))
    linked = 0
    for i, (n, shared, keys) in enumerate(indexed):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if 100 * common >= 80 * (n + len(sets[j]) - common):
                m, other, theirs = indexed[j]
                linked += 1

                def most(k):
                    return min(shared, other, min(keys[k][0], theirs[k][0]) + min(keys[k][1], theirs[k][1]))

                assert any(100 * most(k) >= 80 * (n + m - most(k)) for k in keys.keys() & theirs.keys())
    assert linked > 100
