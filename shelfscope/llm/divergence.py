"""Divergence of sources: which sources of a language differ, and by which terms.

Every group (language, source) and every language gives each kept term a share of a
billion, smoothed by one occurrence: p = 1 + floor(10^9 * (count + 1) / (N + V)). The
divergence of p from q is the sum of floor((p - q)^2 / q) over all kept terms. All
arithmetic is on whole numbers.

Pairs of groups are compared in a three-dimensional cube. A task owns one (block of
groups, block of groups, block of terms) cell of a language: both blocks' slices of terms
are sent to it, it adds up a partial divergence for each of its pairs, and the partial
sums are reduced along the axis of terms. A term that neither group has adds the same for
all terms, so slices stay sparse: a cell adds what its terms differ from that constant.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..staging import Workspace, stage

#: A term is kept by a language that has it in so many documents.
LEAST_DOCUMENTS = 3
#: Terms reported per group.
TOP_TERMS = 200
#: Shares are parts of this.
WHOLE = 1_000_000_000
#: Groups in a block, and entries (terms of groups) a cell is to hold of each side.
GROUP_BLOCK, CELL_ENTRIES = 64, 16_384
#: Terms of a cell that are compared at once.
CHUNK_TERMS = 4096
#: Bytes of a text that are split at once, and counts held before they are passed on.
PIECE_BYTES, HELD_COUNTS = 1 << 20, 250_000

#: A maximal run of letters A-Z and characters beyond ASCII, in UTF-8 bytes.
_TERM = re.compile(rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
_BREAK = re.compile(rb"[\x00-\x40\x5B-\x60\x7B-\x7F]")
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))

PARTIAL = "lang string, source string, term binary, n long, docs long"


def _pieces(text: bytes) -> Iterator[bytes]:
    """The text in pieces of bounded size (or one term), cut where no term is."""
    at = 0
    while at < len(text):
        end = at + PIECE_BYTES
        cut = _BREAK.search(text, end) if end < len(text) else None
        end = cut.start() if cut else len(text)
        yield text[at:end]
        at = end


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of ``PARTIAL``: occurrences and documents of each term, summed up as far as memory allows."""
    counts: dict[tuple, tuple[Counter, Counter]] = {}
    held = 0

    def flush() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in counts.items():
            if n:
                size = len(n)
                columns = [
                    pa.array([lang] * size, pa.string()),
                    pa.array([source] * size, pa.string()),
                    pa.array(list(n), pa.binary()),
                    pa.array(list(n.values()), pa.int64()),
                    pa.array([docs[t] for t in n], pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "source", "term", "n", "docs"])
        counts.clear()

    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("lang", "source", "text"))
        for lang, source, text in zip(*columns, strict=True):
            n, docs = counts.setdefault((lang, source), (Counter(), Counter()))
            before, seen = len(n), set()
            for piece in _pieces(text.translate(_LOWER)):
                terms = _TERM.findall(piece)
                n.update(terms)
                seen.update(terms)
            docs.update(seen)
            held += len(n) - before
            if held >= HELD_COUNTS:
                yield from flush()
                held = 0
    yield from flush()


def _share(count: Column, total: Column) -> Column:
    """1 + floor(WHOLE * (count + 1) / total), exact for any counts of 64 bits."""
    wide = (F.coalesce(count, F.lit(0)) + 1).cast("decimal(19,0)") * F.lit(WHOLE).cast("decimal(10,0)")
    return (1 + F.call_function("div", wide, total.cast("decimal(19,0)"))).cast("bigint")


def divergence(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q).cast("bigint")


def _slice(table: pa.Table, term_codes: np.ndarray, n_terms: int) -> tuple[list, np.ndarray, np.ndarray]:
    """Names, constant shares and the matrix of shares (groups x terms) of one block's slice."""
    coded = pa.chunked_array(table.column("source").chunks, pa.string()).combine_chunks().dictionary_encode()
    coded = coded.combine_chunks() if isinstance(coded, pa.ChunkedArray) else coded
    group = coded.indices.to_numpy()
    names = coded.dictionary.to_pylist()
    absent = np.zeros(len(names), dtype=np.int64)
    absent[group] = table.column("absent").to_numpy()
    shares = np.repeat(absent[:, None], n_terms, axis=1)
    has = term_codes >= 0
    shares[group[has], term_codes[has]] = table.column("p").to_numpy(zero_copy_only=False)[has].astype(np.int64)
    return names, absent, shares


def _cell(key, left: pa.Table, right: pa.Table) -> pa.Table:
    """(lang, source, other, part): for each pair, what the cell's terms add beyond the constant."""
    out = {"lang": [], "source": [], "other": [], "part": []}
    if left.num_rows and right.num_rows:
        both = pa.chunked_array([*left.column("term").chunks, *right.column("term").chunks], pa.binary()).combine_chunks()
        both = both.combine_chunks() if isinstance(both, pa.ChunkedArray) else both
        coded = both.dictionary_encode()
        codes = coded.indices.fill_null(-1).to_numpy(zero_copy_only=False)
        n_terms = len(coded.dictionary)
        names, absent, p = _slice(left, codes[: left.num_rows], n_terms)
        others, other_absent, q = _slice(right, codes[left.num_rows :], n_terms)
        sums = np.zeros((len(names), len(others)), dtype=np.int64)
        for at in range(0, n_terms, CHUNK_TERMS):
            q_part = q[:, at : at + CHUNK_TERMS]
            for i in range(len(names)):
                apart = p[i, at : at + CHUNK_TERMS] - q_part
                sums[i] += (apart * apart // q_part).sum(axis=1)
        constant = absent[:, None] - other_absent[None, :]
        sums -= n_terms * (constant * constant // other_absent[None, :])
        for i, name in enumerate(names):
            out["lang"] += [key[0].as_py()] * len(others)
            out["source"] += [name] * len(others)
            out["other"] += others
        out["part"] = sums.ravel().tolist()
    kinds = {"lang": pa.string(), "source": pa.string(), "other": pa.string(), "part": pa.int64()}
    return pa.table({name: pa.array(values, kinds[name]) for name, values in out.items()})


def _pairs(entries: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, other, value) for every ordered pair of different groups of a language."""
    block = F.pmod(F.xxhash64(F.lit("group"), "source"), F.col("group_blocks")).cast("int")
    term_block = F.pmod(F.xxhash64(F.lit("term"), "term"), F.col("term_blocks")).cast("int")
    known = groups.withColumn("own", block)
    # Every cell knows its groups, also those that have none of its terms.
    heads = known.select(
        "lang", "source", "own", "group_blocks", "absent", F.lit(None).cast("binary").alias("term"), F.lit(None).cast("bigint").alias("p"),
        F.explode(F.sequence(F.lit(0), F.col("term_blocks") - 1)).alias("at"),
    )
    slices = heads.unionByName(
        entries.select("lang", "source", block.alias("own"), "group_blocks", "absent", "term", "p", term_block.alias("at"))
    )
    every = F.explode(F.sequence(F.lit(0), F.col("group_blocks") - 1))
    columns = ["lang", "source", "absent", "term", "p", "at"]
    left = slices.select(*columns, F.col("own").alias("i"), every.alias("j"))
    right = slices.select(*columns, F.col("own").alias("j"), every.alias("i"))
    cell = ["lang", "i", "j", "at"]
    partial = left.groupBy(*cell).cogroup(right.groupBy(*cell)).applyInArrow(_cell, "lang string, source string, other string, part long")
    summed = partial.filter("source != other").groupBy("lang", "source", "other").agg(F.sum("part").alias("part"))
    own = groups.select("lang", "source", F.col("absent").alias("p0"), "kept_terms")
    other = groups.select("lang", F.col("source").alias("other"), F.col("absent").alias("q0"))
    based = summed.join(own, ["lang", "source"]).join(other, ["lang", "other"])
    value = F.col("part") + F.col("kept_terms") * divergence(F.col("p0"), F.col("q0"))
    return based.select("lang", "source", "other", value.alias("value"))


def audit_sources(docs: DataFrame) -> DataFrame:
    """(lang, source, part, item, value, rank): the audit of the sources of every language.

    Reads text, lang and source; a null is the empty string. Part ``pair`` has, for each
    group, every other source of its language by divergence from it; part ``term`` the terms
    the group has more of than its language, the first ``TOP_TERMS`` by divergence. Ties go
    to the item that is smaller in UTF-8. A language without kept terms has pairs of value 0;
    an empty table gives nothing. Repeated rows count each; other columns don't matter.

    Texts are counted where they are read, so a source or a word that a third of all rows
    hold reaches the shuffle as a few counts per task. Shares of tables of terms are joined
    from staged tables, which are broadcast only if their real size is small.
    """
    with Workspace(docs.sparkSession, "divergence") as space:
        plain = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))
        counted = plain.withColumn("text", F.col("text").cast("binary")).mapInArrow(_count, PARTIAL)
        counts = counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
        same = Window.partitionBy("lang", "term")
        weighed = counts.select(
            "lang", "source", "term", "n",
            F.sum("n").over(same).alias("lang_n"),
            F.sum("docs").over(same).alias("lang_docs"),
            (F.row_number().over(same.orderBy("source")) == 1).alias("first"),
        )
        kept = space.stage(weighed.filter(F.col("lang_docs") >= LEAST_DOCUMENTS).drop("lang_docs"), "kept").frame

        totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("n"), F.count_if("first").alias("terms"), F.count("term").alias("entries"))
        listed = plain.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").fillna(0)
        listed = space.stage(listed, "groups").frame
        langs = listed.groupBy("lang").agg(
            F.sum("n").alias("lang_total"),
            F.sum("terms").alias("kept_terms"),
            F.ceil(F.count(F.lit(1)) / GROUP_BLOCK).cast("int").alias("group_blocks"),
            F.greatest(F.lit(1), F.ceil(F.sum("entries") / CELL_ENTRIES)).cast("int").alias("term_blocks"),
        )
        langs = space.stage(langs, "langs").frame
        size = F.greatest(F.lit(1), F.col("n") + F.col("kept_terms"))
        groups = listed.join(langs, "lang").select(
            "lang", "source", size.alias("size"), _share(F.lit(0), size).alias("absent"), "lang_total", "kept_terms", "group_blocks", "term_blocks"
        )
        groups = space.stage(groups, "sized").frame
        shares = kept.drop("first").join(groups, ["lang", "source"])
        entries = space.stage(
            shares.select(
                "lang", "source", "term", "group_blocks", "term_blocks", "absent",
                _share(F.col("n"), F.col("size")).alias("p"),
                _share(F.col("lang_n"), F.col("lang_total") + F.col("kept_terms")).alias("q"),
            ),
            "entries",
        ).frame

        terms = entries.filter("p > q").select("lang", "source", "term", divergence(F.col("p"), F.col("q")).alias("value"))
        top = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "term")
        terms = terms.withColumn("rank", F.row_number().over(top)).filter(F.col("rank") <= TOP_TERMS)
        by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "other")
        pairs = _pairs(entries.drop("q"), groups).withColumn("rank", F.row_number().over(by_value))

        def part(frame: DataFrame, name: str, item: str) -> DataFrame:
            return frame.select("lang", "source", F.lit(name).alias("part"), F.col(item).cast("string").alias("item"), "value", "rank")

        return stage(part(pairs, "pair", "other").unionByName(part(terms, "term", "term")), "divergence").frame
