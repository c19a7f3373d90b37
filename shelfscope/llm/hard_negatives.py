"""Hard negatives by segment summaries: bounds first, refined step by step, then exact scores.

A vector is cut into segments. For each the mean and the deviation (the norm of what is
left when the mean is taken off) are stored. Over a segment of length L the product of a
and v is L * mean(a) * mean(v) give or take dev(a) * dev(v); the sum over all segments
bounds the score. One segment gives the loosest bounds, more give tighter ones: each level
drops the pairs that cannot be in the answer, and only what all levels leave is scored.

The summaries are stored beside the vectors. The anchors are a stated query set against
all rows. Both are dealt into blocks of bounded size, by row number, and a task owns one
block of anchors and one of rows; what it finds for an anchor is merged by a ranking that
keeps the first few inside every task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..staging import Staged, Workspace, stage

#: Rows and anchors in a task's block: what it holds at once is bounded by their product.
ROW_BLOCK, ANCHOR_BLOCK = 4096, 1024
#: Anchors whose bounds are computed at once within a task.
CHUNK = 128
#: Segments of a vector at each level; a level with segments of under two components is left out.
LEVELS = (1, 4, 16)
#: Integer products up to here are exact as doubles, up to the next as longs.
EXACT_DOUBLE, EXACT_LONG = 2**53, 2**63 - 1


@dataclass(frozen=True)
class Mining:
    """What to mine: positives per anchor, negatives per positive, and their share of its score in percent."""

    positives: int = 5
    negatives: int = 10
    least_percent: int = 30
    most_percent: int = 90
    scale: int = 256


def _levels(width: int) -> list[int]:
    return [s for s in LEVELS if s == 1 or width >= 2 * s] if width else []


def _cuts(width: int, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """Where segments begin, and their lengths."""
    cuts = np.arange(segments) * width // segments
    return cuts, np.diff(np.append(cuts, width))


def summaries(v: np.ndarray) -> np.ndarray:
    """Means and deviations of the segments of every row, level after level."""
    parts = [np.empty((len(v), 0))]
    for segments in _levels(v.shape[1]):
        cuts, lengths = _cuts(v.shape[1], segments)
        mean = np.add.reduceat(v, cuts, axis=1) / lengths
        left = v - np.repeat(mean, lengths, axis=1)
        parts += [mean, np.sqrt(np.add.reduceat(left * left, cuts, axis=1))]
    return np.concatenate(parts, axis=1)


def _with_summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each batch with its ``summary``, computed for all vectors of one length at once."""
    for batch in batches:
        vectors = batch.column("q")
        widths = np.diff(np.asarray(vectors.offsets))
        found: list = [None] * batch.num_rows
        for width in np.unique(widths).tolist():
            chosen = np.flatnonzero(widths == width)
            flat = vectors.take(pa.array(chosen)).flatten().to_numpy(zero_copy_only=False)
            for i, summary in zip(chosen.tolist(), summaries(flat.reshape(len(chosen), width).astype(np.float64)), strict=True):
                found[i] = summary
        columns = [*batch.columns, pa.array(found, pa.list_(pa.float64()))]
        yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "summary"])


def quantized(vectors: DataFrame, scale: int) -> DataFrame:
    """(row, vec_id, label, asks, q, summary): floor(scale * x) of the rows that take part, and their segments' summaries.

    Rows with a null label or vector, or a null or non-finite component, take no part.
    """
    plain = vectors.withColumn("v", F.col("embedding").cast("array<double>")).drop("embedding")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    sound = plain.filter(F.col("label").isNotNull() & F.col("v").isNotNull() & F.coalesce(finite, F.lit(False)))
    q = F.transform("v", lambda x: F.floor(x * F.lit(float(scale)))).cast("array<bigint>")
    numbered = sound.select(F.monotonically_increasing_id().alias("row"), "vec_id", "label", "asks", q.alias("q"))
    return numbered.mapInArrow(
        _with_summaries, "row long, vec_id long, label long, asks boolean, q array<bigint>, summary array<double>"
    )


def segment_bounds(a: np.ndarray, v: np.ndarray, width: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Level by level: lower and upper bounds of all products, from the summaries; safe against rounding."""
    at = 0
    for segments in _levels(width):
        _, lengths = _cuts(width, segments)
        mean, dev = slice(at, at + segments), slice(at + segments, at + 2 * segments)
        middle, spread = (a[:, mean] * lengths) @ v[:, mean].T, a[:, dev] @ v[:, dev].T
        slack = 1e-9 * ((np.abs(a[:, mean]) * lengths) @ np.abs(v[:, mean]).T + spread) + 1e-6
        yield middle - spread - slack, middle + spread + slack
        at += 2 * segments


def _kth_largest(values: np.ndarray, k: int) -> np.ndarray:
    """The k-th largest of each row; minus infinity if it has fewer."""
    if values.shape[1] < k:
        return np.full(len(values), -np.inf)
    return -np.partition(-values, k - 1, axis=1)[:, k - 1]


def surviving(
    bounds: Iterator[tuple[np.ndarray, np.ndarray]], which: np.ndarray, allowed: np.ndarray, low: np.ndarray, high: np.ndarray, k: int
) -> np.ndarray:
    """Which pairs can be among the k best that are allowed and score from low to high; never drops one that is.

    ``which`` names the row of the bounds that each row of ``allowed`` belongs to.
    """
    alive = allowed.copy()
    for lower, upper in bounds:
        lower, upper = lower[which], upper[which]
        alive &= (upper >= low[:, None]) & (lower <= high[:, None])
        sure = alive & (lower >= low[:, None]) & (upper <= high[:, None])
        alive &= upper >= _kth_largest(np.where(sure, lower, -np.inf), k)[:, None]
        if not alive.any():
            break
    return alive


def _scorer(a: np.ndarray, v: np.ndarray):
    """Exact scores of one row of ``a`` with chosen rows of ``v``."""
    largest = [int(np.abs(x.astype(np.float64)).max(initial=1)) for x in (a, v)]
    most = largest[0] * largest[1] * max(1, a.shape[1])
    if most > EXACT_LONG:
        raise ArithmeticError("scores exceed 64 bits: use a smaller scale")
    if most <= EXACT_DOUBLE:
        a, v = a.astype(np.float64), v.astype(np.float64)
    return lambda i, rows: (v[rows] @ a[i]).astype(np.int64)


def _matrix(table: pa.Table, name: str) -> np.ndarray:
    flat = np.concatenate([np.asarray(x.flatten()) for x in table.column(name).chunks])
    return flat.reshape(table.num_rows, len(flat) // table.num_rows)


def _by_rank(table: pa.Table) -> pa.Table:
    """Rows in the order that settles ties: by id, nulls last."""
    return table.sort_by([("vec_id", "ascending"), ("row", "ascending")])


def _miner(columns: list[str], k: int, positive: bool, mining: Mining):
    """Per cell: the k best rows of each anchor (``positive``), or of each anchor and its positive."""

    def mine(key, anchors: pa.Table, rows: pa.Table) -> pa.Table:
        out: dict[str, list] = {name: [] for name in columns}
        if anchors.num_rows and rows.num_rows:
            # Pairs of one anchor side by side share its bounds; rows stand in the order of ties.
            anchors, rows = anchors.sort_by("row"), _by_rank(rows)
            a, v = _matrix(anchors, "q"), _matrix(rows, "q")
            score = _scorer(a, v)
            a_summary, v_summary = _matrix(anchors, "summary"), _matrix(rows, "summary")
            a_label, v_label = anchors.column("label").to_numpy(), rows.column("label").to_numpy()
            a_row, v_row = anchors.column("row").to_numpy(), rows.column("row").to_numpy()
            ids = rows.column("vec_id").to_pylist()
            reference = None if positive else anchors.column("positive_score").to_numpy()
            for at in range(0, len(a), CHUNK):
                part = slice(at, at + CHUNK)
                same = a_label[part, None] == v_label[None, :]
                if positive:
                    allowed = same & (a_row[part, None] != v_row[None, :])
                    low, high = np.full(len(same), -np.inf), np.full(len(same), np.inf)
                else:
                    allowed = ~same
                    # A little wider than the limits; exact integers decide below.
                    wide = 1e-9 * np.abs(reference[part].astype(np.float64)) + 1
                    low = mining.least_percent / 100 * reference[part] - wide
                    high = mining.most_percent / 100 * reference[part] + wide
                _, first, which = np.unique(a_row[part], return_index=True, return_inverse=True)
                bounds = segment_bounds(a_summary[part][first], v_summary, v.shape[1])
                alive = surviving(bounds, which, allowed, low, high, k)
                for i in np.flatnonzero(alive.any(axis=1)).tolist():
                    left = np.flatnonzero(alive[i])
                    scores = score(at + i, left)
                    if not positive:
                        own = int(reference[at + i])
                        least, most = -(-mining.least_percent * own // 100), mining.most_percent * own // 100
                        fits = (scores >= least) & (scores <= most)
                        left, scores = left[fits], scores[fits]
                    best = np.argsort(-scores, kind="stable")[:k]
                    for j in best.tolist():
                        found = {"other_row": v_row[left[j]], "other_id": ids[left[j]], "score": int(scores[j])}
                        for name in columns:
                            out[name].append(found[name] if name in found else anchors.column(name)[at + i].as_py())
        return pa.table({name: pa.array(values, pa.int64()) for name, values in out.items()})

    return mine


def _dealt(frame: DataFrame, own: str, own_blocks: int, other: str, other_blocks: int) -> DataFrame:
    """Rows with their own block, by row number, and one copy for each block of the other side."""
    block = F.pmod(F.xxhash64(F.lit(own), "row"), F.lit(own_blocks)).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.lit(other_blocks - 1)))
    return frame.withColumn(own, block).withColumn(other, every)


def _search(
    anchors: DataFrame, n_anchors: int, rows: Staged, carried: list[str], k: int, positive: bool, mining: Mining, space: Workspace
) -> DataFrame:
    """The k best of every anchor over all cells, as rows ``carried`` + other_row, other_id, score, rank."""
    anchor_blocks = max(1, math.ceil(n_anchors / ANCHOR_BLOCK))
    row_blocks = max(1, math.ceil(rows.rows / ROW_BLOCK))
    left = _dealt(anchors, "anchor_block", anchor_blocks, "row_block", row_blocks).withColumn("width", F.size("q"))
    right = _dealt(rows.frame, "row_block", row_blocks, "anchor_block", anchor_blocks).withColumn("width", F.size("q"))
    cell = ["anchor_block", "row_block", "width"]
    columns = [*carried, "other_row", "other_id", "score"]
    found = (
        left.groupBy(*cell)
        .cogroup(right.groupBy(*cell))
        .applyInArrow(_miner(columns, k, positive, mining), ", ".join(f"{name} long" for name in columns))
    )
    found = space.stage(found, "found").frame
    order = Window.partitionBy(*carried).orderBy(F.desc("score"), F.asc_nulls_last("other_id"), "other_row")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def mine_hard_negatives(
    vectors: DataFrame, is_anchor: Column, label: Column | None = None, mining: Mining | None = None
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``vectors`` has vec_id (a whole number), embedding and label; ``label`` may replace the label.
    A row with a null label or vector, or a null or non-finite component, takes no part. A
    component x is taken as floor(scale * x), a score is the integer inner product; only
    vectors of one length are compared, and scores beyond 64 bits are an error. An
    anchor's positives are its best other rows of the same label. For each, the best rows of
    other labels are returned that score between the two percentages of the positive's
    score (none if that is negative). Ties go to the smaller id, null ids last. Repeated
    rows and ids are rows of their own. Other columns don't matter; an empty table gives none.
    """
    mining = mining or Mining()
    named = F.col("label") if label is None else label
    chosen = vectors.select("vec_id", "embedding", named.cast("bigint").alias("label"), F.coalesce(is_anchor, F.lit(False)).alias("asks"))
    with Workspace(vectors.sparkSession, "mining") as space:
        rows = space.stage(quantized(chosen, mining.scale), "rows", asking=F.count_if("asks"))
        anchors = rows.frame.filter("asks")
        best = _search(anchors, rows.figures["asking"], rows, ["row"], mining.positives, True, mining, space)
        positives = best.select(
            "row", F.col("other_row").alias("positive_row"), F.col("other_id").alias("positive_id"), F.col("score").alias("positive_score")
        )
        named_anchors = anchors.withColumnRenamed("vec_id", "anchor_id")
        asked = space.stage(named_anchors.join(space.stage(positives, "positives").frame, "row"), "asked")
        carried = ["row", "anchor_id", "positive_row", "positive_id", "positive_score"]
        hard = _search(asked.frame, asked.rows, rows, carried, mining.negatives, False, mining, space)
        result = hard.select(
            "anchor_id",
            "positive_id",
            F.col("rank").cast("int").alias("rank"),
            F.col("other_id").alias("negative_id"),
            "positive_score",
            F.col("score").alias("negative_score"),
        )
        return stage(result, "hard-negatives").frame
