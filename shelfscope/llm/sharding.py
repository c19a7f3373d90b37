"""Sharding by sampled splitters into shards of near equal bytes.

Records are ordered by a hash of their text and then by id, so copies of a text are
neighbours and stay together as far as sizes allow, while a text that makes up a
third of all rows can still be cut between two of its copies. Splitters are
quantiles of a sample in which a record's chance is proportional to its size. They
cut the order into ranges, several per shard; a range that turns out overfull is
subdivided by a denser sample of its own. Exact range sums then place every record at
its byte offset, and the offset names the shard.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..staging import Workspace
from .frames import long_array, with_own, without

#: Ranges per shard, sampled records per range, and when a range counts as overfull.
RANGES_PER_SHARD = 32
SAMPLES_PER_RANGE = 8
OVERFULL = 2.0
MAX_ROUNDS = 6

Key = tuple[int, int]


@dataclass(frozen=True)
class ShardPlan:
    """Splitters in ascending order and the exact sums before each range; bounded by the parameters."""

    shards: int
    total: int
    splitters: tuple[Key, ...]
    bytes_before: tuple[int, ...] = (0,)
    rows_before: tuple[int, ...] = (0,)
    first_row: tuple[int, ...] = ()

    def range_of(self, high: Column, low: Column) -> Column:
        """How many splitters are not above a key: binary search in two literal arrays."""
        count = len(self.splitters)
        if not count:
            return F.lit(0)
        highs = long_array(h for h, _ in self.splitters)
        lows = long_array(x for _, x in self.splitters)

        def narrow(state: Column, _: Column) -> Column:
            middle = F.floor((state["low"] + state["high"]) / 2).cast("int")
            at_high, at_low = F.get(highs, middle), F.get(lows, middle)
            right = (at_high < high) | ((at_high == high) & (at_low <= low))
            done = state["low"] >= state["high"]
            return F.struct(
                F.when(~done & right, middle + 1).otherwise(state["low"]).alias("low"),
                F.when(~done & ~right, middle).otherwise(state["high"]).alias("high"),
            )

        steps = F.sequence(F.lit(1), F.lit(count.bit_length()))
        start = F.struct(F.lit(0).alias("low"), F.lit(count).alias("high"))
        return F.aggregate(steps, start, narrow, lambda state: state["low"])


def _keyed(df: DataFrame, text: str, key: str) -> DataFrame:
    size = F.coalesce(F.octet_length(F.col(f"`{text}`")), F.lit(0)).cast("bigint") + 8
    return with_own(
        df,
        {
            "size": size,
            "_shard_high": F.xxhash64(F.col(f"`{text}`")),
            "_shard_low": F.coalesce(F.col(f"`{key}`").cast("bigint"), F.lit(-(2**63))),
        },
    )


def _in_shards(df: DataFrame, plan: ShardPlan) -> DataFrame:
    """Adds the shard and ``_shard_row``, the place in the whole order."""
    ranged = df.withColumn("_shard_range", plan.range_of(F.col("_shard_high"), F.col("_shard_low")))
    order = Window.partitionBy("_shard_range").orderBy("_shard_high", "_shard_low")
    until = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    number = F.row_number().over(order)
    placed = ranged.withColumns({"_shard_until": until, "_shard_number": number})
    before = F.get(long_array(plan.bytes_before), F.col("_shard_range")) + F.col("_shard_until") - F.col("size")
    row = F.get(long_array(plan.rows_before), F.col("_shard_range")) + F.col("_shard_number") - 1
    # The middle of a record decides, in whole numbers.
    placed = placed.withColumns({"_shard_middle": 2 * before + F.col("size"), "_shard_row": row})
    shard = F.expr(f"_shard_middle * {plan.shards} div {2 * max(1, plan.total)}")
    return placed.withColumn("shard", F.least(shard, F.lit(plan.shards - 1)).cast("int"))


def _sampled(keys: DataFrame, chance: Column, weight: Column, seed: int) -> list[tuple[Key, float]]:
    uniform = F.shiftrightunsigned(F.xxhash64("_shard_high", "_shard_low", F.lit(seed)), 11).cast("double") / float(2**53)
    drawn = keys.filter(uniform < chance).select("_shard_high", "_shard_low", weight.cast("double").alias("w"))
    return sorted(((r[0], r[1]), r[2]) for r in drawn.collect())


def _quantiles(sample: list[tuple[Key, float]], pieces: int) -> list[Key]:
    """Keys at which the running weight passes each of the inner quantiles."""
    sums = list(accumulate(w for _, w in sample))
    cuts, wanted = [], 1
    for (key, _), reached in zip(sample, sums, strict=True):
        while wanted < pieces and reached >= sums[-1] * wanted / pieces:
            cuts.append(key)
            wanted += 1
    return sorted(set(cuts))


def plan_shards(keys: DataFrame, shards: int, total: int) -> ShardPlan:
    """Splitters, range sums and shard starts for staged rows of keys and sizes."""
    ranges = shards * RANGES_PER_SHARD
    wanted = ranges * SAMPLES_PER_RANGE
    share = max(1.0, total / wanted)
    sample = _sampled(keys, F.col("size") / F.lit(share), F.greatest(F.col("size"), F.lit(share)), 1)
    plan = ShardPlan(shards, total, tuple(_quantiles(sample, ranges)))
    for turn in range(MAX_ROUNDS):
        ranged = keys.withColumn("_shard_range", plan.range_of(F.col("_shard_high"), F.col("_shard_low")))
        sums = {
            r[0]: (r[1], r[2])
            for r in ranged.groupBy("_shard_range").agg(F.sum("size"), F.count(F.lit(1))).collect()
        }
        limit = OVERFULL * total / ranges
        over = {r: -(-b * ranges // total) for r, (b, n) in sums.items() if b > limit and n > 1}
        if turn + 1 == MAX_ROUNDS or not over:
            break
        chances = [over[r] * SAMPLES_PER_RANGE * 2 / sums[r][0] if r in over else 0.0 for r in range(len(plan.splitters) + 1)]
        rate = F.get(F.split(F.lit(",".join(map(repr, chances))), ",").cast("array<double>"), F.col("_shard_range"))
        found = _sampled(ranged, F.col("size") * rate, F.greatest(F.col("size"), 1 / F.nullif(rate, F.lit(0.0))), turn + 2)
        added = set(plan.splitters)
        for r, pieces in over.items():
            low = plan.splitters[r - 1] if r else None
            high = plan.splitters[r] if r < len(plan.splitters) else None
            own = [(k, w) for k, w in found if (low is None or k >= low) and (high is None or k < high)]
            added.update(_quantiles(own, int(pieces)) if own else ())
        if len(added) == len(plan.splitters):
            break
        plan = ShardPlan(shards, total, tuple(sorted(added)))
    order = range(len(plan.splitters) + 1)
    bytes_before = (0, *accumulate(sums.get(r, (0, 0))[0] for r in order))
    rows_before = (0, *accumulate(sums.get(r, (0, 0))[1] for r in order))
    plan = ShardPlan(shards, total, plan.splitters, bytes_before, rows_before)
    starts = {r[0]: r[1] for r in _in_shards(keys, plan).groupBy("shard").agg(F.min("_shard_row")).collect()}
    return ShardPlan(shards, total, plan.splitters, bytes_before, rows_before, tuple(starts.get(s, 0) for s in range(shards)))


def shard_by_splitters(docs: DataFrame, shards: int, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``docs`` with ``size``, ``shard`` (from 0) and ``slot``, the gapless place in it.

    The size is the text's UTF-8 bytes (null: none) plus 8. Two shards differ by at most
    the size of the records at their ends. Rows equal in text and id are interchangeable
    and share their slots in any order. An empty table gives no rows; columns of the same
    names are replaced.

    Planning reads keys and sizes from a staged table of a few bytes per row, which is
    dropped; the records themselves are shuffled once, by range.
    """
    if shards < 1:
        raise ValueError("there is at least one shard")
    with Workspace(docs.sparkSession, "shards") as space:
        keys = _keyed(docs.select(F.col(f"`{text}`"), F.col(f"`{key}`")), text, key)
        staged = space.stage(keys.select("size", "_shard_high", "_shard_low"), "keys", total=F.sum("size"))
        plan = plan_shards(staged.frame, shards, staged.figures["total"] or 0)
    rest = without(docs, ["shard", "slot"])
    placed = _in_shards(_keyed(rest, text, key), plan)
    slot = F.col("_shard_row") - F.get(long_array(plan.first_row), F.col("shard"))
    own = [c for c in placed.columns if c.startswith("_shard_")]
    return with_own(placed, {"slot": slot}).drop(*own)
