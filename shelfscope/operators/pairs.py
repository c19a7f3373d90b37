"""Sellers against a list of items: all pairs, and the pairs not stocked.

The answer to "which top items does each seller lack" is close to sellers x
items rows, so the work is arranged for those rows to exist only at the very
end. Every item gets a small number, its slot, and the catalog is reduced to
bitmaps: 64 slots are one long integer, or-ed together inside the map tasks. Per
seller, words that it holds nothing of are added as zeros, and the open bits of
every word are expanded in the task that emits the pairs. Nothing of size
sellers x items is shuffled or compared, and there is no cross join.

One plan serves lists of any length. Slots are numbered inside chunks, so no
numbering task grows with the list and no bitmap exceeds a chunk. The expansion
looks items up in a broadcast of counted size: a list of up to ``PART_ROWS`` rows
is one part, a longer one several, each expanded by the same plan.

Who only wants to know how much each seller lacks, and what first, needs no pairs at all:
``missing_counts`` works on what sellers hold, which is no more than the catalog.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..staging import Staged, stage
from .ranking import first_per_group

#: Rows of the list in a chunk, on average.
CHUNK_ITEMS = 16_384
#: Rows of the list that are broadcast at once.
PART_ROWS = 1_000_000
ROWS_PER_TASK = 1_000_000
#: Slots in a word of a bitmap.
WORD = 64


@dataclass(frozen=True)
class SlottedItems:
    """A written item list with ``chunk`` and ``slot`` columns, and the chunks of each part with their rows."""

    frame: DataFrame
    rows: int
    parts: tuple[tuple[tuple[int, ...], int], ...]

    @property
    def slots(self) -> DataFrame:
        return self.frame.select("item_id", "chunk", "slot").distinct()


def _packed(sizes: list[tuple[int, int]]) -> tuple[tuple[tuple[int, ...], int], ...]:
    """Chunks in groups of at most ``PART_ROWS`` rows; a larger chunk is a part of its own."""
    parts: list[tuple[tuple[int, ...], int]] = []
    for chunk, rows in sorted(sizes):
        if parts and parts[-1][1] + rows <= PART_ROWS:
            parts[-1] = ((*parts[-1][0], chunk), parts[-1][1] + rows)
        else:
            parts.append(((chunk,), rows))
    return tuple(parts)


def assign_slots(items: Staged) -> SlottedItems:
    """Number the distinct items 0, 1, ... inside each chunk."""
    chunks = max(1, math.ceil(items.rows / CHUNK_ITEMS))
    chunk = F.pmod(F.xxhash64("item_id"), F.lit(chunks)).cast("int")
    numbered = items.frame.withColumn("chunk", chunk).withColumn(
        "slot", F.dense_rank().over(Window.partitionBy("chunk").orderBy("item_id")) - 1
    )
    parts = ((tuple(range(chunks)), items.rows),)
    if items.rows > PART_ROWS:
        # One row per chunk: a number for every CHUNK_ITEMS rows of the list.
        parts = _packed([tuple(row) for row in items.frame.groupBy(chunk.alias("chunk")).count().collect()])
    return SlottedItems(numbered, items.rows, parts)


def stocked_slots(seller_catalog: DataFrame, items: SlottedItems) -> Staged:
    """Bitmap words held per seller; a seller holding nothing keeps one row without a word.

    One pass over two catalog columns. Bits merge in the map tasks, so neither a
    seller nor an item that fills the catalog makes a large group.
    """
    matched = seller_catalog.select("seller_id", "item_id").join(items.slots, "item_id", "left")
    word, bit = F.expr(f"int(slot div {WORD})"), F.expr(f"shiftleft(1L, slot % {WORD})")
    held = matched.groupBy("seller_id", "chunk", word.alias("word")).agg(F.bit_or(bit).alias("mask"))
    return stage(held, "stock", sellers=F.approx_count_distinct("seller_id"))


def stocked_by_any(stock: Staged) -> DataFrame:
    """``(chunk, slot)`` of every seller that holds it, a NULL seller included."""
    bits = stock.frame.filter("mask IS NOT NULL").withColumn("bit", F.explode(F.sequence(F.lit(0), F.lit(WORD - 1))))
    held = bits.filter(F.getbit("mask", F.col("bit")) == 1)
    return held.select("seller_id", "chunk", (F.col("word") * WORD + F.col("bit")).alias("slot"))


def seller_counts(stock: Staged) -> DataFrame:
    """Distinct sellers per slot, from the already reduced stock."""
    named = stocked_by_any(stock).filter("seller_id IS NOT NULL")
    return named.groupBy("chunk", "slot").agg(F.count(F.lit(1)).alias("company_seller_count"))


def _open_slots(held: DataFrame, listed: DataFrame, chunks: tuple[int, ...], tasks: int) -> DataFrame:
    """``(seller_id, chunk, slot)`` for every slot of these chunks that a seller does not hold.

    A NULL seller holds nothing, as it equals no seller.
    Spread over ``tasks`` range partitions of ``seller_id`` before the explode:
    the partitions are sized by what they will produce, not by what goes in.
    """
    wanted = F.explode(F.lit(list(chunks))).alias("chunk")
    cells = held.select("seller_id").distinct().select("seller_id", wanted, F.lit(None).cast("int").alias("word"))
    words = held.filter("mask IS NOT NULL AND seller_id IS NOT NULL")
    per_cell = (
        words.filter(F.col("chunk").isin(*chunks))
        .unionByName(cells.withColumn("mask", F.lit(None).cast("bigint")))
        .groupBy("seller_id", "chunk")
        .agg(F.collect_list(F.when(F.col("mask").isNotNull(), F.struct("word", "mask"))).alias("held"))
        .repartitionByRange(tasks, "seller_id")
    )
    # One row per chunk of the part.
    sizes = listed.groupBy("chunk").agg((F.max("slot") + 1).alias("n_slots"))
    every = F.sequence(F.lit(0), F.expr(f"int((n_slots - 1) div {WORD})"))
    blank = F.transform(
        F.array_except(every, F.transform("held", lambda h: h["word"])),
        lambda w: F.struct(w.alias("word"), F.lit(0).cast("bigint").alias("mask")),
    )
    first, last = F.col("word") * WORD, F.least(F.col("word") * WORD + WORD - 1, F.col("n_slots") - 1)
    return (
        per_cell.join(F.broadcast(sizes), "chunk")
        .select("seller_id", "chunk", "n_slots", F.inline(F.concat("held", blank)))
        .select("seller_id", "chunk", "mask", F.explode(F.sequence(first, last)).alias("slot"))
        .filter(F.getbit("mask", F.col("slot") % WORD) == 0)
        .drop("mask")
    )


def expand_open_slots(stock: Staged, items: SlottedItems, described: DataFrame) -> DataFrame:
    """``seller_id`` with every row of ``described`` whose slot the seller lacks.

    ``described`` is the item list with any columns added. The result stays
    range-partitioned by ``seller_id``, part by part.
    """

    def expand(chunks: tuple[int, ...], rows: int) -> DataFrame:
        tasks = max(1, math.ceil(stock.figures["sellers"] * rows / ROWS_PER_TASK))
        whole = len(items.parts) == 1
        listed = described if whole else described.filter(F.col("chunk").isin(*chunks))
        open_slots = _open_slots(stock.frame, items.frame if whole else items.frame.filter(F.col("chunk").isin(*chunks)), chunks, tasks)
        # A chunk beyond the bound (one item with very many descriptions) is left to Catalyst.
        small = F.broadcast(listed) if rows <= PART_ROWS else listed
        return open_slots.join(small, ["chunk", "slot"]).drop("chunk", "slot")

    return reduce(DataFrame.unionByName, [expand(*part) for part in items.parts])


def missing_items(seller_catalog: DataFrame, items: DataFrame) -> DataFrame:
    """Every seller with every row of ``items`` whose ``item_id`` it does not stock."""
    slotted = assign_slots(stage(items, "items"))
    return expand_open_slots(stocked_slots(seller_catalog, slotted), slotted, slotted.frame)


def seller_item_pairs(seller_catalog: DataFrame, items: DataFrame) -> DataFrame:
    """Every seller with every row of ``items``, stocked or not."""
    slotted = assign_slots(stage(items, "items"))
    nothing = {"chunk": "int", "word": "int", "mask": "bigint"}
    sellers = seller_catalog.select("seller_id", *(F.lit(None).cast(t).alias(n) for n, t in nothing.items())).distinct()
    stock = stage(sellers, "sellers", sellers=F.approx_count_distinct("seller_id"))
    return expand_open_slots(stock, slotted, slotted.frame)


def missing_counts(seller_catalog: DataFrame, items: DataFrame) -> DataFrame:
    """Of the rows of :func:`missing_items` per seller: their number, their distinct items and the least item.

    No pair of a seller and an item that it lacks is made. The counts are the list's less what
    the seller holds. Items have places in the order of their ids; the least that is lacking
    follows a held place or is the first, and it comes at most one place after as many as the
    seller holds, so only held places up to that number are looked at. Sellers that lack
    nothing have no row.
    """
    per_item = items.groupBy("item_id").agg(F.count(F.lit(1)).alias("rows"))
    listed = stage(per_item, "list", total=F.coalesce(F.sum("rows"), F.lit(0)), named=F.count("item_id"))
    named = listed.figures["named"]
    ranked = first_per_group(listed.frame.filter("item_id IS NOT NULL"), [], ["item_id"], named, "place")
    places = stage(ranked.withColumn("place", F.col("place").cast("bigint")), "places").frame
    # A NULL seller holds nothing, as it equals no seller; all sellers keep a row.
    pairs = seller_catalog.select("seller_id", "item_id").distinct().join(places, "item_id", "left")
    known = F.col("seller_id").isNotNull()
    held = stage(pairs.select("seller_id", *(F.when(known, F.col(c)).alias(c) for c in ("place", "rows"))), "held").frame
    counts = held.groupBy("seller_id").agg(
        (F.lit(listed.figures["total"]) - F.coalesce(F.sum("rows"), F.lit(0))).alias("variants"),
        F.count("place").alias("n_held"),
    )
    counts = stage(counts, "held-counts").frame
    near = held.join(counts.select("seller_id", "n_held"), "seller_id").filter("place <= n_held")
    near = stage(near.select("seller_id", "place"), "near").frame
    followers = near.select("seller_id", (F.col("place") + 1).alias("place"))
    candidates = counts.withColumn("place", F.lit(1).cast("bigint")).unionByName(followers, allowMissingColumns=True)
    lacking = candidates.join(near.withColumn("taken", F.lit(True)), ["seller_id", "place"], "left")
    per_seller = lacking.groupBy("seller_id").agg(
        F.max("variants").alias("variants"),
        (F.lit(named) - F.max("n_held")).alias("items"),
        F.min(F.when(F.col("taken").isNull(), F.col("place"))).alias("place"),
    )
    first = places.select("place", F.col("item_id").alias("first_item"))
    return per_seller.filter("variants > 0").join(first, "place", "left").select("seller_id", "variants", "items", "first_item")
