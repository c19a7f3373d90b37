"""Mixing sources to target weights by Poisson replication.

Each source gets a repetition rate: its share of the output's bytes over the bytes
that it has. A document is repeated as often as a Poisson variable of that mean
says, which is read off the inverse distribution at a number hashed from the seed
and the document's id: no state, no order, the same on every run. The copies are
then put into one global random order, also by hash.
"""

from __future__ import annotations

import math
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frames import double_array, with_own

#: A larger mean is split into equal parts, whose independent draws add up.
MAX_MEAN = 16.0
#: Hex digits of an md5 that a draw and an order key use: 52 and 60 bits.
DRAW_DIGITS, ORDER_DIGITS = 13, 15


@dataclass(frozen=True)
class Target:
    """Weights of the output's bytes by source.

    Sources that are not listed, null among them, share ``rest`` as one class. Weights
    of classes without documents are left out; ``scale`` is the output's size in
    multiples of the input's.
    """

    weights: Mapping[str, float]
    rest: float = 0.0
    scale: float = 1.0
    seed: int = 0

    @property
    def names(self) -> list[str]:
        return sorted(self.weights)


def text_bytes(text: Column) -> Column:
    """UTF-8 bytes, at least one: an empty or null text can be drawn as well."""
    return F.greatest(F.coalesce(F.octet_length(text), F.lit(0)), F.lit(1)).cast("bigint")


def _class(target: Target, source: Column) -> Column:
    """The number of a source's class; the rest comes last."""
    chain = F.when(F.lit(False), F.lit(0))
    for number, name in enumerate(target.names):
        chain = chain.when(source == name, F.lit(number))
    return chain.otherwise(F.lit(len(target.names)))


def repetition_rates(docs: DataFrame, target: Target, source: str = "source", text: str = "text") -> list[float]:
    """The mean number of copies by class: one figure for each listed source and one for the rest.

    The sums that reach the driver are as many as the target lists, plus one.
    """
    sizes = docs.select(_class(target, F.col(f"`{source}`")).alias("c"), text_bytes(F.col(f"`{text}`")).alias("b"))
    found = {row["c"]: row["b"] for row in sizes.groupBy("c").agg(F.sum("b").alias("b")).collect()}
    weights = [float(target.weights[name]) for name in target.names] + [float(target.rest)]
    if any(w < 0 for w in weights):
        raise ValueError("weights are not negative")
    present = math.fsum(w for c, w in enumerate(weights) if c in found)
    if not present:
        return [0.0] * len(weights)
    budget = target.scale * sum(found.values())
    return [w / present * budget / found[c] if c in found else 0.0 for c, w in enumerate(weights)]


def poisson_table(mean: float) -> list[float]:
    """P(X <= k) for k = 0, 1, ... as far as doubles below one tell them apart."""
    term = math.exp(-mean)
    sums, k = [term], 0
    while len(sums) < 400:
        k += 1
        term = term * mean / k
        sums.append(sums[-1] + term)
        if k > mean and sums[-1] == sums[-2]:
            break
    return sums


def hashed_uniform(*parts: Column) -> Column:
    """A number in [0, 1) from the md5 of the parts."""
    key = F.concat_ws(":", *(F.coalesce(p.cast("string"), F.lit("")) for p in parts))
    return F.conv(F.substring(F.md5(key), 1, DRAW_DIGITS), 16, 10).cast("bigint").cast("double") / float(16**DRAW_DIGITS)


def _copies(rate: float, seed: int, key: Column) -> Column:
    """How often a document is repeated: the inverse distribution at its hashed number."""
    if rate <= 0:
        return F.lit(0)
    parts = max(1, math.ceil(rate / MAX_MEAN))
    table = double_array(poisson_table(rate / parts))

    def inverse(draw: Column) -> Column:
        return F.size(F.filter(table, lambda p: p <= draw))

    if parts == 1:
        return inverse(hashed_uniform(F.lit(f"draw0-{seed}"), key))

    def draw(total: Column, j: Column) -> Column:
        return total + inverse(hashed_uniform(F.concat(F.lit("draw"), j.cast("string"), F.lit(f"-{seed}")), key))

    # However many draws a high rate takes, the plan holds one of them, and one table.
    return F.aggregate(F.sequence(F.lit(0), F.lit(parts - 1)), F.lit(0), draw)


def mix_sources(
    docs: DataFrame,
    target: Target,
    source: str = "source",
    text: str = "text",
    key: str = "doc_id",
    partitions: int | None = None,
) -> DataFrame:
    """``docs`` repeated to the target's weights and shuffled globally.

    Adds ``copies`` (of that document in all), ``copy`` (from 1) and ``mix_key``, the
    place in the global order; partition after partition, rows are in that order. Rows
    that are equal in ``key``, null included, get the same number of copies each.
    Columns of the same names are replaced. An empty table, or a target whose classes
    have no documents, gives no rows.

    Rows are repeated before the one shuffle, but by a generator: a task never holds
    more than one document and its count.
    """
    rates = repetition_rates(docs, target, source, text)
    identity = F.col(f"`{key}`")
    number = _class(target, F.col(f"`{source}`"))
    copies = F.when(F.lit(False), F.lit(0))
    for c, rate in enumerate(rates):
        copies = copies.when(number == c, _copies(rate, target.seed, identity))
    drawn = with_own(docs, {"copies": copies.cast("int")}).filter(F.col("copies") > 0)
    repeated = with_own(drawn, {"copy": F.explode(F.sequence(F.lit(1), F.col("copies")))})
    digest = F.md5(F.concat_ws(":", F.lit(f"order-{target.seed}"), F.coalesce(identity.cast("string"), F.lit("")), F.col("copy").cast("string")))
    ordered = with_own(repeated, {"mix_key": F.conv(F.substring(digest, 1, ORDER_DIGITS), 16, 10).cast("bigint")})
    count = partitions or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    width = -(-(16**ORDER_DIGITS) // count)
    place = F.expr(f"cast(mix_key div {width} as int)")
    return ordered.repartitionById(count, place).sortWithinPartitions("mix_key", "copy")
