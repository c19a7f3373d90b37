"""Small helpers that the operators share."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_own(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """``df`` plus ``columns``; an input column of the same name, in any case, gives way."""
    taken = {name.casefold() for name in columns}
    kept = [F.col(f"`{name}`") for name in df.columns if name.casefold() not in taken]
    return df.select(*kept, *(column.alias(name) for name, column in columns.items()))


def with_settled(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """As ``with_own``, but behind a generator of one row.

    Catalyst pushes a later filter on a projected column below the projection and
    repeats its expression there; inside a higher-order function that repeats it for
    every element. It doesn't push one below the generator that makes the column.
    """
    taken = {name.casefold() for name in columns}
    kept = [F.col(f"`{name}`") for name in df.columns if name.casefold() not in taken]
    row = F.struct(*(column.alias(name) for name, column in columns.items()))
    return df.select(*kept, F.inline(F.array(row)))


def without(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """``df`` without the columns of these names, in any case."""
    gone = {name.casefold() for name in names}
    return df.select(*(F.col(f"`{name}`") for name in df.columns if name.casefold() not in gone))


def long_array(values: Iterable[int]) -> Column:
    """A literal array of longs, one constant in the plan however many values it has."""
    text = ",".join(str(int(value)) for value in values)
    return F.split(F.lit(text), ",").cast("array<bigint>") if text else F.array().cast("array<bigint>")


def double_array(values: Iterable[float]) -> Column:
    """A literal array of doubles; ``repr`` round-trips every value."""
    text = ",".join(repr(float(value)) for value in values)
    return F.split(F.lit(text), ",").cast("array<double>") if text else F.array().cast("array<double>")
