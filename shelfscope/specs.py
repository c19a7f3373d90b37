"""Declarative dataset specs: landing columns, typing, rules and keys.

A spec is the only place that knows what a dataset looks like. The cleaning,
quality, de-duplication, pre-flight and sink code is written once and driven by
it, so a fourth dataset is a new spec, not a new job.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .functions import clean_text, title_text, to_date, to_double, to_int

REASON_COLUMN = "dq_failure_reason"
#: Code, and marking column, of rows whose file has another header than the dataset's.
WRONG_HEADER = "header_mismatch"

_READERS: dict[str, Callable[[Column], Column]] = {
    "text": clean_text,
    "title": title_text,
    "int": to_int,
    "double": to_double,
    "date": to_date,
}
_TYPES: dict[str, T.DataType] = {
    "text": T.StringType(),
    "title": T.StringType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
}


@dataclass(frozen=True)
class Field:
    """One landed column: how to read it and what an unreadable value becomes."""

    name: str
    kind: str
    default: int | float | None = None

    @property
    def data_type(self) -> T.DataType:
        return _TYPES[self.kind]

    def cleaned(self) -> Column:
        value = _READERS[self.kind](F.col(self.name))
        if self.default is not None:
            value = F.coalesce(value, F.lit(self.default))
        return value.alias(self.name)


@dataclass(frozen=True)
class Rule:
    """A quality rule: the code a row collects when ``broken(as_of)`` is true.

    A predicate that evaluates to NULL counts as passing.
    """

    code: str
    broken: Callable[[Column], Column]


@dataclass(frozen=True)
class DatasetSpec:
    """Everything the generic operators need to know about one dataset."""

    name: str
    fields: tuple[Field, ...]
    rules: tuple[Rule, ...]
    keys: tuple[str, ...]
    order_by: str
    partition_by: tuple[str, ...] = ()
    constants: tuple[tuple[str, str], ...] = ()
    unique_by_key: bool = False
    min_rows: int = 10

    @property
    def columns(self) -> list[str]:
        return [field.name for field in self.fields]

    @property
    def landing_schema(self) -> T.StructType:
        return T.StructType([T.StructField(name, T.StringType()) for name in self.columns])

    @property
    def typed_schema(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, f.data_type) for f in self.fields])

    @property
    def snapshot_schema(self) -> T.StructType:
        extra = [T.StructField(name, T.StringType()) for name, _ in self.constants]
        return T.StructType(self.typed_schema.fields + extra)

    @property
    def header_line(self) -> str:
        return ",".join(self.columns)


def missing(name: str) -> Callable[[Column], Column]:
    return lambda as_of: F.col(name).isNull() | (F.col(name) == "")


def negative(name: str) -> Callable[[Column], Column]:
    return lambda as_of: F.col(name) < 0


def null_or_negative(name: str) -> Callable[[Column], Column]:
    return lambda as_of: F.col(name).isNull() | (F.col(name) < 0)


def null_or_after(name: str) -> Callable[[Column], Column]:
    return lambda as_of: F.col(name).isNull() | (F.col(name) > as_of)


def not_finite(name: str) -> Callable[[Column], Column]:
    """Optional stricter rule: NaN and infinities pass the sign rules above."""
    return lambda as_of: F.isnan(name) | F.abs(F.col(name)).eqNullSafe(F.lit(float("inf")))


SELLER_CATALOG = DatasetSpec(
    name="seller_catalog",
    fields=(
        Field("seller_id", "text"),
        Field("item_id", "text"),
        Field("item_name", "title"),
        Field("category", "title"),
        Field("marketplace_price", "double"),
        Field("stock_qty", "int", default=0),
    ),
    rules=(
        Rule("seller_id_missing", missing("seller_id")),
        Rule("item_id_missing", missing("item_id")),
        Rule("item_name_missing", missing("item_name")),
        Rule("category_missing", missing("category")),
        Rule("price_invalid", null_or_negative("marketplace_price")),
        Rule("stock_qty_negative", negative("stock_qty")),
    ),
    keys=("seller_id", "item_id"),
    order_by="marketplace_price",
    partition_by=("category",),
    unique_by_key=True,
)

COMPANY_SALES = DatasetSpec(
    name="company_sales",
    fields=(
        Field("item_id", "text"),
        Field("units_sold", "int", default=0),
        Field("revenue", "double", default=0.0),
        Field("sale_date", "date"),
    ),
    rules=(
        Rule("item_id_missing", missing("item_id")),
        Rule("units_sold_negative", negative("units_sold")),
        Rule("revenue_negative", negative("revenue")),
        Rule("sale_date_invalid", null_or_after("sale_date")),
    ),
    keys=("item_id",),
    order_by="sale_date",
)

COMPETITOR_SALES = DatasetSpec(
    name="competitor_sales",
    fields=(
        Field("seller_id", "text"),
        Field("item_id", "text"),
        Field("units_sold", "int", default=0),
        Field("revenue", "double", default=0.0),
        Field("marketplace_price", "double", default=0.0),
        Field("sale_date", "date"),
    ),
    rules=(
        Rule("item_id_missing", missing("item_id")),
        Rule("seller_id_missing", missing("seller_id")),
        Rule("units_sold_negative", negative("units_sold")),
        Rule("revenue_negative", negative("revenue")),
        Rule("marketplace_price_negative", negative("marketplace_price")),
        Rule("sale_date_invalid", null_or_after("sale_date")),
    ),
    keys=("seller_id", "item_id"),
    order_by="sale_date",
    partition_by=("partition_col",),
    constants=(("partition_col", "default"),),
)

DATASETS = {spec.name: spec for spec in (SELLER_CATALOG, COMPANY_SALES, COMPETITOR_SALES)}
