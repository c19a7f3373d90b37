"""Seller recommendations, the company gap report and checks on both."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import exact_avg, round_half_up
from ..functions.numeric import Rounding
from ..operators import items, pairs
from ..sinks import read_gap, read_recommendations, write_company_gap, write_recommendations
from ..staging import Staged, stage

RECOMMENDATION_COLUMNS = (
    "seller_id",
    "item_id",
    "item_name",
    "category",
    "market_price",
    "expected_units_sold",
    "expected_revenue",
)


def _finite_or_zero(value: Column) -> Column:
    return F.coalesce(F.nanvl(value, F.lit(0.0)), F.lit(0.0))


def _priced(listed: DataFrame, rounding: Rounding) -> DataFrame:
    """Price, expected units and expected revenue per listed item.

    Company figures win wherever the company sold the item. Revenue multiplies
    the unrounded figures. An item without an id has no metrics.
    """
    known = F.col("item_id").isNotNull()

    def first_of(*names: str) -> Column:
        return F.coalesce(*(F.when(known, F.col(name)) for name in names), F.lit(0.0))

    price = first_of("company_market_price", "competitor_market_price")
    units = first_of("company_expected_units", "competitor_expected_units")
    return items.with_company_expectation(listed).select(
        "chunk",
        "slot",
        "item_id",
        "item_name",
        "category",
        rounding(price).alias("market_price"),
        rounding(units).alias("expected_units_sold"),
        _finite_or_zero(rounding(units * price)).alias("expected_revenue"),
    )


@dataclass(frozen=True)
class _Prepared:
    """The two written tables everything else is derived from."""

    listed: pairs.SlottedItems
    stock: Staged


def _prepare(seller_catalog: DataFrame, shortlist: DataFrame) -> _Prepared:
    listed = pairs.assign_slots(stage(shortlist, "shortlist"))
    return _Prepared(listed, pairs.stocked_slots(seller_catalog, listed))


def _recommendations(prepared: _Prepared, rounding: Rounding) -> DataFrame:
    """In order of seller and revenue: the pairs are range-partitioned by seller when they come to be.

    Sorting inside each partition is a global sort that moves no pair; a list of several
    parts is in order within each part.
    """
    listed, stock = prepared.listed, prepared.stock
    counted = listed.frame.join(pairs.seller_counts(stock), ["chunk", "slot"], "left")
    found = pairs.expand_open_slots(stock, listed, _priced(counted, rounding))
    order = ["seller_id", F.desc("expected_revenue"), "item_id", "category", "item_name"]
    return found.select(*RECOMMENDATION_COLUMNS).sortWithinPartitions(*order)


def recommend(
    seller_catalog: DataFrame,
    company_sales: DataFrame,
    competitor_sales: DataFrame,
    top_n: int = 10,
    rounding: Rounding = round_half_up,
) -> DataFrame:
    """Top items each seller does not stock, by seller and expected revenue.

    Reads each sales table once and the catalog twice. Two small tables are
    written on the way: the top list and the sellers' held slots.
    """
    shortlist = items.shortlist(seller_catalog, company_sales, competitor_sales, top_n)
    return _recommendations(_prepare(seller_catalog, shortlist), rounding)


def generate_recommendations(
    seller_catalog: DataFrame,
    company_sales: DataFrame,
    top_company_items: DataFrame,
    top_competitor_items: DataFrame,
    competitor_sales: DataFrame,
    rounding: Rounding = round_half_up,
) -> DataFrame:
    """The same for top lists chosen by the caller."""
    top_items = items.all_top_items(top_company_items, top_competitor_items)
    chosen = stage(top_items, "top-items").frame
    shortlist = items.shortlist_from_lists(company_sales, competitor_sales, chosen)
    return _recommendations(_prepare(seller_catalog, shortlist), rounding)


def company_gap(
    top_competitor_items: DataFrame,
    seller_catalog: DataFrame,
    rounding: Rounding = round_half_up,
) -> DataFrame:
    """Top competitor items that no seller of the catalog stocks.

    The list is written and counted first; the catalog is then only looked through for its
    items, and what it has of them is all that is shuffled.
    """
    listed = stage(top_competitor_items, "gap-list")
    wanted = listed.frame.select(F.col("item_id").alias("wanted_id")).distinct()
    wanted = F.broadcast(wanted) if listed.rows <= pairs.PART_ROWS else wanted
    stocked = seller_catalog.join(wanted, F.col("item_id") == F.col("wanted_id"), "left_semi").select("item_id").distinct()
    return listed.frame.join(stocked, "item_id", "left_anti").select(
        "item_id",
        "item_name",
        "category",
        "total_units_sold",
        rounding(F.col("avg_marketplace_price")).alias("market_price"),
        rounding(F.col("expected_units_sold")).alias("expected_units_sold"),
    )


def recommendation_checks(recommendations: DataFrame) -> DataFrame:
    """Violation counts in one pass, and whether all of them are zero."""
    violations = {
        "negative_revenue": F.col("expected_revenue") < 0,
        "nonpositive_units": F.col("expected_units_sold") <= 0,
        "nonpositive_price": F.col("market_price") <= 0,
        "null_seller_id": F.col("seller_id").isNull(),
        "null_item_id": F.col("item_id").isNull(),
        "null_revenue": F.col("expected_revenue").isNull(),
    }
    counts = recommendations.agg(*(F.count_if(p).alias(n) for n, p in violations.items()))
    passed = F.lit(True)
    for name in violations:
        passed = passed & (F.col(name) == 0)
    return counts.select(*violations, passed.alias("passed"))


def recommendation_stats(
    recommendations: DataFrame, rounding: Rounding = round_half_up
) -> DataFrame:
    """Size and revenue statistics; an empty input gives a row of zeros and NULLs."""
    revenue = F.col("expected_revenue")
    return recommendations.agg(
        F.count(F.lit(1)).alias("total_recommendations"),
        F.count_distinct("seller_id").alias("unique_sellers"),
        F.count_distinct("item_id").alias("unique_items"),
        rounding(exact_avg(revenue)).alias("avg_revenue"),
        F.max(revenue).alias("max_revenue"),
        F.min(revenue).alias("min_revenue"),
    )


def validate_recommendations(recommendations: DataFrame) -> bool:
    """Whether every check passes."""
    return recommendation_checks(recommendations).first()["passed"]


@dataclass(frozen=True)
class RecommendationRun:
    """The written reports and one row each of checks and statistics."""

    recommendations: DataFrame
    gap: DataFrame | None
    checks: DataFrame
    stats: DataFrame


def _listed_gap(prepared: _Prepared, rounding: Rounding) -> DataFrame:
    """:func:`company_gap` from the written tables: listed items in nobody's stock."""
    stocked = pairs.stocked_by_any(prepared.stock).select("chunk", "slot").distinct()
    return (
        prepared.listed.frame.filter("top_competitor")
        .join(stocked, ["chunk", "slot"], "left_anti")
        .select(
            "item_id",
            "item_name",
            "category",
            F.col("competitor_total_units").alias("total_units_sold"),
            rounding(F.col("competitor_market_price")).alias("market_price"),
            rounding(F.col("competitor_expected_units")).alias("expected_units_sold"),
        )
    )


def publish_recommendations(
    seller_catalog: DataFrame,
    company_sales: DataFrame,
    competitor_sales: DataFrame,
    output_path: str,
    gap_path: str,
    top_n: int = 10,
    rounding: Rounding = round_half_up,
    single_file: bool = False,
) -> RecommendationRun:
    """The whole reporting job: both CSV reports, checks and statistics.

    Each sales table is read once and the catalog twice for all of it; the checks
    read the report that was written instead of computing it again.
    """
    spark = seller_catalog.sparkSession
    shortlist = items.shortlist(seller_catalog, company_sales, competitor_sales, top_n)
    prepared = _prepare(seller_catalog, shortlist)
    write_recommendations(_recommendations(prepared, rounding), output_path, single_file)
    has_gap = write_company_gap(_listed_gap(prepared, rounding), gap_path, single_file)
    written = read_recommendations(spark, output_path)
    return RecommendationRun(
        recommendations=written,
        gap=read_gap(spark, gap_path) if has_gap else None,
        checks=recommendation_checks(written),
        stats=recommendation_stats(written, rounding),
    )
