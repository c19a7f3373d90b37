"""Item-level totals, metrics and top lists.

Sales are summed per item before they meet the catalog. Joining first and
summing after gives the same rows, because every catalog variant of an item
receives the item's full total, but it would carry raw sales through the join;
here the sums merge inside the map tasks and the join sees one row per item.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import exact_avg, exact_sum, guarded_ratio
from .ranking import first_per_group
from .skew import left_join_skewed

ITEM_COLUMNS = ("item_id", "category", "item_name")
#: So many rows of an overall list are picked task by task and merged in one; more are ranked in ranges.
MOST_LIMITED = 1000


def catalog_variants(seller_catalog: DataFrame) -> DataFrame:
    """Distinct ``(item_id, category, item_name)`` of the catalog."""
    return seller_catalog.select(*ITEM_COLUMNS).distinct()


def distinct_sellers(seller_catalog: DataFrame) -> DataFrame:
    return seller_catalog.select("seller_id").distinct()


def distinct_catalog_items(seller_catalog: DataFrame) -> DataFrame:
    return seller_catalog.select("item_id").distinct()


def catalog_seller_counts(seller_catalog: DataFrame) -> DataFrame:
    """Distinct sellers that stock each item."""
    return seller_catalog.groupBy("item_id").agg(
        F.count_distinct("seller_id").alias("company_seller_count")
    )


def sales_with_category(company_sales: DataFrame, seller_catalog: DataFrame) -> DataFrame:
    """Every sale with every catalog variant of its item, or with NULLs; best sellers' sales are not shuffled."""
    return left_join_skewed(company_sales, catalog_variants(seller_catalog), "item_id")


def company_item_totals(company_sales: DataFrame) -> DataFrame:
    return company_sales.groupBy("item_id").agg(
        F.sum("units_sold").alias("total_units_sold"),
        exact_sum(F.col("revenue")).alias("total_revenue"),
    )


def competitor_item_totals(competitor_sales: DataFrame, approximate: bool = False) -> DataFrame:
    """Totals, average price and number of sellers per item.

    ``approximate`` replaces the exact distinct count by a sketch, which saves
    one of the two shuffles.
    """
    count_sellers = F.approx_count_distinct if approximate else F.count_distinct
    return competitor_sales.groupBy("item_id").agg(
        F.sum("units_sold").alias("total_units_sold"),
        exact_sum(F.col("revenue")).alias("total_revenue"),
        exact_avg(F.col("marketplace_price")).alias("avg_marketplace_price"),
        count_sellers("seller_id").alias("num_sellers"),
    )


def item_sales_by_category(company_sales: DataFrame, seller_catalog: DataFrame) -> DataFrame:
    """Units and revenue per ``(item_id, category, item_name)``."""
    totals = company_item_totals(company_sales).join(
        catalog_variants(seller_catalog), "item_id", "left"
    )
    return totals.select(*ITEM_COLUMNS, "total_units_sold", "total_revenue")


def top_company_items(
    company_sales: DataFrame, seller_catalog: DataFrame, top_n: int = 10
) -> DataFrame:
    """Best-selling items of every category, numbered by ``rank``.

    A category that holds most items ships ``top_n`` rows per task, or, for a long list,
    is ranked by many tasks (see ``ranking``).
    """
    best_first = [F.desc("total_units_sold"), "item_id", "item_name"]
    totals = item_sales_by_category(company_sales, seller_catalog)
    return first_per_group(totals, ["category"], best_first, top_n).select(*ITEM_COLUMNS, "total_units_sold", "rank")


def _units_per_seller(units: str, sellers: str) -> Column:
    return guarded_ratio(F.col(units), F.col(sellers), otherwise=F.col(units))


def top_competitor_items(
    competitor_sales: DataFrame, seller_catalog: DataFrame, top_n: int = 10
) -> DataFrame:
    """Best-selling competitor items overall, described from the catalog."""
    totals = competitor_item_totals(competitor_sales).join(catalog_variants(seller_catalog), "item_id", "left")
    best_first = [F.desc("total_units_sold"), *ITEM_COLUMNS]
    if top_n <= MOST_LIMITED:
        best = totals.orderBy(*best_first).limit(top_n)
    else:
        best = first_per_group(totals, [], best_first, top_n).orderBy(*best_first)
    return best.select(
        *ITEM_COLUMNS,
        "total_units_sold",
        "avg_marketplace_price",
        _units_per_seller("total_units_sold", "num_sellers").alias("expected_units_sold"),
        "num_sellers",
    )


def all_top_items(top_company: DataFrame, top_competitor: DataFrame) -> DataFrame:
    """The items of both lists, each once."""
    return (
        top_company.select(*ITEM_COLUMNS)
        .unionByName(top_competitor.select(*ITEM_COLUMNS))
        .distinct()
    )


def _company_totals(company_sales: DataFrame) -> DataFrame:
    return company_item_totals(company_sales).select(
        "item_id",
        F.col("total_units_sold").alias("company_total_units"),
        F.col("total_revenue").alias("company_total_revenue"),
        guarded_ratio(
            F.col("total_revenue"), F.col("total_units_sold"), otherwise=F.lit(None)
        ).alias("company_market_price"),
    )


def with_company_expectation(metrics: DataFrame) -> DataFrame:
    """Add expected units from ``company_total_units`` and ``company_seller_count``."""
    return metrics.withColumn(
        "company_expected_units", _units_per_seller("company_total_units", "company_seller_count")
    )


def company_metrics(company_sales: DataFrame, seller_catalog: DataFrame) -> DataFrame:
    """Realised price and expected units per item with company sales."""
    return with_company_expectation(
        _company_totals(company_sales).join(
            catalog_seller_counts(seller_catalog), "item_id", "left"
        )
    )


def competitor_metrics(competitor_sales: DataFrame) -> DataFrame:
    """Average price and expected units per item with competitor sales."""
    return competitor_item_totals(competitor_sales).select(
        "item_id",
        F.col("total_units_sold").alias("competitor_total_units"),
        F.col("total_revenue").alias("competitor_total_revenue"),
        F.col("avg_marketplace_price").alias("competitor_market_price"),
        F.col("num_sellers").alias("competitor_seller_count"),
        _units_per_seller("total_units_sold", "num_sellers").alias("competitor_expected_units"),
    )


def item_metrics(company: DataFrame, competitor: DataFrame) -> DataFrame:
    """Company and competitor metrics side by side, one row per item."""
    return competitor.join(company, "item_id", "full_outer")


def shortlist(
    seller_catalog: DataFrame,
    company_sales: DataFrame,
    competitor_sales: DataFrame,
    top_n: int = 10,
) -> DataFrame:
    """Both top lists with their metrics, from one pass over each sales table.

    Gives the rows of ``all_top_items`` joined to ``item_metrics`` (without the
    seller counts of the catalog), and whether each came in by the competitor
    ranking. Item totals of both sides meet on ``item_id``, by which both are
    already partitioned, and each item then stands as a candidate in up to two
    rankings: its category's, by company units, and the overall one, by competitor
    units. One group limit serves both.
    """
    facts = (
        _company_totals(company_sales)
        .withColumn("_company", F.lit(True))
        .join(
            competitor_metrics(competitor_sales).withColumn("_competitor", F.lit(True)),
            "item_id",
            "full_outer",
        )
        .join(catalog_variants(seller_catalog), "item_id", "left")
    )
    candidacies = F.array(
        F.struct(
            F.lit("company").alias("ranking"),
            F.col("category").alias("section"),
            F.col("company_total_units").alias("units"),
            F.col("_company").alias("listed"),
        ),
        F.struct(
            F.lit("competitor").alias("ranking"),
            F.lit(None).cast("string").alias("section"),
            F.col("competitor_total_units").alias("units"),
            F.col("_competitor").alias("listed"),
        ),
    )
    best_first = [F.desc("units"), *ITEM_COLUMNS]
    metrics = (
        "company_total_units",
        "company_market_price",
        "competitor_total_units",
        "competitor_market_price",
        "competitor_expected_units",
    )
    candidates = facts.select("*", F.inline(candidacies)).filter("listed")
    return (
        first_per_group(candidates, ["ranking", "section"], best_first, top_n, "place")
        .groupBy(*ITEM_COLUMNS)
        .agg(
            *(F.first(name).alias(name) for name in metrics),
            F.bool_or(F.col("ranking") == "competitor").alias("top_competitor"),
        )
    )


def shortlist_from_lists(
    company_sales: DataFrame,
    competitor_sales: DataFrame,
    top_items: DataFrame,
) -> DataFrame:
    """Metrics for a given top list; sales of other items are dropped up front."""
    wanted = top_items.select("item_id").distinct()
    company = _company_totals(company_sales.join(wanted, "item_id", "left_semi"))
    competitor = competitor_metrics(competitor_sales.join(wanted, "item_id", "left_semi"))
    return (
        top_items.select(*ITEM_COLUMNS)
        .join(company, "item_id", "left")
        .join(competitor, "item_id", "left")
        .select(
            *ITEM_COLUMNS,
            "company_total_units",
            "company_market_price",
            "competitor_market_price",
            "competitor_expected_units",
        )
    )
