"""DataFrame to DataFrame operators."""

from .clean import clean
from .dedup import (
    best_price_per_key,
    drop_exact_duplicates,
    first_per_key,
    keyed_snapshot,
    latest_per_key,
    remove_duplicates,
)
from .items import (
    all_top_items,
    catalog_seller_counts,
    catalog_variants,
    company_item_totals,
    company_metrics,
    competitor_item_totals,
    competitor_metrics,
    distinct_catalog_items,
    distinct_sellers,
    item_metrics,
    item_sales_by_category,
    sales_with_category,
    top_company_items,
    top_competitor_items,
)
from .merge import as_of, commit_timeline, merge, merge_summary, reconcile, replace_keys, without_keys
from .pairs import missing_counts, missing_items, seller_item_pairs
from .quality import (
    check_quality,
    failed_codes,
    failure_reason,
    invalid_rows,
    reason_counts,
    valid_rows,
)

__all__ = [
    "all_top_items",
    "as_of",
    "best_price_per_key",
    "catalog_seller_counts",
    "catalog_variants",
    "check_quality",
    "clean",
    "commit_timeline",
    "company_item_totals",
    "company_metrics",
    "competitor_item_totals",
    "competitor_metrics",
    "distinct_catalog_items",
    "distinct_sellers",
    "drop_exact_duplicates",
    "failed_codes",
    "failure_reason",
    "first_per_key",
    "invalid_rows",
    "item_metrics",
    "item_sales_by_category",
    "keyed_snapshot",
    "latest_per_key",
    "merge",
    "merge_summary",
    "missing_counts",
    "missing_items",
    "reason_counts",
    "reconcile",
    "remove_duplicates",
    "replace_keys",
    "sales_with_category",
    "seller_item_pairs",
    "top_company_items",
    "top_competitor_items",
    "valid_rows",
    "without_keys",
]
