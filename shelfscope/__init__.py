"""Catalog and sales analytics as Spark DataFrame operators."""

from .specs import COMPANY_SALES, COMPETITOR_SALES, DATASETS, SELLER_CATALOG, DatasetSpec, Field, Rule

__all__ = [
    "COMPANY_SALES",
    "COMPETITOR_SALES",
    "DATASETS",
    "DatasetSpec",
    "Field",
    "Rule",
    "SELLER_CATALOG",
]
