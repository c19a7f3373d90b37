"""Whole jobs composed from the operators."""

from .buckets import BUCKET_SUMMARY, BucketedTable
from .commits import CommitLog
from .etl import EtlRun, run_datasets, run_etl, run_etl_from_csv, trusted_rows
from .incremental import upsert_snapshot
from .landing import LandingRun, run_landing
from .recommendations import (
    RecommendationRun,
    company_gap,
    generate_recommendations,
    publish_recommendations,
    recommend,
    recommendation_checks,
    recommendation_stats,
    validate_recommendations,
)
from .seen import UniqueRows

__all__ = [
    "BUCKET_SUMMARY",
    "BucketedTable",
    "CommitLog",
    "EtlRun",
    "LandingRun",
    "RecommendationRun",
    "UniqueRows",
    "company_gap",
    "generate_recommendations",
    "publish_recommendations",
    "recommend",
    "recommendation_checks",
    "recommendation_stats",
    "run_datasets",
    "run_etl",
    "run_etl_from_csv",
    "run_landing",
    "trusted_rows",
    "upsert_snapshot",
    "validate_recommendations",
]
