"""Writers of trusted tables, quarantine, reports and run metrics."""

from .reports import read_gap, read_recommendations, write_company_gap, write_recommendations
from .run_metrics import RunMetrics, read_run_metrics, run_summary, write_run_metrics
from .tables import write_commit, write_quarantine, write_snapshot, write_table

__all__ = [
    "RunMetrics",
    "read_gap",
    "read_recommendations",
    "read_run_metrics",
    "run_summary",
    "write_commit",
    "write_company_gap",
    "write_quarantine",
    "write_recommendations",
    "write_run_metrics",
    "write_snapshot",
    "write_table",
]
