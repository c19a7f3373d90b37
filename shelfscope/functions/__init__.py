"""Column-level building blocks; all of them compile to JVM expressions."""

from .numeric import exact_avg, exact_sum, guarded_ratio, percent, round_half_up
from .parse import clean_text, title_text, to_date, to_double, to_int

__all__ = [
    "clean_text",
    "exact_avg",
    "exact_sum",
    "guarded_ratio",
    "percent",
    "round_half_up",
    "title_text",
    "to_date",
    "to_double",
    "to_int",
]
