"""Readers and pre-flight checks of the landing files."""

from .files import added_columns, csv_glob, read_commit_log, read_evolved, read_snapshot, scan_csv
from .preflight import (
    dataset_verdicts,
    file_inventory,
    has_input,
    header_contract,
    headers_of,
    line_profile,
    mark_wrong_headers,
    min_row_count,
)

__all__ = [
    "added_columns",
    "csv_glob",
    "dataset_verdicts",
    "file_inventory",
    "has_input",
    "header_contract",
    "headers_of",
    "line_profile",
    "mark_wrong_headers",
    "min_row_count",
    "read_commit_log",
    "read_evolved",
    "read_snapshot",
    "scan_csv",
]
