"""Incremental landing of new files."""

from .landing import ingest_landing, landed_batches, read_bronze, read_deliveries, read_landed

__all__ = ["ingest_landing", "landed_batches", "read_bronze", "read_deliveries", "read_landed"]
