"""Typing and normalising landed rows."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..specs import DatasetSpec


def clean(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    """All-string rows to typed rows, in one projection and without a shuffle."""
    return df.select(*(field.cleaned() for field in spec.fields))
