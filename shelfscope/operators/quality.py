"""Row-level quality rules: reasons, valid/invalid split and rule histogram.

All of it is narrow: the rules are one expression per row, and the histogram
pre-aggregates to a single row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..specs import REASON_COLUMN, DatasetSpec, Rule


def _as_of(as_of: Column | None) -> Column:
    return F.current_date() if as_of is None else as_of


def failed_codes(
    spec: DatasetSpec, as_of: Column | None = None, extra_rules: tuple[Rule, ...] = ()
) -> Column:
    """Codes of the rules a row breaks, as an array in rule order."""
    day = _as_of(as_of)
    rules = spec.rules + extra_rules
    return F.array_compact(F.array(*(F.when(rule.broken(day), F.lit(rule.code)) for rule in rules)))


def failure_reason(
    spec: DatasetSpec, as_of: Column | None = None, extra_rules: tuple[Rule, ...] = ()
) -> Column:
    """The same codes as one string, each followed by ``;``; empty when valid."""
    day = _as_of(as_of)
    return F.concat(
        *(
            F.when(rule.broken(day), F.lit(rule.code + ";")).otherwise(F.lit(""))
            for rule in spec.rules + extra_rules
        )
    )


def check_quality(
    df: DataFrame,
    spec: DatasetSpec,
    as_of: Column | None = None,
    extra_rules: tuple[Rule, ...] = (),
) -> DataFrame:
    """Cleaned rows with their ``dq_failure_reason``.

    The row is built as one struct and unpacked again. That keeps a later filter
    on the reason from being pushed below the cleaning, where it would repeat
    every cleaning expression per rule: several times the work, in generated code
    too long for the JVM to compile.
    """
    reason = failure_reason(spec, as_of, extra_rules).alias(REASON_COLUMN)
    return df.select(F.inline(F.array(F.struct(*spec.columns, reason))))


def valid_rows(checked: DataFrame) -> DataFrame:
    return checked.filter(F.col(REASON_COLUMN) == "").drop(REASON_COLUMN)


def invalid_rows(checked: DataFrame) -> DataFrame:
    return checked.filter(F.col(REASON_COLUMN) != "")


def reason_counts(df: DataFrame, spec: DatasetSpec, as_of: Column | None = None) -> DataFrame:
    """Rows broken per rule, one output row per rule, rules that never fire included."""
    day = _as_of(as_of)
    counts = df.agg(*(F.count_if(rule.broken(day)).alias(rule.code) for rule in spec.rules))
    return counts.unpivot(
        ids=[],
        values=[rule.code for rule in spec.rules],
        variableColumnName="dq_code",
        valueColumnName="n_rows",
    ).select(F.lit(spec.name).alias("dataset"), "dq_code", "n_rows")
