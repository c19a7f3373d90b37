"""Typing and arithmetic on hand-written edge values."""

import math
import time
from datetime import date
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfscope import functions as fn


def _apply(spark, function, values, type_="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {type_}")
    rows = df.select("i", function(F.col("v")).alias("r")).orderBy("i").collect()
    return [row["r"] for row in rows]


def test_int_keeps_the_whole_part(spark):
    values = ["12", " 12 ", "12.7", "-3.9", "+4", "12.", "3000000000", "1e3", "abc", "", None]
    want = [12, 12, 12, -3, 4, 12, None, None, None, None, None]
    assert _apply(spark, fn.to_int, values) == want


_ODD_TEXTS = [None, "", "12", " 12\t", "\x0012\x7f", "+7", "-7", "--7", "12.", "12.7", "-12.7", ".5", "1e3", "12\u2028", "12\x85", "abc", "n/a"]
_ODD_TEXTS += ["2147483647", "2147483648", "-2147483649.5", "99999999999", "\u0661", "1 2", "1d", "0x1p3", "NaN", "-infinity", "+INF", "infx"]


def test_numbers_are_those_that_the_casts_read(spark):
    plain_int = lambda v: F.coalesce(v.try_cast("int"), F.regexp_extract(v, fn.parse.INT_PATTERN, 1).try_cast("int"))
    assert _apply(spark, fn.to_int, _ODD_TEXTS) == _apply(spark, plain_int, _ODD_TEXTS)
    assert repr(_apply(spark, fn.to_double, _ODD_TEXTS)) == repr(_apply(spark, lambda v: v.try_cast("double"), _ODD_TEXTS))


def test_refused_numbers_are_not_cast(spark):
    """A cast that refuses a text throws; decimal numerals read as integers must not cost that."""
    rows = spark.range(0, 400_000, 1, 4).select(F.concat("id", F.lit(".25")).alias("v")).localCheckpoint()

    def seconds(read):
        times = []
        for _ in range(3):
            began = time.perf_counter()
            rows.select(F.sum(read(F.col("v")))).collect()
            times.append(time.perf_counter() - began)
        return min(times)

    thrown = seconds(lambda v: F.coalesce(v.try_cast("int"), F.lit(0)))
    assert seconds(fn.to_int) < thrown / 2


def test_double_reads_special_values(spark):
    got = _apply(spark, fn.to_double, ["1.5", "1e3", "1d", "Infinity", "NaN", "abc", "", None])
    assert got[:4] == [1.5, 1000.0, 1.0, math.inf]
    assert math.isnan(got[4])
    assert got[5:] == [None, None, None]


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("2025-10-11", date(2025, 10, 11)),
        ("2025-1-5", date(2025, 1, 5)),
        ("2025-10-11T00:00:00", date(2025, 10, 11)),
        ("2025-01-1T", date(2025, 1, 1)),
        ("  2025-10-11", date(2025, 10, 11)),
        ("2025-02-30", None),
        ("2025-13-01", None),
        ("11/10/2025", None),
        ("20251011", None),
        ("25-10-11", None),
        ("2025- 1-5", None),
        ("2025-10-111", None),
        ("", None),
        (None, None),
    ],
)
def test_date(spark, text, want):
    assert _apply(spark, fn.to_date, [text]) == [want]


def test_title_lowers_the_rest_and_keeps_tabs(spark):
    values = ["  Apple iPhone 15 PRO ", "\thome appliances", "", None]
    want = ["Apple Iphone 15 Pro", "\thome Appliances", "", None]
    assert _apply(spark, fn.title_text, values) == want
    assert _apply(spark, fn.clean_text, ["\t a "]) == ["\t a"]


def test_typing_does_not_depend_on_ansi_mode(spark):
    values = ["12.7", "3000000000", "abc", "2025-1-5", "2025-02-30", "1e3", "NaN"]
    readers = (fn.to_int, fn.to_double, fn.to_date)
    strict = [repr(_apply(spark, reader, values)) for reader in readers]
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        assert [repr(_apply(spark, reader, values)) for reader in readers] == strict
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def _sum(spark, values, function=fn.exact_sum):
    df = spark.createDataFrame([(float(v) if v is not None else None,) for v in values], "v double")
    return df.agg(function(F.col("v")).alias("s")).first()["s"]


def test_sum_is_exact_for_money(spark):
    assert _sum(spark, [0.1] * 10) == 1.0
    assert _sum(spark, [1e16, 1.0, -1e16]) == 1.0
    assert _sum(spark, [-0.01, -1234567.89, 0.005]) == -1234567.895
    assert _sum(spark, [296447575.14, 99999999.99, None]) == 396447575.13


def test_sum_drops_no_places(spark):
    assert _sum(spark, [1e-9] * 1000) == 1e-6
    assert _sum(spark, [1e12 + 0.01, 1e-9, -1e12]) == pytest.approx(0.010000001, rel=1e-6)
    values = [0.123456789012, -7.5, 1e-9, 3.333333333333, 1e12 + 0.01, 0.1] * 50
    want = float(sum(Decimal(repr(v)) for v in values))
    assert _sum(spark, values) == pytest.approx(want, rel=1e-15)
    assert _sum(spark, values[::-1]) == _sum(spark, values)


def test_sum_of_special_values(spark):
    assert _sum(spark, []) is None
    assert _sum(spark, [None, None]) is None
    assert _sum(spark, [math.inf, 1.0]) == math.inf
    assert math.isnan(_sum(spark, [math.nan, 1.0]))
    assert math.isnan(_sum(spark, [math.inf, -math.inf]))
    assert _sum(spark, [1e300, 1.0]) == 1e300


def test_avg_ignores_nulls(spark):
    assert _sum(spark, [1.0, None, 2.0], fn.exact_avg) == 1.5
    assert _sum(spark, [None], fn.exact_avg) is None


@settings(max_examples=20, deadline=None)
@given(st.lists(st.integers(-(10**11), 10**11), min_size=1, max_size=60), st.randoms())
def test_sum_matches_decimal_arithmetic_in_any_order(spark, cents, random):
    values = [c / 100 for c in cents]
    want = float(sum((Decimal(repr(v)) for v in values), Decimal(0)))
    random.shuffle(values)
    assert _sum(spark, values) == want


def test_ratio_and_rounding(spark):
    df = spark.createDataFrame([(10, 4), (10, 0), (10, None), (10, -2)], "n bigint, d bigint")
    ratio = fn.guarded_ratio(F.col("n"), F.col("d"), otherwise=F.col("n"))
    assert [r[0] for r in df.select(ratio).collect()] == [2.5, 10.0, 10.0, 10.0]
    assert _apply(spark, fn.round_half_up, [1.005, 2.675, -1.005], "double") == [1.01, 2.68, -1.01]


def test_percent_of_nothing_is_zero(spark):
    df = spark.createDataFrame([(1, 3), (0, 0)], "p bigint, w bigint")
    got = df.select(fn.percent(F.col("p"), F.col("w")).alias("r")).collect()
    assert [r["r"] for r in got] == [33.33, 0.0]
