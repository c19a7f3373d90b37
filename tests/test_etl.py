"""Cleaning, rules, de-duplication, ETL runs and their sinks on hand-written rows."""

import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from shelfscope import COMPANY_SALES, COMPETITOR_SALES, SELLER_CATALOG
from shelfscope import operators as ops
from shelfscope import plans, sinks, sources
from shelfscope.specs import Rule, not_finite



def _day(text="2025-12-31"):
    return F.lit(text).cast("date")


def _raw(spark, spec, rows):
    return spark.createDataFrame(rows, spec.landing_schema)


CATALOG_ROWS = [
    (" S1 ", "I1", "apple iPhone 15 PRO", "home appliances", "10.5", "12.7"),
    ("S1", "I1", "Apple Iphone 15 Pro", "Home Appliances", "11.5", "abc"),
    ("S2", "I2", "Lamp", "Home", "NaN", "3000000000"),
    (None, "", None, " ", "abc", "-5"),
    ("S3", "I3", "Desk", "Home", "-1.5", "1"),
]


def test_catalog_cleaning_and_reasons(spark):
    cleaned = ops.clean(_raw(spark, SELLER_CATALOG, CATALOG_ROWS), SELLER_CATALOG)
    assert cleaned.schema == SELLER_CATALOG.typed_schema or [
        (f.name, f.dataType) for f in cleaned.schema
    ] == [(f.name, f.dataType) for f in SELLER_CATALOG.typed_schema]
    first = cleaned.first()
    assert first["seller_id"] == "S1"
    assert first["item_name"] == "Apple Iphone 15 Pro"
    assert first["category"] == "Home Appliances"
    assert first["stock_qty"] == 12
    checked = ops.check_quality(cleaned, SELLER_CATALOG)
    assert [row["dq_failure_reason"] for row in checked.collect()] == [
        "",
        "",
        "",
        "seller_id_missing;item_id_missing;item_name_missing;category_missing;"
        "price_invalid;stock_qty_negative;",
        "price_invalid;",
    ]
    codes = cleaned.select(ops.failed_codes(SELLER_CATALOG).alias("c")).collect()
    assert codes[4]["c"] == ["price_invalid"]


def test_stricter_rule_is_an_option(spark):
    cleaned = ops.clean(_raw(spark, SELLER_CATALOG, CATALOG_ROWS), SELLER_CATALOG)
    strict = (Rule("price_not_finite", not_finite("marketplace_price")),)
    checked = ops.check_quality(cleaned, SELLER_CATALOG, extra_rules=strict)
    assert checked.collect()[2]["dq_failure_reason"] == "price_not_finite;"


def test_sales_defaults_and_future_dates(spark):
    rows = [
        ("C1", " I1 ", "x", None, "abc", "2025-1-5"),
        ("C1", "I1", "-4", "-10", "-2", "2026-01-01"),
        ("C1", "I1", "4", "10", "2", "2025-02-30"),
    ]
    cleaned = ops.clean(_raw(spark, COMPETITOR_SALES, rows), COMPETITOR_SALES)
    assert tuple(cleaned.first()) == ("C1", "I1", 0, 0.0, 0.0, date(2025, 1, 5))
    checked = ops.check_quality(cleaned, COMPETITOR_SALES, _day())
    assert [row["dq_failure_reason"] for row in checked.collect()] == [
        "",
        "units_sold_negative;revenue_negative;marketplace_price_negative;sale_date_invalid;",
        "sale_date_invalid;",
    ]


def test_default_day_is_today(spark):
    rows = [("I1", "1", "1", "2000-01-01"), ("I1", "1", "1", "9999-01-01")]
    checked = ops.check_quality(ops.clean(_raw(spark, COMPANY_SALES, rows), COMPANY_SALES), COMPANY_SALES)
    assert [r["dq_failure_reason"] for r in checked.collect()] == ["", "sale_date_invalid;"]


def test_catalog_keeps_highest_price_and_sales_keep_transactions(spark):
    catalog = plans.trusted_rows(_raw(spark, SELLER_CATALOG, CATALOG_ROWS), SELLER_CATALOG)
    prices = {row["item_id"]: row["marketplace_price"] for row in catalog.collect()}
    assert prices["I1"] == 11.5
    assert set(prices) == {"I1", "I2"}
    sale = ("I1", "1", "5.0", "2025-01-01")
    sales = _raw(spark, COMPANY_SALES, [sale, sale, ("I1", "2", "5.0", "2025-01-01")])
    assert plans.trusted_rows(sales, COMPANY_SALES).count() == 2


def test_snapshot_keeps_latest_sale_whatever_the_order(spark):
    rows = [("I1", i % 3, float(i), date(2025, 1, 1 + i % 5)) for i in range(200)]
    rows += [("I2", 1, 1.0, date(2025, 1, 1))]
    schema = COMPANY_SALES.typed_schema
    want = {("I1", 2, 194.0, date(2025, 1, 5)), ("I2", 1, 1.0, date(2025, 1, 1))}
    for ordering, partitions in ((rows, 1), (rows[::-1], 7)):
        df = spark.createDataFrame(ordering, schema).repartition(partitions)
        assert {tuple(r) for r in ops.keyed_snapshot(df, COMPANY_SALES).collect()} == want


def test_run_counts_quarantines_and_saves_metrics(spark, tmp_path):
    raw = _raw(spark, SELLER_CATALOG, CATALOG_ROWS)
    run = plans.run_etl(
        raw,
        SELLER_CATALOG,
        f"{tmp_path}/table",
        f"{tmp_path}/quarantine",
        metrics_path=f"{tmp_path}/metrics",
    )
    assert run.table.columns == SELLER_CATALOG.columns
    assert run.table.count() == 2
    bad = spark.read.parquet(f"{tmp_path}/quarantine")
    assert bad.columns == [*SELLER_CATALOG.columns, "dq_failure_reason"]
    assert bad.count() == 2
    saved = sinks.read_run_metrics(spark, f"{tmp_path}/metrics").first()
    assert saved["records"].asDict() == {
        "input_count": 5,
        "valid_count": 3,
        "invalid_count": 2,
        "duplicate_count": 1,
        "output_count": 2,
    }
    assert saved["data_quality"].asDict() == {"valid_percentage": 60.0, "invalid_percentage": 40.0}
    assert saved["status"] == "SUCCESS"
    assert saved["duration_seconds"] >= 0
    assert saved["errors"] == []


def test_run_without_valid_rows(spark, tmp_path):
    raw = _raw(spark, SELLER_CATALOG, CATALOG_ROWS[3:])
    run = plans.run_etl(raw, SELLER_CATALOG, f"{tmp_path}/table", f"{tmp_path}/quarantine")
    assert run.table.count() == 0
    assert run.metrics.first()["records"]["output_count"] == 0
    assert not (tmp_path / "table").exists()


def test_run_on_empty_input(spark, tmp_path):
    raw = _raw(spark, COMPANY_SALES, [])
    run = plans.run_etl(raw, COMPANY_SALES, f"{tmp_path}/table", f"{tmp_path}/quarantine")
    figures = run.metrics.first()
    assert figures["records"]["input_count"] == 0
    assert figures["data_quality"]["valid_percentage"] == 0.0


def test_clean_run_leaves_the_previous_quarantine(spark, tmp_path):
    paths = (f"{tmp_path}/table", f"{tmp_path}/quarantine")
    plans.run_etl(_raw(spark, SELLER_CATALOG, CATALOG_ROWS), SELLER_CATALOG, *paths)
    plans.run_etl(_raw(spark, SELLER_CATALOG, CATALOG_ROWS[:2]), SELLER_CATALOG, *paths)
    assert spark.read.parquet(paths[1]).count() == 2


def test_failed_run_is_recorded_and_raised(spark, tmp_path):
    raw = _raw(spark, COMPANY_SALES, [("I1", "1", "1", "2020-01-01")]).withColumn(
        "units_sold", F.raise_error(F.lit("broken input"))
    )
    with pytest.raises(Exception, match="broken input"):
        plans.run_etl(
            raw,
            COMPANY_SALES,
            f"{tmp_path}/table",
            f"{tmp_path}/quarantine",
            metrics_path=f"{tmp_path}/metrics",
        )
    saved = sinks.read_run_metrics(spark, f"{tmp_path}/metrics").first()
    assert saved["status"] == "FAILED"
    assert "broken input" in saved["errors"][0]["message"]


def test_unsaved_metrics_do_not_fail_the_run(spark, tmp_path):
    (tmp_path / "metrics").write_text("a file where the folder should be")
    raw = _raw(spark, COMPANY_SALES, [("I1", "1", "1", "2020-01-01")])
    run = plans.run_etl(
        raw,
        COMPANY_SALES,
        f"{tmp_path}/table",
        f"{tmp_path}/quarantine",
        metrics_path=f"{tmp_path}/metrics/sub",
    )
    assert run.table.count() == 1


def test_run_from_csv_needs_input(spark, tmp_path):
    with pytest.raises(ValueError, match="no input"):
        plans.run_etl_from_csv(
            spark, COMPANY_SALES, f"{tmp_path}/none", f"{tmp_path}/t", f"{tmp_path}/q"
        )
    (tmp_path / "in").mkdir()
    lines = ["item_id,units_sold,revenue,sale_date", "I1, 3 ,4.50,2025-01-01", "I2,x"]
    (tmp_path / "in" / "sales.csv").write_text("\n".join(lines) + "\n")
    run = plans.run_etl_from_csv(
        spark, COMPANY_SALES, f"{tmp_path}/in", f"{tmp_path}/t", f"{tmp_path}/q"
    )
    assert [tuple(r) for r in run.table.collect()] == [("I1", 3, 4.5, date(2025, 1, 1))]
    assert spark.read.parquet(f"{tmp_path}/q").first()["dq_failure_reason"] == "sale_date_invalid;"


def test_snapshot_round_trip_keeps_types_of_partition_values(spark, tmp_path):
    rows = [("S1", "I1", "Lamp", "007", 1.0, 1), ("S1", "I2", "Desk", "8", 2.0, 2)]
    df = spark.createDataFrame(rows, SELLER_CATALOG.typed_schema)
    assert sinks.write_snapshot(df, SELLER_CATALOG, f"{tmp_path}/gold") == 2
    back = sources.read_snapshot(spark, SELLER_CATALOG, f"{tmp_path}/gold")
    assert sorted(tuple(r) for r in back.collect()) == rows
    only = back.filter(F.col("category") == "007")
    assert only.count() == 1
    assert "PartitionFilters: [isnotnull(category" in only._jdf.queryExecution().toString()


def test_competitor_snapshot_has_its_constant_partition(spark, tmp_path):
    df = spark.createDataFrame(
        [("C1", "I1", 1, 1.0, 1.0, date(2025, 1, 1))], COMPETITOR_SALES.typed_schema
    )
    sinks.write_snapshot(df, COMPETITOR_SALES, f"{tmp_path}/gold")
    assert (tmp_path / "gold" / "partition_col=default").is_dir()
    back = sources.read_snapshot(spark, COMPETITOR_SALES, f"{tmp_path}/gold")
    assert back.first()["partition_col"] == "default"


def test_metrics_file_is_plain_json(spark, tmp_path):
    metrics = sinks.RunMetrics("etl_demo", input_count=4, valid_count=3, invalid_count=1)
    sinks.write_run_metrics(metrics.finish().to_frame(spark), f"{tmp_path}/m")
    (file,) = (tmp_path / "m").glob("*.json")
    saved = json.loads(file.read_text())
    assert saved["pipeline_name"] == "etl_demo"
    assert saved["data_quality"] == {"valid_percentage": 75.0, "invalid_percentage": 25.0}


def test_datasets_run_together_and_all_finish(spark, tmp_path):
    good = _raw(spark, COMPANY_SALES, [("I1", "1", "1", "2020-01-01")])
    bad = _raw(spark, COMPETITOR_SALES, [("C1", "I1", "1", "1", "1", "2020-01-01")]).withColumn(
        "revenue", F.raise_error(F.lit("broken input"))
    )
    with pytest.raises(Exception, match="broken input"):
        plans.run_datasets({COMPETITOR_SALES: bad, COMPANY_SALES: good}, str(tmp_path))
    saved = sinks.read_run_metrics(spark, f"{tmp_path}/metrics").collect()
    assert {row["pipeline_name"]: row["status"] for row in saved} == {
        "etl_company_sales": "SUCCESS",
        "etl_competitor_sales": "FAILED",
    }
    runs = plans.run_datasets({COMPANY_SALES: good}, str(tmp_path / "again"), _day())
    assert runs["company_sales"].table.count() == 1
