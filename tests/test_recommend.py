"""Recommendations against a brute-force computation, and their plans."""

import itertools
import random
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from conformance.fixtures import fixture
from conformance.queries import QUERIES
from shelfscope import operators as ops
from shelfscope import plans, sinks
from shelfscope.operators import pairs, ranking, skew
from shelfscope.staging import stage

SF_DIR = "/root/testdata/sf0.001"
CATALOG = "seller_id string, item_id string, item_name string, category string"
COMPANY = "item_id string, units_sold int, revenue double"
COMPETITOR = "seller_id string, item_id string, units_sold int, revenue double, marketplace_price double"


def _rows(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)


def _small(spark, seed=0):
    """Sellers, items and sales with variants, hot keys and NULLs."""
    rng = random.Random(seed)
    catalog = [
        (f"S{rng.randrange(12)}", f"I{i}", f"name {i}" + (" v2" if rng.random() < 0.3 else ""), f"c{i % 3}")
        for i in range(25)
        for _ in range(rng.randrange(6))
    ]
    hot = [(f"S{s}", "I1", "name 1", "c1") for s in range(12) for _ in range(20)]
    catalog += hot + [("S0", f"I{i}", f"name {i}", f"c{i % 3}") for i in range(25)] + [("S99", "I77", "x", None)]
    company = [(f"I{rng.randrange(30)}", rng.randrange(5), float(rng.randrange(100))) for _ in range(200)]
    company += [("I2", 3, 9.5)] * 100 + [(None, 50, 10.0), ("I28", 0, 0.0)]
    competitor = [
        (f"C{rng.randrange(5)}", f"I{rng.randrange(35)}", rng.randrange(5), 1.0, float(rng.randrange(50)))
        for _ in range(200)
    ]
    return (
        spark.createDataFrame(catalog, CATALOG),
        spark.createDataFrame(company, COMPANY),
        spark.createDataFrame(competitor, COMPETITOR),
    )


def _brute_force(catalog, top, company, competitor):
    stocked = {(r["seller_id"], r["item_id"]) for r in catalog}
    sellers = {r["seller_id"] for r in catalog}
    out = []
    for seller, item in itertools.product(sellers, top):
        if (seller, item["item_id"]) in stocked:
            continue
        own = [s for s in company if s["item_id"] == item["item_id"] and item["item_id"]]
        rival = [s for s in competitor if s["item_id"] == item["item_id"]]
        holders = {s for s, i in stocked if i == item["item_id"]}
        units = sum(s["units_sold"] for s in own)
        price = sum(s["revenue"] for s in own) / units if units > 0 else None
        if price is None and rival:
            price = sum(s["marketplace_price"] for s in rival) / len(rival)
        if own:
            expected = units / len(holders) if holders else float(units)
        elif rival:
            expected = sum(s["units_sold"] for s in rival) / len({s["seller_id"] for s in rival})
        else:
            expected = 0.0
        out.append((seller, item["item_id"], item["item_name"], item["category"], price or 0.0, expected))
    return sorted(out, key=repr)


def _short_chunks(monkeypatch, chunk_items, part_rows=pairs.PART_ROWS):
    monkeypatch.setattr(pairs, "CHUNK_ITEMS", chunk_items)
    monkeypatch.setattr(pairs, "PART_ROWS", part_rows)


@pytest.mark.parametrize(("chunk_items", "part_rows"), [(pairs.CHUNK_ITEMS, pairs.PART_ROWS), (4, pairs.PART_ROWS), (3, 5)])
def test_matches_brute_force(spark, monkeypatch, chunk_items, part_rows):
    _short_chunks(monkeypatch, chunk_items, part_rows)
    catalog, company, competitor = _small(spark)
    top = ops.all_top_items(
        ops.top_company_items(company, catalog, 3), ops.top_competitor_items(competitor, catalog, 3)
    ).collect()
    want = _brute_force(catalog.collect(), top, company.collect(), competitor.collect())
    got = plans.recommend(catalog, company, competitor, top_n=3, rounding=lambda c: c).drop("expected_revenue")
    got = _rows(got)
    assert [row[:4] for row in got] == [row[:4] for row in want]
    for mine, theirs in zip(got, want, strict=True):
        assert mine[4:] == pytest.approx(theirs[4:])


@pytest.mark.parametrize("seed", [1, 2])
def test_both_entry_points_agree_for_any_partitioning(spark, seed, monkeypatch):
    catalog, company, competitor = _small(spark, seed)
    lists = (ops.top_company_items(company, catalog), ops.top_competitor_items(competitor, catalog))
    direct = _rows(plans.recommend(catalog, company, competitor))
    assert direct == _rows(plans.generate_recommendations(catalog, company, *lists, competitor))
    shuffled = [df.repartition(n, F.rand(seed)) for df, n in ((catalog, 3), (company, 5), (competitor, 2))]
    assert direct == _rows(plans.recommend(*shuffled))
    _short_chunks(monkeypatch, 5)
    assert direct == _rows(plans.recommend(*shuffled))


@pytest.mark.parametrize("chunk_items", [pairs.CHUNK_ITEMS, 7])
def test_output_is_globally_ordered(spark, chunk_items, monkeypatch):
    monkeypatch.setattr(pairs, "ROWS_PER_TASK", 100)
    _short_chunks(monkeypatch, chunk_items)
    inputs = [fixture(spark, SF_DIR, n) for n in ("fx_catalog", "fx_company_sales", "fx_competitor_sales")]
    found = plans.recommend(*inputs)
    assert found.rdd.getNumPartitions() > 1
    rows = [(r["seller_id"], -r["expected_revenue"], r["item_id"]) for r in found.collect()]
    assert rows == sorted(rows)


def test_no_recommended_pair_is_stocked(spark):
    inputs = [fixture(spark, SF_DIR, n) for n in ("fx_catalog", "fx_company_sales", "fx_competitor_sales")]
    found = plans.recommend(*inputs)
    assert found.join(inputs[0], ["seller_id", "item_id"], "left_semi").isEmpty()
    assert not found.isEmpty()


def test_missing_items_and_all_pairs(spark, monkeypatch):
    catalog, company, competitor = _small(spark)
    top = ops.catalog_variants(catalog)
    every = catalog.select("seller_id").distinct().crossJoin(top)
    want_pairs = _rows(every.select("seller_id", *top.columns))
    lacking = every.join(catalog, ["seller_id", "item_id"], "left_anti")
    want_missing = _rows(lacking.select("seller_id", *top.columns))
    for sizes in ((pairs.CHUNK_ITEMS,), (3,), (2, 4)):
        _short_chunks(monkeypatch, *sizes)
        all_pairs = ops.seller_item_pairs(catalog, top)
        assert _rows(all_pairs.select("seller_id", *top.columns)) == want_pairs
        missing = ops.missing_items(catalog, top)
        assert _rows(missing.select("seller_id", *top.columns)) == want_missing


@pytest.mark.parametrize("n_items", [12, 1500])
def test_missing_counts_are_those_of_the_pairs(spark, n_items):
    rng = random.Random(n_items)
    rows = [(s, f"I{i}", f"v{rng.randint(1, 2)}") for s in ("S1", "S2", None) for i in rng.sample(range(n_items), n_items // 3)]
    rows += [("all", f"I{i}", "v1") for i in range(n_items)] + [("all", None, "v1")]
    rows += [("S3", None, "v2"), ("S4", "I0", "v1"), ("S4", "I0", "v1")] + [("S5", f"I{i}", "v1") for i in (0, 1, 11)]
    catalog = spark.createDataFrame(rows, "seller_id string, item_id string, item_name string").withColumn("category", F.lit("c"))
    # One listed item is in no catalog; rows without an id are lacking everywhere.
    listed = ops.catalog_variants(catalog).unionByName(spark.createDataFrame([("I1x", "c", "v")], "item_id string, category string, item_name string"))
    for items in (listed, listed.filter("item_id IS NULL")):
        counted = ops.missing_items(catalog, items).groupBy("seller_id").agg(
            F.count(F.lit(1)).alias("variants"), F.count_distinct("item_id").alias("items"), F.min("item_id").alias("first_item")
        )
        got = ops.missing_counts(catalog, items)
        assert got.columns == counted.columns
        assert sorted(got.collect(), key=str) == sorted(counted.collect(), key=str)


def test_counting_missing_variants_makes_no_pairs(spark, monkeypatch):
    monkeypatch.setattr(pairs, "expand_open_slots", lambda *_: pytest.fail("pairs of sellers and items were made"))
    assert QUERIES["missing_catalog_variants"](spark, "/root/testdata/sf0.001").count() > 0


def test_empty_inputs_give_empty_reports(spark):
    catalog, company, competitor = (df.limit(0) for df in _small(spark))
    found = plans.recommend(catalog, company, competitor)
    assert found.count() == 0
    stats = plans.recommendation_stats(found).first()
    assert tuple(stats) == (0, 0, 0, None, None, None)
    assert plans.validate_recommendations(found)


def test_checks_count_violations(spark):
    rows = [
        ("S1", "I1", "n", "c", 1.0, 1.0, 1.0),
        (None, "I1", "n", "c", 0.0, 0.0, -1.0),
        ("S1", None, "n", "c", 1.0, -1.0, None),
    ]
    df = spark.createDataFrame(rows, sinks.reports.RECOMMENDATION_SCHEMA)
    assert tuple(plans.recommendation_checks(df).first()) == (1, 2, 1, 1, 1, 1, False)
    assert not plans.validate_recommendations(df)
    assert plans.validate_recommendations(df.limit(1))


def test_reports_round_trip(spark, tmp_path):
    catalog, company, competitor = _small(spark)
    found = plans.recommend(catalog, company, competitor)
    sinks.write_recommendations(found, f"{tmp_path}/all", single_file=True)
    assert len(list((tmp_path / "all").glob("*.csv"))) == 1
    assert _rows(sinks.read_recommendations(spark, f"{tmp_path}/all")) == _rows(found)
    gap = plans.company_gap(ops.top_competitor_items(competitor, catalog, 20), catalog)
    assert sinks.write_company_gap(gap, f"{tmp_path}/gap") is True
    read = sinks.read_gap(spark, f"{tmp_path}/gap")
    assert _rows(read) == _rows(gap)
    assert all(row["item_name"] is None for row in read.collect())
    assert sinks.write_company_gap(gap.limit(0), f"{tmp_path}/none") is False
    assert not (tmp_path / "none").exists()


def test_publishing_writes_both_reports(spark, tmp_path):
    inputs = _small(spark)
    run = plans.publish_recommendations(*inputs, f"{tmp_path}/all", f"{tmp_path}/gap", top_n=20)
    want = plans.recommend(*inputs, top_n=20)
    catalog, _, competitor = inputs
    gap = plans.company_gap(ops.top_competitor_items(competitor, catalog, 20), catalog)
    assert _rows(run.recommendations) == _rows(want)
    assert _rows(run.gap) == _rows(gap)
    assert run.gap.count() > 0
    assert _rows(run.stats) == _rows(plans.recommendation_stats(want))
    assert _rows(run.checks) == _rows(plans.recommendation_checks(want))


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans_have_no_cross_joins_and_push_limits_down(spark):
    inputs = [fixture(spark, SF_DIR, n) for n in ("fx_catalog", "fx_company_sales", "fx_competitor_sales")]
    shortlist = ops.items.shortlist(*inputs)
    plan = _plan(shortlist)
    assert len(re.findall(r"WindowGroupLimit .*, Partial", plan)) == 1
    assert plan.count("FileScan") == 4  # two sales tables, and two behind the catalog
    for df in (shortlist, plans.recommend(*inputs)):
        assert "Cartesian" not in _plan(df)
        assert "NestedLoop" not in _plan(df)


def _shape(plan):
    """Operators of a plan, outermost first, without what only differs by name or number."""
    return [m[1] for m in re.finditer(r"^[ :+\-*()0-9]*([A-Z]\w+)", plan, re.M)]


def test_one_plan_for_short_and_long_lists(spark):
    """Every shuffle lies below the explode of the words, and 200,000 items give the plan of 10."""
    catalog = spark.range(50).select(
        F.concat(F.lit("S"), F.col("id") % 3).alias("seller_id"), F.concat(F.lit("I"), F.col("id") * 4001).alias("item_id")
    )
    shapes = []
    for n in (10, 200_000):
        items = spark.range(n).select(F.concat(F.lit("I"), "id").alias("item_id"), F.lit("x").alias("item_name"))
        found = ops.missing_items(catalog, items)
        plan = _plan(found)
        above = plan[: plan.index("Generate explode(sequence(")]
        assert "Exchange hashpartitioning" not in above and "Exchange rangepartitioning" not in above
        shapes.append(_shape(plan))
        held = sum(4001 * i < n for i in range(50))
        assert found.count() == 3 * n - held
    assert shapes[0] == shapes[1]


def test_long_lists_are_ranked_in_ranges(spark, monkeypatch):
    """5,000 of a category with nearly all of 40,000 rows: the same rows as a window finds, and no task with the category."""
    monkeypatch.setattr(ranking, "ROWS_PER_RANGE", 2500)
    rows = spark.range(0, 40_000, 1, 8).select(
        F.when(F.col("id") % 50 > 0, "hot").when(F.col("id") % 100 == 0, "cold").alias("category"),
        (F.xxhash64("id") % 300).alias("units"),
        F.col("id").alias("item"),
    )
    order = [F.desc("units"), "item"]
    found = ranking.first_per_group(rows, ["category"], order, 5000)
    window = Window.partitionBy("category").orderBy(*order)
    want = rows.withColumn("rank", F.row_number().over(window)).filter("rank <= 5000")
    assert _rows(found) == _rows(want) and found.count() == 5000 + 400 + 400
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" in plan and all("_range" in line for line in plan.splitlines() if "Window [" in line)
    ranges = spark.read.parquet(*{f.rsplit("/", 1)[0] for f in found.inputFiles() if "/shelfscope-ranges-" in f})
    largest = ranges.filter("category = 'hot'").groupBy("_range").count().agg(F.max("count")).first()[0]
    assert largest < 40_000 / 4
    overall = ranking.first_per_group(rows, [], order, 2000).drop("rank")
    assert _rows(overall) == _rows(rows.orderBy(*order).limit(2000))
    assert ranking.first_per_group(rows.limit(0), ["category"], order, 5000).count() == 0


def test_long_top_lists_agree_with_short_ones(spark):
    inputs = [fixture(spark, SF_DIR, n) for n in ("fx_catalog", "fx_company_sales", "fx_competitor_sales")]
    catalog, company, competitor = inputs
    short = ops.top_company_items(company, catalog, 1000)
    assert _rows(ops.top_company_items(company, catalog, 1001)) == _rows(short)
    assert _rows(ops.top_competitor_items(competitor, catalog, 1001)) == _rows(ops.top_competitor_items(competitor, catalog, 1000))
    assert _rows(ops.items.shortlist(*inputs, top_n=1001)) == _rows(ops.items.shortlist(*inputs, top_n=1000))


def test_hot_items_are_not_shuffled(spark):
    """An item with a third of all sales, and another third without an item; adaptive execution is off."""
    sales = spark.range(0, 30_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.concat(F.lit("I"), F.col("id") % 2000)).alias("item_id"),
        F.col("id").alias("units_sold"),
    )
    catalog = spark.createDataFrame(
        [(f"I{i}", "c", "n") for i in range(0, 2000, 2)] + [("hot", "c", "n"), ("hot", "c", "n2"), (None, "c", "n")],
        "item_id string, category string, item_name string",
    )
    assert skew.heavy_values(sales, "item_id") == ["hot"]
    want = sales.join(catalog, "item_id", "left")
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        found = ops.sales_with_category(sales, catalog)
        sizes = [r[1] for r in found.groupBy(F.spark_partition_id()).count().collect()]
        moved = found.filter("item_id != 'hot'").groupBy(F.spark_partition_id()).count().collect()
        assert _rows(found.select(*want.columns)) == _rows(want)
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert max(sizes) < 5 * sorted(sizes)[len(sizes) // 2] and len(moved) >= 8
    plain = sales.filter("item_id != 'hot'")
    assert skew.heavy_values(plain, "item_id") == []
    assert _rows(ops.sales_with_category(plain, catalog)) == _rows(plain.join(catalog, "item_id", "left"))
    assert ops.sales_with_category(sales.limit(0), catalog).count() == 0


def test_keyed_dedup_prunes_before_the_shuffle(spark):
    catalog = fixture(spark, SF_DIR, "fx_catalog")
    plan = _plan(ops.best_price_per_key(catalog))
    partial = plan.index("row_number(), 1, Partial")
    exchange = plan.index("Exchange hashpartitioning(seller_id")
    assert exchange < partial


def test_staged_tables_live_in_the_shared_folder(spark):
    staged = stage(spark.range(10).withColumn("odd", F.col("id") % 2 == 1), "demo", ("odd",), odd=F.count_if("odd"))
    assert (staged.rows, staged.figures) == (10, {"odd": 5})
    assert staged.frame.columns == ["id", "odd"]
    assert spark.conf.get("spark.checkpoint.dir") in staged.frame.inputFiles()[0]
