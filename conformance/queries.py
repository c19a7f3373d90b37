"""One registered query per operator, over whole tables.

Queries about files write the fixture to a new place in the shared folder and
read it back through the operator under test.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfscope import COMPANY_SALES, COMPETITOR_SALES, SELLER_CATALOG, DatasetSpec
from shelfscope import operators as ops
from shelfscope import plans, sinks, sources, streaming
from shelfscope.staging import fresh_path

from .fixtures import AS_OF, fixture

Query = Callable[[SparkSession, str], DataFrame]

RAW = {
    "catalog": (SELLER_CATALOG, "fx_raw_catalog"),
    "company": (COMPANY_SALES, "fx_raw_company_sales"),
    "competitor": (COMPETITOR_SALES, "fx_raw_competitor_sales"),
}
DAY_1 = "20010101000000000"
DAY_2 = "20010102000000000"
COMMITS = ("20010101000000000", "20010102000000000", "20010103000000000")
CATALOG_KEYS = ["seller_id", "item_id"]

_REGISTRY: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        _REGISTRY[name] = function
        return function

    return register


def _as_of():
    return F.lit(AS_OF).cast("date")


def _clean_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    names = ("fx_catalog", "fx_company_sales", "fx_competitor_sales")
    return tuple(fixture(spark, sf_dir, name) for name in names)


def _write_csv(df: DataFrame, path: str, mode: str = "overwrite", header: bool = True) -> str:
    """Write strings as they are, surrounding blanks included, in files of even size."""
    df.hint("rebalance").write.mode(mode).option("header", header).option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False
    ).csv(path)
    return path


def _folder(path: str = "path"):
    """Name of the folder a file lies in."""
    return F.element_at(F.split(path, "/"), -2)


# --- the three datasets: scan, clean, check, split, de-duplicate, publish ------


def _register_dataset(short: str, spec: DatasetSpec, raw_name: str) -> None:
    def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fixture(spark, sf_dir, raw_name)

    def checked(spark: SparkSession, sf_dir: str) -> DataFrame:
        return ops.check_quality(ops.clean(raw(spark, sf_dir), spec), spec, _as_of())

    @query(f"scan_{short}_csv")
    def scan(spark, sf_dir):
        path = _write_csv(raw(spark, sf_dir), fresh_path(spark, f"landing-{short}"))
        return sources.scan_csv(spark, spec, path)

    @query(f"clean_{short}")
    def clean(spark, sf_dir):
        return ops.clean(raw(spark, sf_dir), spec)

    @query(f"dq_{short}")
    def dq(spark, sf_dir):
        return checked(spark, sf_dir)

    @query(f"valid_{short}")
    def valid(spark, sf_dir):
        return ops.valid_rows(checked(spark, sf_dir))

    @query(f"quarantine_{short}")
    def quarantine(spark, sf_dir):
        path = fresh_path(spark, f"quarantine-{short}")
        sinks.write_quarantine(ops.invalid_rows(checked(spark, sf_dir)), path)
        return spark.read.parquet(path)

    @query(f"dedup_{short}")
    def dedup(spark, sf_dir):
        return plans.trusted_rows(raw(spark, sf_dir), spec, _as_of())

    @query(f"gold_{short}")
    def gold(spark, sf_dir):
        path = fresh_path(spark, f"gold-{short}")
        sinks.write_snapshot(plans.trusted_rows(raw(spark, sf_dir), spec, _as_of()), spec, path)
        return sources.read_snapshot(spark, spec, path)


for _short, (_spec, _raw_name) in RAW.items():
    _register_dataset(_short, _spec, _raw_name)


@query("dq_reason_counts")
def dq_reason_counts(spark, sf_dir):
    counts = [
        ops.reason_counts(ops.clean(fixture(spark, sf_dir, name), spec), spec, _as_of())
        for spec, name in RAW.values()
    ]
    return reduce(DataFrame.unionByName, counts)


# --- sources and pre-flight checks ---------------------------------------------


@query("scan_gold_snapshot")
def scan_gold_snapshot(spark, sf_dir):
    path = fresh_path(spark, "snapshot")
    sinks.write_snapshot(fixture(spark, sf_dir, "fx_catalog"), SELLER_CATALOG, path)
    return sources.read_snapshot(spark, SELLER_CATALOG, path)


@query("ingest_landing")
def ingest_landing(spark, sf_dir):
    """Two deliveries and three runs; the last run finds nothing new."""
    root = fresh_path(spark, "ingest")
    raw = fixture(spark, sf_dir, "fx_raw_company_sales")
    early = F.coalesce(F.col("sale_date") < "1995-01-01", F.lit(False))

    def run():
        streaming.ingest_landing(
            spark,
            COMPANY_SALES,
            f"{root}/landing",
            f"{root}/bronze",
            f"{root}/checkpoint",
            archive=f"{root}/archive",
        )

    _write_csv(raw.filter(early), f"{root}/landing/first")
    run()
    _write_csv(raw.filter(~early), f"{root}/landing/second")
    run()
    run()
    return streaming.read_bronze(spark, COMPANY_SALES, f"{root}/bronze")


def _swapped_sales(spark, sf_dir, root: str) -> str:
    """All raw sales twice: as they should be, and in files whose columns are in reverse order."""
    raw = fixture(spark, sf_dir, "fx_raw_company_sales")
    _write_csv(raw, root)
    _write_csv(raw.select(*reversed(raw.columns)), root, mode="append")
    return root


def _swapped_run(spark, sf_dir, root: str) -> plans.EtlRun:
    path = _swapped_sales(spark, sf_dir, f"{root}/landing")
    return plans.run_etl_from_csv(spark, COMPANY_SALES, path, f"{root}/table", f"{root}/quarantine", as_of=_as_of())


@query("etl_swapped_header")
def etl_swapped_header(spark, sf_dir):
    return _swapped_run(spark, sf_dir, fresh_path(spark, "swapped")).table


@query("etl_swapped_quarantine")
def etl_swapped_quarantine(spark, sf_dir):
    """Rows in the quarantine for their file's header, and for other reasons."""
    root = fresh_path(spark, "swapped")
    _swapped_run(spark, sf_dir, root)
    wrong = F.startswith(F.col("dq_failure_reason"), F.lit("header_mismatch;"))
    return spark.read.parquet(f"{root}/quarantine").agg(
        F.count_if(wrong).alias("wrong_header"), F.count_if(~wrong).alias("other_reasons")
    )


def _landing_runs(spark, sf_dir, root: str) -> list[plans.LandingRun]:
    """Early sales, then all sales, the early ones again, with files in the wrong column order; a third run finds nothing."""
    raw = fixture(spark, sf_dir, "fx_raw_company_sales")
    early = F.coalesce(F.col("sale_date") < "1997-01-01", F.lit(False))

    def run():
        return plans.run_landing(spark, COMPANY_SALES, root, buckets=16, as_of=_as_of())

    _write_csv(raw.filter(early), f"{root}/landing/first")
    first = run()
    _write_csv(raw, f"{root}/landing/second")
    _write_csv(raw.select(*reversed(raw.columns)), f"{root}/landing/swapped")
    return [first, run(), run()]


@query("landing_run")
def landing_run(spark, sf_dir):
    root = fresh_path(spark, "landing-run")
    _landing_runs(spark, sf_dir, root)
    return plans.BucketedTable(spark, COMPANY_SALES, f"{root}/table").read()


@query("landing_run_unique")
def landing_run_unique(spark, sf_dir):
    """Sales that came in both deliveries are there once."""
    root = fresh_path(spark, "landing-run")
    _landing_runs(spark, sf_dir, root)
    return plans.UniqueRows(spark, f"{root}/unique").read(COMPANY_SALES.typed_schema)


@query("landing_run_summary")
def landing_run_summary(spark, sf_dir):
    root = fresh_path(spark, "landing-run")
    runs = _landing_runs(spark, sf_dir, root)
    inserted = reduce(DataFrame.unionByName, [run.summary for run in runs])
    saved = sinks.read_run_metrics(spark, f"{root}/metrics").select("records.*")
    counts = saved.agg(F.count(F.lit(1)).alias("runs"), F.sum("input_count").alias("rows_in"), F.sum("valid_count").alias("rows_valid"))
    return counts.join(F.broadcast(inserted.agg(F.sum("inserts").alias("inserts"))), F.col("runs") > 0)


@query("file_inventory")
def file_inventory(spark, sf_dir):
    root = fresh_path(spark, "inventory")
    raw = fixture(spark, sf_dir, "fx_raw_company_sales")
    _write_csv(raw, f"{root}/sales", header=False)
    _write_csv(raw.filter(F.lit(False)).coalesce(1), f"{root}/nothing", header=False)
    files = sources.file_inventory(spark, f"{root}/*")
    return files.groupBy(_folder().alias("folder")).agg(
        F.sum("size_bytes").alias("total_bytes"),
        F.count_if("is_empty").alias("empty_files"),
    )


@query("header_contract")
def header_contract(spark, sf_dir):
    root = fresh_path(spark, "header")
    raw = fixture(spark, sf_dir, "fx_raw_catalog")
    _write_csv(raw, f"{root}/in_order")
    _write_csv(raw.select(*reversed(raw.columns)), f"{root}/reversed")
    files = sources.header_contract(spark, SELLER_CATALOG, f"{root}/*")
    return files.groupBy(_folder().alias("folder")).agg(
        F.bool_and("header_ok").alias("header_ok")
    )


@query("min_row_count")
def min_row_count(spark, sf_dir):
    root = fresh_path(spark, "rows")
    _write_csv(fixture(spark, sf_dir, "fx_raw_catalog"), f"{root}/sales")
    _write_csv(spark.read.parquet(f"{sf_dir}/region.parquet"), f"{root}/regions")
    files = sources.min_row_count(spark, SELLER_CATALOG, f"{root}/*")
    return files.groupBy(_folder().alias("folder")).agg(
        F.sum("n_rows").alias("n_rows"), F.bool_and("enough_rows").alias("enough_rows")
    )


@query("dataset_verdict")
def dataset_verdict(spark, sf_dir):
    """Company sales have a wrong header; nothing was delivered for competitors."""
    root = fresh_path(spark, "verdict")
    _write_csv(fixture(spark, sf_dir, "fx_raw_catalog"), f"{root}/seller_catalog")
    sales = fixture(spark, sf_dir, "fx_raw_company_sales")
    _write_csv(sales.select(*reversed(sales.columns)), f"{root}/company_sales")
    inputs = {spec: f"{root}/{spec.name}" for spec, _ in RAW.values()}
    return sources.dataset_verdicts(spark, inputs).select(
        "dataset", (F.col("n_files") > 0).alias("has_files"), "passed"
    )


# --- keyed merges and the commit log --------------------------------------------


def _days(spark, sf_dir):
    return fixture(spark, sf_dir, "fx_catalog_day1"), fixture(spark, sf_dir, "fx_catalog_day2")


def _commit_log(spark, sf_dir):
    first, second = _days(spark, sf_dir)
    path = fresh_path(spark, "commits")
    sinks.write_commit(first, path, DAY_1)
    sinks.write_commit(second, path, DAY_2)
    return sources.read_commit_log(spark, path, first.schema)


@query("merge_catalog")
def merge_catalog(spark, sf_dir):
    first, second = _days(spark, sf_dir)
    return ops.merge(first, second, CATALOG_KEYS, "marketplace_price")


@query("merge_replay")
def merge_replay(spark, sf_dir):
    first, second = _days(spark, sf_dir)
    once = ops.merge(first, second, CATALOG_KEYS, "marketplace_price")
    return ops.merge(once, second, CATALOG_KEYS, "marketplace_price")


def _upsert(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """The catalog of one day's lines, then the other's upserted into a new folder."""
    root = fresh_path(spark, "upsert")
    first, second = (
        fixture(spark, sf_dir, name).select(
            "seller_id",
            "item_id",
            F.concat(F.lit("Item "), "item_id").alias("item_name"),
            F.concat(F.lit("Shelf "), F.substring("item_id", -1, 1)).alias("category"),
            "marketplace_price",
            "stock_qty",
        )
        for name in ("fx_catalog_day1", "fx_catalog_day2")
    )
    sinks.write_snapshot(first, SELLER_CATALOG, f"{root}/v1")
    paths = f"{root}/v1", f"{root}/v2"
    summary = plans.upsert_snapshot(spark, SELLER_CATALOG, paths[0], second, paths[1])
    return summary, sources.read_snapshot(spark, SELLER_CATALOG, paths[1])


@query("upsert_snapshot")
def upsert_snapshot(spark, sf_dir):
    return _upsert(spark, sf_dir)[1]


@query("upsert_summary")
def upsert_summary(spark, sf_dir):
    return _upsert(spark, sf_dir)[0]


@query("merge_summary")
def merge_summary(spark, sf_dir):
    return ops.merge_summary(*_days(spark, sf_dir), CATALOG_KEYS)


@query("merge_null_keys")
def merge_null_keys(spark, sf_dir):
    """Keys with null parts, merged twice."""
    first, second = (fixture(spark, sf_dir, name) for name in ("fx_null_day1", "fx_null_day2"))
    once = ops.merge(first, second, CATALOG_KEYS, "marketplace_price")
    return ops.merge(once, second, CATALOG_KEYS, "marketplace_price")


@query("merge_summary_null_keys")
def merge_summary_null_keys(spark, sf_dir):
    return ops.merge_summary(fixture(spark, sf_dir, "fx_null_day1"), fixture(spark, sf_dir, "fx_null_day2"), CATALOG_KEYS)


def _bucketed(spark, sf_dir) -> tuple[DataFrame, plans.BucketedTable]:
    """The first day's catalog in buckets by seller, and the second day's upserted one half of the sellers at a time."""
    first, second = (
        fixture(spark, sf_dir, name).withColumns({"item_name": F.lit("Item"), "category": F.lit("Shelf")})
        for name in ("fx_null_day1", "fx_null_day2")
    )
    table = plans.BucketedTable(spark, SELLER_CATALOG, fresh_path(spark, "bucketed"))
    table.create(first, 32, by=["seller_id"])
    early = F.coalesce(F.col("seller_id") < "S5", F.lit(True))
    summaries = [table.upsert(second.filter(half)) for half in (early, ~early)]
    return reduce(DataFrame.unionByName, summaries), table


@query("bucketed_upsert")
def bucketed_upsert(spark, sf_dir):
    return _bucketed(spark, sf_dir)[1].read().select(*CATALOG_KEYS, "marketplace_price", "stock_qty")


@query("bucketed_upsert_summary")
def bucketed_upsert_summary(spark, sf_dir):
    """Both upserts together; how many buckets each touches depends on their hash."""
    summaries = _bucketed(spark, sf_dir)[0]
    return summaries.agg(
        F.sum("inserts").alias("inserts"), F.sum("updates").alias("updates"), F.max("total_rows").alias("total_rows")
    )


@query("table_as_of")
def table_as_of(spark, sf_dir):
    """The table between the two commits and after both."""
    log = _commit_log(spark, sf_dir)
    instants = ("20010101120000000", "20010102120000000")
    versions = [
        ops.as_of(log, CATALOG_KEYS, instant).withColumn("instant", F.lit(instant))
        for instant in instants
    ]
    return reduce(DataFrame.unionByName, versions)


@query("commit_log_as_of")
def commit_log_as_of(spark, sf_dir):
    """Three commits and a snapshot after the second: the table before, at and after it."""
    first, second = _days(spark, sf_dir)
    log = plans.CommitLog(spark, fresh_path(spark, "log"), CATALOG_KEYS, first.schema, every=2)
    early = F.col("seller_id") < "S5"
    for instant, rows in zip(COMMITS, (first, second.filter(early), second.filter(~early)), strict=True):
        log.append(rows, instant)
    return reduce(DataFrame.unionByName, [log.as_of(c).withColumn("instant", F.lit(c)) for c in COMMITS])


@query("commit_timeline")
def commit_timeline(spark, sf_dir):
    return ops.commit_timeline(_commit_log(spark, sf_dir))


@query("schema_reconcile")
def schema_reconcile(spark, sf_dir):
    """The second day's files have one more column."""
    first, second = _days(spark, sf_dir)
    path = fresh_path(spark, "evolved")
    first.write.parquet(path)
    second.withColumn("restocked", F.col("stock_qty") > 50).write.mode("append").parquet(path)
    return sources.read_evolved(spark, path)


@query("schema_reconcile_union")
def schema_reconcile_union(spark, sf_dir):
    first, second = _days(spark, sf_dir)
    return ops.reconcile(first, second.withColumn("restocked", F.col("stock_qty") > 50))


# --- item analytics ---------------------------------------------------------------


@query("sales_with_category")
def sales_with_category(spark, sf_dir):
    catalog = fixture(spark, sf_dir, "fx_catalog_variants")
    return ops.sales_with_category(fixture(spark, sf_dir, "fx_company_sales"), catalog)


@query("item_sales_by_category")
def item_sales_by_category(spark, sf_dir):
    catalog = fixture(spark, sf_dir, "fx_catalog_variants")
    return ops.item_sales_by_category(fixture(spark, sf_dir, "fx_company_sales"), catalog)


@query("distinct_sellers")
def distinct_sellers(spark, sf_dir):
    return ops.distinct_sellers(fixture(spark, sf_dir, "fx_catalog"))


@query("distinct_catalog_items")
def distinct_catalog_items(spark, sf_dir):
    return ops.distinct_catalog_items(fixture(spark, sf_dir, "fx_catalog"))


@query("distinct_catalog_variants")
def distinct_catalog_variants(spark, sf_dir):
    return ops.catalog_variants(fixture(spark, sf_dir, "fx_catalog_variants"))


@query("catalog_seller_counts")
def catalog_seller_counts(spark, sf_dir):
    return ops.catalog_seller_counts(fixture(spark, sf_dir, "fx_catalog"))


@query("company_item_totals")
def company_item_totals(spark, sf_dir):
    return ops.company_item_totals(fixture(spark, sf_dir, "fx_company_sales"))


@query("competitor_item_totals")
def competitor_item_totals(spark, sf_dir):
    return ops.competitor_item_totals(fixture(spark, sf_dir, "fx_competitor_sales"))


@query("company_metrics")
def company_metrics(spark, sf_dir):
    catalog, company, _ = _clean_inputs(spark, sf_dir)
    return ops.company_metrics(company, catalog)


@query("competitor_metrics")
def competitor_metrics(spark, sf_dir):
    return ops.competitor_metrics(fixture(spark, sf_dir, "fx_competitor_sales"))


@query("item_metrics")
def item_metrics(spark, sf_dir):
    catalog, company, competitor = _clean_inputs(spark, sf_dir)
    return ops.item_metrics(
        ops.company_metrics(company, catalog), ops.competitor_metrics(competitor)
    )


def _register_top_lists(suffix: str, catalog_name: str) -> None:
    @query(f"top_company_items{suffix}")
    def company(spark, sf_dir):
        sales = fixture(spark, sf_dir, "fx_company_sales")
        return ops.top_company_items(sales, fixture(spark, sf_dir, catalog_name))

    @query(f"top_competitor_items{suffix}")
    def competitor(spark, sf_dir):
        sales = fixture(spark, sf_dir, "fx_competitor_sales")
        return ops.top_competitor_items(sales, fixture(spark, sf_dir, catalog_name))


_register_top_lists("", "fx_catalog")
_register_top_lists("_variants", "fx_catalog_variants")


def _top_items(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """The catalog and the items of both top lists."""
    catalog, company, competitor = _clean_inputs(spark, sf_dir)
    top = ops.all_top_items(
        ops.top_company_items(company, catalog), ops.top_competitor_items(competitor, catalog)
    )
    return catalog, top


@query("all_top_items")
def all_top_items(spark, sf_dir):
    return _top_items(spark, sf_dir)[1]


@query("seller_item_pairs")
def seller_item_pairs(spark, sf_dir):
    return ops.seller_item_pairs(*_top_items(spark, sf_dir))


@query("missing_items")
def missing_items(spark, sf_dir):
    return ops.missing_items(*_top_items(spark, sf_dir))


@query("missing_catalog_variants")
def missing_catalog_variants(spark, sf_dir):
    """Every seller against the whole catalog: per seller, how many variants it lacks and of how many items."""
    catalog = fixture(spark, sf_dir, "fx_catalog_variants")
    return ops.missing_counts(catalog, ops.catalog_variants(catalog))


# --- recommendations --------------------------------------------------------------


@query("seller_recommendations")
def seller_recommendations(spark, sf_dir):
    return plans.recommend(*_clean_inputs(spark, sf_dir))


@query("seller_recommendations_from_lists")
def seller_recommendations_from_lists(spark, sf_dir):
    catalog, company, competitor = _clean_inputs(spark, sf_dir)
    return plans.generate_recommendations(
        catalog,
        company,
        ops.top_company_items(company, catalog),
        ops.top_competitor_items(competitor, catalog),
        competitor,
    )


@query("seller_recommendations_variants")
def seller_recommendations_variants(spark, sf_dir):
    _, company, competitor = _clean_inputs(spark, sf_dir)
    return plans.recommend(fixture(spark, sf_dir, "fx_catalog_variants"), company, competitor)


@query("seller_recommendations_keyed")
def seller_recommendations_keyed(spark, sf_dir):
    """Over keyed sales tables, where each key keeps its latest sale only."""
    catalog, company, competitor = _clean_inputs(spark, sf_dir)
    return plans.recommend(
        catalog,
        ops.keyed_snapshot(company, COMPANY_SALES),
        ops.keyed_snapshot(competitor, COMPETITOR_SALES),
    )


def _run_all(spark, sf_dir, root: str) -> dict[str, plans.EtlRun]:
    inputs = {spec: fixture(spark, sf_dir, raw_name) for spec, raw_name in RAW.values()}
    return plans.run_datasets(inputs, root, _as_of())


@query("end_to_end_recommendations")
def end_to_end_recommendations(spark, sf_dir):
    """Raw strings through all three ETL runs to recommendations."""
    runs = _run_all(spark, sf_dir, fresh_path(spark, "runs"))
    return plans.recommend(*(runs[spec.name].table for spec, _ in RAW.values()))


@query("recommendations_csv")
def recommendations_csv(spark, sf_dir):
    path = fresh_path(spark, "recommendations")
    sinks.write_recommendations(plans.recommend(*_clean_inputs(spark, sf_dir)), path)
    return sinks.read_recommendations(spark, path)


def _gap_inputs(spark, sf_dir) -> tuple[DataFrame, DataFrame, DataFrame]:
    names = ("fx_catalog", "fx_company_sales", "fx_gap_competitor_sales")
    return tuple(fixture(spark, sf_dir, name) for name in names)


def _gap(spark, sf_dir) -> DataFrame:
    catalog, _, competitor = _gap_inputs(spark, sf_dir)
    return plans.company_gap(ops.top_competitor_items(competitor, catalog), catalog)


@query("company_gap")
def company_gap(spark, sf_dir):
    return _gap(spark, sf_dir)


@query("gap_csv")
def gap_csv(spark, sf_dir):
    path = fresh_path(spark, "company-gap")
    sinks.write_company_gap(_gap(spark, sf_dir), path)
    return sinks.read_gap(spark, path)


@query("recommendation_checks")
def recommendation_checks(spark, sf_dir):
    return plans.recommendation_checks(plans.recommend(*_clean_inputs(spark, sf_dir)))


@query("recommendation_stats")
def recommendation_stats(spark, sf_dir):
    return plans.recommendation_stats(plans.recommend(*_clean_inputs(spark, sf_dir)))


def _publish(spark, inputs) -> plans.RecommendationRun:
    root = fresh_path(spark, "published")
    return plans.publish_recommendations(*inputs, f"{root}/recommendations", f"{root}/company_catalog_gap")


@query("published_recommendations")
def published_recommendations(spark, sf_dir):
    return _publish(spark, _clean_inputs(spark, sf_dir)).recommendations


@query("published_gap")
def published_gap(spark, sf_dir):
    return _publish(spark, _gap_inputs(spark, sf_dir)).gap


# --- run metrics ------------------------------------------------------------------


@query("run_metrics")
def run_metrics(spark, sf_dir):
    """Figures of the three ETL runs, as saved."""
    root = fresh_path(spark, "runs")
    _run_all(spark, sf_dir, root)
    saved = sinks.read_run_metrics(spark, f"{root}/metrics")
    return saved.select(
        "pipeline_name", "status", "records.*", "data_quality.*", F.size("errors").alias("n_errors")
    )


@query("run_summary")
def run_summary(spark, sf_dir):
    """The same runs as flat rows; their seconds differ each time, so only their presence is returned."""
    root = fresh_path(spark, "runs")
    _run_all(spark, sf_dir, root)
    summary = sinks.run_summary(sinks.read_run_metrics(spark, f"{root}/metrics"))
    return summary.withColumn("timed", F.col("duration_seconds") >= 0).drop("duration_seconds")


QUERIES: dict[str, Query] = dict(_REGISTRY)
