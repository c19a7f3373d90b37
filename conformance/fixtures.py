"""The three datasets, derived from the star-schema tables.

The text is valid in Spark SQL and in DuckDB, so a query and its oracle start
from the same rows. All of them read whole tables: every line makes its supplier a
seller of the part, and lines of one status are one side's sales, or one day's catalog.
``fx_raw_*`` are all-string rows with every kind of defect; in ``fx_gap_*`` competitors
sell some items under names that no catalog lists; in ``fx_null_*`` keys have nulls.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

AS_OF = "2001-06-30"

_SELLER = "concat('S', CAST(l_suppkey AS STRING))"
_ITEM = "concat('I', CAST(l_partkey AS STRING))"
_CENTS = "CAST(CAST({} AS DECIMAL(18,2)) AS STRING)"
_REPEATED = (
    "(SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem WHERE l_quantity = 50) sold"
)

_RAW_UNITS = """CASE WHEN l_orderkey % 89 = 0 THEN 'x' WHEN l_orderkey % 83 = 0 THEN '-4'
            ELSE CAST(CAST(l_quantity AS INT) AS STRING) END AS units_sold"""
_RAW_REVENUE = f"""CASE WHEN l_orderkey % 79 = 0 THEN NULL WHEN l_orderkey % 73 = 0 THEN '-10.00'
            ELSE {_CENTS.format("l_extendedprice")} END AS revenue"""
_RAW_DATE = """CASE WHEN l_orderkey % 71 = 0 THEN '2000-13-01' WHEN l_orderkey % 67 = 0 THEN NULL
            ELSE CAST(CAST(l_shipdate AS DATE) AS STRING) END AS sale_date"""
_RAW_ITEM = f"CASE WHEN l_orderkey % 97 = 0 THEN '' ELSE concat(' ', {_ITEM}) END AS item_id"


def _catalog(item_name: str) -> str:
    return f"""
SELECT {_SELLER} AS seller_id, {_ITEM} AS item_id, {item_name} AS item_name,
       p_type AS category, MAX(p_retailprice) AS marketplace_price,
       CAST(SUM(l_quantity) AS INT) AS stock_qty
FROM lineitem JOIN part ON l_partkey = p_partkey
GROUP BY l_suppkey, l_partkey, p_name, p_type"""


def _catalog_day(status: str, price: str, seller: str = _SELLER, item: str = _ITEM) -> str:
    return f"""
SELECT {seller} AS seller_id, {item} AS item_id, {price} AS marketplace_price,
       CAST(SUM(l_quantity) AS INT) AS stock_qty
FROM lineitem JOIN part ON l_partkey = p_partkey
WHERE l_linestatus = '{status}' GROUP BY {seller}, {item}"""


def _competitor_sales(item: str) -> str:
    return f"""
SELECT concat('C', CAST(l_suppkey AS STRING)) AS seller_id, {item} AS item_id,
       CAST(l_quantity AS INT) AS units_sold, l_extendedprice AS revenue,
       CAST(FLOOR(l_extendedprice / l_quantity) AS DOUBLE) AS marketplace_price,
       CAST(l_shipdate AS DATE) AS sale_date
FROM lineitem WHERE l_linestatus = 'F'"""


_NULL_SELLER = f"CASE WHEN l_suppkey % 5 = 0 THEN NULL ELSE {_SELLER} END"
_NULL_ITEM = f"CASE WHEN l_partkey % 7 = 0 THEN NULL ELSE {_ITEM} END"


FIXTURES: dict[str, str] = {
    "fx_catalog": _catalog("p_name"),
    "fx_catalog_variants": _catalog(
        "CASE WHEN l_suppkey % 10 = 0 THEN concat(p_name, ' v2') ELSE p_name END"
    ),
    "fx_company_sales": f"""
SELECT {_ITEM} AS item_id, CAST(l_quantity AS INT) AS units_sold, l_extendedprice AS revenue,
       CAST(l_shipdate AS DATE) AS sale_date
FROM lineitem WHERE l_linestatus = 'O'""",
    "fx_competitor_sales": _competitor_sales(_ITEM),
    "fx_gap_competitor_sales": _competitor_sales(
        "concat(CASE WHEN l_partkey % 5 = 0 THEN 'N' ELSE 'I' END, CAST(l_partkey AS STRING))"
    ),
    "fx_raw_catalog": f"""
SELECT CASE WHEN l_orderkey % 97 = 0 THEN NULL
            WHEN l_orderkey % 89 = 0 THEN '  '
            ELSE concat(' ', {_SELLER}, ' ') END AS seller_id,
       CASE WHEN l_orderkey % 83 = 0 THEN '' ELSE {_ITEM} END AS item_id,
       CASE WHEN l_orderkey % 79 = 0 THEN NULL ELSE concat(' ', upper(p_name)) END AS item_name,
       CASE WHEN l_orderkey % 73 = 0 THEN '' ELSE lower(p_type) END AS category,
       CASE WHEN l_orderkey % 71 = 0 THEN 'abc'
            WHEN l_orderkey % 67 = 0 THEN '-1.50'
            ELSE {_CENTS.format("l_extendedprice")} END AS marketplace_price,
       CASE WHEN l_orderkey % 61 = 0 THEN 'n/a'
            WHEN l_orderkey % 59 = 0 THEN '-5'
            WHEN l_orderkey % 53 = 0 THEN '12.7'
            ELSE CAST(CAST(l_quantity AS INT) AS STRING) END AS stock_qty
FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "fx_raw_company_sales": f"""
SELECT {_RAW_ITEM}, {_RAW_UNITS}, {_RAW_REVENUE}, {_RAW_DATE}
FROM {_REPEATED} WHERE l_linestatus = 'O'""",
    "fx_raw_competitor_sales": f"""
SELECT CASE WHEN l_orderkey % 61 = 0 THEN NULL
            ELSE concat('C', CAST(l_suppkey AS STRING)) END AS seller_id,
       {_RAW_ITEM}, {_RAW_UNITS}, {_RAW_REVENUE},
       CASE WHEN l_orderkey % 59 = 0 THEN 'n/a' WHEN l_orderkey % 53 = 0 THEN '-2.00'
            ELSE {_CENTS.format("FLOOR(l_extendedprice / l_quantity)")} END AS marketplace_price,
       {_RAW_DATE}
FROM {_REPEATED} WHERE l_linestatus = 'F'""",
    "fx_catalog_day1": _catalog_day("F", "MAX(p_retailprice)"),
    "fx_catalog_day2": _catalog_day(
        "O", "CAST(CAST(MAX(p_retailprice) * 1.1 AS DECIMAL(18,2)) AS DOUBLE)"
    ),
    "fx_null_day1": _catalog_day("F", "MAX(p_retailprice)", _NULL_SELLER, _NULL_ITEM),
    "fx_null_day2": _catalog_day("O", "MAX(p_retailprice)", _NULL_SELLER, _NULL_ITEM),
}


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A fixture over the parquet tables in ``sf_dir``."""
    return spark.sql(
        f"WITH lineitem AS (SELECT * FROM parquet.`{sf_dir}/lineitem.parquet`), "
        f"part AS (SELECT * FROM parquet.`{sf_dir}/part.parquet`) {FIXTURES[name]}"
    )
