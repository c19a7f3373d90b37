"""DuckDB SQL for every registered query, written from the definitions.

The recommendation SQL builds all pairs and removes the stocked ones, and the
item SQL joins before it sums: none of it shares the shape of the Spark plans.
"""

from __future__ import annotations

from typing import NamedTuple

from .fixtures import AS_OF, FIXTURES
from .queries import COMMITS, DAY_1, DAY_2


class Shape(NamedTuple):
    """What the definitions say of a dataset; nothing of it is taken from the library under test."""

    name: str
    fields: tuple[tuple[str, str, str | None], ...]
    keys: tuple[str, ...]
    order_by: str
    constants: tuple[tuple[str, str], ...] = ()
    unique_by_key: bool = False

    @property
    def columns(self) -> list[str]:
        return [name for name, _, _ in self.fields]


_SALES = (("units_sold", "int", "0"), ("revenue", "double", "0.0"))
SELLER_CATALOG = Shape(
    "seller_catalog",
    (
        ("seller_id", "text", None),
        ("item_id", "text", None),
        ("item_name", "title", None),
        ("category", "title", None),
        ("marketplace_price", "double", None),
        ("stock_qty", "int", "0"),
    ),
    ("seller_id", "item_id"),
    "marketplace_price",
    unique_by_key=True,
)
COMPANY_SALES = Shape("company_sales", (("item_id", "text", None), *_SALES, ("sale_date", "date", None)), ("item_id",), "sale_date")
COMPETITOR_SALES = Shape(
    "competitor_sales",
    (
        ("seller_id", "text", None),
        ("item_id", "text", None),
        *_SALES,
        ("marketplace_price", "double", "0.0"),
        ("sale_date", "date", None),
    ),
    ("seller_id", "item_id"),
    "sale_date",
    constants=(("partition_col", "default"),),
)
RAW = {
    "catalog": (SELLER_CATALOG, "fx_raw_catalog"),
    "company": (COMPANY_SALES, "fx_raw_company_sales"),
    "competitor": (COMPETITOR_SALES, "fx_raw_competitor_sales"),
}

# Fixed patterns of the typed readers, in RE2 syntax.
INT_PATTERN = r"^\s*([+-]?\d+)(\.\d*)?\s*$"
DATE_PATTERN = r"^\s*(\d{4})-(\d{1,2})-(\d{1,2})(?:\D|$)"


def _with(body: str, **ctes: str) -> str:
    """``body`` over the fixtures it names and the given CTEs, in order."""
    text = body + " ".join(ctes.values())
    parts = [f"{name} AS ({sql})" for name, sql in FIXTURES.items() if name in text]
    parts += [f"{name} AS ({sql})" for name, sql in ctes.items()]
    return f"WITH {', '.join(parts)} {body}" if parts else body


def _money_sum(column: str) -> str:
    return f"CAST(SUM(CAST({column} AS DECIMAL(18,2))) AS DOUBLE)"


def _half_up(value: str) -> str:
    """Two decimals, ties up, decided on the shortest decimal form of the double."""
    return f"CAST(ROUND(CAST(CAST({value} AS VARCHAR) AS DECIMAL(38,18)), 2) AS DOUBLE)"


# --- cleaning, rules, de-duplication ---------------------------------------------


def _title(column: str) -> str:
    return (
        f"array_to_string(list_transform(string_split(TRIM({column}), ' '), "
        "lambda w: upper(w[1]) || lower(w[2:])), ' ')"
    )


def _date_part(column: str, group: int) -> str:
    return f"regexp_extract({column}, '{DATE_PATTERN}', {group})"


def _cleaned(kind: str, column: str) -> str:
    if kind == "text":
        return f"TRIM({column})"
    if kind == "title":
        return _title(column)
    if kind == "double":
        return f"TRY_CAST({column} AS DOUBLE)"
    if kind == "int":
        return f"TRY_CAST(NULLIF(regexp_extract({column}, '{INT_PATTERN}', 1), '') AS INTEGER)"
    year, month, day = (_date_part(column, group) for group in (1, 2, 3))
    return f"TRY_CAST({year} || '-' || lpad({month}, 2, '0') || '-' || lpad({day}, 2, '0') AS DATE)"


def _clean_sql(spec: Shape, source: str) -> str:
    columns = []
    for name, kind, default in spec.fields:
        value = _cleaned(kind, name)
        if default is not None:
            value = f"COALESCE({value}, {default})"
        columns.append(f"{value} AS {name}")
    return f"SELECT {', '.join(columns)} FROM {source}"


_FUTURE = f"sale_date IS NULL OR sale_date > DATE '{AS_OF}'"
RULES = {
    "catalog": [
        ("seller_id_missing", "seller_id IS NULL OR seller_id = ''"),
        ("item_id_missing", "item_id IS NULL OR item_id = ''"),
        ("item_name_missing", "item_name IS NULL OR item_name = ''"),
        ("category_missing", "category IS NULL OR category = ''"),
        ("price_invalid", "marketplace_price IS NULL OR marketplace_price < 0"),
        ("stock_qty_negative", "stock_qty < 0"),
    ],
    "company": [
        ("item_id_missing", "item_id IS NULL OR item_id = ''"),
        ("units_sold_negative", "units_sold < 0"),
        ("revenue_negative", "revenue < 0"),
        ("sale_date_invalid", _FUTURE),
    ],
    "competitor": [
        ("item_id_missing", "item_id IS NULL OR item_id = ''"),
        ("seller_id_missing", "seller_id IS NULL OR seller_id = ''"),
        ("units_sold_negative", "units_sold < 0"),
        ("revenue_negative", "revenue < 0"),
        ("marketplace_price_negative", "marketplace_price < 0"),
        ("sale_date_invalid", _FUTURE),
    ],
}


def _reason_sql(short: str) -> str:
    return " || ".join(
        f"CASE WHEN {condition} THEN '{code};' ELSE '' END" for code, condition in RULES[short]
    )


def _etl_ctes(short: str, prefix: str = "") -> dict[str, str]:
    """CTEs ``cleaned``, ``checked``, ``valid``, ``trusted`` and ``snapshot`` of a dataset."""
    spec, raw = RAW[short]
    names = {n: prefix + n for n in ("cleaned", "checked", "valid", "trusted", "snapshot")}
    columns = ", ".join(spec.columns)
    if spec.unique_by_key:
        order = "marketplace_price DESC, stock_qty DESC, item_name, category"
        trusted = _first_per_key(names["valid"], columns, spec.keys, order)
    else:
        trusted = f"SELECT DISTINCT * FROM {names['valid']}"
    return {
        names["cleaned"]: _clean_sql(spec, raw),
        names["checked"]: f"SELECT *, {_reason_sql(short)} AS dq_failure_reason FROM {names['cleaned']}",
        names["valid"]: f"SELECT {columns} FROM {names['checked']} WHERE dq_failure_reason = ''",
        names["trusted"]: trusted,
        names["snapshot"]: _snapshot_sql(spec, names["trusted"]),
    }


def _first_per_key(source: str, columns: str, keys, order: str) -> str:
    return (
        f"SELECT {columns} FROM (SELECT *, row_number() OVER (PARTITION BY {', '.join(keys)} "
        f"ORDER BY {order}) AS rn FROM {source}) WHERE rn = 1"
    )


def _snapshot_sql(spec: Shape, source: str) -> str:
    rest = [c for c in spec.columns if c not in spec.keys and c != spec.order_by]
    order = ", ".join(f"{c} DESC" for c in [spec.order_by, *rest])
    columns = ", ".join([*spec.columns, *(f"'{v}' AS {n}" for n, v in spec.constants)])
    return _first_per_key(source, columns, spec.keys, order)


def _dataset_oracles(short: str) -> dict[str, str]:
    spec, raw = RAW[short]
    ctes = _etl_ctes(short)
    scanned = ", ".join(f"NULLIF(TRIM({c}), '') AS {c}" for c in spec.columns)
    return {
        f"scan_{short}_csv": _with(f"SELECT {scanned} FROM {raw}"),
        f"clean_{short}": _with("SELECT * FROM cleaned", **ctes),
        f"dq_{short}": _with("SELECT * FROM checked", **ctes),
        f"valid_{short}": _with("SELECT * FROM valid", **ctes),
        f"quarantine_{short}": _with("SELECT * FROM checked WHERE dq_failure_reason <> ''", **ctes),
        f"dedup_{short}": _with("SELECT * FROM trusted", **ctes),
        f"gold_{short}": _with("SELECT * FROM snapshot", **ctes),
    }


def _reason_counts() -> str:
    ctes: dict[str, str] = {}
    selects = []
    for short, (spec, _) in RAW.items():
        ctes |= _etl_ctes(short, f"{short}_")
        selects += [
            f"SELECT '{spec.name}' AS dataset, '{code}' AS dq_code, "
            f"COUNT(*) FILTER (WHERE {condition}) AS n_rows FROM {short}_cleaned"
            for code, condition in RULES[short]
        ]
    return _with(" UNION ALL ".join(selects), **ctes)


def _run_metrics() -> str:
    ctes: dict[str, str] = {}
    selects = []
    for short, (spec, _) in RAW.items():
        ctes |= _etl_ctes(short, f"{short}_")
        counts = (
            f"(SELECT COUNT(*) FROM {short}_cleaned) AS i, "
            f"(SELECT COUNT(*) FROM {short}_valid) AS v, "
            f"(SELECT COUNT(*) FROM {short}_trusted) AS o"
        )
        share = "CAST({0} AS DOUBLE) / i * 100"
        selects.append(
            f"SELECT 'etl_{spec.name}' AS pipeline_name, 'SUCCESS' AS status, i AS input_count, "
            "v AS valid_count, i - v AS invalid_count, v - o AS duplicate_count, o AS output_count, "
            f"{_half_up(share.format('v'))} AS valid_percentage, "
            f"{_half_up(share.format('(i - v)'))} AS invalid_percentage, "
            f"CAST(0 AS INTEGER) AS n_errors FROM (SELECT {counts})"
        )
    return _with(" UNION ALL ".join(selects), **ctes)


# --- sources -----------------------------------------------------------------------


def _csv_cell(column: str) -> str:
    """Bytes a string takes in an unquoted CSV row; the empty string is ``""``."""
    return f"CASE WHEN {column} = '' THEN 2 ELSE COALESCE(strlen({column}), 0) END"


def _landing_oracles() -> dict[str, str]:
    ctes = _etl_ctes("company")
    # The rows in reverse column order break the header's rule; they land nowhere else.
    counts = "(SELECT COUNT(*) FROM cleaned) AS n, (SELECT COUNT(*) FROM valid) AS v"
    return {
        "etl_swapped_header": _with("SELECT * FROM trusted", **ctes),
        "etl_swapped_quarantine": _with(f"SELECT n AS wrong_header, n - v AS other_reasons FROM (SELECT {counts})", **ctes),
        "landing_run": _with("SELECT * FROM snapshot", **ctes),
        "landing_run_unique": _with("SELECT * FROM trusted", **ctes),
        "landing_run_summary": _with(
            "SELECT CAST(2 AS BIGINT) AS runs, 2 * n + e AS rows_in, v + ve AS rows_valid, "
            f"(SELECT COUNT(*) FROM snapshot) AS inserts FROM (SELECT {counts}, "
            f"(SELECT COUNT(*) FROM fx_raw_company_sales WHERE sale_date < '1997-01-01') AS e, "
            "(SELECT COUNT(*) FROM valid WHERE sale_date < DATE '1997-01-01') AS ve)",
            **ctes,
        ),
    }


def _source_oracles() -> dict[str, str]:
    sales = COMPANY_SALES.columns
    scanned = ", ".join(f"NULLIF(TRIM({c}), '') AS {c}" for c in sales)
    row_bytes = " + ".join([*(_csv_cell(c) for c in sales), str(len(sales))])
    return {
        "scan_gold_snapshot": _with("SELECT * FROM fx_catalog"),
        "ingest_landing": _with(f"SELECT {scanned} FROM fx_raw_company_sales"),
        "file_inventory": _with(
            f"SELECT 'sales' AS folder, CAST(SUM({row_bytes}) AS BIGINT) AS total_bytes, "
            "CAST(0 AS BIGINT) AS empty_files FROM fx_raw_company_sales "
            "UNION ALL SELECT 'nothing', 0, 1"
        ),
        "header_contract": (
            "SELECT 'in_order' AS folder, TRUE AS header_ok UNION ALL SELECT 'reversed', FALSE"
        ),
        "min_row_count": _with(
            "SELECT 'sales' AS folder, COUNT(*) AS n_rows, COUNT(*) >= 10 AS enough_rows "
            "FROM fx_raw_catalog "
            "UNION ALL SELECT 'regions', COUNT(*), COUNT(*) >= 10 FROM region"
        ),
        "dataset_verdict": (
            "SELECT 'seller_catalog' AS dataset, TRUE AS has_files, TRUE AS passed "
            "UNION ALL SELECT 'company_sales', TRUE, FALSE "
            "UNION ALL SELECT 'competitor_sales', FALSE, FALSE"
        ),
    }


# --- merges ------------------------------------------------------------------------

_SAME_KEY = "d.seller_id = b.seller_id AND d.item_id = b.item_id"
_MERGED = (
    "SELECT * FROM fx_catalog_day1 b WHERE NOT EXISTS "
    f"(SELECT 1 FROM fx_catalog_day2 d WHERE {_SAME_KEY}) "
    "UNION ALL SELECT * FROM fx_catalog_day2"
)


def _merge_oracles() -> dict[str, str]:
    evolved = (
        "SELECT *, CAST(NULL AS BOOLEAN) AS restocked FROM fx_catalog_day1 "
        "UNION ALL SELECT *, stock_qty > 50 FROM fx_catalog_day2"
    )
    log = (
        f"SELECT *, '{DAY_1}' AS commit_time FROM fx_catalog_day1 "
        f"UNION ALL SELECT *, '{DAY_2}' FROM fx_catalog_day2"
    )
    columns = "seller_id, item_id, marketplace_price, stock_qty, commit_time"
    versions = []
    for instant in ("20010101120000000", "20010102120000000"):
        seen = f"(SELECT * FROM log WHERE commit_time <= '{instant}')"
        newest = _first_per_key(seen, columns, ("seller_id", "item_id"), "commit_time DESC")
        versions.append(f"SELECT *, '{instant}' AS instant FROM ({newest})")
    split_log = (
        f"SELECT *, '{COMMITS[0]}' AS commit_time FROM fx_catalog_day1 UNION ALL "
        f"SELECT *, CASE WHEN seller_id < 'S5' THEN '{COMMITS[1]}' ELSE '{COMMITS[2]}' END FROM fx_catalog_day2"
    )
    logged = []
    for instant in COMMITS:
        seen = f"(SELECT * FROM log WHERE commit_time <= '{instant}')"
        newest = _first_per_key(seen, columns, ("seller_id", "item_id"), "commit_time DESC")
        logged.append(f"SELECT *, '{instant}' AS instant FROM ({newest})")
    summary = _with(
        "SELECT COUNT(*) FILTER (WHERE b.item_id IS NULL) AS inserts, "
        "COUNT(*) FILTER (WHERE b.item_id IS NOT NULL AND d.item_id IS NOT NULL) AS updates, "
        "COUNT(*) AS total_rows "
        f"FROM fx_catalog_day1 b FULL OUTER JOIN fx_catalog_day2 d ON {_SAME_KEY}"
    )
    null_key = "d.seller_id IS NOT DISTINCT FROM b.seller_id AND d.item_id IS NOT DISTINCT FROM b.item_id"
    null_merged = (
        f"SELECT * FROM fx_null_day1 b WHERE NOT EXISTS (SELECT 1 FROM fx_null_day2 d WHERE {null_key}) "
        "UNION ALL SELECT * FROM fx_null_day2"
    )
    null_summary = _with(
        "SELECT COUNT(*) FILTER (WHERE b.stock_qty IS NULL) AS inserts, "
        "COUNT(*) FILTER (WHERE b.stock_qty IS NOT NULL AND d.stock_qty IS NOT NULL) AS updates, "
        f"COUNT(*) AS total_rows FROM fx_null_day1 b FULL OUTER JOIN fx_null_day2 d ON {null_key}"
    )
    return {
        "merge_null_keys": _with(null_merged),
        "merge_summary_null_keys": null_summary,
        "bucketed_upsert": _with(null_merged),
        "bucketed_upsert_summary": null_summary,
        "merge_catalog": _with(_MERGED),
        "merge_replay": _with(_MERGED),
        "upsert_snapshot": _with(
            "SELECT *, 'Item ' || item_id AS item_name, 'Shelf ' || right(item_id, 1) AS category "
            f"FROM ({_MERGED})"
        ),
        "merge_summary": summary,
        "upsert_summary": summary,
        "table_as_of": _with(" UNION ALL ".join(versions), log=log),
        "commit_log_as_of": _with(" UNION ALL ".join(logged), log=split_log),
        "commit_timeline": _with(
            "SELECT commit_time, COUNT(*) AS rows_written FROM log GROUP BY commit_time", log=log
        ),
        "schema_reconcile": _with(evolved),
        "schema_reconcile_union": _with(evolved),
    }


# --- items and recommendations -------------------------------------------------------


def _analytics(catalog: str, company: str, competitor: str) -> dict[str, str]:
    """CTEs from the three datasets down to recommendations and the gap."""
    return {
        "variants": f"SELECT DISTINCT item_id, category, item_name FROM {catalog}",
        "sales": (
            f"SELECT s.item_id, s.units_sold, s.revenue, s.sale_date, v.category, v.item_name "
            f"FROM {company} s LEFT JOIN variants v ON s.item_id = v.item_id"
        ),
        "by_category": (
            "SELECT item_id, category, item_name, CAST(SUM(units_sold) AS BIGINT) AS total_units_sold, "
            f"{_money_sum('revenue')} AS total_revenue FROM sales GROUP BY item_id, category, item_name"
        ),
        "top_company": (
            "SELECT * FROM (SELECT item_id, category, item_name, total_units_sold, "
            "CAST(row_number() OVER (PARTITION BY category ORDER BY total_units_sold DESC, item_id, "
            "item_name NULLS FIRST) AS INTEGER) AS rank FROM by_category) WHERE rank <= 10"
        ),
        "company_totals": (
            "SELECT item_id, CAST(SUM(units_sold) AS BIGINT) AS total_units_sold, "
            f"{_money_sum('revenue')} AS total_revenue FROM {company} GROUP BY item_id"
        ),
        "competitor_totals": (
            "SELECT item_id, CAST(SUM(units_sold) AS BIGINT) AS total_units_sold, "
            f"{_money_sum('revenue')} AS total_revenue, "
            f"{_money_sum('marketplace_price')} / COUNT(marketplace_price) AS avg_marketplace_price, "
            f"COUNT(DISTINCT seller_id) AS num_sellers FROM {competitor} GROUP BY item_id"
        ),
        "top_competitor": (
            "SELECT t.item_id, v.category, v.item_name, total_units_sold, avg_marketplace_price, "
            "CASE WHEN num_sellers > 0 THEN CAST(total_units_sold AS DOUBLE) / num_sellers "
            "ELSE CAST(total_units_sold AS DOUBLE) END AS expected_units_sold, num_sellers "
            "FROM competitor_totals t LEFT JOIN variants v ON t.item_id = v.item_id "
            "ORDER BY total_units_sold DESC, t.item_id, category NULLS FIRST, item_name NULLS FIRST "
            "LIMIT 10"
        ),
        "top_items": (
            "SELECT item_id, category, item_name FROM top_company "
            "UNION SELECT item_id, category, item_name FROM top_competitor"
        ),
        "seller_counts": (
            "SELECT item_id, COUNT(DISTINCT seller_id) AS company_seller_count "
            f"FROM {catalog} GROUP BY item_id"
        ),
        "company_m": (
            "SELECT t.item_id, total_units_sold AS company_total_units, "
            "total_revenue AS company_total_revenue, "
            "CASE WHEN total_units_sold > 0 THEN total_revenue / total_units_sold END "
            "AS company_market_price, company_seller_count, "
            "CASE WHEN company_seller_count > 0 "
            "THEN CAST(total_units_sold AS DOUBLE) / company_seller_count "
            "ELSE CAST(total_units_sold AS DOUBLE) END AS company_expected_units "
            "FROM company_totals t LEFT JOIN seller_counts c ON t.item_id = c.item_id"
        ),
        "competitor_m": (
            "SELECT item_id, total_units_sold AS competitor_total_units, "
            "total_revenue AS competitor_total_revenue, "
            "avg_marketplace_price AS competitor_market_price, "
            "num_sellers AS competitor_seller_count, "
            "CASE WHEN num_sellers > 0 THEN CAST(total_units_sold AS DOUBLE) / num_sellers "
            "ELSE CAST(total_units_sold AS DOUBLE) END AS competitor_expected_units "
            "FROM competitor_totals"
        ),
        "metrics": "SELECT * FROM competitor_m FULL OUTER JOIN company_m USING (item_id)",
        "pairs": (
            f"SELECT s.seller_id, t.item_id, t.category, t.item_name "
            f"FROM (SELECT DISTINCT seller_id FROM {catalog}) s CROSS JOIN top_items t"
        ),
        "missing": (
            f"SELECT p.* FROM pairs p WHERE NOT EXISTS (SELECT 1 FROM {catalog} c "
            "WHERE c.seller_id = p.seller_id AND c.item_id = p.item_id)"
        ),
        "figures": (
            "SELECT p.*, COALESCE(company_market_price, competitor_market_price, 0.0) AS price, "
            "COALESCE(company_expected_units, competitor_expected_units, 0.0) AS units "
            "FROM missing p LEFT JOIN metrics m ON p.item_id = m.item_id"
        ),
        "recommendations": (
            f"SELECT seller_id, item_id, item_name, category, {_half_up('price')} AS market_price, "
            f"{_half_up('units')} AS expected_units_sold, "
            f"{_half_up('units * price')} AS expected_revenue FROM figures"
        ),
        "gap": (
            "SELECT item_id, item_name, category, total_units_sold, "
            f"{_half_up('avg_marketplace_price')} AS market_price, "
            f"{_half_up('expected_units_sold')} AS expected_units_sold FROM top_competitor t "
            f"WHERE NOT EXISTS (SELECT 1 FROM {catalog} c WHERE c.item_id = t.item_id)"
        ),
    }


def _analytics_oracles() -> dict[str, str]:
    base = _analytics("fx_catalog", "fx_company_sales", "fx_competitor_sales")
    variants = _analytics("fx_catalog_variants", "fx_company_sales", "fx_competitor_sales")

    def over(name: str, ctes: dict[str, str] = base) -> str:
        return _with(f"SELECT * FROM {name}", **ctes)

    keyed = {
        "keyed_company": _snapshot_sql(COMPANY_SALES, "fx_company_sales"),
        "keyed_competitor": _snapshot_sql(COMPETITOR_SALES, "fx_competitor_sales"),
    } | _analytics("fx_catalog", "keyed_company", "keyed_competitor")

    gap = over("gap", _analytics("fx_catalog", "fx_company_sales", "fx_gap_competitor_sales"))
    raw: dict[str, str] = {}
    for short in RAW:
        raw |= _etl_ctes(short, f"{short}_")
    raw |= _analytics("catalog_trusted", "company_trusted", "competitor_trusted")

    checks = {
        "negative_revenue": "expected_revenue < 0",
        "nonpositive_units": "expected_units_sold <= 0",
        "nonpositive_price": "market_price <= 0",
        "null_seller_id": "seller_id IS NULL",
        "null_item_id": "item_id IS NULL",
        "null_revenue": "expected_revenue IS NULL",
    }
    counts = ", ".join(f"COUNT(*) FILTER (WHERE {c}) AS {n}" for n, c in checks.items())
    return {
        "sales_with_category": over("sales", variants),
        "item_sales_by_category": over("by_category", variants),
        "distinct_sellers": _with("SELECT DISTINCT seller_id FROM fx_catalog"),
        "distinct_catalog_items": _with("SELECT DISTINCT item_id FROM fx_catalog"),
        "distinct_catalog_variants": over("variants", variants),
        "catalog_seller_counts": over("seller_counts"),
        "company_item_totals": over("company_totals"),
        "competitor_item_totals": over("competitor_totals"),
        "company_metrics": over("company_m"),
        "competitor_metrics": over("competitor_m"),
        "item_metrics": over("metrics"),
        "top_company_items": over("top_company"),
        "top_competitor_items": over("top_competitor"),
        "top_company_items_variants": over("top_company", variants),
        "top_competitor_items_variants": over("top_competitor", variants),
        "all_top_items": over("top_items"),
        "seller_item_pairs": over("pairs"),
        "missing_items": over("missing"),
        "missing_catalog_variants": _with(
            "SELECT s.seller_id, COUNT(*) AS variants, COUNT(DISTINCT v.item_id) AS items, MIN(v.item_id) AS first_item "
            "FROM (SELECT DISTINCT seller_id FROM fx_catalog_variants) s CROSS JOIN variants v "
            "WHERE NOT EXISTS (SELECT 1 FROM fx_catalog_variants c WHERE c.seller_id = s.seller_id AND c.item_id = v.item_id) "
            "GROUP BY s.seller_id",
            **variants,
        ),
        "seller_recommendations": over("recommendations"),
        "seller_recommendations_from_lists": over("recommendations"),
        "seller_recommendations_variants": over("recommendations", variants),
        "seller_recommendations_keyed": over("recommendations", keyed),
        "end_to_end_recommendations": over("recommendations", raw),
        "recommendations_csv": over("recommendations"),
        "published_recommendations": over("recommendations"),
        "published_gap": gap,
        "company_gap": gap,
        "gap_csv": gap,
        "recommendation_checks": _with(
            f"SELECT *, {' + '.join(checks)} = 0 AS passed FROM (SELECT {counts} FROM recommendations)",
            **base,
        ),
        "recommendation_stats": _with(
            "SELECT COUNT(*) AS total_recommendations, "
            "COUNT(DISTINCT seller_id) AS unique_sellers, COUNT(DISTINCT item_id) AS unique_items, "
            f"{_half_up(_money_sum('expected_revenue') + ' / COUNT(expected_revenue)')} AS avg_revenue, "
            "MAX(expected_revenue) AS max_revenue, MIN(expected_revenue) AS min_revenue "
            "FROM recommendations",
            **base,
        ),
    }


def _all_oracles() -> dict[str, str]:
    oracles: dict[str, str] = {}
    for short in RAW:
        oracles |= _dataset_oracles(short)
    oracles |= _source_oracles() | _landing_oracles() | _merge_oracles() | _analytics_oracles()
    oracles["dq_reason_counts"] = _reason_counts()
    oracles["run_metrics"] = _run_metrics()
    oracles["run_summary"] = f"SELECT *, CAST(NULL AS VARCHAR) AS first_error, TRUE AS timed FROM ({_run_metrics()})"
    return oracles


ORACLES: dict[str, str] = _all_oracles()
