"""Data-quality reports."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tallyline.operators import anomalies, core, ingest, marts, quality, staging
from tallyline.registry.base import ANOMALY_INPUT, Inputs, query
from tallyline.registry.sql import CHANNELS, REGIONS, SEGMENTS, _canonical, in_list, pct, sql
from tallyline.schemas import SALES_CHECKS, TABLE_KEYS
from tallyline.sources.tables import stage_table
from tallyline.sources.warehouse import LOAD_ORDER, TEST_DOMAINS

PROFILE_COLUMNS = (
    "transaction_id", "record_date", "product_name", "product_category", "region", "sales_rep",
    "customer_id", "customer_segment", "channel", "units_sold", "unit_price", "revenue", "cost",
    "discount_pct",
)
CATEGORIES = TEST_DOMAINS.categories


def _rows(key: str, value: str, source: str, entries: dict[str, str], *more: str) -> str:
    """``entries`` as rows of a UNION ALL, each an aggregate over ``source``."""
    return sql(
        "\nUNION ALL ".join(
            f"SELECT '{name}' AS {key}, {agg} AS {value} FROM {source}"
            for name, agg in entries.items()
        ),
        source,
        *more,
    )


CHECKS = {
    "NULL_TRANSACTION_ID": "count_if(transaction_id IS NULL OR trim(transaction_id) = '')",
    "NULL_RECORD_DATE": "count_if(record_date IS NULL)",
    "NULL_REVENUE": "count_if(revenue IS NULL)",
    "NEGATIVE_REVENUE": "count_if(revenue < 0)",
    "NEGATIVE_COST": "count_if(cost < 0)",
    "INVALID_DISCOUNT": "count_if(discount_pct < 0 OR discount_pct > 100)",
    "ZERO_UNITS": "count_if(units_sold <= 0)",
    "DUPLICATE_TXN_IDS": "count(*) - count(DISTINCT transaction_id)",
}


@query("dq_check_report", _rows("check_name", "affected_rows", "parsed", CHECKS))
def dq_check_report(src: Inputs) -> DataFrame:
    return quality.check_report(src.parsed("part"))


@query(
    "dq_duplicate_ids",
    sql("""SELECT count(*) AS total_rows,
        count(*) - count(DISTINCT transaction_id) AS duplicate_rows FROM raw""", "raw"),
)
def dq_duplicate_ids(src: Inputs) -> DataFrame:
    return quality.duplicate_ids(src.sales_raw("part"))


@query(
    "dq_domain_check",
    _rows("column_name", "out_of_domain_rows", "raw", {
        "region": f"count_if(region NOT IN {in_list(REGIONS)})",
        "channel": f"count_if(channel NOT IN {in_list(CHANNELS)})",
        "customer_segment": f"count_if(customer_segment NOT IN {in_list(SEGMENTS)})",
        "product_category": f"count_if(product_category NOT IN {in_list(CATEGORIES)})",
    }),
)
def dq_domain_check(src: Inputs) -> DataFrame:
    return quality.domain_check(src.sales_raw("customer", "part"), TEST_DOMAINS)


def _key_sql(table: str, keys: tuple[str, ...]) -> str:
    return f"""SELECT '{table}' AS table_name, count(*) AS repeated_keys,
        cast(coalesce(sum(n - 1), 0) AS bigint) AS extra_rows
        FROM (SELECT count(*) AS n FROM {{}} GROUP BY {', '.join(keys)} HAVING count(*) > 1)"""


@query(
    "dq_unique_key",
    sql("\nUNION ALL ".join(
        _key_sql(name, keys).format(cte)
        for name, keys, cte in (
            ("stg_sales_raw", TABLE_KEYS["stg_sales_raw"], "staged"),
            ("core_sales", TABLE_KEYS["core_sales"], "clean"),
            ("rpt_monthly_revenue", TABLE_KEYS["rpt_monthly_revenue"], "monthly"),
            ("rpt_regional_summary", TABLE_KEYS["rpt_regional_summary"], "regional"),
            ("rpt_product_summary", TABLE_KEYS["rpt_product_summary"], "product"),
            ("rpt_anomalies", TABLE_KEYS["rpt_anomalies"], "anomalies"),
        )
    ), "staged", "clean", "monthly", "regional", "product", "anomalies"),
)
def dq_unique_key(src: Inputs) -> DataFrame:
    """The raw sales are parsed once, for the staging table, the fact and the anomalies."""
    staged = stage_table(src.staged("customer", "part"), "staged")
    clean = stage_table(staging.keep_first(staged, order=LOAD_ORDER), "clean")
    frames = {
        "stg_sales_raw": staged,
        "core_sales": clean,
        **marts.all_marts(src.cube()),
        "rpt_anomalies": anomalies.detect_all(core.enrich(clean).select(*ANOMALY_INPUT)),
    }
    return quality.key_report({n: (df, TABLE_KEYS[n]) for n, df in frames.items()})


def _constraint_entries() -> dict[str, str]:
    out = {}
    for check in SALES_CHECKS:
        out[f"{check.name}:not_null"] = f"count_if({check.name} IS NULL)"
        if check.max_len is not None:
            out[f"{check.name}:max_len_{check.max_len}"] = (
                f"count_if(length({check.name}) > {check.max_len})"
            )
        if check.digits is not None:
            out[f"{check.name}:digits_{check.digits}"] = (
                f"count_if(abs({check.name}) >= {10 ** check.digits})"
            )
    return out


@query(
    "dq_not_null_and_fit",
    _rows("constraint_name", "violations", "parsed", _constraint_entries()),
)
def dq_not_null_and_fit(src: Inputs) -> DataFrame:
    return quality.constraint_violations(src.parsed())


@query(
    "dq_null_counts",
    _rows("column_name", "null_count", "parsed",
          {c: f"count_if({c} IS NULL)" for c in PROFILE_COLUMNS}),
)
def dq_null_counts(src: Inputs) -> DataFrame:
    return quality.null_counts(src.parsed(), PROFILE_COLUMNS)


@query(
    "dq_completeness",
    _rows("column_name", "completeness_pct", "parsed",
          {c: pct(f"count({c})", "count(*)", 4)
           for c in PROFILE_COLUMNS}),
)
def dq_completeness(src: Inputs) -> DataFrame:
    return quality.completeness(src.parsed(), PROFILE_COLUMNS)


def _line(name: str, rows: str, action: str, result: str) -> str:
    return f"""SELECT '{name}' AS check_name, n AS rows_affected, '{action}' AS action_taken,
        CASE WHEN n = 0 THEN 'CLEAN' ELSE {result} END AS result FROM (SELECT count_if({rows}) AS n FROM tagged)"""


def _rejected(reason: str, test: str) -> str:
    return _line(f"reject {reason}", test, "row rejected", "'REJECTED'")


def _repaired(column: str, fixed: str) -> str:
    return _line(f"repair {column}", f"NOT is_bad AND ({fixed}) IS DISTINCT FROM {column}",
                 "value replaced", "'REPAIRED'")


def _respelt(column: str, values: tuple[str, ...]) -> str:
    spelt = _canonical(column, values)
    unknown = f"SELECT count_if(NOT is_bad AND {spelt} NOT IN {in_list(values)}) > 0 FROM tagged"
    return _line(f"repair {column}", f"NOT is_bad AND {spelt} IS DISTINCT FROM {column}",
                 "spelling replaced", f"CASE WHEN ({unknown}) THEN 'UNKNOWN VALUES' ELSE 'REPAIRED' END")


def _unfit(column: str, limit: int) -> str:
    return _rejected(f"OUT_OF_RANGE_{column.upper()}", f"abs({column}) >= {limit}")


@query(
    "dq_validation_results",
    sql("\nUNION ALL ".join((
        _rejected("NULL_TRANSACTION_ID", "transaction_id IS NULL"),
        _rejected("BLANK_TRANSACTION_ID", "trim(transaction_id) = ''"),
        _rejected("NULL_DATE", "date IS NULL"),
        _rejected("INVALID_DATE", "date IS NOT NULL AND record_date IS NULL"),
        _rejected("NULL_REVENUE", "revenue IS NULL"),
        _rejected("NEGATIVE_REVENUE", "revenue < 0"),
        _unfit("units_sold", 2 ** 31), _unfit("unit_price", 10 ** 10),
        _unfit("revenue", 10 ** 12), _unfit("cost", 10 ** 12),
        _repaired("discount_pct", "coalesce(least(greatest(discount_pct, 0), 100), 0)"),
        _repaired("units_sold", "trunc(greatest(coalesce(units_sold, 1), 1))"),
        _repaired("cost", "coalesce(cost, 0)"),
        _respelt("region", REGIONS), _respelt("channel", CHANNELS),
        _respelt("customer_segment", SEGMENTS),
    )), "tagged"),
)
def dq_validation_results(src: Inputs) -> DataFrame:
    return quality.validation_results(src.parsed("customer", "part"), TEST_DOMAINS)


@query(
    "dq_quality_score",
    sql(f"""SELECT *, quality_score_pct >= 98 AS meets_threshold FROM (
        SELECT count_if(NOT is_bad) AS rows_loaded, count_if(is_bad) AS rows_rejected,
        {pct('count_if(NOT is_bad)', 'count(*)', 4)} AS quality_score_pct
        FROM tagged)""", "tagged"),
)
def dq_quality_score(src: Inputs) -> DataFrame:
    return quality.quality_score(ingest.ingest_counts(src.parsed("part")))


@query(
    "dq_issue_totals",
    sql("""SELECT *, discounts_fixed + units_fixed + costs_fixed AS issues_auto_fixed FROM (
        SELECT count_if(is_bad) AS rows_rejected,
        count_if(NOT is_bad AND (discount_pct < 0 OR discount_pct > 100
                 OR discount_pct IS NULL)) AS discounts_fixed,
        count_if(NOT is_bad AND (units_sold IS NULL OR units_sold < 1)) AS units_fixed,
        count_if(NOT is_bad AND cost IS NULL) AS costs_fixed,
        count_if(NOT is_bad) - count(DISTINCT CASE WHEN NOT is_bad THEN trim(transaction_id) END)
            AS duplicates_removed FROM tagged)""", "tagged"),
)
def dq_issue_totals(src: Inputs) -> DataFrame:
    return quality.issue_totals(src.parsed("part"))


