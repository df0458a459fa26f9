"""The same layers as SQL common table expressions, for the side-by-side checks."""

from __future__ import annotations

BASE_JOIN = """
    FROM lineitem
    LEFT JOIN orders ON l_orderkey = o_orderkey
    LEFT JOIN customer ON o_custkey = c_custkey
    LEFT JOIN nation ON c_nationkey = n_nationkey
    LEFT JOIN region ON n_regionkey = r_regionkey
    LEFT JOIN part ON l_partkey = p_partkey
    LEFT JOIN supplier ON l_suppkey = s_suppkey"""

_REVENUE = (
    "cast(l_extendedprice AS decimal(14,2)) * (1 - cast(l_discount AS decimal(4,2)))"
)
_COST = (
    "cast(p_retailprice AS decimal(12,2)) * cast(l_quantity AS int) * cast(0.5 AS decimal(2,1))"
)
_TXN = "concat('TXN-', l_orderkey, '-', l_linenumber)"
_DISCOUNT = "cast(cast(l_discount AS decimal(4,2)) * 100 AS decimal(6,2))"


def q(num: str, den: str, places: int, hundred: bool = False) -> str:
    """``num / den`` rounded exactly, half away from zero, by whole-number division."""
    n = f"cast(cast({num} AS decimal(24,6)) * 1000000 AS hugeint)"
    d = f"cast(cast({den} AS decimal(24,6)) * 1000000 AS hugeint)"
    unit = 10 ** places * (100 if hundred else 1)
    whole = f"(2 * abs({n}) * {unit} + abs({d})) // nullif(2 * abs({d}), 0)"
    tick = f"cast({10 ** -places:.{places}f} AS decimal({places + 1},{places}))"
    return (
        f"cast(cast(sign({n}) * sign({d}) * ({whole}) AS decimal(24,0)) * {tick} "
        f"AS decimal(24,{places}))"
    )


def pct(num: str, den: str, places: int = 2) -> str:
    return q(num, den, places, hundred=True)


def mean(c: str, places: int) -> str:
    return q(f"sum({c})", f"count({c})", places)


def as_percent(margin: str, places: int = 2) -> str:
    return f"cast(round({margin} * 100, {places}) AS decimal(24,{places}))"


def _core(source: str) -> str:
    return f"""
    SELECT transaction_id, record_date AS txn_date,
           cast(year(record_date) AS int) AS txn_year,
           cast(quarter(record_date) AS int) AS txn_quarter,
           cast(month(record_date) AS int) AS txn_month,
           strftime(record_date, '%Y-%m') AS txn_month_label,
           trim(product_name) AS product_name, trim(product_category) AS product_category,
           trim(region) AS region, trim(sales_rep) AS sales_rep,
           trim(customer_id) AS customer_id, trim(customer_segment) AS customer_segment,
           trim(channel) AS channel, units_sold, unit_price, revenue, cost,
           cast(revenue - cost AS decimal(15,2)) AS gross_profit,
           cast(coalesce({q('revenue - cost', 'revenue', 6)}, 0) AS decimal(22,6))
               AS profit_margin,
           discount_pct,
           cast(round(unit_price * units_sold * discount_pct * 0.01, 2)
                AS decimal(24,2)) AS discount_amount,
           cast(CASE WHEN revenue - cost > 0 THEN 1 ELSE 0 END AS int) AS is_profitable
    FROM {source}
    WHERE transaction_id IS NOT NULL AND record_date IS NOT NULL AND revenue IS NOT NULL"""


def in_list(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def _canonical(column: str, values) -> str:
    whens = " ".join(f"WHEN '{v.lower()}' THEN '{v}'" for v in values)
    return f"CASE lower(trim({column})) {whens} ELSE trim({column}) END"


def title_case(text: str) -> str:
    runs = f"regexp_extract_all({text}, '(\\p{{L}}+|\\P{{L}}+)', 1)"
    return (
        f"array_to_string(list_transform({runs}, "
        "lambda w: upper(w[1:1]) || lower(w[2:])), '')"
    )


REGIONS = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")
CHANNELS = ("Direct", "Partner", "Online")
SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")

_MONTHLY = f"""
    SELECT txn_month_label AS month_label, txn_year, txn_month,
           cast(sum(revenue) AS decimal(24,2)) AS total_revenue,
           cast(sum(cost) AS decimal(24,2)) AS total_cost,
           cast(sum(gross_profit) AS decimal(25,2)) AS total_gross_profit,
           {mean('profit_margin', 6)} AS avg_profit_margin,
           count(*) AS transaction_count, cast(sum(units_sold) AS bigint) AS units_sold
    FROM core GROUP BY txn_month_label, txn_year, txn_month"""

_ZSCORE_STATS = """
    SELECT product_category AS g,
           avg(cast(revenue AS double)) AS rm, nullif(stddev_samp(cast(revenue AS double)), 0) AS rs,
           avg(cast(cost AS double)) AS cm, nullif(stddev_samp(cast(cost AS double)), 0) AS cs
    FROM clean_core GROUP BY product_category"""

# name: (text, names it needs)
CTES: dict[str, tuple[str, tuple[str, ...]]] = {
    "sales": (f"""
    SELECT {_TXN} AS transaction_id, cast(o_orderdate AS date) AS record_date,
           p_name AS product_name, p_type AS product_category, r_name AS region,
           s_name AS sales_rep, concat('CUST-', c_custkey) AS customer_id,
           c_mktsegment AS customer_segment,
           CASE l_returnflag WHEN 'A' THEN 'Direct' WHEN 'N' THEN 'Partner'
                ELSE 'Online' END AS channel,
           cast(l_quantity AS int) AS units_sold,
           cast(p_retailprice AS decimal(12,2)) AS unit_price,
           cast({_REVENUE} AS decimal(14,2)) AS revenue,
           cast({_COST} AS decimal(14,2)) AS cost,
           {_DISCOUNT} AS discount_pct, l_shipdate AS loaded_at, l_partkey, l_suppkey
    {BASE_JOIN}""", ()),
    "core": (_core("sales"), ("sales",)),
    "monthly": (_MONTHLY, ("core",)),
    "regional": (f"""
    SELECT region, txn_year, cast(sum(revenue) AS decimal(24,2)) AS total_revenue,
           cast(sum(cost) AS decimal(24,2)) AS total_cost,
           cast(sum(gross_profit) AS decimal(25,2)) AS total_gross_profit,
           {mean('profit_margin', 6)} AS avg_profit_margin, count(*) AS transaction_count
    FROM core GROUP BY region, txn_year""", ("core",)),
    "product": (f"""
    SELECT product_category, product_name, txn_year,
           cast(sum(revenue) AS decimal(24,2)) AS total_revenue,
           cast(sum(gross_profit) AS decimal(25,2)) AS total_gross_profit,
           {mean('profit_margin', 6)} AS avg_profit_margin,
           cast(sum(units_sold) AS bigint) AS units_sold, count(*) AS transaction_count
    FROM core GROUP BY product_category, product_name, txn_year""", ("core",)),
    "trends": (f"""
    SELECT m.month_label, m.txn_year, m.txn_month, m.total_revenue, m.total_cost,
           m.total_gross_profit, {as_percent('m.avg_profit_margin')} AS profit_margin_pct,
           m.transaction_count, m.units_sold,
           {pct('m.total_revenue - prev', 'prev')} AS mom_growth_pct,
           {pct('m.total_revenue - py.total_revenue', 'py.total_revenue')} AS yoy_growth_pct,
           cast(sum(m.total_revenue) OVER (PARTITION BY m.txn_year ORDER BY m.txn_month
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS decimal(28,2)) AS ytd_revenue
    FROM (SELECT *, lag(total_revenue) OVER (ORDER BY txn_year, txn_month) AS prev
          FROM monthly) m
    LEFT JOIN monthly py ON py.txn_year = m.txn_year - 1 AND py.txn_month = m.txn_month""",
               ("monthly",)),
    "reps": ("""
    SELECT region, txn_year, sales_rep, cast(sum(revenue) AS decimal(24,2)) AS rep_revenue,
           cast(rank() OVER (PARTITION BY region, txn_year ORDER BY sum(revenue) DESC) AS int)
               AS rep_rank
    FROM core GROUP BY region, txn_year, sales_rep""", ("core",)),
    "regional_view": (f"""
    SELECT r.region, r.txn_year, r.total_revenue, r.total_cost, r.total_gross_profit,
           {as_percent('r.avg_profit_margin')} AS profit_margin_pct, r.transaction_count,
           {pct('r.total_revenue - py.total_revenue', 'py.total_revenue')}
               AS yoy_revenue_growth_pct,
           {pct('r.total_revenue', 'sum(r.total_revenue) OVER (PARTITION BY r.txn_year)')}
               AS region_revenue_share_pct,
           {q('r.total_revenue', 'r.transaction_count', 2)} AS avg_transaction_value,
           t.sales_rep AS top_sales_rep, t.rep_revenue AS top_rep_revenue
    FROM regional r
    LEFT JOIN regional py ON py.region = r.region AND py.txn_year = r.txn_year - 1
    LEFT JOIN reps t ON t.region = r.region AND t.txn_year = r.txn_year AND t.rep_rank = 1""",
                      ("regional", "reps")),
    "raw": (f"""
    SELECT CASE WHEN l_orderkey % 97 = 3 THEN NULL WHEN l_orderkey % 89 = 3 THEN '  '
                ELSE {_TXN} END AS transaction_id,
           CASE WHEN l_orderkey % 83 = 3 THEN NULL WHEN l_orderkey % 79 = 3 THEN 'not-a-date'
                ELSE cast(cast(o_orderdate AS date) AS varchar) END AS date,
           p_name AS product_name, p_type AS product_category,
           CASE l_linenumber % 3 WHEN 0 THEN upper(r_name) WHEN 1 THEN '  ' || lower(r_name)
                ELSE r_name || ' ' END AS region,
           s_name AS sales_rep, concat('CUST-', c_custkey) AS customer_id,
           c_mktsegment AS customer_segment,
           CASE l_returnflag WHEN 'A' THEN 'direct' WHEN 'N' THEN ' PARTNER'
                ELSE 'Online' END AS channel,
           CASE WHEN l_orderkey % 61 = 3 THEN '0' WHEN l_orderkey % 59 = 3 THEN NULL
                ELSE cast(cast(l_quantity AS int) AS varchar) END AS units_sold,
           cast(cast(p_retailprice AS decimal(12,2)) AS varchar) AS unit_price,
           CASE WHEN l_orderkey % 73 = 3 THEN 'n/a'
                WHEN l_orderkey % 71 = 3 THEN cast(-spiked AS varchar)
                ELSE cast(spiked AS varchar) END AS revenue,
           CASE WHEN l_orderkey % 67 = 3 THEN NULL
                ELSE cast(cast({_COST} * CASE WHEN l_orderkey % 100 IN (9, 57)
                     THEN cast(4.0 AS decimal(2,1)) ELSE cast(1.0 AS decimal(2,1)) END
                     AS decimal(14,2)) AS varchar) END AS cost,
           CASE WHEN l_orderkey % 53 = 3 THEN '150' WHEN l_orderkey % 47 = 3 THEN '-5'
                WHEN l_orderkey % 43 = 3 THEN '60'
                ELSE cast({_DISCOUNT} AS varchar) END AS discount_pct,
           l_shipdate AS loaded_at, l_partkey, l_suppkey
    FROM (SELECT *, cast({_REVENUE} * CASE WHEN l_orderkey % 50 = 7
                 THEN cast(4.2 AS decimal(2,1)) ELSE cast(1.0 AS decimal(2,1)) END
                 AS decimal(14,2)) AS spiked
    {BASE_JOIN}) joined""", ()),
    "parsed": ("""
    SELECT * REPLACE (try_cast(units_sold AS decimal(30,6)) AS units_sold,
                      try_cast(unit_price AS decimal(30,6)) AS unit_price,
                      try_cast(revenue AS decimal(30,6)) AS revenue,
                      try_cast(cost AS decimal(30,6)) AS cost,
                      try_cast(discount_pct AS decimal(30,6)) AS discount_pct),
           try_cast(date AS date) AS record_date
    FROM raw""", ("raw",)),
    "tagged": ("""
    SELECT *, (transaction_id IS NULL OR trim(transaction_id) = '' OR date IS NULL
               OR record_date IS NULL OR revenue IS NULL OR revenue < 0) AS is_bad
    FROM parsed""", ("parsed",)),
    "staged": (f"""
    SELECT trim(transaction_id) AS transaction_id, record_date,
           trim(product_name) AS product_name, trim(product_category) AS product_category,
           {_canonical('region', REGIONS)} AS region, trim(sales_rep) AS sales_rep,
           trim(customer_id) AS customer_id,
           {_canonical('customer_segment', SEGMENTS)} AS customer_segment,
           {_canonical('channel', CHANNELS)} AS channel,
           cast(trunc(greatest(coalesce(units_sold, 1), 1)) AS int) AS units_sold,
           cast(unit_price AS decimal(12,2)) AS unit_price,
           cast(revenue AS decimal(14,2)) AS revenue,
           cast(coalesce(cost, 0) AS decimal(14,2)) AS cost,
           cast(coalesce(least(greatest(discount_pct, 0), 100), 0) AS decimal(6,2))
               AS discount_pct,
           loaded_at, l_partkey, l_suppkey
    FROM tagged WHERE NOT is_bad""", ("tagged",)),
    "clean": ("""
    SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY loaded_at, l_partkey,
               l_suppkey, revenue, units_sold) AS rn FROM staged) WHERE rn = 1""", ("staged",)),
    "clean_core": (_core("clean"), ("clean",)),
    "stats": (_ZSCORE_STATS, ("clean_core",)),
    "scored": ("""
    SELECT c.*, coalesce((cast(revenue AS double) - rm) / rs, 0) AS rz,
           coalesce((cast(cost AS double) - cm) / cs, 0) AS cz
    FROM clean_core c LEFT JOIN stats ON g = product_category""", ("clean_core", "stats")),
    "fences": ("""
    SELECT q[1] - 1.5 * (q[2] - q[1]) AS lower, q[2] + 1.5 * (q[2] - q[1]) AS upper
    FROM (SELECT quantile_cont(cast(discount_pct AS double), [0.25, 0.75]) AS q
          FROM clean_core)""", ("clean_core",)),
    "findings": ("""
    SELECT transaction_id, txn_date, product_name, region, revenue, cost,
           round(rz, 4) AS revenue_zscore, cast(NULL AS double) AS cost_zscore,
           CASE WHEN rz > 0 THEN 'HIGH_REVENUE' ELSE 'LOW_REVENUE' END AS anomaly_type,
           abs(rz) AS strength, 0 AS place
    FROM scored WHERE abs(rz) > 2.5
    UNION ALL
    SELECT transaction_id, txn_date, product_name, region, revenue, cost,
           NULL, round(cz, 4), CASE WHEN cz > 0 THEN 'HIGH_COST' ELSE 'LOW_COST' END, 0, 1
    FROM scored WHERE abs(cz) > 2.5
    UNION ALL
    SELECT transaction_id, txn_date, product_name, region, revenue, cost,
           NULL, NULL, 'DISCOUNT_OUTLIER', 0, 2
    FROM clean_core, fences
    WHERE cast(discount_pct AS double) < lower OR cast(discount_pct AS double) > upper""",
                 ("scored", "fences")),
    "anomalies": ("""
    SELECT * EXCLUDE (rn, strength, place) FROM (
        SELECT *, row_number() OVER (PARTITION BY transaction_id
               ORDER BY strength DESC, place) AS rn FROM findings) WHERE rn = 1""",
                  ("findings",)),
    "op_metrics": ("""
    SELECT cast(ts AS date) AS record_date, concat('USER-', user_id) AS entity_id,
           event_type AS metric_name, cast(value AS decimal(18,4)) AS metric_value,
           'EVENTS' AS source_system, ts AS loaded_at, event_id AS staging_id
    FROM events""", ()),
    "gap_metrics": ("""
    SELECT * REPLACE (CASE WHEN value <= 100 THEN cast(value AS decimal(18,4)) END
                      AS metric_value)
    FROM (SELECT cast(ts AS date) AS record_date, concat('USER-', user_id) AS entity_id,
                 event_type AS metric_name, cast(value AS decimal(18,4)) AS metric_value,
                 ts AS loaded_at, event_id AS staging_id, value FROM events)""", ()),
    "filled": ("""
    SELECT record_date, entity_id, metric_name, staging_id,
           last_value(metric_value IGNORE NULLS) OVER (
               PARTITION BY record_date, entity_id, metric_name
               ORDER BY loaded_at, staging_id
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS metric_value
    FROM gap_metrics""", ("gap_metrics",)),
    "run_log": ("""
    SELECT event_id AS log_id, cast(ts AS date) AS run_date,
           CASE user_id % 4 WHEN 0 THEN 'Extraction' WHEN 1 THEN 'Staging'
                WHEN 2 THEN 'Transformation' ELSE 'Reporting' END AS stage,
           CASE WHEN event_type = 'error' THEN 'Failed' ELSE 'Completed' END AS status,
           CASE WHEN event_type = 'error' THEN 0
                ELSE cast(floor(value * 100) AS bigint) END AS records_processed,
           ts AS start_time, cast(floor(value) AS bigint) AS duration_seconds
    FROM events""", ()),
}


def _plain_counts(text: str) -> str:
    """``count_if(x)`` as ``count(CASE WHEN x THEN 1 END)``: DuckDB's own is not a BIGINT."""
    start = text.find("count_if(")
    if start < 0:
        return text
    begin = at = start + len("count_if(")
    depth = 1
    while depth:
        depth += {"(": 1, ")": -1}.get(text[at], 0)
        at += 1
    inner = text[begin:at - 1]
    return text[:start] + f"count(CASE WHEN {inner} THEN 1 END)" + _plain_counts(text[at:])


def sql(body: str, *needs: str) -> str:
    """``body`` with the common table expressions it needs, in dependency order."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order:
            return
        for dep in CTES[name][1]:
            visit(dep)
        order.append(name)

    for name in needs:
        visit(name)
    body = _plain_counts(body)
    if not order:
        return body
    parts = ",\n".join(f"{name} AS MATERIALIZED ({CTES[name][0]})" for name in order)
    return f"WITH {parts}\n{body}"
