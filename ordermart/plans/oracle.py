"""Independent SQL for the correctness oracle (DuckDB dialect).

Each registered query has a SQL text that DuckDB runs over the same parquet
tables (views named after the tables). The SQL restates the models the way
the reference writes them: real joins to the dimensions, row_number for the
cheapest supplier, lead for versions, generated series for the day spine.
The Spark side differs on purpose (join-free key lookups, min_by, order-grain
customer lookup, distributed quantiles), so agreement checks those rewrites.

Model definitions are common table expressions; ``sql_with`` emits the ones
a query needs, in dependency order. This is text assembly only.
"""

from __future__ import annotations

from ..operators.quality import Check
from . import catalog

AS_OF = "2001-08-01"
NULL = "'@@NULL@@'"


def _sk(*exprs: str) -> str:
    parts = ", ".join(f"coalesce(CAST({e} AS VARCHAR), {NULL})" for e in exprs)
    return f"md5(concat_ws('|', {parts}))"


def _tier(bal: str) -> str:
    return (f"CASE WHEN {bal} < 0 THEN 'Negative' WHEN {bal} BETWEEN 0 AND 2500 THEN 'Bronze' "
            f"WHEN {bal} BETWEEN 2500 AND 5000 THEN 'Silver' WHEN {bal} BETWEEN 5000 AND 7500 "
            f"THEN 'Gold' ELSE 'Platinum' END")


def _fy(d: str) -> str:
    return f"CAST(CASE WHEN month({d}) >= 10 THEN year({d}) + 1 ELSE year({d}) END AS INTEGER)"


def _fq(d: str) -> str:
    return (f"CAST(CASE WHEN month({d}) IN (10, 11, 12) THEN 1 WHEN month({d}) IN (1, 2, 3) THEN 2 "
            f"WHEN month({d}) IN (4, 5, 6) THEN 3 WHEN month({d}) IN (7, 8, 9) THEN 4 END AS INTEGER)")


def _fm(d: str) -> str:
    return f"CAST(CASE WHEN month({d}) >= 10 THEN month({d}) - 9 ELSE month({d}) + 3 END AS INTEGER)"


def _div(num: str, den: str, default: str = "NULL") -> str:
    return f"CASE WHEN ({den}) = 0 OR ({den}) IS NULL THEN {default} ELSE ({num}) / ({den}) END"


def _ratio(num: str, den: str) -> str:
    return _div(f"CAST({num} AS DOUBLE)", f"CAST({den} AS DOUBLE)")


def _money(x: str) -> str:
    return f"CAST({x} AS DECIMAL(12,2))"


CTE: dict[str, tuple[list[str], str]] = {}


def cte(name: str, deps: list[str], body: str) -> None:
    CTE[name] = (deps, body)


cte("src_orders", [], """
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
         'Clerk#' || lpad(CAST(o_orderkey % 1000 AS VARCHAR), 9, '0') AS o_clerk,
         0 AS o_shippriority, CAST(NULL AS VARCHAR) AS o_comment
  FROM orders""")

cte("stg_orders", ["src_orders"], """
  SELECT * FROM (
    SELECT CAST(o_orderkey AS BIGINT) AS order_key, CAST(o_custkey AS BIGINT) AS customer_key,
      o_orderstatus AS order_status, o_orderpriority AS order_priority, o_clerk AS clerk_name,
      CAST(o_shippriority AS INTEGER) AS ship_priority, o_comment AS order_comment,
      CAST(o_totalprice AS DOUBLE) AS order_total_price, CAST(o_orderdate AS DATE) AS order_date,
      CASE o_orderstatus WHEN 'O' THEN 'Open' WHEN 'F' THEN 'Fulfilled' WHEN 'P' THEN 'In Progress'
        ELSE 'Unknown' END AS order_status_desc,
      CASE WHEN o_orderpriority = '1-URGENT' THEN 1 WHEN o_orderpriority = '2-HIGH' THEN 2
        WHEN o_orderpriority = '3-MEDIUM' THEN 3 WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 4
        WHEN o_orderpriority = '5-LOW' THEN 5 ELSE 99 END AS order_priority_rank
    FROM src_orders) t
  WHERE order_key IS NOT NULL AND customer_key IS NOT NULL AND order_date IS NOT NULL
    AND order_total_price >= 0""")

cte("stg_customers", [], f"""
  SELECT CAST(c.c_custkey AS BIGINT) AS customer_key, CAST(c.c_nationkey AS INTEGER) AS nation_key,
    CAST(n.n_regionkey AS INTEGER) AS region_key, c.c_name AS customer_name,
    CAST(NULL AS VARCHAR) AS customer_address, CAST(NULL AS VARCHAR) AS customer_phone,
    c.c_mktsegment AS market_segment, CAST(NULL AS VARCHAR) AS customer_comment,
    n.n_name AS nation_name, r.r_name AS region_name,
    CAST({_money('c.c_acctbal')} AS DOUBLE) AS account_balance,
    {_tier(_money('c.c_acctbal'))} AS account_tier
  FROM customer c
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey""")

cte("src_part", [], """
  SELECT p_partkey, p_name, p_brand, p_size, p_retailprice,
    p_type || ' ' || (['ANODIZED', 'BRUSHED', 'BURNISHED', 'PLATED', 'POLISHED'])[p_partkey % 5 + 1]
      || ' ' || (['BRASS', 'COPPER', 'NICKEL', 'STEEL', 'TIN'])[(p_partkey * 3 + 1) % 5 + 1] AS p_type,
    (['JUMBO', 'LG', 'MED', 'SM', 'WRAP'])[p_partkey % 5 + 1] || ' '
      || (['BAG', 'BOX', 'CAN', 'CASE', 'DRUM', 'JAR', 'PACK', 'PKG'])[(p_partkey * 7 + 2) % 8 + 1]
      AS p_container,
    'Manufacturer#' || CAST(p_partkey % 5 + 1 AS VARCHAR) AS p_mfgr,
    CAST(NULL AS VARCHAR) AS p_comment
  FROM part""")

cte("src_partsupp", [], """
  SELECT pr.ps_partkey, pr.ps_suppkey,
    CAST((pr.ps_partkey * 7 + pr.ps_suppkey * 11) % 10000 AS INTEGER) AS ps_availqty,
    CAST(CAST(p.p_retailprice AS DECIMAL(12,2))
         * CAST(500 + (pr.ps_partkey * 31 + pr.ps_suppkey * 17) % 400 AS DECIMAL(10,0))
         * CAST(0.001 AS DECIMAL(4,3)) AS DECIMAL(12,2)) AS ps_supplycost
  FROM (SELECT DISTINCT l_partkey AS ps_partkey, l_suppkey AS ps_suppkey
        FROM lineitem) pr
  JOIN part p ON p.p_partkey = pr.ps_partkey""")

cte("best_supplier", ["src_partsupp"], """
  SELECT part_key, supplier_key, available_qty, supply_cost FROM (
    SELECT CAST(ps_partkey AS BIGINT) AS part_key, CAST(ps_suppkey AS BIGINT) AS supplier_key,
      CAST(ps_availqty AS INTEGER) AS available_qty,
      CAST(ps_supplycost AS DECIMAL(12,2)) AS supply_cost,
      row_number() OVER (PARTITION BY ps_partkey ORDER BY ps_supplycost, ps_suppkey) AS cost_rank
    FROM src_partsupp) t
  WHERE cost_rank = 1""")

_RP = _money("p.p_retailprice")
cte("stg_products", ["src_part", "best_supplier"], f"""
  SELECT CAST(p.p_partkey AS BIGINT) AS product_key, bs.supplier_key, p.p_name AS product_name,
    p.p_mfgr AS manufacturer, p.p_brand AS brand, p.p_type AS product_type_raw,
    split_part(p.p_type, ' ', 1) AS product_size_segment,
    split_part(p.p_type, ' ', 2) AS product_finish,
    split_part(p.p_type, ' ', 3) AS product_material,
    p.p_container AS container_raw,
    split_part(p.p_container, ' ', 1) AS container_size,
    split_part(p.p_container, ' ', 2) AS container_type,
    CAST(p.p_size AS INTEGER) AS product_size_units,
    CAST({_RP} AS DOUBLE) AS retail_price,
    CAST(bs.supply_cost AS DOUBLE) AS supply_cost, bs.available_qty,
    {_div(f'CAST({_RP} - bs.supply_cost AS DOUBLE)', f'CAST({_RP} AS DOUBLE)')} AS estimated_margin_pct,
    p.p_comment AS product_comment
  FROM src_part p LEFT JOIN best_supplier bs ON p.p_partkey = bs.part_key""")

cte("src_lineitem", [], """
  SELECT *,
    CAST(l_shipdate AS DATE) + CAST((l_orderkey * 7 + l_linenumber * 13) % 61 - 30 AS INTEGER) AS l_commitdate,
    CAST(l_shipdate AS DATE) + CAST(1 + (l_orderkey * 3 + l_linenumber * 5) % 30 AS INTEGER) AS l_receiptdate,
    (['AIR', 'FOB', 'MAIL', 'RAIL', 'REG AIR', 'SHIP', 'TRUCK'])[(l_orderkey + l_linenumber) % 7 + 1] AS l_shipmode,
    (['COLLECT COD', 'DELIVER IN PERSON', 'NONE', 'TAKE BACK RETURN'])[(l_partkey + l_linenumber) % 4 + 1]
      AS l_shipinstruct,
    CAST(NULL AS VARCHAR) AS l_comment
  FROM (
    SELECT l_orderkey, l_partkey, l_suppkey,
      CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey,
                                l_shipdate, l_extendedprice) AS INTEGER) AS l_linenumber,
      l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate
    FROM lineitem) t""")

cte("lines", ["src_lineitem"], """
  SELECT CAST(l_orderkey AS BIGINT) AS order_key, CAST(l_partkey AS BIGINT) AS product_key,
    CAST(l_suppkey AS BIGINT) AS supplier_key, l_linenumber AS line_number,
    CAST(l_quantity AS DECIMAL(12,2)) AS quantity, CAST(l_extendedprice AS DECIMAL(12,2)) AS extended_price,
    CAST(l_discount AS DECIMAL(4,2)) AS discount_rate, CAST(l_tax AS DECIMAL(4,2)) AS tax_rate,
    l_returnflag AS return_flag, l_linestatus AS line_status, CAST(l_shipdate AS DATE) AS ship_date,
    l_commitdate AS commit_date, l_receiptdate AS receipt_date, l_shipinstruct AS ship_instructions,
    l_shipmode AS ship_mode, l_comment AS line_comment
  FROM src_lineitem""")

_NET = "li.extended_price * (1 - li.discount_rate)"
cte("line_amounts", ["lines"], f"""
  SELECT li.*,
    CAST(round({_NET}, 2) AS DOUBLE) AS net_revenue,
    CAST(round({_NET} * (1 + li.tax_rate), 2) AS DOUBLE) AS gross_revenue,
    CAST(round(li.extended_price * li.discount_rate, 2) AS DOUBLE) AS discount_amount,
    CAST(round({_NET} * li.tax_rate, 2) AS DOUBLE) AS tax_amount,
    {_div('CAST(li.extended_price AS DOUBLE)', 'CAST(li.quantity AS DOUBLE)')} AS unit_price,
    {_div(f'CAST({_NET} AS DOUBLE)', 'CAST(li.quantity AS DOUBLE)')} AS net_unit_price
  FROM lines li""")

cte("int_orders_enriched", ["line_amounts", "stg_orders", "stg_customers", "stg_products"], f"""
  SELECT {_sk('li.order_key', 'li.line_number')} AS order_line_sk,
    o.order_key, o.order_date, o.order_status, o.order_status_desc, o.order_priority,
    o.order_priority_rank, o.clerk_name,
    li.line_number, CAST(li.quantity AS DOUBLE) AS quantity,
    CAST(li.extended_price AS DOUBLE) AS extended_price,
    CAST(li.discount_rate AS DOUBLE) AS discount_rate, CAST(li.tax_rate AS DOUBLE) AS tax_rate,
    li.return_flag, li.line_status, li.ship_mode, li.ship_instructions, li.ship_date,
    li.commit_date, li.receipt_date,
    li.net_revenue, li.gross_revenue, li.discount_amount, li.tax_amount, li.unit_price,
    li.net_unit_price,
    CAST(datediff('day', o.order_date, li.ship_date) AS INTEGER) AS days_to_ship,
    CAST(datediff('day', li.ship_date, li.receipt_date) AS INTEGER) AS days_in_transit,
    CAST(datediff('day', o.order_date, li.receipt_date) AS INTEGER) AS total_fulfillment_days,
    CASE WHEN li.ship_date <= li.commit_date THEN 'On-Time' ELSE 'Late' END AS delivery_status,
    CAST(datediff('day', li.commit_date, li.ship_date) AS INTEGER) AS days_late,
    {_fy('o.order_date')} AS fiscal_year, {_fq('o.order_date')} AS fiscal_quarter,
    c.customer_key, c.customer_name, c.market_segment, c.nation_name, c.region_name,
    c.account_tier, c.account_balance,
    p.product_key, p.product_name, p.brand, p.manufacturer, p.product_material,
    p.product_size_segment, p.product_finish, p.container_size, p.retail_price,
    p.estimated_margin_pct,
    li.supplier_key
  FROM line_amounts li
  INNER JOIN stg_orders o ON li.order_key = o.order_key
  INNER JOIN stg_customers c ON o.customer_key = c.customer_key
  LEFT JOIN stg_products p ON li.product_key = p.product_key""")

cte("customer_history", [], f"""
  SELECT h.c_custkey, h.c_name, h.c_address, h.c_phone, h.c_mktsegment, h.c_comment, h.n_name,
    h.r_name, CAST(h.bal0 + (h.n_versions - v.v) * h.step AS DECIMAL(12,2)) AS c_acctbal,
    {_sk('h.c_custkey', 'h.c_name', 'h.c_mktsegment', 'h.n_name',
         'CAST(CAST(h.bal0 + (h.n_versions - v.v) * h.step AS DECIMAL(12,2)) AS DECIMAL(18,2))')} AS scd_id,
    v.updated_at, CASE WHEN v.v < h.n_versions THEN v.next_start END AS valid_to
  FROM (
    SELECT c.c_custkey, c.c_name, CAST(NULL AS VARCHAR) AS c_address, CAST(NULL AS VARCHAR) AS c_phone,
      c.c_mktsegment, CAST(NULL AS VARCHAR) AS c_comment, n.n_name, r.r_name,
      {_money('c.c_acctbal')} AS bal0, CAST(c.c_custkey % 3 + 1 AS INTEGER) AS n_versions,
      CASE WHEN c.c_custkey % 2 = 1 THEN -2500 ELSE 2500 END AS step
    FROM customer c
    LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
    LEFT JOIN region r ON n.n_regionkey = r.r_regionkey) h
  JOIN (VALUES (1, TIMESTAMP '1992-01-01', TIMESTAMP '1996-06-15'),
               (2, TIMESTAMP '1996-06-15', TIMESTAMP '1998-03-01'),
               (3, TIMESTAMP '1998-03-01', CAST(NULL AS TIMESTAMP))) v(v, updated_at, next_start)
    ON v.v <= h.n_versions""")

_DIM_CUSTOMER_SELECT = f"""
  SELECT {_sk('customer_key', 'effective_from')} AS customer_sk,
    customer_key, customer_name, customer_address, customer_phone, market_segment,
    customer_comment, nation_name, region_name, CAST(account_balance AS DOUBLE) AS account_balance,
    {_tier('account_balance')} AS account_tier, _row_hash, effective_from, effective_to, is_current"""

cte("dim_customer", ["customer_history"], f"""{_DIM_CUSTOMER_SELECT}
  FROM (
    SELECT CAST(c_custkey AS BIGINT) AS customer_key, c_name AS customer_name,
      c_address AS customer_address, c_phone AS customer_phone, c_mktsegment AS market_segment,
      c_comment AS customer_comment, n_name AS nation_name, r_name AS region_name,
      c_acctbal AS account_balance, scd_id AS _row_hash,
      CAST(updated_at AS DATE) AS effective_from,
      coalesce(lead(CAST(updated_at AS DATE)) OVER (PARTITION BY c_custkey ORDER BY updated_at, scd_id) - 1,
               DATE '9999-12-31') AS effective_to,
      valid_to IS NULL AS is_current
    FROM customer_history) t""")

cte("dim_customer_single", ["stg_customers"], f"""{_DIM_CUSTOMER_SELECT}
  FROM (
    SELECT customer_key, customer_name, customer_address, customer_phone, market_segment,
      customer_comment, nation_name, region_name,
      CAST(account_balance AS DECIMAL(12,2)) AS account_balance,
      {_sk('customer_key', 'customer_name', 'market_segment', 'nation_name',
           'CAST(CAST(account_balance AS DECIMAL(12,2)) AS DECIMAL(18,2))')} AS _row_hash,
      DATE '1992-01-01' AS effective_from, DATE '9999-12-31' AS effective_to, TRUE AS is_current
    FROM stg_customers) t""")

cte("dim_product", ["stg_products"], f"""
  SELECT {_sk('product_key')} AS product_sk, product_key, product_name, manufacturer, brand,
    product_type_raw, product_size_segment, product_finish, product_material, container_raw,
    container_size, container_type, product_size_units, retail_price, supply_cost, available_qty,
    estimated_margin_pct
  FROM stg_products""")


def _dim_date_select(source: str) -> str:
    d = "d"
    return f"""
  SELECT CAST(strftime({d}, '%Y%m%d') AS INTEGER) AS date_sk, {d} AS full_date,
    CAST(year({d}) AS INTEGER) AS calendar_year, CAST(quarter({d}) AS INTEGER) AS calendar_quarter,
    CAST(month({d}) AS INTEGER) AS calendar_month, left(monthname({d}), 3) AS month_name,
    left(monthname({d}), 3) AS month_name_short, CAST(weekofyear({d}) AS INTEGER) AS week_of_year,
    CAST(dayofyear({d}) AS INTEGER) AS day_of_year, CAST(day({d}) AS INTEGER) AS day_of_month,
    CAST(dayofweek({d}) AS INTEGER) AS day_of_week, left(dayname({d}), 3) AS day_name,
    left(dayname({d}), 3) AS day_name_short, strftime({d}, '%Y-%m') AS year_month,
    'Q' || CAST(quarter({d}) AS VARCHAR) || '-' || CAST(year({d}) AS VARCHAR) AS quarter_label,
    {_fy(d)} AS fiscal_year, {_fq(d)} AS fiscal_quarter, {_fm(d)} AS fiscal_month,
    'FY' || CAST({_fy(d)} AS VARCHAR) || '-Q' || CAST({_fq(d)} AS VARCHAR) AS fiscal_quarter_label,
    dayofweek({d}) IN (0, 6) AS is_weekend, dayofweek({d}) NOT IN (0, 6) AS is_weekday,
    {d} = DATE '{AS_OF}' AS is_today, {d} = DATE '{AS_OF}' - 1 AS is_yesterday,
    {d} >= date_trunc('month', DATE '{AS_OF}') AND {d} <= DATE '{AS_OF}' AS is_current_month,
    {d} >= date_trunc('year', DATE '{AS_OF}') AND {d} <= DATE '{AS_OF}' AS is_current_year,
    day({d}) = 1 AS is_first_of_month, {d} = last_day({d}) AS is_last_of_month,
    CAST({d} - DATE '1970-01-01' AS INTEGER) AS days_since_epoch
  FROM {source}"""


cte("dim_date", [], _dim_date_select(
    "(SELECT CAST(range AS DATE) AS d FROM range(DATE '1992-01-01', DATE '2031-01-01', INTERVAL 1 DAY)) s"))

cte("dim_date_covered", ["stg_orders"], _dim_date_select(
    "(SELECT CAST(range AS DATE) AS d FROM (SELECT least(DATE '1992-01-01', min(order_date)) AS lo, "
    "greatest(DATE '2030-12-31', max(order_date)) AS hi FROM stg_orders) b, "
    "range(b.lo, b.hi + 1, INTERVAL 1 DAY)) s"))

cte("fact_orders", ["int_orders_enriched", "dim_customer", "dim_date", "dim_product"], """
  SELECT s.order_line_sk,
    coalesce(dc.customer_sk, '-1') AS customer_sk, coalesce(dp.product_sk, '-1') AS product_sk,
    coalesce(dd.date_sk, -1) AS order_date_sk, coalesce(sd.date_sk, -1) AS ship_date_sk,
    s.order_key, s.line_number, s.order_status, s.order_status_desc, s.order_priority,
    s.order_priority_rank, s.ship_mode, s.ship_instructions, s.return_flag, s.line_status,
    s.delivery_status, s.clerk_name,
    s.market_segment, s.nation_name, s.region_name, s.brand, s.product_material,
    s.product_size_segment, s.container_size,
    s.fiscal_year, s.fiscal_quarter,
    s.quantity, s.extended_price, s.discount_amount, s.net_revenue, s.gross_revenue, s.tax_amount,
    s.unit_price, s.net_unit_price,
    s.discount_rate, s.tax_rate, s.estimated_margin_pct,
    s.days_to_ship, s.days_in_transit, s.total_fulfillment_days, s.days_late,
    s.delivery_status = 'Late' AS is_late_delivery, s.return_flag = 'R' AS is_returned,
    s.discount_rate > 0 AS has_discount, s.quantity > 1 AS is_multi_unit,
    s.order_date, s.ship_date, s.commit_date, s.receipt_date
  FROM int_orders_enriched s
  LEFT JOIN (SELECT customer_key, customer_sk FROM dim_customer WHERE is_current) dc
    ON s.customer_key = dc.customer_key
  LEFT JOIN dim_date dd ON s.order_date = dd.full_date
  LEFT JOIN dim_date sd ON s.ship_date = sd.full_date
  LEFT JOIN dim_product dp ON s.product_key = dp.product_key""")


def sql_with(deps: list[str], body: str) -> str:
    """WITH <needed models in dependency order> <body>."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTE[n][0]:
            visit(d)
        order.append(n)

    for d in deps:
        visit(d)
    extra = body.lstrip().startswith(",")
    if not order:
        return "WITH " + body.lstrip()[1:] if extra else body
    parts = ",\n".join(f"{n} AS ({CTE[n][1]}\n)" for n in order)
    return f"WITH {parts}\n{body}"


SQL: dict[str, str] = {}


def oq(name: str, deps: list[str], body: str) -> None:
    SQL[name] = sql_with(deps, body)


# --- staging / models ----------------------------------------------------
oq("stg_orders", ["stg_orders"], "SELECT * FROM stg_orders")
oq("stg_customers", ["stg_customers"], "SELECT * FROM stg_customers")
oq("stg_products", ["stg_products"], "SELECT * FROM stg_products")
oq("best_supplier", ["best_supplier"],
   "SELECT part_key, supplier_key, available_qty, CAST(supply_cost AS DOUBLE) AS supply_cost FROM best_supplier")
oq("order_lines_enriched", ["int_orders_enriched"], "SELECT * FROM int_orders_enriched")
oq("line_revenue", ["line_amounts"], f"""
  SELECT {_sk('order_key', 'line_number')} AS order_line_sk,
    CAST(quantity AS DOUBLE) AS quantity, CAST(extended_price AS DOUBLE) AS extended_price,
    CAST(discount_rate AS DOUBLE) AS discount_rate, CAST(tax_rate AS DOUBLE) AS tax_rate,
    net_revenue, gross_revenue, discount_amount, tax_amount, unit_price, net_unit_price
  FROM line_amounts""")
oq("line_shipping", ["int_orders_enriched"], """
  SELECT order_line_sk, order_date, ship_date, commit_date, receipt_date, days_to_ship,
    days_in_transit, total_fulfillment_days, delivery_status, days_late
  FROM int_orders_enriched""")
oq("date_spine", ["stg_orders"], """
  SELECT CAST(range AS DATE) AS date_day
  FROM (SELECT min(order_date) AS lo, max(order_date) AS hi FROM stg_orders) b,
       range(b.lo, b.hi + 1, INTERVAL 1 DAY)""")
oq("dim_date", ["dim_date_covered"], "SELECT * FROM dim_date_covered")
oq("dim_product", ["dim_product"], "SELECT * FROM dim_product")
oq("dim_customer_scd2", ["dim_customer"], "SELECT * FROM dim_customer")
oq("dim_customer_current", ["dim_customer_single"], "SELECT * FROM dim_customer_single")

_CAP = catalog.CAPTURE_AT
# A newer row closes the open version if any stored attribute differs, NULLs
# included; each attribute changes for other keys.
oq("scd2_capture", ["customer_history"], f"""
  , inc AS (
    SELECT c_custkey, c_name,
      CASE WHEN c_custkey % 11 = 1 THEN 'Moved to ' || c_custkey ELSE c_address END AS c_address,
      CASE WHEN c_custkey % 11 = 2 THEN '+1-' || c_custkey ELSE c_phone END AS c_phone,
      CASE WHEN c_custkey % 11 = 5 THEN NULL ELSE c_mktsegment END AS c_mktsegment,
      CASE WHEN c_custkey % 11 = 3 THEN 'changed' ELSE c_comment END AS c_comment, n_name,
      CASE WHEN c_custkey % 11 = 4 THEN 'ELSEWHERE' ELSE r_name END AS r_name,
      CAST(CASE WHEN c_custkey % 11 = 0 THEN c_acctbal + 1000 ELSE c_acctbal END AS DECIMAL(12,2)) AS c_acctbal,
      TIMESTAMP '{_CAP}' AS updated_at
    FROM customer_history WHERE valid_to IS NULL),
  inc_h AS (
    SELECT *, {_sk('c_custkey', 'c_name', 'c_mktsegment', 'n_name', 'CAST(c_acctbal AS DECIMAL(18,2))')} AS scd_id
    FROM inc),
  changed AS (
    SELECT i.* FROM inc_h i JOIN customer_history o ON i.c_custkey = o.c_custkey
    WHERE o.valid_to IS NULL AND i.updated_at > o.updated_at AND (
      i.c_name IS DISTINCT FROM o.c_name OR i.c_address IS DISTINCT FROM o.c_address
      OR i.c_phone IS DISTINCT FROM o.c_phone OR i.c_mktsegment IS DISTINCT FROM o.c_mktsegment
      OR i.c_comment IS DISTINCT FROM o.c_comment OR i.n_name IS DISTINCT FROM o.n_name
      OR i.r_name IS DISTINCT FROM o.r_name OR i.c_acctbal IS DISTINCT FROM o.c_acctbal))
  SELECT h.c_custkey, h.c_name, h.c_address, h.c_phone, h.c_mktsegment, h.c_comment, h.n_name, h.r_name,
         CAST(h.c_acctbal AS DOUBLE) AS c_acctbal, h.scd_id, h.updated_at,
         coalesce(h.valid_to, (SELECT ch.updated_at FROM changed ch WHERE ch.c_custkey = h.c_custkey)) AS valid_to
  FROM customer_history h
  UNION ALL
  SELECT c_custkey, c_name, c_address, c_phone, c_mktsegment, c_comment, n_name, r_name,
         CAST(c_acctbal AS DOUBLE) AS c_acctbal, scd_id, updated_at, CAST(NULL AS TIMESTAMP) AS valid_to
  FROM changed""")

_FACT_COLS = ", ".join(c for c in catalog.facts.FACT_COLUMNS if c != "_loaded_at")
oq("fact_orders", ["fact_orders"], "SELECT * FROM fact_orders")
oq("fact_upsert", ["fact_orders"], f"SELECT {_FACT_COLS} FROM fact_orders")
oq("daily_build_fact", ["fact_orders"], f"SELECT {_FACT_COLS} FROM fact_orders")
oq("view_and_rebuild", ["stg_orders"], "SELECT * FROM stg_orders")
oq("fact_full_refresh", ["fact_orders"], f"""
  SELECT {_FACT_COLS} FROM fact_orders WHERE order_date <= (SELECT max(order_date) FROM fact_orders) - 400""")
oq("fact_schema_drift", ["fact_orders"], f"""
  SELECT {_FACT_COLS.replace("clerk_name", "CASE WHEN order_date >= (SELECT max(order_date) FROM fact_orders) - 3 THEN clerk_name END AS clerk_name")}
  FROM fact_orders""")
oq("fact_lookback", ["fact_orders"], f"""
  SELECT {_FACT_COLS} FROM fact_orders
  WHERE order_date >= (SELECT max(order_date) FROM fact_orders) - {catalog.LOOKBACK_DAYS}""")
oq("fact_customer_as_of", ["int_orders_enriched", "dim_customer"], """
  SELECT s.order_line_sk, s.order_key, s.order_date, s.customer_key,
    coalesce(dc.customer_sk, '-1') AS customer_sk, dc.account_tier AS tier_at_order, s.account_tier
  FROM int_orders_enriched s
  LEFT JOIN dim_customer dc ON s.customer_key = dc.customer_key
    AND s.order_date BETWEEN dc.effective_from AND dc.effective_to""")

# --- scalar functions ----------------------------------------------------
oq("surrogate_keys", ["lines"], f"""
  SELECT order_key, line_number, {_sk('order_key', 'line_number')} AS order_line_sk,
    {_sk('product_key')} AS product_sk,
    {_sk('supplier_key', 'product_key', 'line_comment')} AS supply_line_sk
  FROM lines""")
oq("safe_divide_cases", ["int_orders_enriched"], f"""
  SELECT order_line_sk,
    {_div('tax_rate', 'discount_rate')} AS tax_per_discount,
    {_div('tax_rate', 'discount_rate', '0')} AS tax_per_discount_or_zero,
    {_div('estimated_margin_pct', 'retail_price', '-1')} AS margin_per_price,
    {_div('discount_amount', 'quantity')} AS discount_per_unit
  FROM int_orders_enriched""")
oq("fiscal_calendar", ["stg_orders"], f"""
  SELECT order_date, {_fy('order_date')} AS fiscal_year, {_fq('order_date')} AS fiscal_quarter,
    {_fm('order_date')} AS fiscal_month,
    'FY' || CAST({_fy('order_date')} AS VARCHAR) || '-Q' || CAST({_fq('order_date')} AS VARCHAR)
      AS fiscal_period_label
  FROM (SELECT DISTINCT order_date FROM stg_orders) t""")

# --- data quality --------------------------------------------------------
_CHECK_TABLE_CTE = {
    "orders": None, "customer": None, "part": "src_part", "partsupp": "src_partsupp",
    "supplier": None, "lineitem": "src_lineitem", "nation": None, "region": None,
    "stg_orders": "stg_orders", "stg_customers": "stg_customers", "stg_products": "stg_products",
    "int_orders_enriched": "int_orders_enriched", "fact_orders": "fact_orders",
    "dim_customer": "dim_customer", "dim_date": "dim_date", "dim_product": "dim_product",
}


def _fact_with_audit() -> str:
    return "(SELECT *, TIMESTAMP '2001-08-01 04:00:00' AS _loaded_at FROM fact_orders)"


def _table(t: str) -> str:
    if t == "fact_orders":
        return _fact_with_audit()
    return _CHECK_TABLE_CTE[t] or t


def _lit(v) -> str:
    return f"'{v}'" if isinstance(v, str) else str(v)


def _check_count_sql(c: Check) -> str:
    t = _table(c.table)
    col = c.column
    if c.kind == "not_null":
        return f"SELECT count(*) FROM {t} x WHERE {col} IS NULL"
    if c.kind == "unique":
        return (f"SELECT count(*) FROM (SELECT {col} FROM {t} x WHERE {col} IS NOT NULL "
                f"GROUP BY {col} HAVING count(*) > 1) u")
    if c.kind == "accepted_values":
        vals = ", ".join(_lit(v) for v in c.arg)
        return f"SELECT count(*) FROM {t} x WHERE {col} IS NOT NULL AND {col} NOT IN ({vals})"
    if c.kind == "expression_is_true":
        return f"SELECT count(*) FROM {t} x WHERE NOT ({col} {c.arg})"
    if c.kind == "relationships":
        pt, pc = c.arg
        return (f"SELECT count(*) FROM {t} x WHERE {col} IS NOT NULL AND NOT EXISTS "
                f"(SELECT 1 FROM {_table(pt)} p WHERE p.{pc} = x.{col})")
    raise ValueError(c.kind)


def _suite_sql(checks: list[Check]) -> str:
    rows = []
    for c in checks:
        sev = c.severity
        rows.append(
            f"SELECT '{c.name}' AS check_name, '{c.table}' AS table_name, '{c.column}' AS column_name, "
            f"'{c.kind}' AS kind, '{c.detail}' AS detail, '{sev}' AS severity, "
            f"CAST(({_check_count_sql(c)}) AS BIGINT) AS failures")
    body = "\n  UNION ALL\n  ".join(rows)
    return ("SELECT check_name, table_name, column_name, kind, detail, severity, failures, "
            "CASE WHEN failures = 0 THEN 'pass' ELSE severity END AS status FROM (\n  "
            + body + ") r")


def _suite_deps(checks: list[Check]) -> list[str]:
    deps = set()
    for c in checks:
        for t in [c.table] + ([c.arg[0]] if c.kind == "relationships" else []):
            if _CHECK_TABLE_CTE.get(t):
                deps.add(_CHECK_TABLE_CTE[t])
    return sorted(deps)


# The declared checks, one line a column: nn not null, u unique, av accepted
# values, ex expression, rel relationship. Fixed values.
CHECK_LIST = """
orders o_orderkey | nn | u
orders o_custkey | nn
orders o_totalprice | nn | ex >= 0
orders o_orderdate | nn
orders o_orderstatus | nn | av O, F, P
customer c_custkey | nn | u
customer c_mktsegment | av AUTOMOBILE, BUILDING, FURNITURE, HOUSEHOLD, MACHINERY
part p_partkey | nn | u
part p_retailprice | nn | ex > 0
partsupp ps_availqty | ex >= 0
supplier s_suppkey | nn | u
lineitem l_orderkey | nn
lineitem l_linenumber | nn
lineitem l_extendedprice | ex > 0
nation n_nationkey | nn | u
region r_regionkey | nn | u
stg_orders order_key | nn | u
stg_orders customer_key | nn | rel stg_customers.customer_key
stg_orders order_status | nn | av O, F, P
stg_orders order_status_desc | nn | av Open, Fulfilled, In Progress, Unknown
stg_orders order_total_price | nn | ex >= 0
stg_orders order_date | nn
stg_orders order_priority | nn
stg_orders order_priority_rank | ex between 1 and 99
stg_customers customer_key | nn | u
stg_customers customer_name | nn
stg_customers market_segment | nn | av AUTOMOBILE, BUILDING, FURNITURE, HOUSEHOLD, MACHINERY
stg_customers nation_name | nn
stg_customers region_name | nn
stg_customers account_balance | nn
stg_customers account_tier | nn | av Negative, Bronze, Silver, Gold, Platinum
stg_products product_key | nn | u
stg_products product_name | nn
stg_products retail_price | nn | ex > 0
int_orders_enriched order_line_sk | nn | u
int_orders_enriched order_key | nn
int_orders_enriched line_number | nn
int_orders_enriched order_date | nn
int_orders_enriched customer_key | nn
int_orders_enriched product_key | nn
int_orders_enriched net_revenue | nn | ex >= 0
int_orders_enriched gross_revenue | nn | ex >= net_revenue
int_orders_enriched discount_amount | nn | ex >= 0
int_orders_enriched delivery_status | av On-Time, Late
int_orders_enriched fiscal_year | nn
int_orders_enriched fiscal_quarter | nn
int_orders_enriched market_segment | av AUTOMOBILE, BUILDING, FURNITURE, HOUSEHOLD, MACHINERY
fact_orders order_line_sk | nn | u error
fact_orders customer_sk | nn
fact_orders product_sk | nn
fact_orders order_date_sk | nn
fact_orders order_key | nn
fact_orders line_number | nn
fact_orders quantity | nn | ex > 0
fact_orders net_revenue | nn | ex >= 0
fact_orders gross_revenue | nn | ex >= net_revenue
fact_orders discount_amount | nn | ex >= 0
fact_orders discount_rate | ex between 0 and 1
fact_orders delivery_status | nn | av On-Time, Late
fact_orders is_late_delivery | nn
fact_orders is_returned | nn
fact_orders order_status | av O, F, P
fact_orders fiscal_year | nn
fact_orders fiscal_quarter | nn | av 1, 2, 3, 4
fact_orders days_to_ship | ex >= 0
fact_orders _loaded_at | nn
dim_customer customer_sk | nn | u
dim_customer customer_key | nn
dim_customer customer_name | nn
dim_customer market_segment | nn | av AUTOMOBILE, BUILDING, FURNITURE, HOUSEHOLD, MACHINERY
dim_customer account_tier | nn | av Negative, Bronze, Silver, Gold, Platinum
dim_customer effective_from | nn
dim_customer effective_to | nn
dim_customer is_current | nn
dim_customer _row_hash | nn | u
dim_date date_sk | nn | u
dim_date full_date | nn | u
dim_date calendar_year | nn | ex between 1992 and 2030
dim_date calendar_month | nn | ex between 1 and 12
dim_date day_of_week | nn | ex between 0 and 6
dim_date fiscal_year | nn
dim_date fiscal_quarter | nn | av 1, 2, 3, 4
dim_date is_weekend | nn
dim_date is_weekday | nn
dim_product product_sk | nn | u
dim_product product_key | nn | u
dim_product product_name | nn
dim_product retail_price | nn | ex > 0
"""
_KINDS = {"nn": "not_null", "u": "unique", "av": "accepted_values", "ex": "expression_is_true", "rel": "relationships"}


def _listed_checks() -> list[Check]:
    out = []
    for line in CHECK_LIST.strip().splitlines():
        place, *rules = line.split(" | ")
        table, column = place.split(" ")
        for rule in rules:
            kind, _, arg = rule.partition(" ")
            severity = "error" if arg == "error" else "warn"
            value: object = None
            if kind == "av":
                value = [int(v) if v.isdigit() else v for v in arg.split(", ")]
            elif kind == "ex":
                value = arg
            elif kind == "rel":
                value = tuple(arg.split("."))
            out.append(Check(table, column, _KINDS[kind], value, severity=severity))
    return out


LISTED = _listed_checks()
for _kind, _name in [("not_null", "dq_not_null"), ("unique", "dq_unique"),
                     ("accepted_values", "dq_accepted_values"),
                     ("relationships", "dq_relationships"),
                     ("expression_is_true", "dq_expression")]:
    _some = [c for c in LISTED if c.kind == _kind]
    oq(_name, _suite_deps(_some), _suite_sql(_some))
oq("dq_report", _suite_deps(LISTED), _suite_sql(LISTED))

oq("dq_money_scale", ["src_partsupp"], "\n  UNION ALL\n  ".join(
    f"SELECT 'two_decimals__{t}__{c}' AS check_name, '{t}' AS table_name, '{c}' AS column_name, "
    f"'row_condition' AS kind, 'abs(cast({c} as double) - round(cast({c} as double), 2)) > 0.000001' AS detail, "
    f"'error' AS severity, n AS failures, CASE WHEN n = 0 THEN 'pass' ELSE 'error' END AS status "
    f"FROM (SELECT count(*) FILTER (abs(CAST({c} AS DOUBLE) - round(CAST({c} AS DOUBLE), 2)) > 0.000001) AS n "
    f"FROM {'src_partsupp' if t == 'partsupp' else t}) g"
    for t, c in [("orders", "o_totalprice"), ("customer", "c_acctbal"), ("part", "p_retailprice"),
                 ("partsupp", "ps_supplycost"), ("lineitem", "l_extendedprice"), ("lineitem", "l_quantity"),
                 ("lineitem", "l_discount"), ("lineitem", "l_tax")]))


def _row_count_sql(model: str, lo: int, hi) -> str:
    t = "fact_orders" if model == "fact_orders" else model
    hi_sql = "CAST(NULL AS BIGINT)" if hi is None else str(hi)
    above = (f" WHEN cnt > {hi} THEN 'FAIL: row count ' || CAST(cnt AS VARCHAR) || ' above maximum {hi}'"
             if hi is not None else "")
    return (f"SELECT '{model}' AS model, cnt, CAST({lo} AS BIGINT) AS expected_min, "
            f"CAST({hi_sql} AS BIGINT) AS expected_max, "
            f"CASE WHEN cnt < {lo} THEN 'FAIL: row count ' || CAST(cnt AS VARCHAR) || ' below minimum {lo}'"
            f"{above} END AS failure_reason FROM (SELECT count(*) AS cnt FROM {t}) c")


oq("dq_row_count", [m for m, _, _ in catalog.ROW_COUNT_BOUNDS],
   "\n  UNION ALL\n  ".join(_row_count_sql(*b) for b in catalog.ROW_COUNT_BOUNDS))

_plain = {}
_plain["dq_positive_amounts"] = (["fact_orders"], """
  SELECT order_line_sk, order_key, line_number, net_revenue, gross_revenue, quantity,
    extended_price, discount_amount,
    CASE WHEN net_revenue < 0 THEN 'net_revenue < 0' WHEN gross_revenue < 0 THEN 'gross_revenue < 0'
      WHEN quantity <= 0 THEN 'quantity <= 0' WHEN extended_price <= 0 THEN 'extended_price <= 0'
      WHEN discount_amount < 0 THEN 'discount_amount < 0' WHEN tax_amount < 0 THEN 'tax_amount < 0'
    END AS failure_reason
  FROM fact_orders
  WHERE net_revenue < 0 OR gross_revenue < 0 OR quantity <= 0 OR extended_price <= 0
    OR discount_amount < 0 OR tax_amount < 0""")
oq("dq_positive_amounts", *_plain["dq_positive_amounts"])
_plain["dq_invalid_status"] = (["fact_orders"], """
  SELECT fo.order_line_sk, fo.order_key, fo.order_date, fo.order_status,
    'Invalid order_status: ' || coalesce(fo.order_status, 'NULL') AS failure_reason
  FROM fact_orders fo
  LEFT JOIN (VALUES ('O'), ('F'), ('P')) vs(status) ON fo.order_status = vs.status
  WHERE vs.status IS NULL""")
oq("dq_invalid_status", *_plain["dq_invalid_status"])


# The fact with defects planted by key arithmetic, as stated in the catalog.
PLANTED = """
  , planted AS (SELECT * REPLACE (
      CASE WHEN order_key % 97 = 0 THEN -net_revenue ELSE net_revenue END AS net_revenue,
      CASE WHEN order_key % 89 = 0 THEN 0 ELSE quantity END AS quantity,
      CASE WHEN order_key % 101 = 0 THEN 'X' WHEN order_key % 103 = 0 THEN NULL ELSE order_status END AS order_status,
      CASE WHEN order_key % 107 = 0 THEN 'nobody' ELSE customer_sk END AS customer_sk,
      CASE WHEN order_key % 109 = 0 THEN 'nothing' ELSE product_sk END AS product_sk,
      CASE WHEN order_key % 113 = 0 THEN 18000101 ELSE order_date_sk END AS order_date_sk) FROM fact_orders)"""


def _on_planted(name: str) -> str:
    deps, text = _plain[name]
    return PLANTED + text.replace("FROM fact_orders", "FROM planted")


def _gaps_sql(boundary: str) -> str:
    expected = "effective_to" if boundary == "as_written" else "effective_to + 1"
    return f"""
  SELECT '{boundary}' AS boundary, customer_key, customer_sk, effective_from, effective_to,
    next_version_from, coalesce(gap_reason, range_reason) AS failure_reason
  FROM (
    SELECT *,
      CASE WHEN next_version_from IS NOT NULL AND {expected} <> next_version_from
           THEN 'GAP or OVERLAP between versions' END AS gap_reason,
      CASE WHEN effective_to < effective_from THEN 'effective_to before effective_from' END AS range_reason
    FROM (
      SELECT customer_key, customer_sk, effective_from, effective_to,
        lead(effective_from) OVER (PARTITION BY customer_key
                                   ORDER BY effective_from, effective_to, customer_sk) AS next_version_from
      FROM dim_customer) v) g
  WHERE gap_reason IS NOT NULL OR range_reason IS NOT NULL"""


oq("dq_scd2_gaps", ["dim_customer"], _gaps_sql("inclusive") + "\n  UNION ALL" + _gaps_sql("as_written"))


def _orphan_sql(fk: str, dim: str, dim_key: str, unknown: str) -> str:
    return f"""
  SELECT fo.order_line_sk, CAST(fo.{fk} AS VARCHAR) AS fk_value, '{dim}' AS failed_dimension,
    '{fk} ' || CAST(fo.{fk} AS VARCHAR) || ' not found in {dim}' AS reason
  FROM fact_orders fo
  WHERE fo.{fk} <> {unknown} AND NOT EXISTS (SELECT 1 FROM {dim} d WHERE d.{dim_key} = fo.{fk})"""


_plain["dq_orphan_fks"] = (["fact_orders", "dim_customer", "dim_product", "dim_date"], "\n  UNION ALL".join([
    _orphan_sql("customer_sk", "dim_customer", "customer_sk", "'-1'"),
    _orphan_sql("product_sk", "dim_product", "product_sk", "'-1'"),
    _orphan_sql("order_date_sk", "dim_date", "date_sk", "-1"),
    _orphan_sql("ship_date_sk", "dim_date", "date_sk", "-1"),
]))
oq("dq_orphan_fks", *_plain["dq_orphan_fks"])
for _name in ("dq_positive_amounts", "dq_invalid_status", "dq_orphan_fks"):
    oq(f"{_name}_planted", _plain[_name][0], _on_planted(_name))
oq("stored_failures", ["fact_orders"], _on_planted("dq_positive_amounts"))
oq("column_values", ["stg_orders"], """
  SELECT DISTINCT order_priority FROM stg_orders WHERE order_priority IS NOT NULL
  ORDER BY order_priority LIMIT 50""")
oq("source_freshness", [], f"""
  SELECT 'orders' AS table_name, 'o_orderdate' AS loaded_at_field, max_loaded_at,
    DATE '{AS_OF}' AS as_of, CAST(DATE '{AS_OF}' - max_loaded_at AS INTEGER) AS age_days,
    CASE WHEN DATE '{AS_OF}' - max_loaded_at > 3 THEN 'error'
         WHEN DATE '{AS_OF}' - max_loaded_at > 1 THEN 'warn' ELSE 'pass' END AS status
  FROM (SELECT max(CAST(o_orderdate AS DATE)) AS max_loaded_at FROM orders) t""")

# --- measures ------------------------------------------------------------
_REV = "sum(CAST(net_revenue AS DECIMAL(12,2)))"


def _overview_sql(where: str = "") -> str:
    return f"""
  SELECT CAST(rev AS DOUBLE) AS total_revenue, order_count,
    {_ratio('rev', 'order_count')} AS avg_order_value, {_ratio('on_time', 'lines')} AS on_time_rate,
    lines AS line_count
  FROM (SELECT {_REV} AS rev, count(DISTINCT order_key) AS order_count,
          count(*) FILTER (WHERE NOT is_late_delivery) AS on_time, count(*) AS lines
        FROM fact_orders {where}) a"""


oq("sampled_failures", ["fact_orders"], _on_planted("dq_positive_amounts") + " ORDER BY order_key, line_number LIMIT 500")
oq("kpi_overview", ["fact_orders"], _overview_sql())
_S = catalog.SLICE
oq("kpi_sliced", ["fact_orders"], _overview_sql(
    f"WHERE fiscal_year = {_S['fiscal_year']} AND region_name = '{_S['region']}' "
    f"AND market_segment = '{_S['segment']}'"))
oq("revenue_by_month", ["fact_orders"], f"""
  , monthly AS (SELECT CAST(date_trunc('month', order_date) AS DATE) AS month_start, {_REV} AS rev
                FROM fact_orders GROUP BY 1),
  grid AS (SELECT CAST(range AS DATE) AS month_start
           FROM (SELECT min(month_start) AS lo, max(month_start) AS hi FROM monthly) b,
                range(b.lo, b.hi + INTERVAL 1 DAY, INTERVAL 1 MONTH)),
  dense AS (SELECT g.month_start, coalesce(m.rev, 0) AS rev FROM grid g
            LEFT JOIN monthly m ON g.month_start = m.month_start)
  SELECT month_start, strftime(month_start, '%Y-%m') AS year_month, CAST(rev AS DOUBLE) AS revenue,
    CAST(lag(rev) OVER (ORDER BY month_start) AS DOUBLE) AS prev_month_revenue,
    {_ratio('rev - lag(rev) OVER (ORDER BY month_start)', 'lag(rev) OVER (ORDER BY month_start)')} AS mom_pct
  FROM dense""")
oq("revenue_yoy", ["fact_orders"], f"""
  , per AS (SELECT CAST(date_trunc('month', order_date) AS DATE) AS period_start, {_REV} AS rev
            FROM fact_orders GROUP BY 1)
  SELECT p.period_start, CAST(p.rev AS DOUBLE) AS revenue, CAST(l.rev AS DOUBLE) AS ly_revenue,
    {_ratio('p.rev - l.rev', 'l.rev')} AS yoy_pct
  FROM per p LEFT JOIN per l ON CAST(l.period_start + INTERVAL 12 MONTH AS DATE) = p.period_start"""
   )


def _to_date_sql(period: str) -> str:
    col = f"{period[0]}td_revenue"
    return f"""
  SELECT order_date, CAST(date_trunc('{period}', order_date) AS DATE) AS period_start,
    CAST(rev AS DOUBLE) AS daily_revenue,
    CAST(sum(rev) OVER (PARTITION BY date_trunc('{period}', order_date) ORDER BY order_date
                        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS {col}
  FROM (SELECT order_date, {_REV} AS rev FROM fact_orders GROUP BY 1) d"""


oq("revenue_mtd", ["fact_orders"], _to_date_sql("month"))
oq("revenue_qtd", ["fact_orders"], _to_date_sql("quarter"))


def _share_sql(by: str) -> str:
    return f"""
  SELECT {by}, CAST(rev AS DOUBLE) AS revenue, {_ratio('rev', 'sum(rev) OVER ()')} AS revenue_share
  FROM (SELECT {by}, {_REV} AS rev FROM fact_orders GROUP BY 1) g"""


oq("revenue_by_segment", ["fact_orders"], _share_sql("market_segment"))
oq("revenue_by_region", ["fact_orders"], _share_sql("region_name"))
oq("shipping_kpis", ["fact_orders"], f"""
  SELECT {_ratio('s_ship', 'n_ship')} AS avg_days_to_ship, {_ratio('s_transit', 'n_transit')} AS avg_transit_days,
    {_ratio('late', 'lines')} AS late_rate, {_ratio('returned', 'lines')} AS return_rate,
    {_ratio('s_late', 'n_late')} AS avg_days_late, lines
  FROM (SELECT sum(days_to_ship) AS s_ship, count(days_to_ship) AS n_ship,
          sum(days_in_transit) AS s_transit, count(days_in_transit) AS n_transit,
          count(*) FILTER (WHERE is_late_delivery) AS late, count(*) FILTER (WHERE is_returned) AS returned,
          sum(CASE WHEN days_late > 0 THEN days_late END) AS s_late,
          count(CASE WHEN days_late > 0 THEN days_late END) AS n_late, count(*) AS lines
        FROM fact_orders) a""")
oq("on_time_by_ship_mode", ["fact_orders"], f"""
  SELECT ship_mode, lines, on_time_lines, late_lines, {_ratio('on_time_lines', 'lines')} AS on_time_rate
  FROM (SELECT ship_mode, count(*) AS lines, count(*) FILTER (WHERE NOT is_late_delivery) AS on_time_lines,
          count(*) FILTER (WHERE is_late_delivery) AS late_lines
        FROM fact_orders GROUP BY 1) g""")
oq("fulfillment_histogram", ["fact_orders"], """
  SELECT bucket, CASE WHEN bucket = 0 THEN '<1' WHEN bucket = 14 THEN '14+' ELSE CAST(bucket AS VARCHAR) END
      AS bucket_label, count(*) AS lines
  FROM (SELECT CAST(CASE WHEN total_fulfillment_days IS NULL THEN NULL WHEN total_fulfillment_days < 1 THEN 0
                        WHEN total_fulfillment_days >= 14 THEN 14 ELSE total_fulfillment_days END AS INTEGER)
               AS bucket FROM fact_orders) b
  GROUP BY 1, 2""")
oq("late_by_material", ["fact_orders"], f"""
  SELECT product_material, total_lines, late_lines, {_ratio('late_lines', 'total_lines')} AS late_rate,
    {_ratio('s', 'n')} AS avg_days_late
  FROM (SELECT product_material, count(*) AS total_lines, count(*) FILTER (WHERE is_late_delivery) AS late_lines,
          sum(CASE WHEN days_late > 0 THEN days_late END) AS s,
          count(CASE WHEN days_late > 0 THEN days_late END) AS n
        FROM fact_orders GROUP BY 1) g""")
oq("tier_revenue_by_quarter", ["fact_orders", "dim_customer"], f"""
  SELECT CAST(year(q) AS INTEGER) AS calendar_year, CAST(quarter(q) AS INTEGER) AS calendar_quarter,
    account_tier, CAST(sum(rev) AS DOUBLE) AS revenue
  FROM (SELECT CAST(date_trunc('quarter', f.order_date) AS DATE) AS q,
          coalesce(dc.account_tier, 'Unknown') AS account_tier, CAST(f.net_revenue AS DECIMAL(12,2)) AS rev
        FROM fact_orders f LEFT JOIN dim_customer dc ON f.customer_sk = dc.customer_sk) t
  GROUP BY 1, 2, 3""")
oq("segment_box_plot", ["fact_orders", "dim_customer"], """
  , per_cust AS (
    SELECT coalesce(dc.market_segment, 'Unknown') AS market_segment, CAST(c.rev AS DOUBLE) AS customer_revenue
    FROM (SELECT customer_sk, sum(CAST(net_revenue AS DECIMAL(12,2))) AS rev FROM fact_orders GROUP BY 1) c
    LEFT JOIN dim_customer dc ON c.customer_sk = dc.customer_sk),
  q AS (
    SELECT market_segment, count(customer_revenue) AS n,
      CAST(quantile_cont(customer_revenue, 0.25) AS DECIMAL(18,4)) AS q1,
      CAST(quantile_cont(customer_revenue, 0.5) AS DECIMAL(18,4)) AS median,
      CAST(quantile_cont(customer_revenue, 0.75) AS DECIMAL(18,4)) AS q3
    FROM per_cust GROUP BY 1),
  f AS (
    SELECT *, CAST(q3 - q1 AS DECIMAL(18,4)) AS iqr,
      CAST(q1 - CAST(q3 - q1 AS DECIMAL(18,4)) * 1.5 AS DECIMAL(18,4)) AS lower_fence,
      CAST(q3 + CAST(q3 - q1 AS DECIMAL(18,4)) * 1.5 AS DECIMAL(18,4)) AS upper_fence
    FROM q)
  SELECT f.market_segment, f.n AS n_customers, CAST(f.q1 AS DOUBLE) AS q1, CAST(f.median AS DOUBLE) AS median,
    CAST(f.q3 AS DOUBLE) AS q3, CAST(f.iqr AS DOUBLE) AS iqr, CAST(f.lower_fence AS DOUBLE) AS lower_fence,
    CAST(f.upper_fence AS DOUBLE) AS upper_fence,
    (SELECT count(*) FROM per_cust p WHERE p.market_segment = f.market_segment
       AND (CAST(p.customer_revenue AS DECIMAL(18,4)) < f.lower_fence
            OR CAST(p.customer_revenue AS DECIMAL(18,4)) > f.upper_fence)) AS n_outliers
  FROM f""")
oq("top_customers", ["fact_orders", "dim_customer"], """
  SELECT CAST(row_number() OVER (ORDER BY rev DESC, customer_key) AS INTEGER) AS rank, customer_key,
    customer_name, account_tier, market_segment, CAST(rev AS DOUBLE) AS net_revenue, order_count
  FROM (
    SELECT dc.customer_key, dc.customer_name, dc.account_tier, dc.market_segment, c.rev, c.order_count
    FROM (SELECT customer_sk, sum(CAST(net_revenue AS DECIMAL(12,2))) AS rev,
            count(DISTINCT order_key) AS order_count FROM fact_orders GROUP BY 1) c
    LEFT JOIN dim_customer dc ON c.customer_sk = dc.customer_sk
    ORDER BY c.rev DESC, dc.customer_key LIMIT 20) t""")
oq("tier_migration", ["dim_customer"], """
  SELECT from_tier, to_tier, count(DISTINCT customer_key) AS customers
  FROM (SELECT customer_key, account_tier AS from_tier,
          lead(account_tier) OVER (PARTITION BY customer_key
                                   ORDER BY effective_from, effective_to, customer_sk) AS to_tier
        FROM dim_customer) t
  WHERE to_tier IS NOT NULL AND to_tier <> from_tier
  GROUP BY 1, 2""")
oq("weighted_rates", ["fact_orders"], f"""
  SELECT market_segment, {_ratio('wd', 'ext')} AS weighted_discount_rate,
    CAST(CAST({_ratio('wm', 'net_m')} AS DECIMAL(18,6)) AS DOUBLE) AS weighted_margin_pct
  FROM (SELECT market_segment,
          sum(CAST(discount_rate AS DECIMAL(4,2)) * CAST(extended_price AS DECIMAL(12,2))) AS wd,
          sum(CAST(extended_price AS DECIMAL(12,2))) AS ext,
          sum(CASE WHEN estimated_margin_pct IS NOT NULL THEN CAST(estimated_margin_pct AS DECIMAL(24,12)) * CAST(net_revenue AS DECIMAL(12,2)) END) AS wm,
          sum(CASE WHEN estimated_margin_pct IS NOT NULL THEN CAST(net_revenue AS DECIMAL(12,2)) END) AS net_m
        FROM fact_orders GROUP BY 1) g""")

# --- monitoring ----------------------------------------------------------
oq("relation_count_diff", ["fact_orders"], """
  SELECT 'lineitem' AS relation_a, 'fact_orders' AS relation_b, a.count_a, b.count_b,
    b.count_b - a.count_a AS diff
  FROM (SELECT count(*) AS count_a FROM lineitem) a, (SELECT count(*) AS count_b FROM fact_orders) b""")
oq("volume_anomaly", ["fact_orders"], """
  , daily AS (SELECT order_date AS day, count(*) AS rows FROM fact_orders GROUP BY 1),
  w AS (SELECT day, rows,
          sum(rows) OVER win AS s1, sum(rows * rows) OVER win AS s2, count(rows) OVER win AS n
        FROM daily WINDOW win AS (ORDER BY day ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)),
  z AS (SELECT *, CAST(s1 AS DOUBLE) / CAST(n AS DOUBLE) AS mean,
          n * s2 - s1 * s1 AS var_num,
          CAST(n * s2 - s1 * s1 AS DOUBLE) / CAST(n * (n - 1) AS DOUBLE) AS var FROM w)
  SELECT day, rows, n AS window_days,
    CAST(CAST(CASE WHEN n > 0 THEN mean END AS DECIMAL(18,6)) AS DOUBLE) AS trailing_mean,
    CAST(CAST(CASE WHEN n >= 2 THEN sqrt(var) END AS DECIMAL(18,6)) AS DOUBLE) AS trailing_stddev,
    CAST(CAST(CASE WHEN n >= 2 AND var_num > 0 THEN (CAST(rows AS DOUBLE) - mean) / sqrt(var) END
              AS DECIMAL(18,6)) AS DOUBLE) AS z_score,
    coalesce(abs(CASE WHEN n >= 2 AND var_num > 0 THEN (CAST(rows AS DOUBLE) - mean) / sqrt(var) END) > 3.0, FALSE)
      AS is_anomaly
  FROM z""")


# Kept aggregates, after a load has corrected dates: those of the final fact.
for _name in ("kpi_overview", "revenue_by_month", "late_by_material", "top_customers"):
    SQL[f"maintained_{_name}"] = SQL[_name]
