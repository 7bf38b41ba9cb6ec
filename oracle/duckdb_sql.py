"""DuckDB SQL for every registered query, over the driver's pre-registered views.

Each query is one ``WITH … SELECT``: raw extracts shaped exactly as
``ledgerline.sources.driver_tables`` shapes them, cleaned as the silver specs clean them, the
star schema, then the query itself. The SQL is written independently of the Spark code; only
column lists are shared. Idioms that agree between the engines: money as ``DECIMAL(18,2)``
before any arithmetic; ``('0x' || substr(md5(k), 1, 15))::BIGINT`` for the surrogate key;
``row_number`` ordered by every column ``DESC NULLS LAST`` for the dedupe survivor; an
explicit title-case expression for Spark's ``initcap``.
"""

from __future__ import annotations

TS = "TIMESTAMP '2024-06-01 00:00:00'"


def initcap(expr: str) -> str:
    return (
        f"array_to_string(list_transform(string_split({expr}, ' '), "
        f"lambda w: upper(left(w, 1)) || lower(substr(w, 2))), ' ')"
    )


def money_text(expr: str) -> str:
    return f"CAST(CAST({expr} AS DECIMAL(18,2)) AS VARCHAR)"


def dirty(key: str, text: str) -> str:
    return f"CASE WHEN {key} % 50 = 0 THEN 'bad' ELSE {text} END"


def latest(source: str, keys: list[str], columns: list[str]) -> str:
    """Rows of ``source`` that survive the dedupe on ``keys`` (greatest tuple wins)."""
    order = ", ".join(f"{c} DESC NULLS LAST" for c in ["ingested_at"] + [c for c in columns if c not in keys])
    part = ", ".join(keys)
    return f"(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {part} ORDER BY {order}) AS _rn FROM {source}) WHERE _rn = 1)"


GEO = (
    "(SELECT c.c_custkey, n.n_name, r.r_name FROM customer c "
    "JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey)"
)

RAW = {
    "raw_customers": f"""
SELECT CAST(c.c_custkey AS VARCHAR) AS customer_id,
       lower(c.c_name) AS customer_name,
       '09' || lpad(CAST(c.c_custkey AS VARCHAR), 9, '0') AS phone_number,
       'customer' || CAST(c.c_custkey AS VARCHAR) || '@example.com' AS email,
       upper(n.n_name) AS city,
       lower(r.r_name) AS region,
       CAST(NULL AS VARCHAR) AS township,
       lower(c.c_mktsegment) AS segment,
       {dirty('c.c_custkey', "CAST(DATE '1990-01-01' + CAST(c.c_custkey % 3650 AS INTEGER) AS VARCHAR) || ' 00:00:00'")} AS created_at,
       {TS} AS ingested_at
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey""",
    "raw_sellers": f"""
SELECT CAST(s.s_suppkey AS VARCHAR) AS seller_id,
       lower(s.s_name) AS seller_name,
       upper(n.n_name) AS city,
       upper(r.r_name) AS region,
       CASE WHEN s.s_acctbal < 0 THEN 'individual' ELSE 'business' END AS seller_type,
       {dirty('s.s_suppkey', 'CAST(s.s_suppkey % 5 + 1 AS VARCHAR)')} AS rating,
       CAST(NULL AS VARCHAR) AS created_at,
       {TS} AS ingested_at
FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey""",
    "raw_products": f"""
SELECT CAST(p_partkey AS VARCHAR) AS product_id,
       CAST(NULL AS VARCHAR) AS seller_id,
       p_name AS product_name,
       p_type AS category,
       p_brand AS brand,
       {dirty('p_partkey', money_text('p_retailprice'))} AS unit_price_mmk,
       CASE WHEN p_partkey % 10 = 0 THEN 'false' ELSE 'true' END AS is_active,
       CAST(NULL AS VARCHAR) AS created_at,
       {TS} AS ingested_at
FROM part""",
    "raw_orders": f"""
SELECT CAST(o.o_orderkey AS VARCHAR) AS order_id,
       CAST(o.o_custkey AS VARCHAR) AS customer_id,
       {dirty('o.o_orderkey', 'CAST(o.o_orderdate AS VARCHAR)')} AS order_timestamp,
       nullif(o.o_orderstatus, 'P') AS order_status,
       g.n_name AS city,
       g.r_name AS region,
       nullif(o.o_orderpriority, '5-LOW') AS payment_method,
       {dirty('o.o_orderkey', "'0.00'")} AS shipping_fee_mmk,
       {money_text('o.o_totalprice')} AS subtotal_amount_mmk,
       {money_text('o.o_totalprice')} AS order_total_mmk,
       'MMK' AS currency,
       CAST(NULL AS VARCHAR) AS item_count,
       CAST(NULL AS VARCHAR) AS total_quantity,
       {TS} AS ingested_at,
       CAST(o.o_orderdate AS DATE) AS batch_date
FROM orders o LEFT JOIN {GEO} g ON o.o_custkey = g.c_custkey""",
    "raw_order_items": f"""
SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS order_item_id,
       CAST(l_orderkey AS VARCHAR) AS order_id,
       CAST(l_partkey AS VARCHAR) AS product_id,
       CAST(l_suppkey AS VARCHAR) AS seller_id,
       CAST(l_linenumber AS VARCHAR) AS line_number,
       CAST(CAST(round(l_quantity) AS INTEGER) AS VARCHAR) AS quantity,
       {dirty('l_orderkey', money_text('p_retailprice'))} AS unit_price_mmk,
       CAST(gross AS VARCHAR) AS gross_line_amount_mmk,
       CAST(discount AS VARCHAR) AS discount_amount_mmk,
       CAST(CAST(gross - discount AS DECIMAL(18,2)) AS VARCHAR) AS net_line_amount_mmk,
       {TS} AS ingested_at,
       CAST(o_orderdate AS DATE) AS batch_date
FROM (SELECT l.*, o.o_orderdate, p.p_retailprice,
             CAST(l.l_extendedprice AS DECIMAL(18,2)) AS gross,
             CAST(round(CAST(l.l_extendedprice AS DECIMAL(18,2)) * CAST(l.l_discount AS DECIMAL(18,2)), 2) AS DECIMAL(18,2)) AS discount
      FROM lineitem l
      LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
      LEFT JOIN part p ON l.l_partkey = p.p_partkey)""",
    "raw_payments": f"""
SELECT CAST(event_id AS VARCHAR) AS payment_id,
       CAST(NULL AS VARCHAR) AS order_id,
       CAST(user_id AS VARCHAR) AS customer_id,
       CAST(NULL AS VARCHAR) AS payment_method,
       CASE WHEN event_type = 'purchase' THEN 'captured' ELSE 'refunded' END AS payment_status,
       {dirty('event_id', money_text('value'))} AS payment_amount_mmk,
       {dirty('event_id', 'CAST(ts AS VARCHAR)')} AS paid_at,
       {TS} AS ingested_at,
       CAST(ts AS DATE) AS batch_date
FROM events WHERE event_type IN ('purchase', 'error')""",
    "raw_deliveries": f"""
SELECT CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) AS delivery_id,
       CAST(l.l_orderkey AS VARCHAR) AS order_id,
       'carrier-' || l.l_returnflag AS delivery_provider,
       og.r_name AS region,
       og.n_name AS city,
       CAST(CAST(og.o_orderdate AS DATE) + 30 AS VARCHAR) AS promised_delivery_date,
       {dirty('l.l_orderkey', 'CAST(CAST(l.l_shipdate AS DATE) AS VARCHAR)')} AS actual_delivery_date,
       CASE WHEN l.l_linestatus = 'F' THEN 'delivered' ELSE 'in_transit' END AS delivery_status,
       {money_text('l.l_quantity')} AS delivery_fee_mmk,
       {TS} AS ingested_at,
       CAST(og.o_orderdate AS DATE) AS batch_date
FROM lineitem l
LEFT JOIN (SELECT o.o_orderkey, o.o_orderdate, g.n_name, g.r_name
           FROM orders o LEFT JOIN {GEO} g ON o.o_custkey = g.c_custkey) og
  ON l.l_orderkey = og.o_orderkey""",
    "raw_inventory_snapshots": f"""
SELECT 'inv-' || CAST(p.p_partkey AS VARCHAR) AS inventory_snapshot_id,
       CAST(p.p_partkey AS VARCHAR) AS product_id,
       CAST(NULL AS VARCHAR) AS seller_id,
       {dirty('p.p_partkey', 'CAST(CAST(m.last_ship AS DATE) AS VARCHAR)')} AS snapshot_date,
       CAST(p.p_size % 10 AS VARCHAR) AS available_quantity,
       CAST(p.p_size // 10 AS VARCHAR) AS reserved_quantity,
       CASE WHEN p.p_size % 10 = 0 THEN 'out_of_stock' WHEN p.p_size % 10 < 3 THEN 'low_stock' ELSE 'in_stock' END AS inventory_status,
       '3' AS reorder_threshold,
       {TS} AS ingested_at,
       CAST(m.last_ship AS DATE) AS batch_date
FROM part p LEFT JOIN (SELECT l_partkey, max(l_shipdate) AS last_ship FROM lineitem GROUP BY l_partkey) m
  ON p.p_partkey = m.l_partkey""",
}

# source column order of each raw extract (used for the dedupe tie-break order)
RAW_COLUMNS = {
    "customers": ["customer_id", "customer_name", "phone_number", "email", "city", "region", "township", "segment", "created_at"],
    "sellers": ["seller_id", "seller_name", "city", "region", "seller_type", "rating", "created_at"],
    "products": ["product_id", "seller_id", "product_name", "category", "brand", "unit_price_mmk", "is_active", "created_at"],
    "orders": ["order_id", "customer_id", "order_timestamp", "order_status", "city", "region", "payment_method",
               "shipping_fee_mmk", "subtotal_amount_mmk", "order_total_mmk", "currency", "item_count",
               "total_quantity", "batch_date"],
    "order_items": ["order_item_id", "order_id", "product_id", "seller_id", "line_number", "quantity", "unit_price_mmk",
                    "gross_line_amount_mmk", "discount_amount_mmk", "net_line_amount_mmk", "batch_date"],
    "payments": ["payment_id", "order_id", "customer_id", "payment_method", "payment_status", "payment_amount_mmk",
                 "paid_at", "batch_date"],
    "deliveries": ["delivery_id", "order_id", "delivery_provider", "region", "city", "promised_delivery_date",
                   "actual_delivery_date", "delivery_status", "delivery_fee_mmk", "batch_date"],
    "inventory_snapshots": ["inventory_snapshot_id", "product_id", "seller_id", "snapshot_date", "available_quantity",
                            "reserved_quantity", "inventory_status", "reorder_threshold", "batch_date"],
}
# a daily entity's id is unique within its batch day
KEYS = {
    "customers": ["customer_id"], "sellers": ["seller_id"], "products": ["product_id"], "orders": ["order_id", "batch_date"],
    "order_items": ["order_item_id", "batch_date"], "payments": ["payment_id", "batch_date"],
    "deliveries": ["delivery_id", "batch_date"], "inventory_snapshots": ["inventory_snapshot_id", "batch_date"],
}

M = "DECIMAL(18,2)"


def _silver_select(entity: str) -> str:
    sel = {
        "customers": f"""customer_id, {initcap('customer_name')} AS customer_name, phone_number, email,
       {initcap('city')} AS city, {initcap('region')} AS region, township, segment,
       TRY_CAST(created_at AS TIMESTAMP) AS created_at""",
        "sellers": f"""seller_id, {initcap('seller_name')} AS seller_name, {initcap('city')} AS city,
       {initcap('region')} AS region, seller_type, TRY_CAST(rating AS DECIMAL(5,2)) AS rating,
       TRY_CAST(created_at AS TIMESTAMP) AS created_at""",
        "products": f"""product_id, seller_id, product_name, category, brand,
       TRY_CAST(unit_price_mmk AS {M}) AS unit_price_mmk, TRY_CAST(is_active AS BOOLEAN) AS is_active,
       TRY_CAST(created_at AS TIMESTAMP) AS created_at""",
        "orders": f"""order_id, customer_id, TRY_CAST(order_timestamp AS TIMESTAMP) AS order_timestamp,
       CAST(TRY_CAST(order_timestamp AS TIMESTAMP) AS DATE) AS order_date,
       coalesce(order_status, 'placed') AS order_status, {initcap('city')} AS city, {initcap('region')} AS region,
       coalesce(payment_method, 'cash_on_delivery') AS payment_method,
       TRY_CAST(shipping_fee_mmk AS {M}) AS shipping_fee_mmk, TRY_CAST(subtotal_amount_mmk AS {M}) AS subtotal_amount_mmk,
       TRY_CAST(order_total_mmk AS {M}) AS order_total_mmk, currency,
       TRY_CAST(item_count AS INTEGER) AS item_count, TRY_CAST(total_quantity AS INTEGER) AS total_quantity, batch_date""",
        "order_items": f"""order_item_id, order_id, product_id, seller_id,
       TRY_CAST(line_number AS INTEGER) AS line_number, TRY_CAST(quantity AS INTEGER) AS quantity,
       TRY_CAST(unit_price_mmk AS {M}) AS unit_price_mmk, TRY_CAST(gross_line_amount_mmk AS {M}) AS gross_line_amount_mmk,
       TRY_CAST(discount_amount_mmk AS {M}) AS discount_amount_mmk, TRY_CAST(net_line_amount_mmk AS {M}) AS net_line_amount_mmk,
       batch_date""",
        "payments": f"""payment_id, order_id, customer_id, payment_method, payment_status,
       TRY_CAST(payment_amount_mmk AS {M}) AS payment_amount_mmk, TRY_CAST(paid_at AS TIMESTAMP) AS paid_at, batch_date""",
        "deliveries": f"""delivery_id, order_id, delivery_provider, {initcap('region')} AS region, {initcap('city')} AS city,
       TRY_CAST(promised_delivery_date AS DATE) AS promised_delivery_date,
       TRY_CAST(actual_delivery_date AS DATE) AS actual_delivery_date, delivery_status,
       TRY_CAST(delivery_fee_mmk AS {M}) AS delivery_fee_mmk,
       CAST(date_diff('day', TRY_CAST(promised_delivery_date AS DATE), TRY_CAST(actual_delivery_date AS DATE)) AS INTEGER) AS delivery_delay_days,
       batch_date""",
        "inventory_snapshots": """inventory_snapshot_id, product_id, seller_id, TRY_CAST(snapshot_date AS DATE) AS snapshot_date,
       TRY_CAST(available_quantity AS INTEGER) AS available_quantity,
       TRY_CAST(reserved_quantity AS INTEGER) AS reserved_quantity, inventory_status,
       TRY_CAST(reorder_threshold AS INTEGER) AS reorder_threshold, batch_date""",
    }
    return sel[entity]


def silver_sql(entity: str, dedupe: bool = True) -> str:
    source = f"raw_{entity}"
    if dedupe:
        source = latest(source, KEYS[entity], RAW_COLUMNS[entity])
    return f"SELECT {_silver_select(entity)}\nFROM {source}"


GOLD = {
    "dim_customer": "SELECT customer_id, customer_name, phone_number, email, city, region, township, segment, created_at FROM silver_customers",
    "dim_seller": "SELECT seller_id, seller_name, city, region, seller_type, rating, created_at FROM silver_sellers",
    "dim_product": "SELECT product_id, seller_id, product_name, category, brand, unit_price_mmk, is_active, created_at FROM silver_products",
    "dim_region": """
SELECT ('0x' || substr(md5(region || '|' || city), 1, 15))::BIGINT AS region_key, region, city
FROM (SELECT DISTINCT region, city
      FROM (SELECT region, city FROM silver_customers UNION ALL SELECT region, city FROM silver_sellers)
      WHERE region IS NOT NULL AND city IS NOT NULL)""",
    "dim_date": """
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS calendar_date,
       CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month, CAST(day(d) AS INTEGER) AS day,
       monthname(d) AS month_name, CAST(weekofyear(d) AS INTEGER) AS week_of_year
FROM (SELECT CAST(unnest(generate_series(min(order_date), max(order_date), INTERVAL 1 DAY)) AS DATE) AS d
      FROM silver_orders HAVING min(order_date) IS NOT NULL)""",
    "fact_orders": """
SELECT o.order_id, o.customer_id, r.region_key, CAST(o.order_timestamp AS DATE) AS order_date, o.order_timestamp,
       o.order_status, o.payment_method, o.shipping_fee_mmk, o.subtotal_amount_mmk, o.order_total_mmk,
       o.item_count, o.total_quantity, o.batch_date
FROM silver_orders o LEFT JOIN dim_region r ON o.region = r.region AND o.city = r.city""",
    "fact_order_items": """
SELECT i.order_item_id, i.order_id, i.product_id, i.seller_id, p.category, p.brand, i.line_number, i.quantity,
       i.unit_price_mmk, i.gross_line_amount_mmk, i.discount_amount_mmk, i.net_line_amount_mmk, i.batch_date
FROM silver_order_items i LEFT JOIN silver_products p ON i.product_id = p.product_id""",
    "fact_payments": """
SELECT payment_id, order_id, customer_id, payment_method, payment_status, payment_amount_mmk,
       CAST(paid_at AS DATE) AS payment_date, paid_at, batch_date
FROM silver_payments""",
    "fact_inventory_snapshot": """
SELECT inventory_snapshot_id, product_id, seller_id, snapshot_date, available_quantity, reserved_quantity,
       inventory_status, reorder_threshold, batch_date
FROM silver_inventory_snapshots""",
    "fact_delivery_performance": """
SELECT delivery_id, order_id, delivery_provider, region, city, promised_delivery_date, actual_delivery_date,
       delivery_status, delivery_fee_mmk, delivery_delay_days, batch_date
FROM silver_deliveries""",
}

# which CTEs each gold table needs (in dependency order)
GOLD_NEEDS = {
    "dim_customer": ["customers"],
    "dim_seller": ["sellers"],
    "dim_product": ["products"],
    "dim_region": ["customers", "sellers"],
    "dim_date": ["orders"],
    "fact_orders": ["customers", "sellers", "orders"],
    "fact_order_items": ["products", "order_items"],
    "fact_payments": ["payments"],
    "fact_inventory_snapshot": ["inventory_snapshots"],
    "fact_delivery_performance": ["deliveries"],
}
GOLD_DEPS = {"fact_orders": ["dim_region"]}


def with_ctes(entities: list[str], gold: list[str] = (), extra: list[tuple[str, str]] = (), dedupe: bool = True) -> str:
    """``WITH`` clause holding the raw and silver CTEs of ``entities`` and the gold CTEs ``gold``."""
    parts: list[tuple[str, str]] = []
    seen: set[str] = set()

    def add(name: str, sql: str) -> None:
        if name not in seen:
            seen.add(name)
            parts.append((name, sql))

    wanted = list(entities)
    for g in gold:
        for dep in GOLD_DEPS.get(g, []):
            wanted += GOLD_NEEDS[dep]
        wanted += GOLD_NEEDS[g]
    for e in dict.fromkeys(wanted):
        add(f"raw_{e}", RAW[f"raw_{e}"])
        add(f"silver_{e}", silver_sql(e, dedupe))
    for g in gold:
        for dep in GOLD_DEPS.get(g, []):
            add(dep, GOLD[dep])
        add(g, GOLD[g])
    for name, sql in extra:
        add(name, sql)
    if not parts:
        return ""
    return "WITH " + ",\n".join(f"{n} AS ({s.strip()})" for n, s in parts)


def gold_query(table: str) -> str:
    return f"{with_ctes([], [table])}\nSELECT * FROM {table}"


# Each report from its definition: the wanted figures of a group are looked up for the list of groups, so
# nothing is shared with the plan of the Spark query.
REPORTS = {
    "report_gmv_by_city": (["fact_orders", "dim_region"], """
, placed AS (
    SELECT order_id, order_total_mmk,
           (SELECT any_value(region) FROM dim_region d WHERE d.region_key = f.region_key) AS region,
           (SELECT any_value(city) FROM dim_region d WHERE d.region_key = f.region_key) AS city
    FROM fact_orders f),
one_order AS (SELECT region, city, order_id, sum(order_total_mmk) AS amount FROM placed GROUP BY ALL)
SELECT region, city, CAST(sum(amount) AS DECIMAL(38,2)) AS gmv_mmk, count(order_id) AS total_orders
FROM one_order GROUP BY ALL"""),
    "report_product_revenue": (["fact_order_items", "dim_product"], """
, sold AS (
    SELECT product_id, category, sum(net_line_amount_mmk) AS amount, sum(quantity) AS units
    FROM fact_order_items WHERE product_id IN (SELECT product_id FROM dim_product) GROUP BY ALL),
named AS (SELECT product_id, list(product_name) AS names FROM dim_product GROUP BY product_id)
SELECT category, product_name, CAST(sum(amount) AS DECIMAL(38,2)) AS revenue_mmk, CAST(sum(units) AS BIGINT) AS units_sold
FROM (SELECT category, unnest(names) AS product_name, amount, units FROM sold NATURAL JOIN named) GROUP BY ALL"""),
    "report_seller_revenue": (["fact_order_items", "dim_seller"], """
, earned AS MATERIALIZED (SELECT seller_id, sum(net_line_amount_mmk) AS amount FROM fact_order_items GROUP BY seller_id),
shops AS (SELECT DISTINCT seller_name, region FROM dim_seller WHERE seller_id IN (SELECT seller_id FROM earned))
SELECT seller_name, region,
       (SELECT CAST(sum(amount) AS DECIMAL(38,2)) FROM earned e WHERE e.seller_id IN (
           SELECT d.seller_id FROM dim_seller d WHERE d.seller_name = shops.seller_name AND d.region IS NOT DISTINCT FROM shops.region)) AS seller_revenue_mmk
FROM shops"""),
    "report_order_trends": (["fact_orders", "dim_date"], """
, daily AS (
    SELECT order_date, list_unique(list(order_id)) AS total_orders, CAST(sum(order_total_mmk) AS DECIMAL(38,2)) AS gmv_mmk
    FROM fact_orders WHERE order_date IS NOT NULL GROUP BY order_date)
SELECT calendar.year, calendar.month, daily.order_date, CAST(total_orders AS BIGINT) AS total_orders, gmv_mmk
FROM daily, dim_date AS calendar WHERE calendar.calendar_date = daily.order_date"""),
    "report_delivery": (["fact_delivery_performance"], """
, late AS (SELECT region, delivery_delay_days AS days, count(*) AS n FROM fact_delivery_performance GROUP BY ALL)
SELECT region, sum(days * n) FILTER (days IS NOT NULL) / CAST(nullif(sum(n) FILTER (days IS NOT NULL), 0) AS DOUBLE) AS avg_delay_days,
       CAST(coalesce(sum(n) FILTER (days <= 0), 0) AS BIGINT) AS on_time_deliveries
FROM late GROUP BY region"""),
    "report_out_of_stock": (["fact_inventory_snapshot", "dim_product"], """
, empty_shelf AS (SELECT * FROM fact_inventory_snapshot EXCEPT ALL SELECT * FROM fact_inventory_snapshot WHERE inventory_status IS DISTINCT FROM 'out_of_stock')
SELECT product_name, snapshot_date, available_quantity, inventory_status FROM empty_shelf
SEMI JOIN dim_product USING (product_id) JOIN (SELECT product_id, product_name FROM dim_product) USING (product_id)"""),
    "report_top_customers": (["fact_orders", "dim_customer"], """
, spent AS (SELECT customer_id, sum(order_total_mmk) AS amount FROM fact_orders GROUP BY customer_id),
people AS (SELECT customer_name, city, CAST(sum(amount) AS DECIMAL(38,2)) AS lifetime_value_mmk
           FROM dim_customer NATURAL JOIN spent GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (ORDER BY lifetime_value_mmk DESC NULLS FIRST, customer_name NULLS LAST, city NULLS LAST) AS place FROM people)
SELECT * EXCLUDE (place) FROM ranked WHERE place <= 20"""),
    "report_payment_mix": (["fact_orders", "dim_region"], """
, keyed AS (SELECT region_key, payment_method, count(*) AS n, sum(order_total_mmk) AS amount FROM fact_orders GROUP BY ALL)
SELECT (SELECT any_value(region) FROM dim_region d WHERE d.region_key = keyed.region_key) AS region, payment_method,
       CAST(sum(n) AS BIGINT) AS orders_count, CAST(sum(amount) AS DECIMAL(38,2)) AS payment_volume_mmk
FROM keyed GROUP BY ALL"""),
}


def report_query(name: str) -> str:
    gold, body = REPORTS[name]
    return f"{with_ctes([], gold)}\n{body.strip()}"  # the bodies go on with further CTEs


# ---- operator-level queries ---------------------------------------------------------------------

NATION_PAIRS_SQL = (
    "(VALUES ('Nation_0', 'Africa'), ('Nation_1', 'America'), ('Nation_2', 'Asia'), ('Nation_3', 'Europe'), "
    "('Nation_4', 'Middle East'), ('Nation_5', 'Africa'), ('Nation_6', 'America')) AS a(city, region)"
)


def check_row(name: str, failed_expr: str, message: str, source: str) -> str:
    """One check result row from an aggregate over ``source``."""
    return (
        f"SELECT '{name}' AS check_name, failed = 0 AS passed, failed AS failed_rows, '{message}' AS message "
        f"FROM (SELECT CAST(coalesce({failed_expr}, 0) AS BIGINT) AS failed FROM {source})"
    )


def count_when(cond: str) -> str:
    return f"sum(CASE WHEN {cond} THEN 1 ELSE 0 END)"


RECON = """
SELECT r.order_id, r.recalc_subtotal_mmk, o.subtotal_amount_mmk
FROM (SELECT order_id, batch_date, CAST(round(sum(net_line_amount_mmk), 2) AS DECIMAL(18,2)) AS recalc_subtotal_mmk
      FROM silver_order_items GROUP BY order_id, batch_date) r
JOIN silver_orders o ON r.order_id = o.order_id AND r.batch_date IS NOT DISTINCT FROM o.batch_date"""


def pairs_check(name: str, source: str) -> str:
    bad = (f"(SELECT count(*) AS n FROM (SELECT DISTINCT city, region FROM {source}) t "
           f"WHERE NOT EXISTS (SELECT 1 FROM {NATION_PAIRS_SQL} WHERE a.city = t.city AND a.region = t.region))")
    return check_row(name, "sum(n)", "Allowed pair validation for city and region", bad)


def refs_check(name: str, fact: str, fact_key: str, dim: str, dim_key: str, message: str) -> str:
    orphans = (f"(SELECT n FROM (SELECT {fact_key} AS k, count(*) AS n FROM {fact} GROUP BY {fact_key}) f "
               f"WHERE NOT EXISTS (SELECT 1 FROM {dim} d WHERE d.{dim_key} = f.k))")
    return check_row(name, "sum(n)", message, orphans)


def dup_check(name: str, source: str, cols: str, message: str) -> str:
    groups = f"(SELECT count(*) AS n FROM {source} GROUP BY {cols})"
    return check_row(name, count_when("n > 1"), message, groups)


QUALITY_SUITE = " UNION ALL ".join([
    check_row("orders_primary_keys", count_when("order_id IS NULL OR customer_id IS NULL"),
              "Null check on [''order_id'', ''customer_id'']", "silver_orders"),
    check_row("orders_timestamp_valid", count_when("order_timestamp IS NULL"),
              "Timestamp validity check on order_timestamp", "silver_orders"),
    dup_check("orders_duplicates", "raw_orders", "order_id, batch_date", "Duplicate check on [''order_id'']"),
    check_row("payments_timestamp_valid", count_when("paid_at IS NULL"),
              "Timestamp validity check on paid_at", "silver_payments"),
    check_row("payment_amount_non_negative", count_when("payment_amount_mmk < 0"),
              "Non-negative check on payment_amount_mmk", "silver_payments"),
    pairs_check("orders_region_city_mapping", "silver_orders"),
    pairs_check("deliveries_region_city_mapping", "silver_deliveries"),
    check_row("order_items_product_id_present", count_when("product_id IS NULL"),
              "Null check on [''product_id'']", "silver_order_items"),
    check_row("order_item_price_non_negative", count_when("unit_price_mmk < 0"),
              "Non-negative check on unit_price_mmk", "silver_order_items"),
    check_row("order_item_quantity_non_negative", count_when("quantity < 0"),
              "Non-negative check on quantity", "silver_order_items"),
    refs_check("orders_customer_reference", "silver_orders", "customer_id", "silver_customers", "customer_id",
               "Reference check for customer_id"),
    refs_check("order_items_product_reference", "silver_order_items", "product_id", "silver_products", "product_id",
               "Reference check for product_id"),
    check_row("order_subtotal_reconciliation", count_when("abs(recalc_subtotal_mmk - subtotal_amount_mmk) > 1.0"),
              "Amount reconciliation for recalc_subtotal_mmk and subtotal_amount_mmk", "recon"),
])

DATE_TARGET = "dim_date"
DATE_INCOMING = ("(SELECT date_key, calendar_date, year, month, day, upper(month_name) AS month_name, week_of_year "
                 "FROM dim_date WHERE month % 2 = 0)")

CUSTOMER_COLS = ["customer_id", "customer_name", "phone_number", "email", "city", "region", "township", "segment", "created_at"]
UPSERT_INCOMING = ("(SELECT customer_id, customer_name, phone_number, CAST(NULL AS VARCHAR) AS email, city, region, township, "
                   "upper(segment) AS segment, created_at FROM dim_customer WHERE segment IN ('building', 'machinery'))")

OPS = {
    "scan_batch": (["orders"], [], "SELECT * FROM raw_orders WHERE batch_date = DATE '1996-09-17'"),
    "fill_defaults": (["orders"], [], """
SELECT order_id, coalesce(order_status, 'placed') AS order_status,
       coalesce(payment_method, 'cash_on_delivery') AS payment_method
FROM raw_orders"""),
    "dedupe_items": (["order_items"], [], "SELECT * EXCLUDE (_rn) FROM "
                     + latest("raw_order_items", KEYS["order_items"], RAW_COLUMNS["order_items"])),
    "scalar_suite": (["orders"], [], f"""
SELECT order_id,
       {initcap('city')} AS city_title,
       {initcap('region')} AS region_title,
       ts AS order_ts,
       d AS order_day,
       CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key,
       CAST(year(d) AS INTEGER) AS year,
       CAST(month(d) AS INTEGER) AS month,
       CAST(day(d) AS INTEGER) AS day_of_month,
       monthname(d) AS month_name,
       CAST(weekofyear(d) AS INTEGER) AS week_of_year,
       CAST(date_diff('day', DATE '2000-01-01', d) AS INTEGER) AS days_since_2000,
       ('0x' || substr(md5({initcap('region')} || '|' || {initcap('city')}), 1, 15))::BIGINT AS region_key,
       concat_ws('|', region, city) AS geo_text,
       total,
       CAST(abs(TRY_CAST(shipping_fee_mmk AS DECIMAL(18,2)) - 1) AS DECIMAL(18,2)) AS fee_gap,
       CAST(round(total * 0.15, 1) AS DECIMAL(18,1)) AS tax_estimate,
       TRY_CAST(item_count AS INTEGER) AS item_count,
       CASE WHEN total >= 100000 THEN 'large' ELSE 'small' END AS size_band
FROM (SELECT *, TRY_CAST(order_timestamp AS TIMESTAMP) AS ts,
             CAST(TRY_CAST(order_timestamp AS TIMESTAMP) AS DATE) AS d,
             TRY_CAST(order_total_mmk AS DECIMAL(18,2)) AS total
      FROM raw_orders)"""),
    "check_non_null": (["orders"], [], check_row(
        "orders_required_fields", count_when("order_id IS NULL OR customer_id IS NULL OR shipping_fee_mmk IS NULL"),
        "Null check on [''order_id'', ''customer_id'', ''shipping_fee_mmk'']", "silver_orders")),
    "check_valid_timestamp": (["payments"], [], check_row(
        "payments_timestamp_valid", count_when("paid_at IS NULL"), "Timestamp validity check on paid_at", "silver_payments")),
    "check_positive": ([], [], check_row(
        "customer_balance_positive", count_when("c_acctbal <= 0"), "Positive check on c_acctbal", "customer")),
    "check_non_negative": ([], [], check_row(
        "customer_balance_non_negative", count_when("c_acctbal < 0"), "Non-negative check on c_acctbal", "customer")),
    "keys_across_days": (["order_items"], [], """
SELECT product_id, seller_id, min(batch_date) AS first_day, max(batch_date) AS last_day, count(DISTINCT batch_date) AS n_days
FROM silver_order_items WHERE product_id IS NOT NULL AND seller_id IS NOT NULL GROUP BY ALL HAVING count(DISTINCT batch_date) > 1"""),
    "check_no_duplicates": (["order_items"], [], dup_check(
        "order_items_duplicates", "raw_order_items", "order_item_id", "Duplicate check on [''order_item_id'']")),
    "check_references": ([], [], refs_check(
        "lineitem_supplier_reference", "lineitem", "l_suppkey", "(SELECT * FROM supplier WHERE s_acctbal >= 0)",
        "s_suppkey", "Reference check for l_suppkey")),
    "reconcile_orders": (["orders", "order_items"], [], RECON),
    "check_amount_match": (["orders", "order_items"], [("recon", RECON)], check_row(
        "order_subtotal_reconciliation", count_when("abs(recalc_subtotal_mmk - subtotal_amount_mmk) > 1.0"),
        "Amount reconciliation for recalc_subtotal_mmk and subtotal_amount_mmk", "recon")),
    "check_allowed_pairs": (["customers"], [], pairs_check("customers_city_region_mapping", "silver_customers")),
    "quality_report": (["orders", "order_items", "payments", "deliveries", "customers", "products"],
                       [("recon", RECON)], QUALITY_SUITE),
    "audit_counts": (list(RAW_COLUMNS), [], " UNION ALL ".join(
        f"SELECT 'silver_{e}' AS pipeline_stage, 'SUCCESS' AS status, count(*) AS row_count FROM silver_{e}"
        for e in RAW_COLUMNS)),
    "publish_replace_key": ([], ["dim_date"], f"""
SELECT * FROM {DATE_TARGET} t WHERE NOT EXISTS (SELECT 1 FROM {DATE_INCOMING} i WHERE i.date_key = t.date_key)
UNION ALL SELECT * FROM {DATE_INCOMING}"""),
    "upsert_dimension": ([], ["dim_customer"], "SELECT " + ", ".join(
        f"coalesce(i.{c}, t.{c}) AS {c}" for c in CUSTOMER_COLS)
        + f" FROM (SELECT * FROM dim_customer WHERE segment <> 'building') t FULL OUTER JOIN {UPSERT_INCOMING} i "
          "ON t.customer_id IS NOT DISTINCT FROM i.customer_id"),
    "scd2_history": (["orders"], [], """
SELECT customer_id, payment_method, valid_from,
       lead(valid_from) OVER (PARTITION BY customer_id ORDER BY valid_from) AS valid_to,
       lead(valid_from) OVER (PARTITION BY customer_id ORDER BY valid_from) IS NULL AS is_current
FROM (SELECT customer_id, payment_method, batch_date AS valid_from
      FROM (SELECT *, row_number() OVER w AS rn, lag(payment_method) OVER w AS prev
            FROM (SELECT customer_id, batch_date, arg_max(payment_method, order_id) AS payment_method
                  FROM silver_orders GROUP BY customer_id, batch_date)
            WINDOW w AS (PARTITION BY customer_id ORDER BY batch_date))
      WHERE rn = 1 OR payment_method IS DISTINCT FROM prev)"""),
    "scd2_products": (["order_items"], [], """
SELECT product_id, last.seller_id AS seller_id, last.unit_price_mmk AS unit_price_mmk, batch_date AS valid_from,
       lead(batch_date) OVER k AS valid_to, lead(batch_date) OVER k IS NULL AS is_current
FROM (SELECT product_id, batch_date, last, lag(last) OVER (PARTITION BY product_id ORDER BY batch_date) AS prev
      FROM (SELECT product_id, batch_date, max_by({'seller_id': seller_id, 'unit_price_mmk': unit_price_mmk}, order_item_id) AS last
            FROM silver_order_items GROUP BY product_id, batch_date))
WHERE prev IS NULL OR last.seller_id IS DISTINCT FROM prev.seller_id OR last.unit_price_mmk IS DISTINCT FROM prev.unit_price_mmk
WINDOW k AS (PARTITION BY product_id ORDER BY batch_date)"""),
    "scd2_sellers": (["order_items"], [], """
SELECT seller_id, tier AS seller_tier, batch_date AS valid_from,
       lead(batch_date) OVER k AS valid_to, lead(batch_date) OVER k IS NULL AS is_current
FROM (SELECT *, lag(tier) OVER (PARTITION BY seller_id ORDER BY batch_date) AS prev
      FROM (SELECT seller_id, batch_date, CASE WHEN max_by({'p': unit_price_mmk}, order_item_id).p >= 1500 THEN 'premium' ELSE 'standard' END AS tier
            FROM silver_order_items GROUP BY seller_id, batch_date))
WHERE prev IS NULL OR tier <> prev
WINDOW k AS (PARTITION BY seller_id ORDER BY batch_date)"""),
}


def op_query(name: str) -> str:
    """OPS values are (entities, ctes, body); a CTE given by name is a gold table."""
    entities, ctes, body = OPS[name]
    gold = [c for c in ctes if isinstance(c, str)]
    extra = [c for c in ctes if not isinstance(c, str)]
    return f"{with_ctes(entities, gold, extra)}\n{body.strip()}"
