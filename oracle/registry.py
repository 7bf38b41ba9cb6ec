"""DuckDB SQL per registered key (same keys and column names as the Spark queries)."""

from __future__ import annotations

from oracle import duckdb_sql as Q

CLEAN_KEYS = {
    "clean_customers": "customers",
    "clean_sellers": "sellers",
    "clean_products": "products",
    "clean_orders": "orders",
    "clean_order_items": "order_items",
    "clean_payments": "payments",
    "clean_deliveries": "deliveries",
    "clean_inventory": "inventory_snapshots",
}

SQL: dict[str, str] = {}
for _key, _entity in CLEAN_KEYS.items():
    SQL[_key] = f"{Q.with_ctes([_entity])}\nSELECT * FROM silver_{_entity}"
for _table in Q.GOLD:
    SQL[_table] = Q.gold_query(_table)
for _name in Q.REPORTS:
    SQL[_name] = Q.report_query(_name)
for _name in Q.OPS:
    SQL[_name] = Q.op_query(_name)
SQL["partials_gmv_by_city"] = SQL["report_gmv_by_city"]
SQL["partials_order_trends"] = SQL["report_order_trends"]
