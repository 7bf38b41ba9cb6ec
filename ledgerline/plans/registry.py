"""Registry of named queries: one per operator / query of the survey's inventory.

Every entry takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the whole driver
tables. Keys match the DuckDB twins in ``oracle.registry``.
"""

from __future__ import annotations

from functools import partial
from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerline.operators import reports as R
from ledgerline.plans import catalog as K

Query = Callable[[SparkSession, str], DataFrame]

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

GOLD_KEYS = (
    "dim_customer", "dim_seller", "dim_product", "dim_region", "dim_date",
    "fact_orders", "fact_order_items", "fact_payments", "fact_inventory_snapshot",
    "fact_delivery_performance",
)

QUERIES: dict[str, Query] = {}
for _key, _entity in CLEAN_KEYS.items():
    QUERIES[_key] = partial(lambda spark, sf_dir, entity: K.silver(spark, sf_dir, entity), entity=_entity)
for _table in GOLD_KEYS:
    QUERIES[_table] = partial(lambda spark, sf_dir, table: K.gold_table(spark, sf_dir, table), table=_table)
for _name in R.REPORTS:
    QUERIES[_name] = partial(lambda spark, sf_dir, name: K.report(spark, sf_dir, name), name=_name)

for _name in (
    "scan_batch", "fill_defaults", "dedupe_items", "scalar_suite",
    "check_non_null", "check_valid_timestamp", "check_positive", "check_non_negative",
    "check_no_duplicates", "check_references", "reconcile_orders", "check_amount_match",
    "check_allowed_pairs", "quality_report", "audit_counts", "publish_replace_key",
    "upsert_dimension", "scd2_history", "scd2_products", "scd2_sellers",
    "keys_across_days", "partials_gmv_by_city", "partials_order_trends",
):
    QUERIES[_name] = getattr(K, _name)
