"""The eight business reports (B1–B8) over the star schema.

Semantics follow the reference's SQL, including its PostgreSQL NULL ordering (NULLs sort
last ascending and first descending), cancelled orders counted, namesakes merged when a
report groups by name, and a NULL region group kept by the left joins.

Scale: where a report joins a large fact to a dimension and only sums, the fact is first aggregated on the
join key. The partial aggregate runs map-side, so a customer or region holding a third of all
orders becomes one row per input partition before anything is shuffled, and the join sees one row per
key. Distinct orders are counted by (key, order), which spreads a hot key.
Money sums are exact decimals widened to ``decimal(38,2)`` so they cannot overflow.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions import scalars as S

TOTAL = "decimal(38,2)"


def _sum_money(c: str) -> F.Column:
    return F.sum(c).cast(TOTAL)


def gmv_by_city(fact_orders: DataFrame, dim_region: DataFrame) -> DataFrame:
    """B1: GMV and distinct orders per (region, city).

    The dimension has one key per (region, city), so orders are counted per key before it is joined.
    """
    per_key = fact_orders.groupBy("region_key").agg(F.sum("order_total_mmk").alias("gmv"), F.countDistinct("order_id").alias("orders"))
    return gmv_of_keys(per_key, dim_region)


def gmv_of_keys(per_key: DataFrame, dim_region: DataFrame) -> DataFrame:
    """B1 from (region_key, gmv, orders), a row per key."""
    joined = per_key.join(dim_region, "region_key", "left")
    return (
        joined.groupBy("region", "city")
        .agg(_sum_money("gmv").alias("gmv_mmk"), F.sum("orders").alias("total_orders"))
        .orderBy(F.desc_nulls_first("gmv_mmk"))
    )


def product_revenue(fact_order_items: DataFrame, dim_product: DataFrame) -> DataFrame:
    """B2: revenue and units per (category, product name); namesakes merge."""
    per_product = fact_order_items.groupBy("product_id", "category").agg(
        F.sum("net_line_amount_mmk").alias("revenue"), F.sum("quantity").alias("units")
    )
    joined = per_product.join(dim_product.select("product_id", "product_name"), "product_id", "inner")
    return (
        joined.groupBy("category", "product_name")
        .agg(_sum_money("revenue").alias("revenue_mmk"), F.sum("units").cast("long").alias("units_sold"))
        .orderBy(F.desc_nulls_first("revenue_mmk"))
    )


def seller_revenue(fact_order_items: DataFrame, dim_seller: DataFrame) -> DataFrame:
    """Revenue per (seller name, region)."""
    per_seller = fact_order_items.groupBy("seller_id").agg(F.sum("net_line_amount_mmk").alias("revenue"))
    joined = per_seller.join(dim_seller.select("seller_id", "seller_name", "region"), "seller_id", "inner")
    return (
        joined.groupBy("seller_name", "region")
        .agg(_sum_money("revenue").alias("seller_revenue_mmk"))
        .orderBy(F.desc_nulls_first("seller_revenue_mmk"))
    )


def order_trends(fact_orders: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Orders and GMV per day, with year and month from ``dim_date`` (join on yyyymmdd).

    The fact is aggregated per day first, so the join sees one row a day on both sides.
    """
    per_day = fact_orders.groupBy("order_date").agg(F.countDistinct("order_id").alias("total_orders"), _sum_money("order_total_mmk").alias("gmv_mmk"))
    return trends_of_days(per_day, dim_date)


def trends_of_days(per_day: DataFrame, dim_date: DataFrame) -> DataFrame:
    """B4 from (order_date, total_orders, gmv_mmk), a row per date."""
    joined = per_day.withColumn("date_key", S.date_key("order_date")).join(dim_date.select("date_key", "year", "month"), "date_key", "inner")
    return joined.select("year", "month", "order_date", "total_orders", "gmv_mmk").orderBy(F.asc_nulls_last("order_date"))


def delivery_performance(fact_delivery: DataFrame) -> DataFrame:
    """Average delay and on-time count per region (undelivered rows included)."""
    delay = F.col("delivery_delay_days")
    return (
        fact_delivery.groupBy("region")
        .agg(
            F.avg(delay).alias("avg_delay_days"),
            F.sum(F.when(delay <= 0, 1).otherwise(0)).cast("long").alias("on_time_deliveries"),
        )
        .orderBy(F.asc_nulls_last("avg_delay_days"))
    )


def out_of_stock(fact_inventory: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Out-of-stock snapshots with product names, latest first."""
    stock = fact_inventory.where(F.col("inventory_status") == "out_of_stock")
    joined = stock.join(dim_product.select("product_id", "product_name"), "product_id", "inner")
    return joined.select("product_name", "snapshot_date", "available_quantity", "inventory_status").orderBy(
        F.desc_nulls_first("snapshot_date"), F.asc_nulls_last("product_name")
    )


def top_customers(fact_orders: DataFrame, dim_customer: DataFrame, n: int = 20) -> DataFrame:
    """The ``n`` (name, city) groups with the highest lifetime value.

    The limit is the feature (a top-k report); name and city break ties so the k rows are
    well defined. Spark plans it as ``TakeOrderedAndProject``: each partition keeps its own
    top k, so only k rows per partition reach the final merge.
    """
    per_customer = fact_orders.groupBy("customer_id").agg(F.sum("order_total_mmk").alias("value"))
    joined = per_customer.join(dim_customer.select("customer_id", "customer_name", "city"), "customer_id", "inner")
    return (
        joined.groupBy("customer_name", "city")
        .agg(_sum_money("value").alias("lifetime_value_mmk"))
        .orderBy(F.desc_nulls_first("lifetime_value_mmk"), F.asc_nulls_last("customer_name"), F.asc_nulls_last("city"))
        .limit(n)
    )


def payment_mix(fact_orders: DataFrame, dim_region: DataFrame) -> DataFrame:
    """Order count and volume per (region, payment method)."""
    per_key = fact_orders.groupBy("region_key", "payment_method").agg(F.count(F.lit(1)).alias("n"), F.sum("order_total_mmk").alias("volume"))
    joined = per_key.join(dim_region, "region_key", "left")
    return (
        joined.groupBy("region", "payment_method")
        .agg(F.sum("n").alias("orders_count"), _sum_money("volume").alias("payment_volume_mmk"))
        .orderBy(F.asc_nulls_last("region"), F.desc_nulls_first("payment_volume_mmk"))
    )


REPORTS = {
    "report_gmv_by_city": (gmv_by_city, ("fact_orders", "dim_region")),
    "report_product_revenue": (product_revenue, ("fact_order_items", "dim_product")),
    "report_seller_revenue": (seller_revenue, ("fact_order_items", "dim_seller")),
    "report_order_trends": (order_trends, ("fact_orders", "dim_date")),
    "report_delivery": (delivery_performance, ("fact_delivery_performance",)),
    "report_out_of_stock": (out_of_stock, ("fact_inventory_snapshot", "dim_product")),
    "report_top_customers": (top_customers, ("fact_orders", "dim_customer")),
    "report_payment_mix": (payment_mix, ("fact_orders", "dim_region")),
}


#: Reports that read the region key of ``fact_orders``.
BY_REGION = frozenset({"report_gmv_by_city", "report_payment_mix"})


def run_report(name: str, gold: dict[str, DataFrame]) -> DataFrame:
    fn, inputs = REPORTS[name]
    return fn(*[gold[t] for t in inputs])
