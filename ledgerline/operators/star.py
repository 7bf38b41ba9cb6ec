"""Gold layer: five dimensions and five facts (G1–G10), projected onto the warehouse contracts.

Joins are declared; Catalyst/AQE pick the strategy. ``dim_region`` is a distinct over
geography (partial aggregation, so it is small however large the customer table is). A dimension beyond the broadcast
threshold meets its fact through ``skew.join_one``: a city or product that holds a third of the rows is split.
``dim_date`` is generated from the date range, so its size is bounded by the number of days.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.contracts import GOLD, conform
from ledgerline.functions import scalars as S
from ledgerline.operators.skew import join_one


def dim_customer(customers: DataFrame) -> DataFrame:
    return conform(customers, GOLD["dim_customer"])


def dim_seller(sellers: DataFrame) -> DataFrame:
    return conform(sellers, GOLD["dim_seller"])


def dim_product(products: DataFrame) -> DataFrame:
    return conform(products, GOLD["dim_product"])


def dim_region(customers: DataFrame, sellers: DataFrame) -> DataFrame:
    """Every (region, city) of customers ∪ sellers once, keyed by a 60-bit md5 key.

    Geography with a NULL part has no key and is left out (a NULL primary key can't be joined).
    """
    geo = (
        customers.select("region", "city")
        .unionByName(sellers.select("region", "city"))
        .where(F.col("region").isNotNull() & F.col("city").isNotNull())
        .distinct()
    )
    return geo.select(S.surrogate_key("region", "city").alias("region_key"), "region", "city")


def dim_date_between(spark: SparkSession, start: dt.date | str, end: dt.date | str) -> DataFrame:
    """One row per calendar day in [start, end] (inclusive)."""
    days = spark.range(1).select(
        F.explode(F.sequence(F.lit(str(start)).cast("date"), F.lit(str(end)).cast("date"))).alias("calendar_date")
    )
    return _date_attributes(days)


def dim_date_for(dates: DataFrame, column: str) -> DataFrame:
    """One row per day between the first and last value of ``column`` in ``dates``.

    The range is found with a global min/max (one row after partial aggregation), then
    expanded with ``sequence``; no driver round trip.
    """
    bounds = dates.agg(F.min(S.date_of(column)).alias("lo"), F.max(S.date_of(column)).alias("hi"))
    days = bounds.where(F.col("lo").isNotNull()).select(F.explode(F.sequence("lo", "hi")).alias("calendar_date"))
    return _date_attributes(days)


def _date_attributes(days: DataFrame) -> DataFrame:
    d = F.col("calendar_date")
    return days.select(
        S.date_key(d).alias("date_key"),
        d.alias("calendar_date"),
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        F.dayofmonth(d).alias("day"),
        S.month_name(d).alias("month_name"),
        S.iso_week(d).alias("week_of_year"),
    )


def fact_orders(orders: DataFrame, regions: DataFrame | None) -> DataFrame:
    """Orders with their geography's key; unknown geography keeps the order with a NULL key.

    Without ``regions`` all keys are NULL: for readers that don't use the key, so that their plans have no lookup.
    """
    if regions is not None:
        orders = join_one(orders, regions.select("region", "city", "region_key"), ["region", "city"], ["order_id"])
    return conform(orders.withColumn("order_date", S.date_of("order_timestamp")), GOLD["fact_orders"])


def fact_order_items(items: DataFrame, products: DataFrame) -> DataFrame:
    joined = join_one(items, products.select("product_id", "category", "brand"), ["product_id"], ["order_item_id"])
    return conform(joined, GOLD["fact_order_items"])


def fact_payments(payments: DataFrame) -> DataFrame:
    return conform(payments.withColumn("payment_date", S.date_of("paid_at")), GOLD["fact_payments"])


def fact_inventory_snapshot(inventory: DataFrame) -> DataFrame:
    return conform(inventory, GOLD["fact_inventory_snapshot"])


def fact_delivery_performance(deliveries: DataFrame) -> DataFrame:
    return conform(deliveries, GOLD["fact_delivery_performance"])


def build_star(silver: dict[str, DataFrame], dim_date: DataFrame | None = None) -> dict[str, DataFrame]:
    """All ten gold tables from the eight silver entities (lazy; nothing runs here)."""
    regions = dim_region(silver["customers"], silver["sellers"])
    gold = {
        "dim_customer": dim_customer(silver["customers"]),
        "dim_seller": dim_seller(silver["sellers"]),
        "dim_product": dim_product(silver["products"]),
        "dim_region": regions,
        "dim_date": dim_date if dim_date is not None else dim_date_for(silver["orders"], "order_timestamp"),
        "fact_orders": fact_orders(silver["orders"], regions),
        "fact_order_items": fact_order_items(silver["order_items"], silver["products"]),
        "fact_payments": fact_payments(silver["payments"]),
        "fact_inventory_snapshot": fact_inventory_snapshot(silver["inventory_snapshots"]),
        "fact_delivery_performance": fact_delivery_performance(silver["deliveries"]),
    }
    return gold
