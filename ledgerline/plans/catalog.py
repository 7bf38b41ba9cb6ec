"""Named queries over a directory of driver tables: raw extract → silver → gold → report.

Each function takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the whole tables.
Nothing is collected or cached here; Catalyst sees the full plan of each query, except where a query reads a part of it several
times or needs more disk for all parts than for one: such a part is stored first (``sources.scratch``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ledgerline.operators import clean as C
from ledgerline.operators import reports as R
from ledgerline.operators import star as G
from ledgerline.sources import driver_tables as D


def raw(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    return D.extract(spark, sf_dir, entity)


def silver(spark: SparkSession, sf_dir: str, entity: str, columns: Sequence[str] | None = None) -> DataFrame:
    return C.clean_entity(raw(spark, sf_dir, entity), entity, columns=columns)


def silver_all(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {e: silver(spark, sf_dir, e) for e in D.EXTRACTS}


class LazySilver(dict):
    """Silver entities built on first use, so a query only plans the entities it reads."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__()
        self._spark, self._dir = spark, sf_dir

    def __missing__(self, entity: str) -> DataFrame:
        df = silver(self._spark, self._dir, entity)
        self[entity] = df
        return df


class LazyGold(dict):
    """Gold tables built on first use from one shared set of silver frames.

    Tables that need the same silver entity or dimension reuse the same DataFrame, so within a
    query the plan has one lineage per input and Spark can reuse its exchanges.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__()
        self.silver = LazySilver(spark, sf_dir)

    def __missing__(self, table: str) -> DataFrame:
        s = self.silver
        builders = {
            "dim_customer": lambda: G.dim_customer(s["customers"]),
            "dim_seller": lambda: G.dim_seller(s["sellers"]),
            "dim_product": lambda: G.dim_product(s["products"]),
            "dim_region": lambda: G.dim_region(s["customers"], s["sellers"]),
            "dim_date": lambda: G.dim_date_for(s["orders"], "order_timestamp"),
            "fact_orders": lambda: G.fact_orders(s["orders"], self["dim_region"]),
            "fact_order_items": lambda: G.fact_order_items(s["order_items"], s["products"]),
            "fact_payments": lambda: G.fact_payments(s["payments"]),
            "fact_inventory_snapshot": lambda: G.fact_inventory_snapshot(s["inventory_snapshots"]),
            "fact_delivery_performance": lambda: G.fact_delivery_performance(s["deliveries"]),
        }
        df = builders[table]()
        self[table] = df
        return df


def gold_table(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return LazyGold(spark, sf_dir)[table]


def report(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    gold = LazyGold(spark, sf_dir)
    if name not in R.BY_REGION:  # no lookup of a key that nothing reads
        gold["fact_orders"] = G.fact_orders(gold.silver["orders"], None)
    return R.run_report(name, gold)


# ---- operator-level queries over the fixture -------------------------------------------------

import datetime as _dt  # noqa: E402
from decimal import Decimal  # noqa: E402

from pyspark.sql import functions as F  # noqa: E402

from ledgerline.functions import scalars as S  # noqa: E402
from ledgerline.operators import audit as A  # noqa: E402
from ledgerline.operators import checks as Q  # noqa: E402
from ledgerline.operators import distinct_partials as B  # noqa: E402
from ledgerline.operators import history as H  # noqa: E402
from ledgerline.operators import key_days as K  # noqa: E402
from ledgerline.operators import publish as P  # noqa: E402
from ledgerline.operators.dedupe import keep_latest  # noqa: E402
from ledgerline.sources.layers import filter_batch  # noqa: E402
from ledgerline.sources.scratch import stored  # noqa: E402

# fixed values of the fixture: the batch day scanned, and the allow-list made of the
# (city, region) pairs of nations 0–6 (the other 18 nations' pairs are the bad ones)
SCAN_DAY = _dt.date(1996, 9, 17)
NATION_PAIRS = [
    ("Nation_0", "Africa"),
    ("Nation_1", "America"),
    ("Nation_2", "Asia"),
    ("Nation_3", "Europe"),
    ("Nation_4", "Middle East"),
    ("Nation_5", "Africa"),
    ("Nation_6", "America"),
]


def scan_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_batch(raw(spark, sf_dir, "orders"), SCAN_DAY)


def fill_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = raw(spark, sf_dir, "orders").select("order_id", "order_status", "payment_method")
    return C.fill_defaults(o, C.SPECS["orders"].defaults)


def dedupe_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keep_latest(raw(spark, sf_dir, "order_items"), C.SPECS["order_items"].row_keys)


def scalar_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = raw(spark, sf_dir, "orders")
    ts = S.parse_timestamp("order_timestamp")
    day = S.date_of(ts)
    total = S.to_money("order_total_mmk")
    return o.select(
        "order_id",
        S.title_case("city").alias("city_title"),
        S.title_case("region").alias("region_title"),
        ts.alias("order_ts"),
        day.alias("order_day"),
        S.date_key(day).alias("date_key"),
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day_of_month"),
        S.month_name(day).alias("month_name"),
        S.iso_week(day).alias("week_of_year"),
        S.day_difference(day, F.lit(_dt.date(2000, 1, 1))).alias("days_since_2000"),
        S.surrogate_key(S.title_case("region"), S.title_case("city")).alias("region_key"),
        F.concat_ws("|", "region", "city").alias("geo_text"),
        total.alias("total"),
        F.abs(S.to_money("shipping_fee_mmk") - F.lit(1)).cast(S.MONEY).alias("fee_gap"),
        F.round(total * F.lit(Decimal("0.15")), 1).cast("decimal(18,1)").alias("tax_estimate"),
        S.to_int("item_count").alias("item_count"),
        F.when(total >= 100000, "large").otherwise("small").alias("size_band"),
    )


def check_non_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.single(silver(spark, sf_dir, "orders"), Q.non_null(["order_id", "customer_id", "shipping_fee_mmk"], "orders_required_fields"))


def check_valid_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.single(silver(spark, sf_dir, "payments"), Q.valid_timestamp("paid_at", "payments_timestamp_valid"))


def check_positive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.single(D.read_table(spark, sf_dir, "customer"), Q.positive("c_acctbal", "customer_balance_positive"))


def check_non_negative(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.single(D.read_table(spark, sf_dir, "customer"), Q.non_negative("c_acctbal", "customer_balance_non_negative"))


def check_no_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.no_duplicates(raw(spark, sf_dir, "order_items"), ["order_item_id"], "order_items_duplicates")


def check_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = D.read_table(spark, sf_dir, "lineitem")
    solvent = D.read_table(spark, sf_dir, "supplier").where(F.col("s_acctbal") >= 0)
    return Q.references(lines, solvent, "l_suppkey", "s_suppkey", "lineitem_supplier_reference")


def reconcile_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.reconciliation(silver(spark, sf_dir, "order_items"), silver(spark, sf_dir, "orders"))


def check_amount_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    check = Q.amount_match("recalc_subtotal_mmk", "subtotal_amount_mmk", 1.0, "order_subtotal_reconciliation")
    return Q.single(reconcile_orders(spark, sf_dir), check)


def check_allowed_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.allowed_pairs(silver(spark, sf_dir, "customers"), "city", "region", NATION_PAIRS, "customers_city_region_mapping")


def _stored_items(spark: SparkSession, sf_dir: str, columns: Sequence[str]) -> DataFrame:
    """These columns of silver order items, stored slice by slice of their ids: the dedupe shuffles each row's text twice."""
    return stored(silver(spark, sf_dir, "order_items", ["order_item_id", *columns]), "order-items", ["order_item_id"], columns)


COPIES = "_copies"


def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 13 checks over silver rows of the columns that they read; items, deliveries and orders, whose dedupes shuffle most, are stored first, one after another."""
    items = _stored_items(spark, sf_dir, ["order_id", "product_id", "quantity", "unit_price_mmk", "net_line_amount_mmk", "batch_date"])
    places = ["city", "region"]
    deliveries = stored(silver(spark, sf_dir, "deliveries", ["delivery_id", *places]), "deliveries", ["delivery_id"], places)
    # orders carry their raw copy count from the dedupe, so the duplicate check needs no
    # second grouping of the raw orders
    columns = ["order_id", "customer_id", "order_timestamp", *places, "subtotal_amount_mmk", "batch_date"]
    orders = stored(C.clean_entity(raw(spark, sf_dir, "orders"), "orders", copies=COPIES, columns=columns), "orders", ["order_id"])
    return Q.silver_suite(
        None, orders, items, silver(spark, sf_dir, "payments", ["paid_at", "payment_amount_mmk"]), deliveries,
        silver(spark, sf_dir, "customers", ["customer_id"]), silver(spark, sf_dir, "products", ["product_id"]), pairs=NATION_PAIRS, copies=COPIES,
    )


def audit_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = LazySilver(spark, sf_dir)
    return A.stage_counts({f"silver_{e}": s[e] for e in D.EXTRACTS})


def publish_replace_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole date range as the target; the days of even months come again, with another spelling."""
    target = gold_table(spark, sf_dir, "dim_date")
    incoming = target.where(F.col("month") % 2 == 0).withColumn("month_name", F.upper("month_name"))
    return P.replace_by_key(target, incoming, ["date_key"])


def upsert_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = gold_table(spark, sf_dir, "dim_customer")
    target = customers.where(F.col("segment") != "building")
    incoming = customers.where(F.col("segment").isin("building", "machinery")).select(
        *[F.lit(None).cast("string").alias("email") if c == "email"
          else F.upper("segment").alias("segment") if c == "segment" else F.col(c)
          for c in customers.columns]
    )
    return P.upsert(target, incoming, ["customer_id"])


def scd2_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = silver(spark, sf_dir, "orders")
    snaps = H.daily_snapshots(orders, ["customer_id"], "batch_date", ["payment_method"], ["order_id"])
    return H.scd2_versions(snaps, ["customer_id"], "batch_date", ["payment_method"])


def _late_day(snaps: DataFrame, keys: list[str], attrs: list[str]) -> DataFrame:
    """History over all days but one, into which that day's snapshot is spliced: the versions over all days.

    As in a stored history, snapshots and versions are tables: the splice reads each several times, with other filters and columns.
    """
    day = F.lit(SCAN_DAY)
    snaps = stored(snaps, "snapshots")
    versions = stored(H.scd2_versions(snaps.where(F.col("batch_date") != day), keys, "batch_date", attrs), "versions")
    seen = snaps.select(*keys, F.col("batch_date").alias("as_of"))
    return H.spliced(versions, snaps.where(F.col("batch_date") == day), day, keys, attrs, seen)


def scd2_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seller and unit price of a product as of each day, from its last item that day; SCAN_DAY arrives last."""
    attrs = ["seller_id", "unit_price_mmk"]
    items = _stored_items(spark, sf_dir, ["order_item_id", "product_id", *attrs, "batch_date"])
    return _late_day(H.daily_snapshots(items, ["product_id"], "batch_date", attrs, ["order_item_id"]), ["product_id"], attrs)


def scd2_sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A seller's tier as of each day, by the price of its last item that day; SCAN_DAY arrives last."""
    tier = F.when(F.col("unit_price_mmk") >= 1500, "premium").otherwise("standard")
    items = _stored_items(spark, sf_dir, ["order_item_id", "seller_id", "unit_price_mmk", "batch_date"]).withColumn("seller_tier", tier)
    return _late_day(H.daily_snapshots(items, ["seller_id"], "batch_date", ["seller_tier"], ["order_item_id"]), ["seller_id"], ["seller_tier"])


def keys_across_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of product and seller that came on several days, found by their prints and compared by value."""
    items, keys = silver(spark, sf_dir, "order_items"), ["product_id", "seller_id"]
    found = K.repeated(items, keys, K.shared_prints(K.prints(items, keys)))
    return found.select(*keys, F.array_min("days").alias("first_day"), F.array_max("days").alias("last_day"), F.size("days").cast("long").alias("n_days"))


def _order_partials(gold: LazyGold) -> DataFrame:
    return B.partials(gold["fact_orders"], B.coded(gold["fact_orders"]))


def partials_gmv_by_city(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B1 from the days' bitmaps of order codes."""
    gold = LazyGold(spark, sf_dir)
    return R.gmv_of_keys(B.merged(_order_partials(gold), ["region_key"], "orders", "gmv"), gold["dim_region"])


def partials_order_trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B4 from the days' bitmaps of order codes."""
    gold = LazyGold(spark, sf_dir)
    return R.trends_of_days(B.merged(_order_partials(gold), ["order_date"], "total_orders", "gmv_mmk"), gold["dim_date"])
