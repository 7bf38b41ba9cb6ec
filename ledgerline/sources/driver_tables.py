"""Raw entity extracts derived from the driver's TPC-H-like tables.

The test data isn't the retail extract the pipeline is written for, so each entity is shaped
from the given tables (see README, "Test data"): the result looks like a headered CSV read as
text — every source column a string, plus ``ingested_at`` and, for daily entities,
``batch_date``. Some values are made dirty on purpose: every 50th key gets the text ``bad`` in
one timestamp / date / number column, names and places arrive in the wrong case, and
``order_items`` / ``deliveries`` keep lineitem's duplicate (order, line) keys, so the cleaners,
dedupe and checks do real work.

Numbers are rendered through ``decimal(18,2)`` and timestamps by a plain cast of the zone-less
value (no session time zone involved, so a DST jump at midnight can't move a value), so the text
is the same byte for byte in any engine (the DuckDB oracle builds the identical text).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

# fixed values: the ingest time stamped on every fixture row, and the 1-in-N dirty-value rule
INGESTED_AT = "2024-06-01 00:00:00"
BAD_EVERY = 50
BAD = "bad"


# fixed values: column types of the driver's tables. Reading with a declared schema skips
# footer-based inference, which otherwise costs one Spark job per read.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read.schema(SCHEMAS[name]) if name in SCHEMAS else spark.read
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _text(c: Column) -> Column:
    return c.cast("string")


def _money_text(c: Column) -> Column:
    return c.cast("decimal(18,2)").cast("string")


def _dirty(key: Column, text: Column) -> Column:
    return F.when(key % BAD_EVERY == 0, F.lit(BAD)).otherwise(text)


def _ingested() -> Column:
    return F.lit(INGESTED_AT).cast("timestamp_ntz")


def _customer_geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = read_table(spark, sf_dir, "nation")
    region = read_table(spark, sf_dir, "region")
    geo = nation.join(region, nation.n_regionkey == region.r_regionkey).select("n_nationkey", "n_name", "r_name")
    customer = read_table(spark, sf_dir, "customer")
    return customer.join(geo, customer.c_nationkey == geo.n_nationkey)


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _customer_geo(spark, sf_dir)
    key = F.col("c_custkey")
    created = F.concat(_text(F.date_add(F.lit("1990-01-01").cast("date"), (key % 3650).cast("int"))), F.lit(" 00:00:00"))
    return c.select(
        _text(key).alias("customer_id"),
        F.lower("c_name").alias("customer_name"),
        F.concat(F.lit("09"), F.lpad(_text(key), 9, "0")).alias("phone_number"),
        F.concat(F.lit("customer"), _text(key), F.lit("@example.com")).alias("email"),
        F.upper("n_name").alias("city"),
        F.lower("r_name").alias("region"),
        F.lit(None).cast("string").alias("township"),
        F.lower("c_mktsegment").alias("segment"),
        _dirty(key, created).alias("created_at"),
        _ingested().alias("ingested_at"),
    )


def sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = read_table(spark, sf_dir, "nation")
    region = read_table(spark, sf_dir, "region")
    s = read_table(spark, sf_dir, "supplier")
    s = s.join(nation, s.s_nationkey == nation.n_nationkey).join(region, F.col("n_regionkey") == region.r_regionkey)
    key = F.col("s_suppkey")
    return s.select(
        _text(key).alias("seller_id"),
        F.lower("s_name").alias("seller_name"),
        F.upper("n_name").alias("city"),
        F.upper("r_name").alias("region"),
        F.when(F.col("s_acctbal") < 0, "individual").otherwise("business").alias("seller_type"),
        _dirty(key, _text(key % 5 + 1)).alias("rating"),
        F.lit(None).cast("string").alias("created_at"),
        _ingested().alias("ingested_at"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part")
    key = F.col("p_partkey")
    return p.select(
        _text(key).alias("product_id"),
        F.lit(None).cast("string").alias("seller_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("brand"),
        _dirty(key, _money_text(F.col("p_retailprice"))).alias("unit_price_mmk"),
        F.when(key % 10 == 0, "false").otherwise("true").alias("is_active"),
        F.lit(None).cast("string").alias("created_at"),
        _ingested().alias("ingested_at"),
    )


def _orders_geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    c = _customer_geo(spark, sf_dir).select("c_custkey", "n_name", "r_name")
    return o.join(c, o.o_custkey == c.c_custkey, "left")


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _orders_geo(spark, sf_dir)
    key = F.col("o_orderkey")
    total = _money_text(F.col("o_totalprice"))
    return o.select(
        _text(key).alias("order_id"),
        _text(F.col("o_custkey")).alias("customer_id"),
        _dirty(key, _text(F.col("o_orderdate"))).alias("order_timestamp"),
        F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("order_status"),
        F.col("n_name").alias("city"),
        F.col("r_name").alias("region"),
        F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("payment_method"),
        _dirty(key, F.lit("0.00")).alias("shipping_fee_mmk"),
        total.alias("subtotal_amount_mmk"),
        total.alias("order_total_mmk"),
        F.lit("MMK").alias("currency"),
        F.lit(None).cast("string").alias("item_count"),
        F.lit(None).cast("string").alias("total_quantity"),
        _ingested().alias("ingested_at"),
        F.to_date("o_orderdate").alias("batch_date"),
    )


def _lines_with_order(spark: SparkSession, sf_dir: str, geo: bool) -> DataFrame:
    lines = read_table(spark, sf_dir, "lineitem")
    o = _orders_geo(spark, sf_dir) if geo else read_table(spark, sf_dir, "orders")
    cols = ["o_orderkey", "o_orderdate"] + (["n_name", "r_name"] if geo else [])
    # lines and orders are both facts: a merge join at every size. Its exchange also deals the lines to all
    # tasks before their text is rendered, however few files hold them.
    return lines.join(o.select(*cols).hint("merge"), lines.l_orderkey == o.o_orderkey, "left")


def _by_text_size(rows: DataFrame, row_id: str) -> DataFrame:
    """``rows`` dealt once more, by the size of their text, to the tasks that dedupe them.

    The join's exchange is sized by narrow numbers, so a task of it that also sorts the rendered text for the dedupe
    holds some 16 times the bytes it read, and its sorts of lines and orders besides. Beside the row's id the order's
    is dealt by: with the id alone Spark would take this exchange for the dedupe's own, and could not split a hot id
    that comes from several tasks of the join before it is collapsed.
    """
    return rows.hint("rebalance", "order_id", row_id)


def _line_id(l: Column, n: Column) -> Column:
    return F.concat(_text(l), F.lit("-"), _text(n))


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _lines_with_order(spark, sf_dir, geo=False)
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_retailprice")
    li = li.join(part, li.l_partkey == part.p_partkey, "left")
    key = F.col("l_orderkey")
    gross = F.col("l_extendedprice").cast("decimal(18,2)")
    discount = F.round(gross * F.col("l_discount").cast("decimal(18,2)"), 2).cast("decimal(18,2)")
    rows = li.select(
        _line_id(key, F.col("l_linenumber")).alias("order_item_id"),
        _text(key).alias("order_id"),
        _text(F.col("l_partkey")).alias("product_id"),
        _text(F.col("l_suppkey")).alias("seller_id"),
        _text(F.col("l_linenumber")).alias("line_number"),
        _text(F.round("l_quantity").cast("int")).alias("quantity"),
        _dirty(key, _money_text(F.col("p_retailprice"))).alias("unit_price_mmk"),
        _text(gross).alias("gross_line_amount_mmk"),
        _text(discount).alias("discount_amount_mmk"),
        _text((gross - discount).cast("decimal(18,2)")).alias("net_line_amount_mmk"),
        _ingested().alias("ingested_at"),
        F.to_date("o_orderdate").alias("batch_date"),
    )
    return _by_text_size(rows, "order_item_id")


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "events").filter(F.col("event_type").isin("purchase", "error"))
    key = F.col("event_id")
    return e.select(
        _text(key).alias("payment_id"),
        F.lit(None).cast("string").alias("order_id"),
        _text(F.col("user_id")).alias("customer_id"),
        F.lit(None).cast("string").alias("payment_method"),
        F.when(F.col("event_type") == "purchase", "captured").otherwise("refunded").alias("payment_status"),
        _dirty(key, _money_text(F.col("value"))).alias("payment_amount_mmk"),
        _dirty(key, _text(F.col("ts"))).alias("paid_at"),
        _ingested().alias("ingested_at"),
        F.to_date("ts").alias("batch_date"),
    )


def deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _lines_with_order(spark, sf_dir, geo=True)
    key = F.col("l_orderkey")
    order_day = F.to_date("o_orderdate")
    rows = li.select(
        _line_id(key, F.col("l_linenumber")).alias("delivery_id"),
        _text(key).alias("order_id"),
        F.concat(F.lit("carrier-"), F.col("l_returnflag")).alias("delivery_provider"),
        F.col("r_name").alias("region"),
        F.col("n_name").alias("city"),
        _text(F.date_add(order_day, 30)).alias("promised_delivery_date"),
        _dirty(key, _text(F.to_date("l_shipdate"))).alias("actual_delivery_date"),
        F.when(F.col("l_linestatus") == "F", "delivered").otherwise("in_transit").alias("delivery_status"),
        _money_text(F.col("l_quantity")).alias("delivery_fee_mmk"),
        _ingested().alias("ingested_at"),
        order_day.alias("batch_date"),
    )
    return _by_text_size(rows, "delivery_id")


def inventory_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part")
    last_ship = (
        read_table(spark, sf_dir, "lineitem")
        .groupBy("l_partkey")
        .agg(F.max("l_shipdate").alias("last_ship"))
    )
    p = p.join(last_ship, p.p_partkey == last_ship.l_partkey, "left")
    key = F.col("p_partkey")
    stock = F.col("p_size") % 10
    return p.select(
        F.concat(F.lit("inv-"), _text(key)).alias("inventory_snapshot_id"),
        _text(key).alias("product_id"),
        F.lit(None).cast("string").alias("seller_id"),
        _dirty(key, _text(F.to_date("last_ship"))).alias("snapshot_date"),
        _text(stock).alias("available_quantity"),
        _text(F.expr("p_size div 10")).alias("reserved_quantity"),
        F.when(stock == 0, "out_of_stock").when(stock < 3, "low_stock").otherwise("in_stock").alias("inventory_status"),
        F.lit("3").alias("reorder_threshold"),
        _ingested().alias("ingested_at"),
        F.to_date("last_ship").alias("batch_date"),
    )


EXTRACTS = {
    "customers": customers,
    "sellers": sellers,
    "products": products,
    "orders": orders,
    "order_items": order_items,
    "payments": payments,
    "deliveries": deliveries,
    "inventory_snapshots": inventory_snapshots,
}


def extract(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    return EXTRACTS[entity](spark, sf_dir)
