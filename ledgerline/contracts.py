"""Table contracts: one ``StructType`` per table and layer, plus ``conform``.

Bronze keeps the source text (every source column is a string) so nothing is lost on ingest
(a phone number ``09…`` keeps its leading zero). Typing happens once, in silver, through
``conform``; gold tables project silver columns into the warehouse contracts below.
"""

from __future__ import annotations

import re
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_DECIMAL = re.compile(r"decimal\((\d+),\s*(\d+)\)")
_SIMPLE = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampNTZType(),
}


def _type(name: str) -> T.DataType:
    m = _DECIMAL.fullmatch(name)
    if m:
        return T.DecimalType(int(m.group(1)), int(m.group(2)))
    return _SIMPLE[name]


def schema(spec: str) -> T.StructType:
    """``"a string, b decimal(18,2)"`` → ``StructType`` (``timestamp`` means NTZ)."""
    fields = []
    for part in re.split(r",\s*(?![^()]*\))", spec.strip()):
        name, typ = part.strip().split(None, 1)
        fields.append(T.StructField(name, _type(typ.strip()), True))
    return T.StructType(fields)


# ---- raw extracts: column names of each headered CSV (all read as text) ----------------------
# fixed values: the column names and types of the tables, which files and warehouse share
SOURCE_COLUMNS: dict[str, tuple[str, ...]] = {
    "customers": ("customer_id", "customer_name", "phone_number", "email", "city", "region",
                  "township", "segment", "created_at"),
    "sellers": ("seller_id", "seller_name", "city", "region", "seller_type", "rating", "created_at"),
    "products": ("product_id", "seller_id", "product_name", "category", "brand", "unit_price_mmk",
                 "is_active", "created_at"),
    "orders": ("order_id", "customer_id", "order_timestamp", "order_status", "city", "region",
               "payment_method", "shipping_fee_mmk", "subtotal_amount_mmk", "order_total_mmk",
               "currency", "item_count", "total_quantity"),
    "order_items": ("order_item_id", "order_id", "product_id", "seller_id", "line_number", "quantity",
                    "unit_price_mmk", "gross_line_amount_mmk", "discount_amount_mmk",
                    "net_line_amount_mmk"),
    "payments": ("payment_id", "order_id", "customer_id", "payment_method", "payment_status",
                 "payment_amount_mmk", "paid_at"),
    "deliveries": ("delivery_id", "order_id", "delivery_provider", "region", "city",
                   "promised_delivery_date", "actual_delivery_date", "delivery_status",
                   "delivery_fee_mmk"),
    "inventory_snapshots": ("inventory_snapshot_id", "product_id", "seller_id", "snapshot_date",
                            "available_quantity", "reserved_quantity", "inventory_status",
                            "reorder_threshold"),
}

MASTER_ENTITIES = ("customers", "sellers", "products")
BATCH_ENTITIES = ("orders", "order_items", "payments", "deliveries", "inventory_snapshots")


def source_schema(entity: str) -> T.StructType:
    """Schema used to read a raw CSV: every column as text."""
    return T.StructType([T.StructField(c, T.StringType(), True) for c in SOURCE_COLUMNS[entity]])


def bronze_schema(entity: str) -> T.StructType:
    """Bronze = source text + ``ingested_at`` (+ ``batch_date`` for daily entities)."""
    fields = list(source_schema(entity).fields)
    fields.append(T.StructField("ingested_at", T.TimestampNTZType(), True))
    if entity in BATCH_ENTITIES:
        fields.append(T.StructField("batch_date", T.DateType(), True))
    return T.StructType(fields)


# ---- silver: typed, deduplicated entities -----------------------------------------------------
SILVER = {
    "customers": schema(
        "customer_id string, customer_name string, phone_number string, email string, city string, "
        "region string, township string, segment string, created_at timestamp"),
    "sellers": schema(
        "seller_id string, seller_name string, city string, region string, seller_type string, "
        "rating decimal(5,2), created_at timestamp"),
    "products": schema(
        "product_id string, seller_id string, product_name string, category string, brand string, "
        "unit_price_mmk decimal(18,2), is_active boolean, created_at timestamp"),
    "orders": schema(
        "order_id string, customer_id string, order_timestamp timestamp, order_date date, "
        "order_status string, city string, region string, payment_method string, "
        "shipping_fee_mmk decimal(18,2), subtotal_amount_mmk decimal(18,2), "
        "order_total_mmk decimal(18,2), currency string, item_count int, total_quantity int, "
        "batch_date date"),
    "order_items": schema(
        "order_item_id string, order_id string, product_id string, seller_id string, "
        "line_number int, quantity int, unit_price_mmk decimal(18,2), "
        "gross_line_amount_mmk decimal(18,2), discount_amount_mmk decimal(18,2), "
        "net_line_amount_mmk decimal(18,2), batch_date date"),
    "payments": schema(
        "payment_id string, order_id string, customer_id string, payment_method string, "
        "payment_status string, payment_amount_mmk decimal(18,2), paid_at timestamp, batch_date date"),
    "deliveries": schema(
        "delivery_id string, order_id string, delivery_provider string, region string, city string, "
        "promised_delivery_date date, actual_delivery_date date, delivery_status string, "
        "delivery_fee_mmk decimal(18,2), delivery_delay_days int, batch_date date"),
    "inventory_snapshots": schema(
        "inventory_snapshot_id string, product_id string, seller_id string, snapshot_date date, "
        "available_quantity int, reserved_quantity int, inventory_status string, "
        "reorder_threshold int, batch_date date"),
}

# ---- gold: the warehouse contracts (five dimensions, five facts, the audit table) ------------
# fixed values: the column names and types of the warehouse
GOLD = {
    "dim_customer": schema(
        "customer_id string, customer_name string, phone_number string, email string, city string, "
        "region string, township string, segment string, created_at timestamp"),
    "dim_seller": schema(
        "seller_id string, seller_name string, city string, region string, seller_type string, "
        "rating decimal(5,2), created_at timestamp"),
    "dim_product": schema(
        "product_id string, seller_id string, product_name string, category string, brand string, "
        "unit_price_mmk decimal(18,2), is_active boolean, created_at timestamp"),
    "dim_region": schema("region_key long, region string, city string"),
    "dim_date": schema(
        "date_key int, calendar_date date, year int, month int, day int, month_name string, "
        "week_of_year int"),
    "fact_orders": schema(
        "order_id string, customer_id string, region_key long, order_date date, "
        "order_timestamp timestamp, order_status string, payment_method string, "
        "shipping_fee_mmk decimal(18,2), subtotal_amount_mmk decimal(18,2), "
        "order_total_mmk decimal(18,2), item_count int, total_quantity int, batch_date date"),
    "fact_order_items": schema(
        "order_item_id string, order_id string, product_id string, seller_id string, "
        "category string, brand string, line_number int, quantity int, "
        "unit_price_mmk decimal(18,2), gross_line_amount_mmk decimal(18,2), "
        "discount_amount_mmk decimal(18,2), net_line_amount_mmk decimal(18,2), batch_date date"),
    "fact_payments": schema(
        "payment_id string, order_id string, customer_id string, payment_method string, "
        "payment_status string, payment_amount_mmk decimal(18,2), payment_date date, "
        "paid_at timestamp, batch_date date"),
    "fact_inventory_snapshot": schema(
        "inventory_snapshot_id string, product_id string, seller_id string, snapshot_date date, "
        "available_quantity int, reserved_quantity int, inventory_status string, "
        "reorder_threshold int, batch_date date"),
    "fact_delivery_performance": schema(
        "delivery_id string, order_id string, delivery_provider string, region string, city string, "
        "promised_delivery_date date, actual_delivery_date date, delivery_status string, "
        "delivery_fee_mmk decimal(18,2), delivery_delay_days int, batch_date date"),
    "pipeline_run_audit": schema(
        "audit_id long, batch_date date, pipeline_stage string, status string, row_count long, "
        "message string, created_at timestamp"),
}

DIMENSIONS = ("dim_customer", "dim_seller", "dim_product", "dim_region", "dim_date")
FACTS = ("fact_orders", "fact_order_items", "fact_payments", "fact_inventory_snapshot",
         "fact_delivery_performance")

def layer_schema(layer: str, table: str) -> T.StructType:
    """Declared schema of a stored table: a table without files yet reads as empty."""
    if layer == "bronze":
        return bronze_schema(table)
    return SILVER[table] if layer == "silver" else GOLD[table]


def require_columns(df: DataFrame, columns: Sequence[str], what: str) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{what}: missing columns {', '.join(missing)}")


def conform(df: DataFrame, contract: T.StructType, keep: Sequence[str] = ()) -> DataFrame:
    """Project ``df`` onto ``contract``: contract order, contract types, missing columns NULL.

    Where a missing column is a fault, call ``require_columns`` first.

    Text is parsed with ``try_cast`` (NULL on bad input); columns already of the right type
    pass through untouched. Columns named in ``keep`` follow the contract's, unchanged. One
    ``select``, so it is a single projection in the plan.
    """
    present = {f.name: f.dataType for f in df.schema.fields}
    cols = []
    for field in contract.fields:
        if field.name not in present:
            cols.append(F.lit(None).cast(field.dataType).alias(field.name))
        elif present[field.name] == field.dataType:
            cols.append(F.col(field.name))
        else:
            cols.append(F.col(field.name).try_cast(field.dataType).alias(field.name))
    cols += [F.col(c) for c in keep if c not in contract.fieldNames()]
    return df.select(*cols)
