"""Exact distinct counts that add up: per-day partials of the order fact, merged by reports over any days.

Distinct orders of a long range can't be had from the days' counts, as an order may come on several days. Here each order id has a code in a
stored dictionary, and each day keeps, per (order date, region key), bitmaps of its orders' codes (Spark's bitmap functions, 32,768
codes in one row) beside the sums. A report ORs the bitmaps and counts their bits: exact, and it reads only the partials, not the fact.

Codes are dealt where they make few bitmaps: new ids are numbered in the order of (region key, id), so a region's orders lie
in a run of codes, and a day has about one bitmap per region and per 32,768 orders, however many regions there are. A code never
changes; an id that comes again keeps its code. Numbering is per task, so no task sees all ids; a hot region is split by the id.

Null ids have no code and count as no order, but their amounts do. One writer at a time; a stopped run is made good by running its days
again: ids already coded are found, and the days' partials are replaced.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators.publish import write_batches
from ledgerline.sources import files

CODES = "order_id string, code long"
PARTIALS = "order_date date, region_key long, bucket long, bits binary, amount decimal(38,2), batch_date date"
TASK_BITS = 33  # of a code: rows of one task


def codes_path(root: str) -> str:
    return f"{root.rstrip('/')}/partials/order_codes"


def partials_path(root: str) -> str:
    return f"{root.rstrip('/')}/partials/orders"


def coded(ids: DataFrame, base: int = 0) -> DataFrame:
    """(order_id, code) for the distinct non-null ids of (order_id, region_key); codes from ``base`` on."""
    one = ids.where(F.col("order_id").isNotNull()).groupBy("order_id").agg(F.min("region_key").alias("region_key"))
    dealt = one.repartitionByRange("region_key", "order_id").sortWithinPartitions("region_key", "order_id")
    return dealt.select("order_id", (F.monotonically_increasing_id() + F.lit(base)).alias("code"))


def partials(orders: DataFrame, codes: DataFrame) -> DataFrame:
    """``PARTIALS`` of rows of ``fact_orders`` whose ids are all in ``codes``."""
    rows = orders.select("order_id", "order_date", "region_key", "order_total_mmk", "batch_date")
    known = rows.where(F.col("order_id").isNotNull()).join(codes, "order_id")
    nameless = rows.where(F.col("order_id").isNull()).withColumn("code", F.lit(None).cast("long"))  # not joined: one key for all
    bucket: Column = F.bitmap_bucket_number("code").alias("bucket")
    each = known.unionByName(nameless).groupBy("order_date", "region_key", bucket, "batch_date")
    made = each.agg(F.bitmap_construct_agg(F.bitmap_bit_position("code")).alias("bits"), F.sum("order_total_mmk").cast("decimal(38,2)").alias("amount"))
    return made.select("order_date", "region_key", "bucket", "bits", "amount", "batch_date")


def merged(parts: DataFrame, keys: Sequence[str], orders: str, amount: str) -> DataFrame:
    """Per ``keys``: distinct orders and summed amount of all rows of ``parts``."""
    each = parts.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"), F.sum("amount").cast("decimal(38,2)").alias("amount"))
    return each.groupBy(*keys).agg(F.sum(F.bitmap_count("bits")).alias(orders), F.sum("amount").cast("decimal(38,2)").alias(amount))


def read_codes(spark: SparkSession, root: str) -> DataFrame:
    path = codes_path(root)
    return spark.read.schema(CODES).parquet(path) if files.exists(spark, path) else spark.createDataFrame([], CODES)


def read_partials(spark: SparkSession, root: str, days: Sequence[dt.date] | None = None) -> DataFrame:
    """The partials of ``days`` (all if None), by a partition filter."""
    path = partials_path(root)
    rows = spark.read.schema(PARTIALS).parquet(path) if files.exists(spark, path) else spark.createDataFrame([], PARTIALS)
    return rows if days is None else rows.where(F.col("batch_date").isin(*[F.lit(d) for d in days]))


def store_days(orders: DataFrame, root: str, days: Sequence[dt.date]) -> int:
    """Code the ids of ``orders`` (rows of ``fact_orders`` of ``days``) that are new, and replace the days' partials; the rows written."""
    spark = orders.sparkSession
    known = read_codes(spark, root)
    top = known.agg(F.max("code")).first()[0]
    base = 0 if top is None else ((top >> TASK_BITS) + 1) << TASK_BITS
    new = orders.select("order_id", "region_key").join(known.select("order_id"), "order_id", "left_anti")
    coded(new, base).write.mode("append").parquet(codes_path(root))
    return write_batches(partials(orders, read_codes(spark, root)), partials_path(root), days)
