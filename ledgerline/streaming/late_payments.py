"""Late-arriving payments with Structured Streaming (the reference's roadmap item).

Payment events land as files in a folder over time, possibly late and possibly twice. The
stream

1. shapes each event like a raw payment and types it (the batch silver rules, same columns);
2. drops repeats of a ``payment_id`` seen within the watermark
   (``dropDuplicatesWithinWatermark``: state is bounded by the watermark delay, not by history);
3. appends the distinct payments to a ``batch_date``-partitioned Parquet table through the
   file sink, which is exactly-once (its commit log lists the files of each micro-batch);
4. keeps per-day totals by payment status in windowed state, emitted once the watermark has
   passed the end of the day (append mode), so each day's row is final when written.

Checkpoints live under the shared ``spark.checkpoint.dir`` unless a location is given, so a
restarted driver or lost executor resumes from the last committed micro-batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerline.contracts import SILVER, conform
from ledgerline.session import checkpoint_dir

EVENT_SCHEMA = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def read_events(spark: SparkSession, folder: str, max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(EVENT_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.parquet(folder)


def payments_from_events(events: DataFrame) -> DataFrame:
    """Purchases (captured) and errors (refunded) as typed silver payments."""
    paid = events.where(F.col("event_type").isin("purchase", "error")).select(
        F.col("event_id").cast("string").alias("payment_id"),
        F.col("user_id").cast("string").alias("customer_id"),
        F.when(F.col("event_type") == "purchase", "captured").otherwise("refunded").alias("payment_status"),
        F.col("value").try_cast("decimal(18,2)").alias("payment_amount_mmk"),
        F.col("ts").alias("paid_at"),
        F.to_date("ts").alias("batch_date"),
    )
    return conform(paid, SILVER["payments"])


def _event_time(payments: DataFrame, delay: str) -> DataFrame:
    """Watermarks need a zoned timestamp: ``paid_at`` read in the session zone (UTC)."""
    return payments.withColumn("event_time", F.col("paid_at").cast("timestamp")).withWatermark("event_time", delay)


def _distinct(payments: DataFrame, delay: str) -> DataFrame:
    return _event_time(payments, delay).dropDuplicatesWithinWatermark(["payment_id"])


def distinct_payments(payments: DataFrame, delay: str = "2 days") -> DataFrame:
    """Drop repeats of a payment within ``delay`` of event time (bounded state)."""
    return _distinct(payments, delay).drop("event_time")


def daily_totals(payments: DataFrame, delay: str = "2 days") -> DataFrame:
    """Final per-day totals by status over distinct payments; a day is emitted once the
    watermark passes its end (two stateful operators chained in one append-mode query)."""
    day = F.window("event_time", "1 day")
    return (
        _distinct(payments, delay)
        .groupBy(day.alias("day"), "payment_status")
        .agg(F.count(F.lit(1)).alias("payments"), F.sum("payment_amount_mmk").cast("decimal(38,2)").alias("amount_mmk"))
        .select(F.col("day.start").cast("date").alias("payment_date"), "payment_status", "payments", "amount_mmk")
    )


def _checkpoint(spark: SparkSession, name: str, location: str | None) -> str:
    return location or f"{checkpoint_dir(spark).rstrip('/')}/streams/{name}"


def start(
    spark: SparkSession,
    source: str,
    target_root: str,
    delay: str = "2 days",
    available_now: bool = True,
    checkpoint_root: str | None = None,
) -> list[StreamingQuery]:
    """Start both sinks: distinct payments and daily totals (Parquet, exactly-once)."""
    events = read_events(spark, source)
    payments = payments_from_events(events)
    trigger = {"availableNow": True} if available_now else {"processingTime": "1 minute"}
    base = checkpoint_root.rstrip("/") if checkpoint_root else None
    rows = (
        distinct_payments(payments, delay).writeStream.format("parquet")
        .option("checkpointLocation", _checkpoint(spark, "payments", f"{base}/payments" if base else None))
        .partitionBy("batch_date")
        .outputMode("append")
        .trigger(**trigger)
        .start(f"{target_root.rstrip('/')}/stream/payments")
    )
    totals = (
        daily_totals(payments, delay).writeStream.format("parquet")
        .option("checkpointLocation", _checkpoint(spark, "payment_totals", f"{base}/totals" if base else None))
        .outputMode("append")
        .trigger(**trigger)
        .start(f"{target_root.rstrip('/')}/stream/payment_totals")
    )
    return [rows, totals]
