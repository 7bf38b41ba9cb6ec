"""Late payments from the stream into silver and ``fact_payments`` (the reference's roadmap item).

Each micro-batch goes through ``merge_batch`` in two steps, each of which ends with a marker of its batch id:

1. **sort out.** Events without an id or time, with a negative amount, or older than the watermark (the latest event of earlier
   micro-batches less the delay) go to a side table with their reason. Of the others the first of each payment is kept, unless silver or an
   earlier micro-batch has the payment on a day within the delay; the rows are stored under the batch id.
2. **merge.** The stored rows that silver and ``fact_payments`` don't hold yet are appended to exactly their days' partitions; days
   that no late payment touches are neither read nor written.

A micro-batch that Spark replays after a crash starts at the step whose marker is missing: step 1 overwrites its own rows and is over before anything
is merged, and step 2 appends only what is missing, so a replay at any point gives the same tables. ``to_silver`` adds the accepted
payments of its days to the extract's (``with_accepted``), so a batch rerun of a day keeps them.

Layout under ``root``: ``late/accepted`` and ``late/rejected`` by ``merge_batch``; ``late/steps/<step>/batch=<id>``, a row of counts each.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ledgerline.contracts import SILVER
from ledgerline.operators import audit as A
from ledgerline.operators import star as G
from ledgerline.sources import files
from ledgerline.sources.layers import scan, table_path
from ledgerline.streaming import late_payments as L

STAGE = "late_payments_merge"
DELAY = dt.timedelta(days=2)
PAYMENTS = SILVER["payments"]
_STORED = {"accepted": T.StructType([*PAYMENTS.fields, T.StructField("merge_batch", T.LongType())]),
           "rejected": T.StructType([*PAYMENTS.fields, T.StructField("reason", T.StringType()), T.StructField("merge_batch", T.LongType())])}


def late_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/late/{name}"


def stored(spark: SparkSession, root: str, name: str) -> DataFrame | None:
    """``accepted`` or ``rejected`` payments with their ``merge_batch``; None before the first."""
    path = late_path(root, name)
    return spark.read.schema(_STORED[name]).parquet(path) if files.exists(spark, path) else None


def _step(root: str, step: str, batch: int) -> str:
    return f"{late_path(root, 'steps')}/{step}/batch={batch}"


def _done(spark: SparkSession, root: str, step: str, batch: int) -> bool:
    return files.exists(spark, f"{_step(root, step, batch)}/_SUCCESS")


def _mark(spark: SparkSession, root: str, step: str, batch: int, latest: dt.datetime | None, **counts: int) -> None:
    row = spark.createDataFrame([(latest, *counts.values())], "latest timestamp_ntz, " + ", ".join(f"{c} long" for c in counts))
    row.coalesce(1).write.mode("overwrite").parquet(_step(root, step, batch))


def _latest_before(spark: SparkSession, root: str, batch: int) -> dt.datetime | None:
    """The latest event time of earlier micro-batches; each marker carries it on, so the last one is enough."""
    path = f"{late_path(root, 'steps')}/sorted"
    if not files.exists(spark, path):
        return None
    earlier = spark.read.schema("latest timestamp_ntz, batch long").parquet(path).where(F.col("batch") < batch)
    if _done(spark, root, "sorted", batch - 1):
        earlier = earlier.where(F.col("batch") == batch - 1)
    return earlier.agg(F.max("latest")).first()[0]


def _reason(horizon: dt.datetime | None) -> Column:
    too_late = F.lit(False) if horizon is None else F.col("paid_at") < F.lit(horizon).cast("timestamp_ntz")
    return (F.when(F.col("payment_id").isNull(), "no_id").when(F.col("paid_at").isNull(), "no_time")
            .when(F.col("payment_amount_mmk") < 0, "negative_amount").when(too_late, "too_late"))


def _of_days(df: DataFrame, days: list[dt.date]) -> DataFrame:
    """Rows of partitions ``days``; the filter prunes."""
    return df.where(F.col("batch_date").isin(*[F.lit(d) for d in days])) if days else df.where("false")


def _held(spark: SparkSession, root: str, layer: str, table: str) -> DataFrame | None:
    return scan(spark, root, layer, table) if files.exists(spark, table_path(root, layer, table)) else None


def _without(rows: DataFrame, held: DataFrame | None) -> DataFrame:
    return rows if held is None else rows.join(held.select("payment_id"), "payment_id", "left_anti").select(*rows.columns)


def sort_out(payments: DataFrame, root: str, batch: int, delay: dt.timedelta) -> None:
    """Step 1."""
    spark = payments.sparkSession
    before = _latest_before(spark, root, batch)
    judged = payments.withColumn("reason", _reason(None if before is None else before - delay)).persist()
    try:
        rows, latest, first, last = judged.agg(F.count(F.lit(1)), F.max("paid_at"), F.min(F.when(F.col("reason").isNull(), F.col("batch_date"))),
                                               F.max(F.when(F.col("reason").isNull(), F.col("batch_date")))).first()
        judged.where("reason IS NOT NULL").select(*PAYMENTS.fieldNames(), "reason").write.mode("overwrite").parquet(f"{late_path(root, 'rejected')}/merge_batch={batch}")
        order = ["paid_at", *[c for c in PAYMENTS.fieldNames() if c not in ("payment_id", "paid_at")]]
        one = judged.where("reason IS NULL").groupBy("payment_id").agg(F.min(F.struct(*order)).alias("_r"))
        fresh = one.select(*[F.col("payment_id") if c == "payment_id" else F.col("_r")[c].alias(c) for c in PAYMENTS.fieldNames()])
        if first is not None:
            span = F.col("batch_date").between(F.lit(first - delay), F.lit(last + delay))
            earlier = stored(spark, root, "accepted")
            for held in (_held(spark, root, "silver", "payments"), earlier and earlier.where(F.col("merge_batch") != batch)):
                fresh = _without(fresh, held and held.where(span))
        fresh.write.mode("overwrite").parquet(f"{late_path(root, 'accepted')}/merge_batch={batch}")
    finally:
        judged.unpersist()
    accepted = stored(spark, root, "accepted").where(F.col("merge_batch") == batch).count()
    rejected = stored(spark, root, "rejected").where(F.col("merge_batch") == batch).count()
    latest = max((t for t in (before, latest) if t is not None), default=None)
    _mark(spark, root, "sorted", batch, latest, accepted=accepted, rejected=rejected, repeated=rows - accepted - rejected)


def merge(spark: SparkSession, root: str, batch: int) -> dict[dt.date, int]:
    """Step 2: the accepted rows of ``batch`` that are missing in silver and ``fact_payments``; accepted rows per day."""
    rows = stored(spark, root, "accepted").where(F.col("merge_batch") == batch).drop("merge_batch")
    days = {r.batch_date: r["count"] for r in rows.groupBy("batch_date").count().collect()}  # a row a day
    for layer, table, shaped in (("silver", "payments", rows), ("gold", "fact_payments", G.fact_payments(rows))):
        held = _held(spark, root, layer, table)
        missing = _without(shaped, held and _of_days(held, sorted(days)))
        if days:
            _append(missing.hint("rebalance", "batch_date"), table_path(root, layer, table))
    if days:
        audit = [(day, STAGE, A.SUCCESS, n, f"micro-batch {batch}") for day, n in sorted(days.items())]
        frame = spark.createDataFrame(audit, "batch_date date, pipeline_stage string, status string, row_count long, message string")
        A.with_audit_ids(frame).coalesce(1).write.mode("append").parquet(A.audit_path(root))
    _mark(spark, root, "merged", batch, None, days=len(days))
    return days


def _append(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").partitionBy("batch_date").parquet(path)


def merge_batch(payments: DataFrame, batch: int, root: str, delay: dt.timedelta = DELAY) -> None:
    """One micro-batch of typed payments, from where it last stopped."""
    spark = payments.sparkSession
    if _done(spark, root, "merged", batch):
        return
    if not _done(spark, root, "sorted", batch):
        sort_out(payments, root, batch, delay)
    merge(spark, root, batch)


def with_accepted(spark: SparkSession, root: str, payments: DataFrame, days: list[dt.date]) -> DataFrame:
    """Silver ``payments`` of ``days`` and the accepted late ones that are not among them."""
    late = stored(spark, root, "accepted")
    if late is None:
        return payments
    rows = _of_days(late.drop("merge_batch"), days).dropDuplicates(["payment_id", "batch_date"])
    known = payments.select("payment_id", "batch_date")
    return payments.unionByName(rows.join(known, ["payment_id", "batch_date"], "left_anti").select(*payments.columns))


def metrics(spark: SparkSession, root: str) -> DataFrame:
    """(batch, latest, accepted, rejected, repeated) of each micro-batch."""
    return spark.read.schema("latest timestamp_ntz, accepted long, rejected long, repeated long, batch long").parquet(f"{late_path(root, 'steps')}/sorted")


def start(spark: SparkSession, source: str, root: str, delay: dt.timedelta = DELAY, available_now: bool = True, checkpoint: str | None = None) -> StreamingQuery:
    """Merge the payments of the event files in ``source``, those there now or as they come."""
    payments = L.payments_from_events(L.read_events(spark, source))
    trigger = {"availableNow": True} if available_now else {"processingTime": "1 minute"}
    return (payments.writeStream.foreachBatch(lambda rows, batch: merge_batch(rows, batch, root, delay))
            .option("checkpointLocation", L._checkpoint(spark, "merge_payments", checkpoint)).trigger(**trigger).start())
