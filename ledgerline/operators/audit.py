"""Audit trail (K7): one row per (batch, stage) appended to a Parquet table.

Both outcomes are recorded: SUCCESS with the row count observed during the stage's write, and
FAILED with the check message, written before the failure is raised. ``audit_id`` is a 64-bit
hash of (batch_date, stage, created_at) instead of a database sequence, so appends from
concurrent jobs need no coordination.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.contracts import GOLD
from ledgerline.sources.layers import as_date

AUDIT = GOLD["pipeline_run_audit"]
SUCCESS = "SUCCESS"
FAILED = "FAILED"


def audit_path(root: str) -> str:
    return f"{root.rstrip('/')}/audit/pipeline_run_audit"


def audit_frame(
    spark: SparkSession,
    batch_date: dt.date | str | None,
    stage: str,
    status: str,
    row_count: int | None = None,
    message: str | None = None,
) -> DataFrame:
    row = [(as_date(batch_date) if batch_date is not None else None, stage, status, row_count, message)]
    base = spark.createDataFrame(row, "batch_date date, pipeline_stage string, status string, row_count long, message string")
    return with_audit_ids(base)


def with_audit_ids(rows: DataFrame) -> DataFrame:
    """Add ``created_at`` (now, UTC wall clock) and the hashed ``audit_id``; contract order."""
    stamped = rows.withColumn("created_at", F.current_timestamp().cast("timestamp_ntz"))
    keyed = stamped.withColumn("audit_id", F.xxhash64("batch_date", "pipeline_stage", "created_at"))
    return keyed.select(*[f.name for f in AUDIT.fields])


def write_audit(
    spark: SparkSession,
    root: str,
    batch_date: dt.date | str | None,
    stage: str,
    status: str,
    row_count: int | None = None,
    message: str | None = None,
) -> None:
    audit_frame(spark, batch_date, stage, status, row_count, message).coalesce(1).write.mode("append").parquet(audit_path(root))


def stage_counts(frames: dict[str, DataFrame], status: str = SUCCESS) -> DataFrame:
    """One audit row per named frame: ``(pipeline_stage, status, row_count)``.

    Each count is a global aggregate (partial counts per partition, one final row), and the
    rows are unioned; no count reaches the driver.
    """
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(stage).alias("pipeline_stage"), F.lit(status).alias("status"), F.col("row_count")
        )
        for stage, df in frames.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def read_audit(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(AUDIT).parquet(audit_path(root))


def stage_metrics(audit: DataFrame) -> DataFrame:
    """Per stage: runs, failures, rows written and the last run time (roadmap 'stage metrics')."""
    return audit.groupBy("pipeline_stage").agg(
        F.count(F.lit(1)).alias("runs"),
        F.sum(F.when(F.col("status") == FAILED, 1).otherwise(0)).cast("long").alias("failures"),
        F.sum("row_count").cast("long").alias("rows_written"),
        F.max("created_at").alias("last_run_at"),
    )
