"""What the pipeline's stages cost, from Spark's event log read as a table (2.16 stage metrics).

Stages of the pipeline mark their jobs with a local property; job starts in the event log carry it. ``stage_costs`` joins
the log's task ends with the marked jobs' stages and sums them per pipeline stage and run: tasks, failed tasks, wall and task time, bytes read, written, shuffled and
spilled, and the largest task's shuffle read. It is a scan and two aggregates however long the log is. ``over_limits`` compares the sums with limits per stage, and
``audit_limits`` writes an audit row for each broken one, for the days of the run.

The log is written by Spark if the session is started with ``spark.eventLog.enabled``, ``spark.eventLog.dir`` and ``spark.eventLog.compress=false``.
No web page or port is involved.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators import audit as A

PROPERTY = "ledgerline.stage"
LIMIT = "LIMIT"
# fixed values: names in Spark's event log
_LOG = """
    Event string, `Job ID` long, `Stage IDs` array<long>, Properties map<string,string>, `Stage ID` long,
    `Task Info` struct<`Launch Time`: long, `Finish Time`: long, Failed: boolean>,
    `Task Metrics` struct<`Executor Run Time`: long, `Executor CPU Time`: long, `Disk Bytes Spilled`: long,
        `Shuffle Read Metrics`: struct<`Remote Bytes Read`: long, `Local Bytes Read`: long>, `Shuffle Write Metrics`: struct<`Shuffle Bytes Written`: long>,
        `Input Metrics`: struct<`Bytes Read`: long, `Records Read`: long>, `Output Metrics`: struct<`Bytes Written`: long, `Records Written`: long>>
"""
METRICS = ("tasks", "failed_tasks", "wall_ms", "task_ms", "cpu_ms", "bytes_read", "rows_read", "bytes_written", "rows_written", "shuffle_bytes_written", "shuffle_bytes_read",
           "bytes_spilled", "largest_task_shuffle_read")


@contextmanager
def marked(spark: SparkSession, stage: str, days: Sequence[dt.date]) -> Iterator[None]:
    """Jobs begun inside belong to this run of ``stage``."""
    context = spark.sparkContext
    before = context.getLocalProperty(PROPERTY)
    context.setLocalProperty(PROPERTY, "|".join([stage, days[0].isoformat(), days[-1].isoformat(), uuid.uuid4().hex]))
    try:
        yield
    finally:
        context.setLocalProperty(PROPERTY, before)


def stage_costs(spark: SparkSession, log: str) -> DataFrame:
    """(pipeline_stage, first_day, last_day, run_id, then ``METRICS``) of each run of a stage in the event log file or folder ``log``."""
    events = spark.read.schema(_LOG).option("recursiveFileLookup", "true").json(log)
    jobs = events.where(F.col("Event") == "SparkListenerJobStart").select(F.col("Properties")[PROPERTY].alias("mark"), F.explode("Stage IDs").alias("stage"))
    owner = jobs.where(F.col("mark").isNotNull()).groupBy("stage").agg(F.min_by("mark", "mark").alias("mark"))
    info, m = F.col("Task Info"), F.col("Task Metrics")
    read = F.coalesce(m["Shuffle Read Metrics"]["Remote Bytes Read"], F.lit(0)) + F.coalesce(m["Shuffle Read Metrics"]["Local Bytes Read"], F.lit(0))
    tasks = events.where(F.col("Event") == "SparkListenerTaskEnd").select(
        F.col("Stage ID").alias("stage"), info["Launch Time"].alias("began"), info["Finish Time"].alias("ended"), info["Failed"].cast("long").alias("failed"),
        m["Executor Run Time"].alias("task_ms"), (m["Executor CPU Time"] / 1_000_000).cast("long").alias("cpu_ms"),
        m["Input Metrics"]["Bytes Read"].alias("bytes_read"), m["Input Metrics"]["Records Read"].alias("rows_read"),
        m["Output Metrics"]["Bytes Written"].alias("bytes_written"), m["Output Metrics"]["Records Written"].alias("rows_written"),
        m["Shuffle Write Metrics"]["Shuffle Bytes Written"].alias("shuffle_bytes_written"), read.alias("shuffle_bytes_read"), m["Disk Bytes Spilled"].alias("bytes_spilled"))
    sums = ["task_ms", "cpu_ms", "bytes_read", "rows_read", "bytes_written", "rows_written", "shuffle_bytes_written", "shuffle_bytes_read", "bytes_spilled"]
    per_stage = tasks.groupBy("stage").agg(  # before the join: a row a stage
        F.count(F.lit(1)).alias("tasks"), F.sum("failed").alias("failed_tasks"), F.min("began").alias("began"), F.max("ended").alias("ended"),
        *[F.sum(c).alias(c) for c in sums], F.max("shuffle_bytes_read").alias("largest_task_shuffle_read"))
    costs = per_stage.join(owner, "stage").groupBy("mark").agg(
        *[F.sum(c).alias(c) for c in ("tasks", "failed_tasks", *sums)], (F.max("ended") - F.min("began")).alias("wall_ms"), F.max("largest_task_shuffle_read").alias("largest_task_shuffle_read"))
    part = F.split("mark", r"\|")
    return costs.select(part[0].alias("pipeline_stage"), part[1].cast("date").alias("first_day"), part[2].cast("date").alias("last_day"), part[3].alias("run_id"),
                        *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in METRICS])


def over_limits(costs: DataFrame, limits: Mapping[str, Mapping[str, int]]) -> DataFrame:
    """(pipeline_stage, first_day, last_day, run_id, metric, value, most) of each limit that a run of a stage breaks."""
    unknown = {m for of in limits.values() for m in of} - set(METRICS)
    if unknown:
        raise ValueError(f"unknown metrics: {', '.join(sorted(unknown))}")
    rows = [(stage, metric, most) for stage, of in limits.items() for metric, most in of.items()]
    wanted = costs.sparkSession.createDataFrame(rows, "pipeline_stage string, metric string, most long")
    values = F.map_from_arrays(F.array(*[F.lit(m) for m in METRICS]), F.array(*[F.col(m) for m in METRICS]))
    long = costs.select("pipeline_stage", "first_day", "last_day", "run_id", F.explode(values).alias("metric", "value"))
    return long.join(wanted, ["pipeline_stage", "metric"]).where("value > most").select("pipeline_stage", "first_day", "last_day", "run_id", "metric", "value", "most")


def audit_limits(spark: SparkSession, root: str, costs: DataFrame, limits: Mapping[str, Mapping[str, int]]) -> int:
    """Append an audit row, of the run's last day, for each broken limit; how many there are."""
    broken = over_limits(costs, limits)
    message = F.concat(F.lit("run "), "run_id", F.lit(": "), "metric", F.lit(" "), F.col("value").cast("string"), F.lit(" > "), F.col("most").cast("string"))
    rows = broken.select(F.col("last_day").alias("batch_date"), "pipeline_stage", F.lit(LIMIT).alias("status"), F.col("value").alias("row_count"), message.alias("message"))
    held = spark.createDataFrame(rows.collect(), rows.schema)  # a row a limit and run at most
    n = held.count()
    if n:
        stamped = A.with_audit_ids(held).withColumn("audit_id", F.xxhash64("audit_id", "message")).withColumn("row_count", F.lit(None).cast("long"))
        stamped.coalesce(1).write.mode("append").parquet(A.audit_path(root))
    return n
