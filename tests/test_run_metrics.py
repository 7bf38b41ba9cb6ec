"""Durations and bytes per pipeline stage from Spark's event log; a broken limit is an audit row."""

import os
import subprocess
import sys

import pytest

from ledgerline.operators import audit as A
from ledgerline.operators import run_metrics as R
from tests import fixtures as FX

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
RUN = """
import sys
from pyspark.sql import SparkSession
from ledgerline.plans import medallion as M
from ledgerline.session import recommended_conf
raw, root, log = sys.argv[1:]
conf = recommended_conf() | {"spark.master": "local[2]", "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "2", "spark.eventLog.enabled": "true",
                             "spark.eventLog.dir": "file://" + log, "spark.eventLog.compress": "false"}
spark = SparkSession.builder.config(map=conf).getOrCreate()
spark.range(10).repartition(3).count()  # no stage of the pipeline
for days in ("2024-03-01", ["2024-03-01", "2024-03-02"]):
    M.to_bronze(spark, raw, root, days)
M.to_silver(spark, root, "2024-03-01")
spark.stop()
"""


@pytest.fixture(scope="module")
def logged(tmp_path_factory):
    base = str(tmp_path_factory.mktemp("metrics"))
    os.mkdir(f"{base}/log")
    FX.write_drop(f"{base}/raw")
    done = subprocess.run([sys.executable, "-c", RUN, f"{base}/raw", f"{base}/lake", f"{base}/log"], cwd=ROOT, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    return base


def test_costs_per_stage_and_run(spark, logged):
    rows = R.stage_costs(spark, f"{logged}/log").collect()
    stages = {r.pipeline_stage for r in rows}
    assert {"bronze_customers", "bronze_orders", "bronze_payments", "silver_transform"} <= stages and all(s.startswith(("bronze_", "silver_")) for s in stages)
    orders = sorted((r for r in rows if r.pipeline_stage == "bronze_orders"), key=lambda r: r.last_day)
    assert [(str(r.first_day), str(r.last_day)) for r in orders] == [("2024-03-01", "2024-03-01"), ("2024-03-01", "2024-03-02")]
    assert all(r.tasks > 0 and r.failed_tasks == 0 and r.wall_ms > 0 and r.task_ms > 0 and r.bytes_written > 0 for r in rows)
    assert all(r.bytes_read > 0 and r.rows_written >= 3 for r in orders) and len({r.run_id for r in orders}) == 2
    silver = next(r for r in rows if r.pipeline_stage == "silver_transform")
    assert silver.shuffle_bytes_written > 0 and 0 < silver.largest_task_shuffle_read <= silver.shuffle_bytes_read and silver.bytes_spilled == 0


def test_a_broken_limit_is_an_audit_row(spark, logged):
    costs = R.stage_costs(spark, f"{logged}/log")
    limits = {"silver_transform": {"bytes_spilled": 0, "shuffle_bytes_written": 1, "wall_ms": 10**9}, "bronze_orders": {"tasks": 0}, "gold_transform": {"tasks": 0}}
    broken = {(r.pipeline_stage, r.metric) for r in R.over_limits(costs, limits).collect()}
    assert broken == {("silver_transform", "shuffle_bytes_written"), ("bronze_orders", "tasks")}
    assert R.audit_limits(spark, f"{logged}/lake", costs, limits) == 3
    rows = A.read_audit(spark, f"{logged}/lake").where(f"status = '{R.LIMIT}'").collect()
    assert len({r.audit_id for r in rows}) == 3 and sum(r.pipeline_stage == "bronze_orders" for r in rows) == 2
    spill = next(r for r in rows if r.pipeline_stage == "silver_transform")
    assert " shuffle_bytes_written " in spill.message and spill.message.endswith(" > 1") and str(spill.batch_date) == "2024-03-01"
    assert R.audit_limits(spark, f"{logged}/lake", costs, {"silver_transform": {"bytes_spilled": 0}}) == 0
    with pytest.raises(ValueError, match="unknown metrics: heat"):
        R.over_limits(costs, {"silver_transform": {"heat": 1}})
