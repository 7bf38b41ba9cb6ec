"""Backfill ranges, headers, swaps, audits and reruns: what a range must share with its days."""

import datetime as dt
import random
import threading
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from ledgerline.contracts import BATCH_ENTITIES, FACTS, SOURCE_COLUMNS
from ledgerline.operators import audit as A
from ledgerline.operators import publish as P
from ledgerline.operators import reports as R
from ledgerline.operators import star as G
from ledgerline.operators.checks import QualityCheckError
from ledgerline.plans import medallion as M
from ledgerline.sources import csv_extract as X
from ledgerline.sources import files
from ledgerline.sources.layers import scan
from tests import fixtures as FX

D1, D2, D3 = "2024-03-01", "2024-03-02", "2024-03-03"


def _rows(spark, path):
    df = spark.read.parquet(path)
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=str)


def _write_repeating_day(raw, day, amount, repeated=False):
    """A day whose ids are those of every other day."""
    order = ["O1", "C1", f"{day} 10:00:00", "placed", "Yangon", "Yangon Region", "wave", "0.00", amount, amount, "MMK", "1", "1"]
    FX.write_day(raw, day, [order, order] if repeated else [order], [["I1", "O1", "P1", "S1", "1", "1", amount, amount, "0.00", amount]],
                 [["Y1", "O1", "C1", "wave", "captured", amount, f"{day} 10:05:00"]],
                 [["D1", "O1", "Ninja Van", "Yangon Region", "Yangon", day, day, "delivered", "0.00"]], [["N1", "P1", "S1", day, "0", "0", "out_of_stock", "10"]])


def test_range_equals_day_by_day_when_days_share_every_id(spark, workdir):
    raw = f"{workdir}/raw"
    FX.write_master(raw)
    _write_repeating_day(raw, D1, "100.00", repeated=True)
    _write_repeating_day(raw, D2, "7000.00")
    M.to_bronze(spark, raw, f"{workdir}/a", [D1, D2])
    whole = M.to_silver(spark, f"{workdir}/a", [D1, D2])
    M.to_gold(spark, f"{workdir}/a", [D1, D2])
    days = []
    for day in (D1, D2):
        M.to_bronze(spark, raw, f"{workdir}/b", day)
        days.append(M.to_silver(spark, f"{workdir}/b", day))
        M.to_gold(spark, f"{workdir}/b", day)
    for layer, tables in (("silver", BATCH_ENTITIES), ("gold", FACTS)):
        for table in tables:
            a, b = (_rows(spark, f"{workdir}/{run}/{layer}/{table}") for run in "ab")
            assert a == b and len(a) == 2, table
    assert len(whole) == 13
    for at, r in enumerate(whole):
        assert r.failed_rows == sum(day[at].failed_rows for day in days), r.check_name
    assert {r.check_name: r.failed_rows for r in whole if r.failed_rows} == {"orders_duplicates": 1}


@pytest.mark.parametrize("layout", ["reversed", "two orders"])
def test_columns_are_matched_by_header_name(spark, workdir, layout):
    raw = f"{workdir}/raw"
    FX.write_drop(raw)
    want = sorted(tuple(r) for r in X.read_batches(spark, raw, "orders", [D1, D2]).collect())
    for day, rows in ((D1, FX.day1_orders()), (D2, FX.day2_orders())):
        if layout == "reversed" or day == D2:
            names = SOURCE_COLUMNS["orders"]
            with open(f"{raw}/batches/batch_date={day}/orders.csv", "w") as fh:
                fh.write("﻿" + ",".join(f'"{n}"' for n in reversed(names)) + "\n")
                fh.writelines(",".join(reversed(r)) + "\n" for r in rows)
    assert sorted(tuple(r) for r in X.read_batches(spark, raw, "orders", [D1, D2]).collect()) == want


@pytest.mark.parametrize(("names", "fault"), [
    (("seller_id", "seller_name", "city", "region", "seller_type", "created_at"), "missing 'rating'"),
    (("seller_id", "seller_name", "city", "region", "seller_type", "rating", "created_at", "colour"), "unknown 'colour'"),
    (("seller_id", "seller_name", "city", "region", "seller_type", "rating", "created_at", "city"), "repeated 'city'"),
    ((), "missing 'seller_id'"),
])
def test_a_header_with_other_columns_raises(spark, workdir, names, fault):
    raw = f"{workdir}/raw"
    FX.write_master(raw)
    with open(f"{raw}/master/sellers.csv", "w") as fh:
        fh.write(",".join(names) + "\n")
    with pytest.raises(X.HeaderError, match=fault):
        X.read_master(spark, raw, "sellers")


def test_a_missing_bronze_column_raises(spark, workdir):
    raw, root = f"{workdir}/raw", f"{workdir}/lake"
    FX.write_drop(raw)
    M.to_bronze(spark, raw, root, D1)
    from ledgerline.operators.clean import clean_entity

    with pytest.raises(ValueError, match="bronze order_items: missing columns unit_price_mmk"):
        clean_entity(spark.read.parquet(f"{root}/bronze/order_items").drop("unit_price_mmk"), "order_items")


def _breaks_half_way(spark):
    return spark.range(0, 1000, numPartitions=8).select(F.col("id"), F.assert_true(F.col("id") < 900).cast("string").alias("v"))


def test_a_failed_snapshot_leaves_the_table_unchanged(spark, workdir):
    path = f"{workdir}/t"
    spark.range(10).withColumn("v", F.lit("x")).transform(lambda df: P.write_snapshot(df, path) and df)
    before = _rows(spark, path)
    with pytest.raises(Exception, match="ASSERT_TRUE|assert|is not true"):
        P.write_snapshot(_breaks_half_way(spark), path)
    assert _rows(spark, path) == before
    assert P.write_snapshot(P.read_snapshot(spark, path).where("id < 4"), path) == 4  # reads the table it replaces
    assert spark.read.parquet(path).count() == 4


def test_a_swap_that_stopped_half_way_is_undone(spark, workdir):
    path = f"{workdir}/t"
    P.write_snapshot(spark.range(3), path)
    files.rename(spark, path, files.previous_path(path))
    assert P.read_snapshot(spark, path).count() == 3
    assert P.read_snapshot(spark, f"{workdir}/none") is None


def test_a_failed_stage_keeps_masters_dimensions_and_dates(spark, workdir, monkeypatch):
    raw, root = f"{workdir}/raw", f"{workdir}/lake"
    FX.write_drop(raw)
    M.run_batch(spark, raw, root, D1)
    tables = [f"{root}/silver/customers", f"{root}/gold/dim_customer", f"{root}/gold/dim_date"]
    before = [_rows(spark, t) for t in tables]
    M.to_bronze(spark, raw, root, D2)
    real = P.write_snapshot

    def failing(df, path):
        if "/silver/" in path or "/gold/" in path:
            df = df.withColumn(df.columns[0], F.when(F.raise_error(F.lit("disk full")).isNull(), F.col(df.columns[0])))
        return real(df, path)

    monkeypatch.setattr(P, "write_snapshot", failing)
    for stage in (lambda: M.to_silver(spark, root, D2), lambda: M.to_gold(spark, root, D2)):
        with pytest.raises(Exception, match="disk full"):
            stage()
    assert [_rows(spark, t) for t in tables] == before
    assert not files.exists(spark, f"{root}/_staging/silver_orders")


def test_two_runs_at_once_publish_their_own_days(spark, workdir):
    raw, root = f"{workdir}/raw", f"{workdir}/lake"
    FX.write_master(raw)
    _write_repeating_day(raw, D1, "100.00")
    _write_repeating_day(raw, D2, "7000.00")
    M.to_bronze(spark, raw, root, [D1, D2])
    M.to_silver(spark, root, D1)  # the masters are there before the runs meet
    faults = []

    def run(day):
        try:
            df = M._read_days(spark, root, "bronze", "orders", M._days(day))
            from ledgerline.operators.clean import clean_entity

            P.write_batches(clean_entity(df, "orders"), f"{root}/silver/orders", [day])
        except Exception as exc:  # noqa: BLE001
            faults.append(exc)

    threads = [threading.Thread(target=run, args=(d,)) for d in (D1, D2)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert not faults
    stored = spark.read.parquet(f"{root}/silver/orders")
    assert sorted((str(r.batch_date), r.order_total_mmk) for r in stored.collect()) == [(D1, D("100.00")), (D2, D("7000.00"))]


def _audit(spark, root, stage, status=A.SUCCESS):
    rows = A.read_audit(spark, root).where((F.col("pipeline_stage") == stage) & (F.col("status") == status)).collect()
    return sorted((r.batch_date.isoformat(), r.row_count) for r in rows)


def test_a_range_is_audited_for_each_day(spark, workdir):
    raw, root = f"{workdir}/raw", f"{workdir}/lake"
    FX.write_drop(raw)
    _write_repeating_day(raw, D3, "5.00")
    M.run_range(spark, raw, root, D1, D3, target_root=f"{workdir}/wh")
    per_day = [(D1, 2), (D2, 1), (D3, 1)]
    assert _audit(spark, root, "bronze_orders") == [(D1, 3), (D2, 1), (D3, 1)]
    for stage in ("silver_transform", "gold_transform", "warehouse_load"):
        assert _audit(spark, root, stage) == per_day, stage


def test_an_empty_day_fails_the_gate_by_name(spark, workdir):
    raw, root = f"{workdir}/raw", f"{workdir}/lake"
    FX.write_drop(raw)
    FX.write_day(raw, D2, [], [])
    M.to_bronze(spark, raw, root, [D1, D2])
    M.to_silver(spark, root, [D1, D2])
    with pytest.raises(QualityCheckError, match=r"gold_fact_orders_non_empty\(0\) on 2024-03-02"):
        M.to_gold(spark, root, [D1, D2])
    assert _audit(spark, root, "gold_transform", A.FAILED) == [(D2, 0)]
    assert _audit(spark, root, "gold_transform") == [(D1, 2)]


def test_failed_checks_are_audited_for_each_day(spark, workdir):
    raw, root = f"{workdir}/raw", f"{workdir}/lake"
    FX.write_drop(raw)
    FX.write_csv(f"{raw}/master/customers.csv", "customers", FX.CUSTOMERS[:1])
    M.to_bronze(spark, raw, root, [D1, D2])
    with pytest.raises(QualityCheckError, match="orders_customer_reference"):
        M.to_silver(spark, root, [D1, D2])
    assert _audit(spark, root, "silver_transform", A.FAILED) == [(D1, None), (D2, None)]


def test_tables_without_any_rows_are_empty_tables(spark, workdir):
    raw, root = f"{workdir}/raw", f"{workdir}/lake"
    FX.write_drop(raw)
    FX.write_day(raw, D2, FX.day2_orders(), FX.day2_items())  # no payments, deliveries or stock
    M.run_batch(spark, raw, root, D2)
    assert scan(spark, root, "gold", "fact_payments").count() == 0
    assert M.report(spark, root, "report_delivery").count() == 0


def test_a_malformed_row_is_noted_on_its_day_alone(spark, workdir):
    raw, root = f"{workdir}/raw", f"{workdir}/lake"
    FX.write_drop(raw)
    FX.write_day(raw, D2, FX.day2_orders(), [*FX.day2_items(), ["I9", "O1"]])
    M.to_bronze(spark, raw, root, [D1, D2])
    notes = {r.batch_date: r.message for r in A.read_audit(spark, root).where("pipeline_stage = 'bronze_order_items'").collect()}
    assert notes == {dt.date.fromisoformat(D1): None, dt.date.fromisoformat(D2): "malformed_rows=1"}
    masters = A.read_audit(spark, root).where("pipeline_stage = 'bronze_customers'").collect()
    assert sorted(r.batch_date.isoformat() for r in masters) == [D1, D2] and len({r.row_count for r in masters}) == 1


def test_any_failure_is_audited_for_each_day(spark, workdir):
    raw, root = f"{workdir}/raw", f"{workdir}/lake"
    FX.write_drop(raw)
    missing = "2025-01-01"
    with pytest.raises(Exception):  # noqa: B017
        M.to_bronze(spark, raw, root, [D1, missing])
    rows = A.read_audit(spark, root).where("status = 'FAILED'").collect()
    assert {(r.batch_date.isoformat(), r.pipeline_stage) for r in rows} == {(D1, "bronze_orders"), (missing, "bronze_orders")} and all(r.message for r in rows)


def test_dates_of_a_list_of_days_are_those_days(spark, workdir):
    raw, root = f"{workdir}/raw", f"{workdir}/lake"
    FX.write_drop(raw)
    late = "2024-03-10"
    FX.write_day(raw, late, FX.day2_orders(), FX.day2_items())
    M.run_batch(spark, raw, root, [D1, late])
    assert sorted(r.calendar_date.isoformat() for r in scan(spark, root, "gold", "dim_date").collect()) == [D1, late]


def _money(*values):
    return [D(v) for v in values]


def test_report_rows_come_in_order(spark):
    orders = spark.createDataFrame(
        [(f"O{i}", k, d, m, D(v)) for i, (k, d, m, v) in enumerate([
            (1, dt.date(2024, 3, 2), "wave", "5.00"), (2, dt.date(2024, 3, 1), "cash", "9.00"), (None, None, "cash", "1.00"), (3, dt.date(2024, 3, 3), "wave", None or "7.00"),
            (3, dt.date(2024, 3, 3), "cash", "8.00")])],
        "order_id string, region_key long, order_date date, payment_method string, order_total_mmk decimal(18,2)")
    regions = spark.createDataFrame([(1, "B", "b"), (2, "A", "a"), (3, "C", "c")], "region_key long, region string, city string")
    assert [r.gmv_mmk for r in R.gmv_by_city(orders, regions).collect()] == _money("15.00", "9.00", "5.00", "1.00")
    mix = [(r.region, r.payment_method) for r in R.payment_mix(orders, regions).collect()]
    assert mix == [("A", "cash"), ("B", "wave"), ("C", "cash"), ("C", "wave"), (None, "cash")]
    dates = G.dim_date_between(spark, "2024-03-01", "2024-03-05")
    assert [str(r.order_date) for r in R.order_trends(orders, dates).collect()] == ["2024-03-01", "2024-03-02", "2024-03-03"]
    items = spark.createDataFrame([("P1", "x", "S1", 1, D("1.00")), ("P2", "x", "S2", 1, None), ("P3", "y", "S3", 2, D("3.00"))],
                                  "product_id string, category string, seller_id string, quantity int, net_line_amount_mmk decimal(18,2)")
    products = spark.createDataFrame([("P1", "one"), ("P2", "two"), ("P3", "three")], "product_id string, product_name string")
    assert [r.product_name for r in R.product_revenue(items, products).collect()] == ["two", "three", "one"]  # NULL first descending
    sellers = spark.createDataFrame([("S1", "s1", "A"), ("S2", "s2", "A"), ("S3", "s3", "A")], "seller_id string, seller_name string, region string")
    assert [r.seller_name for r in R.seller_revenue(items, sellers).collect()] == ["s2", "s3", "s1"]
    late = spark.createDataFrame([("A", 3), ("B", -1), ("C", None), ("B", 1)], "region string, delivery_delay_days int")
    assert [r.region for r in R.delivery_performance(late).collect()] == ["B", "A", "C"]  # NULL last ascending
    stock = spark.createDataFrame([("P1", dt.date(2024, 1, 1), 0, "out_of_stock"), ("P3", None, 0, "out_of_stock"), ("P2", dt.date(2024, 1, 1), 0, "out_of_stock"),
                                   ("P1", dt.date(2024, 2, 1), 5, "in_stock")], "product_id string, snapshot_date date, available_quantity int, inventory_status string")
    assert [r.product_name for r in R.out_of_stock(stock, products).collect()] == ["three", "one", "two"]


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_hot_city_is_dealt_to_many_tasks(spark, no_broadcast):
    n = 6000
    orders = spark.range(n).select(
        F.concat(F.lit("O"), "id").alias("order_id"), F.when(F.col("id") % 3 == 0, "Yangon").otherwise(F.concat(F.lit("c"), F.col("id") % 40)).alias("city"),
        F.lit("R").alias("region"), F.lit("2024-03-01 10:00:00").cast("timestamp_ntz").alias("order_timestamp"))
    regions = orders.select("region", "city").distinct().withColumn("region_key", F.xxhash64("city"))
    out = G.fact_orders(orders, regions)
    assert out.where(F.col("region_key") == F.xxhash64(F.lit("Yangon"))).count() == n // 3 and out.count() == n
    plan = out._jdf.queryExecution().sparkPlan().toString()
    assert "_salt" in plan and "SortMergeJoin" in plan


def test_a_hot_product_without_broadcast(spark, no_broadcast):
    rnd = random.Random(4)
    rows = [(f"I{i}", "P0" if i % 3 == 0 else rnd.choice(["P1", "P2", "P9", None])) for i in range(3000)]
    items = spark.createDataFrame(rows, "order_item_id string, product_id string")
    products = spark.createDataFrame([(f"P{k}", f"cat{k}", f"b{k}") for k in range(3)], "product_id string, category string, brand string")
    out = G.fact_order_items(items, products)
    assert "SortMergeJoin" in out._jdf.queryExecution().executedPlan().toString()
    made = {r.order_item_id: r.category for r in out.collect()}
    assert made == {i: f"cat{p[1]}" if p in ("P0", "P1", "P2") else None for i, p in rows}


def test_an_amount_beyond_its_type_is_null_in_the_stream_too(spark):
    from ledgerline.streaming.late_payments import payments_from_events

    events = spark.createDataFrame([(1, dt.datetime(2024, 3, 1), 7, "purchase", 1e30, ""), (2, dt.datetime(2024, 3, 1), 7, "purchase", 1.5, "")],
                                   "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string")
    assert [r.payment_amount_mmk for r in payments_from_events(events).orderBy("payment_id").collect()] == [None, D("1.50")]
