"""End to end: CSV → bronze → silver → gold → published copy, in a scratch folder."""

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import audit as A
from ledgerline.operators.checks import QualityCheckError
from ledgerline.plans import medallion as M
from tests import fixtures as FX

D1, D2 = "2024-03-01", "2024-03-02"


def _rows(spark, path, order=None):
    df = spark.read.parquet(path)
    cols = sorted(df.columns)
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_one_day_end_to_end(spark, workdir):
    raw, root, target = f"{workdir}/raw", f"{workdir}/lake", f"{workdir}/wh"
    FX.write_drop(raw)
    M.run_batch(spark, raw, root, D1, target_root=target)

    orders = spark.read.parquet(f"{root}/silver/orders")
    assert orders.count() == 2  # the exact duplicate of O2 is gone
    o2 = orders.where("order_id = 'O2'").first()
    assert o2.order_status == "placed" and o2.payment_method == "cash_on_delivery"
    assert orders.schema["shipping_fee_mmk"].dataType.simpleString() == "decimal(18,2)"

    customers = spark.read.parquet(f"{root}/silver/customers")
    c1 = customers.where("customer_id = 'C1'").first()
    assert c1.customer_name == "Aung Kyaw" and c1.city == "Yangon" and c1.region == "Yangon Region"
    assert c1.phone_number == "0912345678"  # text all the way: the leading zero survives
    c3 = customers.where("customer_id = 'C3'").first()
    # same key, different values: the survivor is the greatest tuple (deterministic)
    assert c3.customer_name == "Mg Mg Old" and c3.created_at == dt.datetime(2023, 1, 1)

    sellers = spark.read.parquet(f"{root}/silver/sellers")
    assert sellers.where("seller_id = 'S2'").first().rating is None  # 'x' → NULL, no ANSI error

    fact = spark.read.parquet(f"{root}/gold/fact_orders")
    assert fact.count() == 2 and fact.where(F.col("region_key").isNull()).count() == 0
    regions = spark.read.parquet(f"{root}/gold/dim_region")
    # sellers arrive as YANGON / yangon region: normalised to the customers' spelling
    assert regions.where("city = 'Yangon'").count() == 1
    dd = spark.read.parquet(f"{root}/gold/dim_date").collect()
    assert [(r.date_key, r.month_name, r.week_of_year) for r in dd] == [(20240301, "March", 9)]
    delivery = spark.read.parquet(f"{root}/gold/fact_delivery_performance")
    assert sorted(r.delivery_delay_days for r in delivery.collect()) == [-2, 1]

    assert sorted(map(tuple, M.published(spark, target, "fact_orders").select(*sorted(fact.columns)).collect())) == _rows(spark, f"{root}/gold/fact_orders")
    audit = A.read_audit(spark, root)
    stages = {r.pipeline_stage for r in audit.collect()}
    assert {"bronze_orders", "silver_transform", "gold_transform", "warehouse_load"} <= stages
    assert audit.where("pipeline_stage = 'bronze_orders'").first().row_count == 3
    metrics = {r.pipeline_stage: (r.runs, r.failures) for r in A.stage_metrics(audit).collect()}
    assert metrics["silver_transform"] == (1, 0) and metrics["gold_transform"] == (1, 0)

    gmv = M.report(spark, root, "report_gmv_by_city").collect()
    assert sorted((r.city, r.gmv_mmk, r.total_orders) for r in gmv) == [
        ("Mandalay", D("3000.50"), 1), ("Yangon", D("32000.00"), 1)]
    top = M.report(spark, root, "report_top_customers", days=D1).collect()
    assert [r.customer_name for r in top] == ["Aung Kyaw", "Su Su"]


def test_malformed_csv_rows_are_kept_and_counted(spark, workdir):
    raw, root = f"{workdir}/raw", f"{workdir}/lake"
    FX.write_drop(raw)
    with open(f"{raw}/batches/batch_date={D1}/payments.csv", "a") as fh:
        fh.write("Y3,O1,C1,kbzpay,captured,1.00,2024-03-01 12:00:00,EXTRA,FIELDS\n")
    M.to_bronze(spark, raw, root, D1)
    pays = spark.read.parquet(f"{root}/bronze/payments")
    assert pays.count() == 3  # PERMISSIVE: the row is kept, its fields as far as they go
    note = A.read_audit(spark, root).where("pipeline_stage = 'bronze_payments'").first().message
    assert note == "malformed_rows=1"


def test_rerun_is_idempotent_and_days_are_independent(spark, workdir):
    raw, root = f"{workdir}/raw", f"{workdir}/lake"
    FX.write_drop(raw)
    M.run_batch(spark, raw, root, D1)
    first = _rows(spark, f"{root}/gold/fact_order_items")
    M.run_batch(spark, raw, root, D1)
    assert _rows(spark, f"{root}/gold/fact_order_items") == first  # no doubling (append would)
    M.run_batch(spark, raw, root, D2)
    items = spark.read.parquet(f"{root}/gold/fact_order_items")
    assert items.where(F.col("batch_date") == F.lit(dt.date(2024, 3, 1))).count() == 2
    assert items.where(F.col("batch_date") == F.lit(dt.date(2024, 3, 2))).count() == 1
    dates = sorted(r.date_key for r in spark.read.parquet(f"{root}/gold/dim_date").collect())
    assert dates == [20240301, 20240302]


def test_empty_rerun_clears_its_day(spark, workdir):
    raw, root = f"{workdir}/raw", f"{workdir}/lake"
    FX.write_drop(raw)
    M.run_batch(spark, raw, root, [D1, D2])
    # the source for day 2 is re-delivered with no payments
    FX.write_day(raw, D2, FX.day2_orders(), FX.day2_items(), payments=[])
    M.to_bronze(spark, raw, root, D2)
    FX.write_day(raw, D2, FX.day2_orders(), FX.day2_items(), payments=[("Y9", "O3", "C1", "wave", "captured", "1.00", "2024-03-02 09:00:00")])
    M.run_batch(spark, raw, root, D2)
    pays = spark.read.parquet(f"{root}/silver/payments")
    assert pays.where(F.col("batch_date") == F.lit(dt.date(2024, 3, 2))).count() == 1
    FX.write_day(raw, D2, FX.day2_orders(), FX.day2_items(), payments=[])
    M.run_batch(spark, raw, root, D2)
    pays = spark.read.parquet(f"{root}/silver/payments")
    assert pays.where(F.col("batch_date") == F.lit(dt.date(2024, 3, 2))).count() == 0
    assert pays.where(F.col("batch_date") == F.lit(dt.date(2024, 3, 1))).count() == 2


def test_backfill_range_equals_day_by_day(spark, workdir):
    raw = f"{workdir}/raw"
    FX.write_drop(raw)
    M.run_range(spark, raw, f"{workdir}/a", D1, D2)
    M.run_batch(spark, raw, f"{workdir}/b", D1)
    M.run_batch(spark, raw, f"{workdir}/b", D2)
    for table in ("fact_orders", "fact_order_items", "fact_payments", "dim_date", "dim_region"):
        assert _rows(spark, f"{workdir}/a/gold/{table}") == _rows(spark, f"{workdir}/b/gold/{table}"), table


def test_bad_batch_changes_nothing_and_is_audited(spark, workdir):
    raw, root = f"{workdir}/raw", f"{workdir}/lake"
    FX.write_drop(raw)
    M.run_batch(spark, raw, root, D1)
    before = _rows(spark, f"{root}/silver/customers")
    bad_orders = [["O9", "C404", "2024-03-02 09:00:00", "placed", "Yangon", "Yangon Region", "wave", "0.00", "10.00", "10.00", "MMK", "1", "1"]]
    FX.write_day(raw, D2, bad_orders, [["I9", "O9", "P1", "S1", "1", "1", "10.00", "10.00", "0.00", "10.00"]])
    FX.write_csv(f"{raw}/master/customers.csv", "customers", FX.CUSTOMERS[:2])
    M.to_bronze(spark, raw, root, D2)
    with pytest.raises(QualityCheckError, match="orders_customer_reference"):
        M.to_silver(spark, root, D2)
    assert _rows(spark, f"{root}/silver/customers") == before  # master tables untouched
    orders = spark.read.parquet(f"{root}/silver/orders")
    assert orders.where(F.col("batch_date") == F.lit(dt.date(2024, 3, 2))).count() == 0
    failed = A.read_audit(spark, root).where("status = 'FAILED'").collect()
    assert len(failed) == 1 and "orders_customer_reference(1)" in failed[0].message


def test_reconciliation_tolerance_is_strict(spark, workdir):
    raw, root = f"{workdir}/raw", f"{workdir}/lake"
    FX.write_master(raw)
    orders = [
        ["O1", "C1", "2024-03-01 10:00:00", "placed", "Yangon", "Yangon Region", "wave", "0.00", "101.00", "101.00", "MMK", "1", "1"],
        ["O2", "C1", "2024-03-01 10:00:00", "placed", "Yangon", "Yangon Region", "wave", "0.00", "101.01", "101.01", "MMK", "1", "1"],
    ]
    items = [
        ["I1", "O1", "P1", "S1", "1", "1", "100.00", "100.00", "0.00", "100.00"],
        ["I2", "O2", "P1", "S1", "1", "1", "100.00", "100.00", "0.00", "100.00"],
    ]
    FX.write_day(raw, D1, orders, items)
    M.to_bronze(spark, raw, root, D1)
    with pytest.raises(QualityCheckError, match=r"order_subtotal_reconciliation\(1\)"):
        M.to_silver(spark, root, D1)


def test_duplicate_check_runs_before_dedupe_and_does_not_block(spark, workdir):
    raw, root = f"{workdir}/raw", f"{workdir}/lake"
    FX.write_drop(raw)  # day 1 delivers order O2 twice
    M.to_bronze(spark, raw, root, D1)
    results = {r.check_name: r for r in M.to_silver(spark, root, D1)}
    assert results["orders_duplicates"].failed_rows == 1 and not results["orders_duplicates"].passed
    assert spark.read.parquet(f"{root}/silver/orders").count() == 2  # published all the same, deduplicated
