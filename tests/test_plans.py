"""Physical-plan properties: no Python in any plan, pruning reaches the scans."""

import datetime as dt

import pytest

import __spark_entry__ as entry
from ledgerline.plans import registry
from ledgerline.sources.layers import filter_batch
from tests.conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", sorted(registry.QUERIES))
def test_no_python_in_plans(spark, key):
    plan = _plan(entry.queries()[key](spark, SF_SMALL))
    for marker in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "FlatMapGroupsInPandas", "MapInPandas"):
        assert marker not in plan, f"{key}: {marker}"


def test_reference_check_reads_one_column(spark):
    plan = entry.queries()["check_references"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_suppkey:bigint>" in plan
    assert "GreaterThanOrEqual(s_acctbal,0.0)" in plan and "ReadSchema: struct<s_suppkey:bigint,s_acctbal:double>" in plan


def test_batch_filter_prunes_partitions(spark, workdir):
    df = spark.range(10).selectExpr("id", "date_add(DATE'2024-01-01', cast(id % 3 as int)) AS batch_date")
    df.write.partitionBy("batch_date").parquet(f"{workdir}/t")
    scanned = filter_batch(spark.read.parquet(f"{workdir}/t"), dt.date(2024, 1, 2))
    plan = _plan(scanned)
    assert "PartitionFilters: [isnotnull(batch_date" in plan and "(batch_date" in plan
    assert scanned.count() == 3


def test_reports_aggregate_before_dimension_join(spark):
    plan = _plan(entry.queries()["report_top_customers"](spark, SF_SMALL))
    assert "TakeOrderedAndProject" in plan
    # partial aggregate per customer below the join, then a partial aggregate per (name, city)
    assert plan.count("partial_sum") >= 2


def test_orders_meet_regions_and_reports_without_a_shuffle_on_few_keys(spark):
    """No plan deals the unaggregated fact by (region, city) or by region_key alone."""
    import re

    for key in ("fact_orders", "report_gmv_by_city", "report_payment_mix"):
        df = entry.queries()[key](spark, SF_SMALL)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            plan = df._jdf.queryExecution().sparkPlan().toString() + _plan(entry.queries()[key](spark, SF_SMALL))
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for line in plan.split("\n"):
            if m := re.search(r"Exchange hashpartitioning\(([^)]*)\)", line):
                keys = re.sub(r"#\d+L?", "", m[1]).split(", ")[:-1]
                below = plan.split(line)[1].split("\n")[1]
                aggregated = "Aggregate" in below
                assert keys not in (["region", "city"], ["region_key"]) or aggregated, (key, line, below)


def test_quality_report_reads_each_entity_once(spark):
    plan = _plan(entry.queries()["quality_report"](spark, SF_SMALL))
    survivors = [x for x in plan.split("\n") if "SortAggregate" in x and "functions=[max(struct" in x or "ObjectHashAggregate" in x and "functions=[max(struct" in x]
    assert 0 < len(survivors) <= 6, survivors  # one dedupe per entity
    assert "BroadcastNestedLoop" not in plan and "Cartesian" not in plan


def test_event_filters_and_pruning_reach_the_scan(spark):
    plan = _plan(entry.queries()["fact_payments"](spark, SF_SMALL))
    assert "PushedFilters: [In(event_type, [error,purchase])]" in plan
    assert "props" not in plan.split("events.parquet")[1].split("\n")[0]  # unused column not read


def test_declared_fixture_schemas_match_the_files(spark):
    from ledgerline.sources import driver_tables as D

    for name, ddl in D.SCHEMAS.items():
        inferred = spark.read.parquet(f"{SF_SMALL}/{name}.parquet").schema
        assert D.read_table(spark, SF_SMALL, name).schema == inferred, name


def test_allow_list_broadcast_only_below_its_bound(spark, monkeypatch):
    from ledgerline.operators import checks as Q

    df = spark.createDataFrame([("A", "X"), ("B", "Y"), ("C", None)], "city string, region string")
    pairs = [("A", "X")]
    small = Q.allowed_pairs(df, "city", "region", pairs, "p")
    assert small.collect()[0].failed_rows == 2
    monkeypatch.setattr(Q, "BROADCAST_PAIRS_MAX", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = Q.allowed_pairs(df, "city", "region", pairs, "p")
        plan = large._jdf.queryExecution().sparkPlan().toString()
        assert "BroadcastHashJoin" not in plan
        assert large.collect()[0].failed_rows == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_reports_that_read_no_region_key_have_no_lookup(spark):
    """Neither sellers nor a distinct of places under B4 and B7, and B4 joins one row a day."""
    for key in ("report_order_trends", "report_top_customers"):
        plan = entry.queries()[key](spark, SF_SMALL)._jdf.queryExecution().sparkPlan().toString()
        assert "s_suppkey" not in plan and "s_nationkey" not in plan and "region_key" not in plan and "Union" not in plan, key
    plan = entry.queries()["report_order_trends"](spark, SF_SMALL)._jdf.queryExecution().sparkPlan().toString()
    assert plan.index("count(distinct") > plan.index("Join")  # below the join


@pytest.mark.parametrize("key, row_id", [("clean_deliveries", "delivery_id"), ("clean_order_items", "order_item_id")])
def test_lines_are_dealt_by_their_text_between_join_and_dedupe(spark, key, row_id):
    """The join's tasks don't sort the text too, and the dedupe keeps its partial aggregate and an exchange of its own."""
    import re

    plan = re.sub(r"#\d+L?", "", _plan(entry.queries()[key](spark, SF_SMALL)))
    own, dealt, join = (
        plan.index(x) for x in (f"Exchange hashpartitioning({row_id}, batch_date", f"Exchange hashpartitioning(order_id, {row_id}", "SortMergeJoin [l_orderkey]")
    )
    assert own < plan.index("partial_max(struct") < dealt < join
    assert "REBALANCE_PARTITIONS_BY_COL" in plan[dealt:].split("\n")[0]


@pytest.mark.parametrize("key", ["clean_deliveries", "clean_order_items", "report_delivery"])
def test_lines_with_a_hot_id_null_keys_and_repeated_orders_match_duckdb(spark, workdir, key):
    from ledgerline.sources import driver_tables as D
    from oracle.compare import compare, connect

    for name in ("region", "nation", "customer", "part"):
        D.read_table(spark, SF_SMALL, name).write.parquet(f"{workdir}/{name}.parquet")
    # order 7 twice, one null order; a third of the lines are line 1 of order 5
    spark.sql(
        "select if(id = 41, null, if(id = 40, 7, id)) as o_orderkey, id % 9 as o_custkey, 'F' as o_orderstatus, 10.5D as o_totalprice, "
        "timestamp_ntz'1996-01-01' + make_dt_interval(cast(id % 5 as int)) as o_orderdate, '5-LOW' as o_orderpriority from range(42)"
    ).write.parquet(f"{workdir}/orders.parquet")
    spark.sql(
        "select case when id % 3 = 0 then 5 when id % 50 = 1 then null else id % 60 end as l_orderkey, id % 20 as l_partkey, id % 4 as l_suppkey, "
        "cast(case when id % 3 = 0 then 1 when id % 70 = 2 then null else id % 4 end as int) as l_linenumber, cast(id % 50 as double) as l_quantity, "
        "100.25D * (id % 30) as l_extendedprice, 0.05D as l_discount, 0.01D as l_tax, if(id % 11 = 0, null, substr('ANR', cast(id % 3 as int) + 1, 1)) as l_returnflag, "
        "if(id % 2 = 0, 'F', 'O') as l_linestatus, timestamp_ntz'1996-02-01' + make_dt_interval(cast(id % 40 as int)) as l_shipdate from range(3000)"
    ).repartition(4).write.parquet(f"{workdir}/lineitem.parquet")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4k")  # many small tasks
    try:
        out = compare(spark, connect(workdir), workdir, key, entry.queries()[key], entry.oracle_sql()[key])
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "128m")
    assert out.ok and out.rows > 0, out.detail
