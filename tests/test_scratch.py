"""Parts of a query stored on the way: all rows whatever the slices, each input run once, no shuffle files left behind."""

import random
import time

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from ledgerline.contracts import SILVER, bronze_schema
from ledgerline.operators import clean as C
from ledgerline.operators.dedupe import keep_latest
from ledgerline.sources import scratch
from tests.conftest import SF_SMALL
from tests.test_plans import _plan


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def _shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(at).getName() for at in range(files.size()) if files.apply(at).getName().startswith("shuffle_")}


@pytest.mark.parametrize("columns", [["v"], ["w", "id"], ["id"], ["v", "w", "x"], []])
def test_survivor_of_some_columns_is_that_of_all(spark, columns):
    rnd = random.Random(3)
    draw = lambda: rnd.choice(["", "a", "b", "10", "9", None])
    df = spark.createDataFrame([tuple(draw() for _ in range(5)) for _ in range(300)], "v string, id string, ingested_at string, w string, x string")
    whole, some = keep_latest(df, ["id"], copies="n"), keep_latest(df, ["id"], copies="n", columns=columns)
    assert some.columns == [c for c in df.columns if c in columns] + ["n"]
    assert _rows(some) == _rows(whole.select(some.columns))
    assert _rows(keep_latest(df, ["id"], columns=columns)) == _rows(keep_latest(df, ["id"]).select(some.columns[:-1]))


def test_columns_ordered_after_the_wanted_ones_are_not_shuffled(spark):
    df = spark.range(10).selectExpr("id % 3 AS k", "cast(id as string) AS early", "repeat('x', 9) AS wanted", "uuid() AS late")
    plan = _plan(keep_latest(df, ["k"], columns=["wanted"]))
    assert "early" in plan and "late" not in plan


@pytest.mark.parametrize("entity", sorted(C.SPECS))
def test_silver_of_some_columns_equals_all_of_it(spark, entity):
    rnd, fields = random.Random(5), bronze_schema(entity).fields
    some_text = ["1", "2.50", "bad", "yangon east", "2024-03-01", "2024-03-01 10:00:00", "TRUE", None]
    rows = [tuple(rnd.choice(some_text if f.dataType.simpleString() == "string" else [None]) for f in fields) for _ in range(80)]
    raw, names = spark.createDataFrame(rows, bronze_schema(entity)), SILVER[entity].fieldNames()
    whole = C.clean_entity(raw, entity, copies="n")
    for columns in (names[:1], names[1::2], names[-3:], list(reversed(names))):
        some = C.clean_entity(raw, entity, copies="n", columns=columns)
        assert some.columns == [c for c in names if c in columns] + ["n"]
        assert _rows(some) == _rows(whole.select(some.columns))


def test_slices_hold_all_rows_and_leave_no_shuffle_files(spark, monkeypatch, workdir):
    spark.range(5000).selectExpr("if(id % 7 = 0, null, id % 900) AS k", "id AS v").write.parquet(f"{workdir}/t")
    df = spark.read.parquet(f"{workdir}/t").groupBy("k").agg(F.max("v").alias("v"), F.count(F.lit(1)).alias("n"))
    monkeypatch.setattr(scratch, "SLICE_BYTES", 1)
    cleanup, before = spark.conf.get(scratch.SHUFFLE_CLEANUP), _shuffle_files(spark)
    made = scratch.stored(df, "t", ["k"], ["n", "v"])
    assert spark.conf.get(scratch.SHUFFLE_CLEANUP) == cleanup
    left = _shuffle_files(spark) - before
    for _ in range(50):  # they go in the background
        if not left:
            break
        time.sleep(0.2)
        left = _shuffle_files(spark) - before
    assert not left
    assert made.columns == ["n", "v"] and _rows(made) == _rows(df.select("n", "v")) and made.count() == 901


def test_without_a_shared_folder_nothing_is_stored(spark, monkeypatch):
    df = spark.range(3)
    monkeypatch.setattr(type(spark.conf), "get", lambda self, key, *default: None)
    monkeypatch.setattr(type(spark.sparkContext), "getCheckpointDir", lambda self: None)
    plan = _plan(scratch.stored(df, "t", ["id"]))
    assert "Range" in plan and "parquet" not in plan


@pytest.mark.parametrize("key", ["scd2_products", "scd2_sellers", "quality_report"])
def test_lines_are_read_and_deduplicated_once_for_a_table(spark, monkeypatch, key):
    from pyspark.sql import DataFrameWriter

    written, write = [], DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, path, **options: (written.append(_plan(self._df)), write(self, path, **options))[1])
    plan = _plan(entry.queries()[key](spark, SF_SMALL))
    assert "lineitem.parquet" not in plan
    lines = [p for p in written if "lineitem.parquet" in p]
    assert len(lines) == (2 if key == "quality_report" else 1)  # order items, deliveries
    assert all(p.count("lineitem.parquet") == 1 for p in lines)
    if key != "quality_report":
        assert "l_extendedprice" not in lines[0]


@pytest.mark.parametrize("key", ["scd2_products", "scd2_sellers", "quality_report"])
def test_slices_of_a_hot_id_and_repeated_rows_match_duckdb(spark, workdir, monkeypatch, key):
    from ledgerline.sources import driver_tables as D
    from oracle.compare import compare, connect

    for name in ("region", "nation", "customer", "supplier", "part", "events"):
        D.read_table(spark, SF_SMALL, name).write.parquet(f"{workdir}/{name}.parquet")
    # days around SCAN_DAY, order 7 twice; a third of the lines are line 1 of order 5
    spark.sql(
        "select if(id = 40, 7, id) as o_orderkey, id % 9 as o_custkey, 'F' as o_orderstatus, 10.5D * id as o_totalprice, "
        "timestamp_ntz'1996-09-15' + make_dt_interval(cast(id % 5 as int)) as o_orderdate, '5-LOW' as o_orderpriority from range(41)"
    ).write.parquet(f"{workdir}/orders.parquet")
    spark.sql(
        "select if(id % 3 = 0, 5, id % 40) as l_orderkey, id % 20 as l_partkey, id % 7 as l_suppkey, cast(if(id % 3 = 0, 1, id % 4) as int) as l_linenumber, "
        "cast(id % 50 as double) as l_quantity, 100.25D * (id % 30) as l_extendedprice, 0.05D as l_discount, 0.01D as l_tax, substr('ANR', cast(id % 3 as int) + 1, 1) as l_returnflag, "
        "if(id % 2 = 0, 'F', 'O') as l_linestatus, timestamp_ntz'1996-10-01' + make_dt_interval(cast(id % 40 as int)) as l_shipdate from range(3000)"
    ).repartition(4).write.parquet(f"{workdir}/lineitem.parquet")
    monkeypatch.setattr(scratch, "SLICE_BYTES", 1)
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4k")  # many small tasks
    try:
        out = compare(spark, connect(workdir), workdir, key, entry.queries()[key], entry.oracle_sql()[key])
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "128m")
    assert out.ok and out.rows > 0, out.detail
