"""Heavy keys are found and split."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import skew


@pytest.fixture
def no_broadcast(spark):
    keep = {k: spark.conf.get(k, None) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.adaptive.skewJoin.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    yield
    for key, value in keep.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def rows_and_keys(spark, n, seed=1):
    rnd = random.Random(seed)
    rows = [(i, "hot" if i % 3 == 0 else None if i % 3 == 1 else rnd.choice(["a", "b", f"k{rnd.randint(0, 400)}"])) for i in range(n)]
    keys = [("hot", 1), ("a", 2), *[(f"k{k}", k) for k in range(0, 400, 2)]]
    return rows, spark.createDataFrame(rows, "id long, key string").repartition(4), keys, spark.createDataFrame(keys, "key string, v int")


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("share", [0.5, 0.02, 0.001])
def test_equals_a_plain_join(spark, no_broadcast, how, share):
    rows, left, keys, right = rows_and_keys(spark, 3000)
    made = skew.join_one(left, right, ["key"], ["id"], how, share=share)
    known = dict(keys)
    want = Counter((k, i, known.get(k)) for i, k in rows if how == "left" or k in known)
    assert Counter(tuple(r) for r in made.collect()) == want and made.columns == ["key", "id", "v"]


def test_no_task_gets_more_than_its_share(spark, no_broadcast):
    """A third of the rows by one key, a third without a key, broadcast, splitting by Spark and coalescing off."""
    n = 30_000
    _, left, _, right = rows_and_keys(spark, n)
    largest = lambda df: max(r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect())
    plain = largest(left.join(right, "key", "left"))
    split = largest(skew.join_one(left, right, ["key"], ["id"], share=0.01))
    assert plain > n / 3 and split < 3 * n / 32


def test_heavy_keys_are_few_and_have_their_ways(spark):
    _, left, _, _ = rows_and_keys(spark, 3000)
    heavy = {r.key: r[skew.WAYS] for r in skew.heavy_keys(left, ["key"], 0.02).collect()}
    counts = Counter(r.key for r in left.collect())
    assert heavy == {k: -(-c // 60) for k, c in counts.items() if k is not None and c >= 60}
    assert len(heavy) <= 50 and sum(heavy.values()) <= 100


def test_two_keys_and_a_cheaper_table_to_count(spark, no_broadcast):
    left = spark.createDataFrame([(i, "r", "c" if i % 2 else f"c{i}") for i in range(500)] + [(9000, "r", None), (9001, None, "c")], "id long, region string, city string")
    right = spark.createDataFrame([("r", "c", 1), ("r", "c4", 2), (None, "c", 3)], "region string, city string, v int")
    made = skew.join_one(left, right, ["region", "city"], ["id"], counted=left.sample(0.5, 1), share=0.05)
    got = {r.id: r.v for r in made.collect()}
    assert len(got) == 502 and got[1] == 1 and got[4] == 2 and got[9000] is None and got[9001] is None and made.count() == 502


def test_a_small_right_side_is_left_to_the_planner(spark):
    _, left, _, unknown = rows_and_keys(spark, 100)
    right = spark.range(400).select(F.concat(F.lit("k"), "id").alias("key"), F.col("id").alias("v"))
    assert skew.broadcastable(right) and not skew.broadcastable(unknown)  # rows of the driver have no estimate
    for other in (right, unknown):
        plan = skew.join_one(left, other, ["key"], ["id"])._jdf.queryExecution().sparkPlan().toString()
        assert "BroadcastHashJoin" in plan and skew.SALT not in plan
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(150 * skew.ROW_BYTES))  # it has 202 rows
    try:
        assert not skew.few_rows(unknown) and skew.SALT in skew.join_one(left, unknown, ["key"], ["id"])._jdf.queryExecution().sparkPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    plan = skew.join_one(left, right, ["key"], ["id"])._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" in plan and skew.SALT not in plan


def test_empty_sides(spark, no_broadcast):
    _, left, _, right = rows_and_keys(spark, 30)
    none = left.limit(0)
    assert skew.join_one(none, right, ["key"], ["id"]).count() == 0
    assert skew.join_one(left, right.limit(0), ["key"], ["id"]).count() == 30
