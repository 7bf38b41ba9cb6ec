"""Upsert into a stored dimension: only the buckets that incoming keys hit are read and rewritten."""

import os
import random
import re

import pytest
from pyspark.sql import functions as F

from ledgerline.contracts import schema
from ledgerline.operators import buckets as B
from ledgerline.operators.publish import upsert

CONTRACT = schema("k string, v string, n int")


def frame(spark, rows, columns="k string, v string, n int"):
    return spark.createDataFrame(rows, columns)


def listing(path):
    return {b: sorted(f for f in os.listdir(f"{path}/{b}") if f.endswith(".parquet")) for b in os.listdir(path) if b.startswith("bucket=")}


def stored(spark, path):
    return sorted(map(tuple, B.read(spark, path, CONTRACT).collect()), key=repr)


def test_random_updates_equal_the_full_merge(spark, workdir):
    rnd, path, model = random.Random(1), f"{workdir}/dim", frame(spark, [])
    for step in range(4):
        rows = [(f"k{i}", rnd.choice(["a", "b", None]), rnd.choice([1, 2, None])) for i in rnd.sample(range(60), 15 if step else 40)] + ([(None, "null key", step)] if step % 2 else [])
        made = B.upsert_stored(frame(spark, rows), path, CONTRACT, ["k"], buckets=16)
        before = model.count()
        model = spark.createDataFrame(upsert(model, frame(spark, rows), ["k"]).collect(), CONTRACT)
        assert stored(spark, path) == sorted(map(tuple, model.collect()), key=repr)
        assert made["keys"] == len(rows) and made["new"] == model.count() - before


def test_untouched_buckets_are_neither_read_nor_written(spark, workdir, monkeypatch):
    path = f"{workdir}/dim"
    B.upsert_stored(frame(spark, [(f"k{i}", "a", 1) for i in range(400)]), path, CONTRACT, ["k"], buckets=32)
    before = listing(path)
    assert len(before) == 32
    seen = []
    monkeypatch.setattr(B, "upsert", lambda held, came, keys: seen.append(held._jdf.queryExecution().executedPlan().toString()) or upsert(held, came, keys))
    made = B.upsert_stored(frame(spark, [("k7", "b", None), ("new", "c", 3)]), path, CONTRACT, ["k"], buckets=32)
    after = listing(path)
    changed = {b for b in after if after[b] != before.get(b)}
    assert made["buckets"] == len(changed) <= 2 and made["new"] == 1
    numbers = {b.removeprefix("bucket=") for b in changed}
    pruned = re.search(r"PartitionFilters: \[bucket#\d+ IN \(([\d,]+)\)\]", seen[0])
    assert set(pruned[1].split(",")) == numbers
    plan = B.read(spark, path, CONTRACT, keep_bucket=True).where(F.col(B.BUCKET).isin(3))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan
    rows = {r[0]: r for r in stored(spark, path)}
    assert rows["k7"] == ("k7", "b", 1) and rows["new"] == ("new", "c", 3) and len(rows) == 401


def test_a_column_that_does_not_come_stays(spark, workdir):
    path = f"{workdir}/dim"
    B.upsert_stored(frame(spark, [("a", "x", 1)]), path, CONTRACT, ["k"])
    B.upsert_stored(frame(spark, [(5, "a")], "n int, k string"), path, CONTRACT, ["k"])
    assert stored(spark, path) == [("a", "x", 5)]


def test_repeated_keys_and_empty_updates(spark, workdir):
    path = f"{workdir}/dim"
    with pytest.raises(ValueError, match="1 rows repeat a key"):
        B.upsert_stored(frame(spark, [("a", "x", 1), ("a", "y", 1)]), path, CONTRACT, ["k"])
    assert B.upsert_stored(frame(spark, []), path, CONTRACT, ["k"]) == {"keys": 0, "new": 0, "buckets": 0}
    assert stored(spark, path) == [] and os.listdir(workdir) in ([], ["dim"])


def test_a_stop_before_the_swap_changes_nothing_and_a_rerun_ends_it(spark, workdir, monkeypatch):
    path = f"{workdir}/dim"
    B.upsert_stored(frame(spark, [("a", "x", 1)]), path, CONTRACT, ["k"])
    monkeypatch.setattr(B, "replace_buckets", lambda *a: (_ for _ in ()).throw(OSError("stopped")))
    with pytest.raises(OSError):
        B.upsert_stored(frame(spark, [("a", "z", None), ("b", "y", 2)]), path, CONTRACT, ["k"])
    monkeypatch.undo()
    assert stored(spark, path) == [("a", "x", 1)] and os.listdir(workdir) == ["dim"]
    for _ in range(2):
        B.upsert_stored(frame(spark, [("a", "z", None), ("b", "y", 2)]), path, CONTRACT, ["k"])
    assert stored(spark, path) == [("a", "z", 1), ("b", "y", 2)]
