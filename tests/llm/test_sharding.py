import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import queries, sharding

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize(("good", "bad", "draws"), [(10, 20, 7), (3, 1, 2), (300, 5000, 900), (5, 5, 10), (0, 9, 3), (9, 0, 4), (7, 7, 0)])
def test_draws_follow_the_law(spark, good, bad, draws):
    unit = ((F.xxhash64("id").bitwiseAND(F.lit((1 << 52) - 1)).cast("double") + 0.5) / float(1 << 52))
    x = sharding.hypergeometric(*[F.lit(float(v)) for v in (good, bad, draws)], unit)
    got = np.array([r[0] for r in spark.range(4000, numPartitions=8).select(x).collect()])
    want = np.random.default_rng(1).hypergeometric(good, bad, draws, 200_000)
    assert got.min() >= max(0, draws - bad) and got.max() <= min(draws, good)
    assert abs(got.mean() - want.mean()) <= 5 * want.std() / 4000**0.5 + 1e-9
    assert abs(got.std() - want.std()) <= 0.08 * want.std() + 1e-9


def test_matrix_has_both_margins(spark):
    sizes = {i * 1000: 1 + (i * 37) % 90 for i in range(40)}
    rows = sharding.matrix(spark.createDataFrame(list(sizes.items()), "chunk long, n long"), 7, 3).collect()
    assert {r.chunk: int(sum(r.counts)) for r in rows} == sizes
    total = sum(sizes.values())
    assert [int(c) for c in np.sum([r.counts for r in rows], axis=0)] == [total // 7 + (s < total % 7) for s in range(7)]


def check(rows, n_rows, shards):
    per = defaultdict(list)
    for r in rows:
        per[r.shard].append(r.slot)
    assert len(rows) == n_rows and all(sorted(s) == list(range(len(s))) for s in per.values())
    assert sorted(len(per[s]) for s in range(shards)) == sorted(n_rows // shards + (s < n_rows % shards) for s in range(shards))


@pytest.mark.parametrize(("n", "shards", "chunk_rows", "parts"), [(1000, 24, 65536, 4), (1000, 7, 10, 3), (5, 24, 2, 2), (1, 1, 1, 1)])
def test_exact_sizes_gapless_slots_and_reruns(spark, n, shards, chunk_rows, parts):
    df = spark.range(0, n, numPartitions=parts).select(F.col("id").alias("doc_id"), F.lit("same text").alias("text"))
    rows = sharding.assign(df, shards, chunk_rows=chunk_rows).collect()
    check(rows, n, shards)
    assert {(r.doc_id, r.shard, r.slot) for r in rows} == {(r.doc_id, r.shard, r.slot) for r in sharding.assign(df, shards, chunk_rows=chunk_rows).collect()}


def test_shuffle_is_uniform(spark):
    """Where a row goes doesn't depend on where it was: shards and places by origin, over several seeds."""
    df = spark.range(0, 600, numPartitions=3).select(F.col("id").alias("doc_id"), F.lit("").alias("text"))
    seen, order = np.zeros((6, 4)), []
    for seed in range(6):
        rows = sharding.assign(df, 4, seed=seed, chunk_rows=50).collect()
        for r in rows:
            seen[r.doc_id // 100, r.shard] += 1
        order += [(r.doc_id, r.slot) for r in rows]
    assert ((seen - 150) ** 2 / 150).sum() < 40  # chi-square, 15 degrees of freedom
    assert abs(np.corrcoef(np.array(order).T)[0, 1]) < 0.06


def test_nulls_repeated_rows_empty_tables_and_whole_rows(spark, workdir):
    rows = [(1, None, "a"), (1, None, "a"), (None, "é", "b"), (2, "", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, __at string")
    made = sharding.assign(df, 3).collect()
    check(made, 4, 3)
    assert Counter((r.doc_id, r["size"], r.text_crc32, r.law, r.grown_shard) for r in made) == Counter(
        {(1, 8, 0, "rows", None): 2, (None, 10, zlib.crc32("é".encode()), "rows", None): 1, (2, 8, 0, "rows", None): 1})
    assert sharding.assign(df.limit(0), 3).count() == 0
    sharding.write_shards(df, f"{workdir}/out", 2)
    back = spark.read.parquet(f"{workdir}/out")
    assert Counter(map(tuple, back.select(*df.columns).collect())) == Counter(rows)
    with pytest.raises(ValueError):
        sharding.shuffle(df.withColumn("Slot", F.lit(1)))


def test_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    rows = queries.op6_sharding(spark, SF).collect()
    check(rows, len(docs), 24)
    want = {d.doc_id: (len((d.text or "").encode()) + 8, zlib.crc32((d.text or "").encode())) for d in docs}
    assert {r.doc_id: (r["size"], r.text_crc32) for r in rows} == want
    plan = queries.op6_sharding(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "ExistingRDD"))
