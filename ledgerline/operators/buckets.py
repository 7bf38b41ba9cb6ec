"""Stored tables laid out by key-hash buckets, of which a partial update reads and rewrites only those it hits (2.16 upsert).

A dimension's rows lie in ``bucket=<n>`` folders by a hash of their key. ``upsert_stored`` finds the buckets of the incoming keys (``buckets`` values at
most reach the driver), reads those buckets alone by a partition filter, merges, stages the result and replaces exactly those
folders by one dynamic overwrite. An update of a few keys of a large dimension so costs a few buckets, not the table, and a
run that stopped half-way is made good by running it again: merging the same rows twice changes nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.contracts import conform
from ledgerline.operators.publish import upsert
from ledgerline.sources import files

BUCKETS = 256
BUCKET = "bucket"


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int").alias(BUCKET)


def read(spark: SparkSession, path: str, contract: T.StructType, keep_bucket: bool = False) -> DataFrame:
    """The stored table, empty before its first rows."""
    schema = T.StructType([*contract.fields, T.StructField(BUCKET, T.IntegerType())])
    rows = spark.read.schema(schema).parquet(path) if files.exists(spark, path) else spark.createDataFrame([], schema)
    return rows if keep_bucket else rows.drop(BUCKET)


def replace_buckets(rows: DataFrame, path: str) -> None:
    """``rows`` (with ``bucket``) become the only rows of the buckets they have; the others stay."""
    dealt = rows.hint("rebalance", BUCKET)
    dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(path)


def upsert_stored(incoming: DataFrame, path: str, contract: T.StructType, keys: Sequence[str], buckets: int = BUCKETS) -> dict[str, int]:
    """Merge ``incoming`` (a row per key; NULL or missing columns leave the stored value) into the table at ``path``.

    ``buckets`` must be the same for every update of a table. Returns the keys that came, those that were new, and the buckets rewritten.
    """
    spark, keys = incoming.sparkSession, list(keys)
    work = files.new_path(path, uuid.uuid4().hex)
    try:
        conform(incoming, contract).select("*", bucket_of(keys, buckets)).write.parquet(f"{work}/incoming")
        came = spark.read.parquet(f"{work}/incoming")
        per_bucket = came.groupBy(BUCKET).agg(F.count(F.lit(1)).alias("n"), F.countDistinct(F.struct(*keys)).alias("keys")).collect()
        if repeated := sum(r.n - r["keys"] for r in per_bucket):
            raise ValueError(f"{repeated} rows repeat a key; deduplicate the update first")
        hit = [r[BUCKET] for r in per_bucket]
        if not hit:
            return {"keys": 0, "new": 0, "buckets": 0}
        held = read(spark, path, contract, keep_bucket=True).where(F.col(BUCKET).isin(*hit)).drop(BUCKET)
        upsert(held, came.drop(BUCKET), keys).select("*", bucket_of(keys, buckets)).write.parquet(f"{work}/merged")
        merged = spark.read.parquet(f"{work}/merged")
        before, after = held.count(), merged.count()  # from the footers
        replace_buckets(merged, path)
        return {"keys": sum(r.n for r in per_bucket), "new": after - before, "buckets": len(hit)}
    finally:
        files.delete(spark, work)
