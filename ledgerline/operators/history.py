"""Slowly changing dimension, type 2 (roadmap item of the reference, built here).

``scd2_versions`` turns dated snapshots of an entity's attributes into version rows
``(keys…, attrs…, valid_from, valid_to, is_current)``: a new version starts whenever any
tracked attribute differs (NULL-safe) from the previous snapshot of the same key; ``valid_to``
is the next version's ``valid_from`` (exclusive), NULL for the current version.

Scale: snapshots are first collapsed to one row per (key, day) with a partial aggregate, so
the window that follows sees at most one row per day for a key, however many raw rows that
key has; a key with a third of all rows costs the window no more than any other key.

``apply_day`` keeps a stored history up: one day's snapshot closes, opens or splits versions, also when the day comes late or again.
"""

from __future__ import annotations

import datetime as dt
import uuid
from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.sources import files
from ledgerline.sources.scratch import stored


def daily_snapshots(df: DataFrame, keys: Sequence[str], as_of: str, attrs: Sequence[str], tie_break: Sequence[str]) -> DataFrame:
    """One row per (keys, as_of): the attributes of the row with the greatest ``tie_break``."""
    keys, attrs, tie_break = list(keys), list(attrs), list(tie_break)
    pick = F.max(F.struct(*[F.col(c) for c in tie_break + attrs])).alias("_s")
    return df.groupBy(*keys, as_of).agg(pick).select(*keys, as_of, *[F.col("_s")[a].alias(a) for a in attrs])


def scd2_versions(snapshots: DataFrame, keys: Sequence[str], as_of: str, attrs: Sequence[str]) -> DataFrame:
    keys, attrs = list(keys), list(attrs)
    w = Window.partitionBy(*keys).orderBy(as_of)
    changed = reduce(
        lambda a, b: a | b,
        [~F.col(a).eqNullSafe(F.lag(a).over(w)) for a in attrs],
    )
    marked = snapshots.select(*keys, *attrs, as_of, F.row_number().over(w).alias("_rn"), changed.alias("_chg"))
    starts = marked.where((F.col("_rn") == 1) | F.col("_chg")).select(*keys, *attrs, F.col(as_of).alias("valid_from"))
    wv = Window.partitionBy(*keys).orderBy("valid_from")
    nxt = F.lead("valid_from").over(wv)
    return starts.select(*keys, *attrs, "valid_from", nxt.alias("valid_to"), nxt.isNull().alias("is_current"))


# ---- kept up day by day ------------------------------------------------------------------------
# A day's snapshot changes the history of a key only where the key's version of that day says something else. For those
# keys the stored versions stand for the observations that made them: each one's first day, and, where a day
# arrives out of order in the middle of a version that differs, the next day the version was observed again. Versions over these few rows
# are the versions over all snapshots.

BUCKETS = 64


def _same(a: Sequence[str], b: Sequence[str]) -> Column:
    return reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(d)) for c, d in zip(a, b, strict=True)])


def _covers(day: Column) -> Column:
    return (F.col("valid_from") <= day) & (F.col("valid_to").isNull() | (F.col("valid_to") > day))


def touched_keys(versions: DataFrame, snapshot: DataFrame, day: Column, keys: Sequence[str], attrs: Sequence[str], gone: DataFrame | None = None) -> DataFrame:
    """Keys whose history the snapshot of ``day`` changes. ``gone``: keys that an earlier delivery of the day had and this one has not."""
    keys, attrs = list(keys), list(attrs)
    then = [f"_{a}" for a in attrs]
    known = versions.where(_covers(day)).select(*keys, *[F.col(a).alias(t) for a, t in zip(attrs, then, strict=True)], F.lit(True).alias("_known"))
    compared = snapshot.select(*keys, *attrs).join(known, keys, "left")
    changed = compared.where(F.col("_known").isNull() | ~_same(attrs, then)).select(*keys)
    if gone is None:
        return changed
    begun = versions.where(F.col("valid_from") == day).join(gone.select(*keys), keys, "left_semi").select(*keys)
    return changed.unionByName(begun)


def resplice(versions: DataFrame, snapshot: DataFrame, day: Column, keys: Sequence[str], attrs: Sequence[str], touched: DataFrame, seen: DataFrame | None = None) -> DataFrame:
    """All versions of the ``touched`` keys with the snapshot of ``day`` in its place.

    ``versions``: at least those of the touched keys. ``seen``: (keys…, as_of) of the snapshots after ``day``, None if there are none.
    """
    keys, attrs = list(keys), list(attrs)
    own = versions.join(touched, keys, "left_semi")
    parts = [
        own.where(F.col("valid_from") != day).select(*keys, *attrs, F.col("valid_from").alias("_at")),
        snapshot.join(touched, keys, "left_semi").select(*keys, *attrs, day.alias("_at")),
    ]
    if seen is not None:
        split = own.where(_covers(day)).select(*keys, *attrs, "valid_to")
        again = seen.where(F.col("as_of") > day).select(*keys, "as_of").join(touched, keys, "left_semi").join(split, keys)
        again = again.where(F.col("valid_to").isNull() | (F.col("as_of") < F.col("valid_to"))).groupBy(*keys).agg(F.min("as_of").alias("_at"))
        parts.append(split.join(again, keys).select(*keys, *attrs, "_at"))
    # Spark 4.1 takes the union's partitioning by key from its parts, and then saw the rows of a key apart (spark.sql.unionOutputPartitioning);
    # dealt by other columns first, these few rows are dealt by key again
    return scd2_versions(reduce(DataFrame.unionByName, parts).repartition(*keys, "_at"), keys, "_at", attrs)


def spliced(versions: DataFrame, snapshot: DataFrame, day: Column, keys: Sequence[str], attrs: Sequence[str], seen: DataFrame | None = None) -> DataFrame:
    """``versions`` with the snapshot of ``day``, which they don't hold yet, in its place."""
    touched = stored(touched_keys(versions, snapshot, day, keys, attrs), "touched")  # mostly few: what follows reads it several times and broadcasts it then
    rest = versions.join(touched, list(keys), "left_anti")
    return rest.unionByName(resplice(versions, snapshot, day, keys, attrs, touched, seen))


def history_path(root: str, entity: str, part: str) -> str:
    return f"{root.rstrip('/')}/history/{entity}/{part}"


def _bucket(keys: Sequence[str]) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int").alias("bucket")


def read_versions(spark: SparkSession, root: str, entity: str, schema: T.StructType, keys: Sequence[str], attrs: Sequence[str]) -> DataFrame:
    """The stored history of an entity, empty before its first day; ``bucket`` is the partition column."""
    fields = [*[schema[c] for c in (*keys, *attrs)], T.StructField("valid_from", T.DateType()), T.StructField("valid_to", T.DateType()),
              T.StructField("is_current", T.BooleanType()), T.StructField("bucket", T.IntegerType())]
    path = history_path(root, entity, "versions")
    if not files.exists(spark, path):
        return spark.createDataFrame([], T.StructType(fields))
    return spark.read.schema(T.StructType(fields)).parquet(path)


def apply_day(snapshot: DataFrame, root: str, entity: str, day: dt.date, keys: Sequence[str], attrs: Sequence[str]) -> int:
    """Splice the snapshot of ``day`` (a row per key) into the stored history; the number of keys it changed.

    Days may come in any order and again. Versions lie in ``BUCKETS`` partitions by key hash, of which only those with a changed
    key are rewritten, staged first and replaced together by one job. Which keys a day had is stored last, so a day that stopped half-way
    is to be run again before another one; what it had changed is then unchanged by it.
    """
    spark, keys, attrs = snapshot.sparkSession, list(keys), list(attrs)
    versions = read_versions(spark, root, entity, snapshot.schema, keys, attrs)
    at, seen_path = F.lit(day), history_path(root, entity, "seen")
    seen, gone = None, None
    if files.exists(spark, seen_path):
        whole = spark.read.schema(T.StructType([*[snapshot.schema[k] for k in keys], T.StructField("as_of", T.DateType())])).parquet(seen_path)
        gone = whole.where(F.col("as_of") == at).join(snapshot.select(*keys), keys, "left_anti").select(*keys)
        seen = whole.where(F.col("as_of") > at)
    work = f"{history_path(root, entity, '_staging')}-{uuid.uuid4().hex}"
    try:
        touched = touched_keys(versions, snapshot, at, keys, attrs, gone).distinct()
        touched.select(*keys, _bucket(keys)).write.parquet(f"{work}/touched")
        touched = spark.read.parquet(f"{work}/touched")
        counts = {r.bucket: r["count"] for r in touched.groupBy("bucket").count().collect()}  # ``BUCKETS`` at most
        if counts:
            held = versions.where(F.col("bucket").isin(*counts)).drop("bucket")
            changed = touched.select(*keys)
            new = resplice(held, snapshot, at, keys, attrs, changed, seen)
            held.join(changed, keys, "left_anti").unionByName(new).select("*", _bucket(keys)).write.parquet(f"{work}/versions")
            made = spark.read.parquet(f"{work}/versions")
            made.hint("rebalance", "bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(history_path(root, entity, "versions"))
            filled = {r.bucket for r in made.select("bucket").distinct().collect()}
            for bucket in sorted(set(counts) - filled):  # all its keys are gone
                files.delete(spark, f"{history_path(root, entity, 'versions')}/bucket={bucket}")
        snapshot.select(*keys).write.mode("overwrite").parquet(f"{seen_path}/as_of={day.isoformat()}")
    finally:
        files.delete(spark, work)
    return sum(counts.values())
