"""Sinks: snapshot overwrite, batch-scoped replace, keyed replace, JDBC (K1–K6).

Plain Parquet has no transaction log, so idempotence comes from *replace* semantics chosen by
the kind of table:

* snapshot (master / dimension) — a new version is written beside the table and swapped in by
  rename once it is complete, so a failed write leaves the table as it was (K1);
* daily (facts, daily silver) — replace exactly the batch days written (K2): for one day the
  partition directory ``…/batch_date=D`` itself is overwritten, which clears the day even when
  the new batch has zero rows; for a range, dynamic partition overwrite replaces the days that
  have rows and the days without rows are cleared explicitly;
* keyed (``dim_date``) — rows of the target whose key is not in the incoming set, plus the
  incoming set (K4), computed with an anti join and a union.

Row counts come from ``DataFrame.observe`` on the write itself, so nothing is counted in a
second pass.
"""

from __future__ import annotations

import datetime as dt
import uuid
from typing import Iterable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerline.sources import files
from ledgerline.sources.layers import as_date


def _observed(df: DataFrame, name: str, with_days: bool = False) -> tuple[DataFrame, Observation]:
    obs = Observation(name)
    metrics = [F.count(F.lit(1)).alias("rows")]
    if with_days:
        metrics.append(F.collect_set("batch_date").alias("days"))
    return df.observe(obs, *metrics), obs


def write_snapshot(df: DataFrame, path: str) -> int:
    """Replace a whole table; returns the number of rows written. ``df`` may read the table itself."""
    spark = df.sparkSession
    new = files.new_path(path, uuid.uuid4().hex)
    observed, obs = _observed(df, "snapshot")
    try:
        observed.write.parquet(new)
    except Exception:
        files.delete(spark, new)
        raise
    files.swap(spark, new, path)
    return int(obs.get["rows"])


def read_snapshot(spark: SparkSession, path: str) -> DataFrame | None:
    """The stored table, or None if nothing was ever stored there. Any other fault is raised."""
    files.recover(spark, path)
    return spark.read.parquet(path) if files.exists(spark, path) else None


def partition_path(path: str, batch_date: dt.date | str) -> str:
    return f"{path.rstrip('/')}/batch_date={as_date(batch_date).isoformat()}"


def write_batches(df: DataFrame, path: str, days: Iterable[dt.date | str], order: Sequence[str] = ()) -> int:
    """Replace every day in ``days`` (one day, or a backfill range) in one job.

    Days with rows are replaced by dynamic partition overwrite; of the days in ``days`` that
    produced no rows, those the table still holds rows for are cleared afterwards, one empty
    overwrite each (bounded by the number of days, never by the data). Rows outside ``days``
    are not written. A table without any rows yet has no files; read it by its declared schema.
    With ``order`` the rows of each file are sorted by those columns.
    """
    wanted = sorted({as_date(d) for d in days})
    if not wanted:
        return 0
    rows = df.where(F.col("batch_date").isin(*[F.lit(d) for d in wanted]))
    # Rebalance by day before the partitioned write: AQE packs each day into files of about
    # the advisory size and splits a day holding a large share of the rows over several tasks,
    # instead of every task writing a small file for every day it happens to hold.
    rows = rows.hint("rebalance", "batch_date")
    if order:
        rows = rows.sortWithinPartitions("batch_date", *order)
    observed, obs = _observed(rows, "batches", with_days=True)
    (
        observed.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch_date")
        .parquet(path)
    )
    metrics = obs.get
    written = {as_date(d) for d in (metrics.get("days") or [])}
    empty = df.drop("batch_date").limit(0)
    for day in stored_days(df.sparkSession, path, [d for d in wanted if d not in written]):
        empty.write.mode("overwrite").parquet(partition_path(path, day))
    return int(metrics["rows"])


def stored_days(spark: SparkSession, path: str, days: Sequence[dt.date]) -> list[dt.date]:
    """Of ``days`` (days a write produced no rows for), those the table at ``path`` still holds rows for.

    Found in one job pruned to those days; a first load of a range clears nothing. At most
    ``len(days)`` values reach the driver.
    """
    if not days or not files.exists(spark, path):
        return []
    stored = spark.read.schema("batch_date date").parquet(path)
    held = stored.where(F.col("batch_date").isin(*[F.lit(d) for d in days])).select("batch_date").distinct()
    return sorted(as_date(r.batch_date) for r in held.collect())


def replace_by_key(target: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows whose key is absent from ``incoming``, plus all of ``incoming`` (K4)."""
    keys = list(keys)
    kept = target.join(incoming.select(*keys).distinct(), keys, "left_anti")
    return kept.unionByName(incoming.select(*target.columns))


def upsert(target: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Merge a partial update: per key, each incoming non-NULL value wins over the target's.

    A full outer join on the key; new keys are inserted, existing keys keep the target value
    where the incoming column is NULL.
    """
    keys = list(keys)
    t = target.alias("t")
    i = incoming.alias("i")
    cond = [F.col(f"t.{k}").eqNullSafe(F.col(f"i.{k}")) for k in keys]
    joined = t.join(i, cond, "full_outer")
    cols = [F.coalesce(F.col(f"i.{k}"), F.col(f"t.{k}")).alias(k) for k in keys]
    cols += [F.coalesce(F.col(f"i.{c}"), F.col(f"t.{c}")).alias(c) for c in target.columns if c not in keys]
    return joined.select(*cols)


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    mode: str = "append",
    properties: dict[str, str] | None = None,
    num_partitions: int = 8,
    batch_size: int = 10000,
    column_types: str | None = None,
) -> None:
    """Write to a database table over JDBC (K5); the URL and credentials come from the caller.

    ``numPartitions`` bounds the number of concurrent connections (Spark coalesces to it) and
    ``batchsize`` the rows per insert round trip. ``column_types`` are those of a table that the write
    makes. A load that replaces rows goes through ``warehouse.load``.
    """
    writer = (
        df.write.format("jdbc")
        .option("url", url)
        .option("dbtable", table)
        .option("numPartitions", str(num_partitions))
        .option("batchsize", str(batch_size))
        .mode(mode)
    )
    if mode == "overwrite":
        writer = writer.option("truncate", "true")
    if column_types:
        writer = writer.option("createTableColumnTypes", column_types)
    for key, value in (properties or {}).items():
        writer = writer.option(key, value)
    writer.save()
