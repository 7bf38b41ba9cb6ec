"""Keys that several days hold (Q2, D1 across days).

Daily tables are deduplicated and counted within their day, so a key that comes again on another day is two rows. This reports such
keys without reading the days that can't hold one. Beside silver lies a key filter: for each day the 64-bit prints
of its keys, sorted, a few bytes a key (``key_days/<entity>/batch_date=D``). A day's prints are looked up in those of all other
days; equal keys have equal prints, so a day whose prints are nowhere else is clean, and no other partition of the table is
read for it. Only days that share a print are read, with a partition filter, and there only keys with such a print are compared, by value: two keys
with one print are told apart. What is found is stored by the day that was checked (``key_repeats/<entity>/batch_date=D``).

Days may come in any order and again: a day's prints and findings are replaced. Rows with a null in the key have no identity and are
left to the non-null check; rows without a day are left out. A key of many days is one short list of days.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.operators.publish import write_batches
from ledgerline.sources import files
from ledgerline.sources.layers import scan

PRINTS = "batch_date date, print long"


def prints_path(root: str, entity: str) -> str:
    return f"{root.rstrip('/')}/key_days/{entity}"


def repeats_path(root: str, entity: str) -> str:
    return f"{root.rstrip('/')}/key_repeats/{entity}"


def _known(keys: Sequence[str]) -> Column:
    known = F.col("batch_date").isNotNull()
    for key in keys:
        known = known & F.col(key).isNotNull()
    return known


def _of(days: Sequence[dt.date]) -> Column:
    return F.array(*[F.lit(d) for d in days])


def _print(keys: Sequence[str]) -> Column:
    return F.xxhash64(*keys).alias("print")


def prints(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(batch_date, print), distinct."""
    return rows.where(_known(keys)).select("batch_date", _print(keys)).distinct()


def shared_prints(held: DataFrame, days: Sequence[dt.date] | None = None) -> DataFrame:
    """(print, days) of the prints that more than one day holds, one of ``days`` among them (None: any).

    The days' own prints are few against all: the planner broadcasts them, or filters the others by them before it shuffles.
    """
    if days is not None:
        ours = held.where(F.col("batch_date").isin(*[F.lit(d) for d in days])).select("print").distinct()
        held = held.join(ours, "print", "left_semi")
    return held.groupBy("print").agg(F.collect_set("batch_date").alias("days")).where(F.size("days") > 1)


def repeated(rows: DataFrame, keys: Sequence[str], shared: DataFrame, days: Sequence[dt.date] | None = None) -> DataFrame:
    """(keys…, days): keys that ``rows`` hold on more than one day, compared by value where a print is shared; ``days`` ascend."""
    suspects = rows.where(_known(keys)).select(*keys, "batch_date", _print(keys)).join(shared.select("print"), "print", "left_semi")
    found = suspects.groupBy(*keys).agg(F.array_sort(F.collect_set("batch_date")).alias("days")).where(F.size("days") > 1)
    return found if days is None else found.where(F.arrays_overlap("days", _of(days)))


def read_repeats(spark: SparkSession, root: str, entity: str, key_fields: Sequence[T.StructField]) -> DataFrame:
    """(keys…, days, batch_date) of all checked days; ``batch_date`` is the day that was checked."""
    schema = T.StructType([*key_fields, T.StructField("days", T.ArrayType(T.DateType())), T.StructField("batch_date", T.DateType())])
    path = repeats_path(root, entity)
    return spark.read.schema(schema).parquet(path) if files.exists(spark, path) else spark.createDataFrame([], schema)


def check_days(spark: SparkSession, root: str, entity: str, keys: Sequence[str], days: Sequence[dt.date]) -> dict[dt.date, int]:
    """Store the prints of ``days`` of a silver table, look them up in all days', store the keys found; their number by day.

    Reads the checked days, the prints, and only those other days of the table that share a print.
    """
    keys, days = list(keys), sorted(days)
    table = scan(spark, root, "silver", entity)
    write_batches(prints(table.where(F.col("batch_date").isin(*[F.lit(d) for d in days])), keys), prints_path(root, entity), days, order=["print"])
    held = spark.read.schema(PRINTS).parquet(prints_path(root, entity))
    work = f"{root.rstrip('/')}/_staging/{uuid.uuid4().hex}"
    try:
        shared_prints(held, days).write.parquet(f"{work}/shared")
        shared = spark.read.schema("print long, days array<date>").parquet(f"{work}/shared")
        suspect = [r[0] for r in shared.select(F.explode("days")).distinct().collect()]  # days, not rows
        if suspect:
            found = repeated(table.where(F.col("batch_date").isin(*[F.lit(d) for d in sorted(suspect)])), keys, shared, days)
        else:
            found = spark.createDataFrame([], T.StructType([*[table.schema[k] for k in keys], T.StructField("days", T.ArrayType(T.DateType()))]))
        found = found.select("*", F.explode(F.array_intersect("days", _of(days))).alias("batch_date"))
        found.write.parquet(f"{work}/found")
        found = spark.read.schema(found.schema).parquet(f"{work}/found")
        write_batches(found, repeats_path(root, entity), days)
        counts = {r.batch_date: r["count"] for r in found.groupBy("batch_date").count().collect()}
    finally:
        files.delete(spark, work)
    return {d: counts.get(d, 0) for d in days}
