"""Headered CSV extracts.

Layout of a raw drop:

    <raw>/master/<entity>.csv                       customers, sellers, products
    <raw>/batches/batch_date=YYYY-MM-DD/<entity>.csv orders, order_items, payments, deliveries,
                                                     inventory_snapshots

Columns are matched by the names in each file's header, in whatever order they come; a header
that lacks a contract column, names an unknown one or names one twice raises ``HeaderError``
before anything is read. Every column is read as text: no inference pass, and values
such as ``09…`` phone numbers keep their leading zero. Rows whose field count doesn't fit the
header are kept (PERMISSIVE) and flagged in ``_corrupt_record`` so they can be counted. The
batch day of a daily file comes from its directory name through partition discovery; the days
whose headers agree are one scan, so a range is normally one read per entity.
"""

from __future__ import annotations

import csv
import datetime as dt
from functools import reduce
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.contracts import SOURCE_COLUMNS
from ledgerline.sources import files
from ledgerline.sources.layers import as_date

CORRUPT = "_corrupt_record"


class HeaderError(ValueError):
    """A CSV header doesn't hold exactly the columns of its entity."""


def header(spark: SparkSession, path: str, entity: str) -> tuple[str, ...]:
    """Column names of a file in its own order, checked against the entity's."""
    line = files.first_line(spark, path).removeprefix("﻿")
    names = tuple(c.strip() for c in next(csv.reader([line]), []))
    wanted = SOURCE_COLUMNS[entity]
    faults = [("missing", [c for c in wanted if c not in names]), ("unknown", [c for c in names if c not in wanted]),
              ("repeated", sorted({c for c in names if names.count(c) > 1}))]
    found = "; ".join(f"{what} {', '.join(map(repr, columns))}" for what, columns in faults if columns)
    if found:
        raise HeaderError(f"{path}: header of {entity}: {found}")
    return names


def _read(spark: SparkSession, entity: str, names: tuple[str, ...], paths: list[str], base: str | None = None) -> DataFrame:
    """Files that share a header, their columns in the contract's order."""
    fields = [T.StructField(c, T.StringType(), True) for c in (*names, CORRUPT)]
    reader = (
        spark.read.schema(T.StructType(fields))
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("multiLine", False)
    )
    df = (reader.option("basePath", base) if base else reader).csv(paths)
    return df.select(*SOURCE_COLUMNS[entity], CORRUPT, *(["batch_date"] if base else []))


def read_master(spark: SparkSession, raw_root: str, entity: str) -> DataFrame:
    path = f"{raw_root.rstrip('/')}/master/{entity}.csv"
    return _read(spark, entity, header(spark, path, entity), [path])


def batch_file(raw_root: str, entity: str, day: dt.date | str) -> str:
    return f"{raw_root.rstrip('/')}/batches/batch_date={as_date(day).isoformat()}/{entity}.csv"


def read_batches(spark: SparkSession, raw_root: str, entity: str, days: Sequence[dt.date | str]) -> DataFrame:
    """Daily files of ``days`` as one DataFrame with a ``batch_date`` (DATE) column."""
    by_header: dict[tuple[str, ...], list[str]] = {}
    for day in days:
        path = batch_file(raw_root, entity, day)
        by_header.setdefault(header(spark, path, entity), []).append(path)
    base = f"{raw_root.rstrip('/')}/batches"
    df = reduce(DataFrame.unionByName, [_read(spark, entity, names, paths, base) for names, paths in by_header.items()])
    return df.withColumn("batch_date", F.col("batch_date").cast("date"))


def with_ingest_time(df: DataFrame) -> DataFrame:
    """Stamp ``ingested_at`` (UTC wall clock; the session zone is pinned to UTC)."""
    return df.withColumn("ingested_at", F.current_timestamp().cast("timestamp_ntz"))
