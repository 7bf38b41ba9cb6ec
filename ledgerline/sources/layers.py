"""Scans of layer tables (bronze / silver / gold Parquet) with an optional batch filter.

Daily tables are partitioned by ``batch_date``; filtering on it with a date literal becomes a
``PartitionFilters`` entry in the scan, so only that day's directory is listed and read.
Whether a table is daily comes from its contract, not from peeking at the data.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.contracts import BATCH_ENTITIES, FACTS, layer_schema

PARTITIONED = set(BATCH_ENTITIES) | set(FACTS)
LAYERS = ("bronze", "silver", "gold", "_staging", "audit")


def table_path(root: str, layer: str, table: str) -> str:
    if layer not in LAYERS:
        raise ValueError(f"unknown layer {layer!r}")
    return f"{root.rstrip('/')}/{layer}/{table}"


def as_date(value: dt.date | str) -> dt.date:
    return value if isinstance(value, dt.date) else dt.date.fromisoformat(str(value))


def filter_batch(df: DataFrame, batch_date: dt.date | str | None, column: str = "batch_date") -> DataFrame:
    """Rows of one batch day (a date literal, so the filter prunes partitions)."""
    if batch_date is None:
        return df
    return df.where(F.col(column) == F.lit(as_date(batch_date)))


def filter_batches(df: DataFrame, start: dt.date | str, end: dt.date | str, column: str = "batch_date") -> DataFrame:
    """Rows of the batch days in [start, end]."""
    return df.where(F.col(column).between(F.lit(as_date(start)), F.lit(as_date(end))))


def scan(spark: SparkSession, root: str, layer: str, table: str, batch_date: dt.date | str | None = None) -> DataFrame:
    """Read a layer table by its declared schema, so one without rows yet is empty; daily tables are filtered to ``batch_date`` if given."""
    df = spark.read.schema(layer_schema(layer, table)).parquet(table_path(root, layer, table))
    return filter_batch(df, batch_date) if table in PARTITIONED else df
