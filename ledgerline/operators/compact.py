"""Small files (K2, K3, K7): days and tables with more files than their bytes need are rewritten, others are not touched.

Appends (late payments, audit rows) leave a small file each. A listing of file names and sizes, no rows, tells how many files of the wanted size a
folder's bytes fill; folders with more than ``spare`` files beyond that are read, staged and written again, in files of about the advisory
partition size. The rows stay the same. To be run while nothing else writes to the table.
"""

from __future__ import annotations

import datetime as dt
import math
import uuid

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from ledgerline.operators import publish as P
from ledgerline.sources import files

TARGET_BYTES = 128 << 20
SPARE = 8


def crowded(sizes: list[int], target_bytes: int = TARGET_BYTES, spare: int = SPARE) -> bool:
    """Whether files of these sizes are more than ``spare`` too many for their bytes."""
    return len(sizes) > math.ceil(sum(sizes) / target_bytes) + spare


def crowded_days(spark: SparkSession, path: str, target_bytes: int = TARGET_BYTES, spare: int = SPARE) -> list[dt.date]:
    """The days of a daily table that hold too many files, from the listing alone."""
    days = [n.removeprefix("batch_date=") for n in files.names(spark, path) if n.startswith("batch_date=") and n != "batch_date=__HIVE_DEFAULT_PARTITION__"]
    return [dt.date.fromisoformat(d) for d in sorted(days) if crowded(files.sizes(spark, f"{path}/batch_date={d}", ".parquet"), target_bytes, spare)]


def compact_days(spark: SparkSession, path: str, contract: T.StructType, target_bytes: int = TARGET_BYTES, spare: int = SPARE) -> list[dt.date]:
    """Rewrite the crowded days of a daily table; the days rewritten."""
    days = crowded_days(spark, path, target_bytes, spare)
    if not days:
        return []
    work = files.new_path(path, uuid.uuid4().hex)
    try:
        rows = spark.read.schema(contract).option("basePath", path).parquet(*[P.partition_path(path, d) for d in days])
        rows.write.parquet(work)
        P.write_batches(spark.read.schema(contract).parquet(work), path, days)
    finally:
        files.delete(spark, work)
    return days


def compact_table(spark: SparkSession, path: str, contract: T.StructType, target_bytes: int = TARGET_BYTES, spare: int = SPARE) -> bool:
    """Swap a table without partitions for one of fewer files, if it has too many."""
    if not files.exists(spark, path):
        return False
    sizes = files.sizes(spark, path, ".parquet")
    if not crowded(sizes, target_bytes, spare):
        return False
    P.write_snapshot(spark.read.schema(contract).parquet(path).coalesce(max(1, math.ceil(sum(sizes) / target_bytes))), path)
    return True
