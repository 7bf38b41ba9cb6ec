"""Intermediate tables of one query, in the folder that driver and executors share (``spark.checkpoint.dir``).

A plan that a query reads several times with different columns or filters is run once for each of them: Spark shares an exchange only
between equal plans. Stored once, it is read as a table. Spark also keeps the shuffle files of a query until the query is over and its driver
collects garbage; those of a stored part go as soon as it is written, so a query needs the disk of its largest part, not of all parts.
A large part can be stored in slices of its keys, one after another, and then needs the disk of one slice.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.sources import files

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Bytes of the files read from which a table is stored in one slice more, and the most slices: each one scans the files again.
SLICE_BYTES = 128 << 20
SLICES_MAX = 4


def read_bytes(df: DataFrame) -> int:
    """Bytes of the tables that ``df`` reads, by the planner's listing of their files."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(at).stats().sizeInBytes())) for at in range(leaves.size()))


def stored(df: DataFrame, name: str, slice_by: Sequence[str] = (), columns: Sequence[str] | None = None) -> DataFrame:
    """The ``columns`` of ``df`` (None: all) written as a Parquet table and read again; not stored where the session names no shared folder.

    ``slice_by``: columns whose hash deals the rows to slices (null is a value), at best the key that ``df`` is grouped or deduplicated by:
    Spark then filters each slice where the tables are read, and shuffles its rows only. All slices together are all rows.
    The shuffle files of a write go when it ends, the table when the application ends.
    """
    spark, columns = df.sparkSession, list(columns or df.columns)
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        return df.select(*columns)
    path = f"{root.rstrip('/')}/ledgerline-{name}-{uuid.uuid4().hex}"
    slices = min(SLICES_MAX, 1 + read_bytes(df) // SLICE_BYTES) if slice_by else 1
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        for at in range(slices):
            part = df.where(F.pmod(F.xxhash64(*slice_by), F.lit(slices)) == at) if slices > 1 else df
            part.select(*columns).write.mode("append").option("compression", "zstd").parquet(path)
    finally:
        files.delete_at_exit(spark, path)
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.select(*columns).schema).parquet(path)
