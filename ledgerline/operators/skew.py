"""Joins of a large table to a table with one row per key, where few keys may hold most rows.

``join_one`` leaves a right side that the planner knows to be small to it, to be broadcast. One whose size the planner only guesses (a distinct over
joins, say) is counted, and broadcast if its rows fit the threshold. Beyond the threshold the heavy keys are
found first: one count per key with map-side combine, of which those with at least ``share`` of the rows are kept, so there are at most 1 / ``share`` of them.
A heavy key is split as many ways as it has shares, its row on the right is repeated as often, and all other
rows go by their key: no task gets more than a share of the rows by any one key, and at most 2 / ``share`` rows of the right side are copies.
Rows with a null key match nothing and are dealt by their own values.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SHARE = 0.001
#: Bytes that a row of a counted right side is taken for: a key and a few short columns.
ROW_BYTES = 100
WAYS, SALT = "_ways", "_salt"


def _threshold(df: DataFrame) -> int:
    return df._jdf.queryExecution().sparkSession().sessionState().conf().autoBroadcastJoinThreshold()


def broadcastable(df: DataFrame) -> bool:
    """Whether the planner's size estimate of ``df`` is under the session's broadcast threshold."""
    return 0 <= int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) <= _threshold(df)


def few_rows(df: DataFrame) -> bool:
    """Whether ``df``, counted, fits the session's broadcast threshold; False without a count where broadcasts are off."""
    most = _threshold(df) // ROW_BYTES
    return most > 0 and df.limit(most + 1).count() <= most


def heavy_keys(rows: DataFrame, keys: Sequence[str], share: float = SHARE) -> DataFrame:
    """(keys…, ways): the keys with at least ``share`` of all rows, and how many shares each has."""
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    least = counts.agg((F.sum("_n") * F.lit(share)).alias("_n")).scalar()
    return counts.where(known & (F.col("_n") >= least)).select(*keys, F.ceil(F.col("_n") / least).cast("int").alias(WAYS))


def join_one(
    left: DataFrame, right: DataFrame, keys: Sequence[str], spread: Sequence[str], how: str = "left", counted: DataFrame | None = None, share: float = SHARE
) -> DataFrame:
    """``left`` join ``right`` (one row per key) on ``keys``; ``how`` is left or inner.

    ``spread``: columns of ``left`` whose values deal the rows of one key, at best its row key. ``counted``: a cheaper table with
    about the same keys to find the heavy ones in.
    """
    keys = list(keys)
    if broadcastable(right):
        return left.join(right, keys, how)
    if few_rows(right):
        return left.join(F.broadcast(right), keys, how)
    heavy = heavy_keys((left if counted is None else counted).select(*keys), keys, share)
    heavy = F.broadcast(heavy)  # 1 / share rows at most
    some_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    dealt = F.pmod(F.xxhash64(*spread), F.when(some_null, F.lit(int(1 / share))).otherwise(F.coalesce(F.col(WAYS), F.lit(1)))).cast("int")
    split = left.join(heavy, keys, "left").withColumn(SALT, dealt).drop(WAYS)
    ways = F.sequence(F.lit(0), F.coalesce(F.col(WAYS), F.lit(1)) - 1)
    copies = right.join(heavy, keys, "left").withColumn(SALT, F.explode(ways)).drop(WAYS)
    return split.join(copies, [*keys, SALT], how).drop(SALT)
