"""Keep-one-row-per-key.

D1 is an aggregation, not a window: ``max(struct(order columns…, rest…))`` per key. The
aggregate runs partially on the map side, so a key that holds a third of the table is first
collapsed to one row per input partition and never lands whole in one task (a
``row_number`` window would sort every row of that key in a single task). The survivor is
deterministic: the greatest ``ingested_at``, then the greatest value of each remaining
column in table order (NULL lowest) — the same as
``row_number() over (partition by key order by ingested_at desc nulls last, c1 desc nulls last, …) = 1``.

Physically, a ``max`` whose buffer holds text is not fixed-width, so Spark runs it as a
sort-based aggregate (``SortAggregate``) on both sides of the shuffle. It still combines on
the map side, and a sort spills to disk, so neither a hot key nor a large input partition needs
more memory than a sort buffer. An exact survivor over text columns has no fixed-width
encoding; a hash of the row would make the choice depend on collisions.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keep_latest(
    df: DataFrame, keys: Sequence[str], order_first: Sequence[str] = ("ingested_at",), copies: str | None = None,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """One row per key: the survivor described above.

    With ``copies``, a column of that name is appended holding the number of input rows of the
    key, computed in the same aggregate; a duplicate check then reads it instead of grouping
    the raw rows a second time.

    With ``columns``, only these of the survivor are returned, in table order. Of the greatest row, any first values are the
    greatest such values, so what is ordered after the last of ``columns`` decides nothing about them and isn't shuffled.
    """
    keys = list(keys)
    first = [c for c in order_first if c in df.columns and c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in first]
    ordered, wanted = first + rest, df.columns
    if columns is not None:
        wanted = [c for c in df.columns if c in columns]
        ordered = ordered[: max((at for at, c in enumerate(ordered, 1) if c in columns), default=0)]
    aggs = [F.count(F.lit(1)).alias(copies)] if copies else []
    extra = [copies] if copies else []
    if not ordered:
        return df.groupBy(*keys).agg(*aggs).select(*wanted, *extra) if copies else df.select(*keys).distinct().select(*wanted)
    survivor = F.max(F.struct(*[F.col(c) for c in ordered])).alias("_survivor")
    fields = [F.col("_survivor")[c].alias(c) for c in ordered]
    return df.groupBy(*keys).agg(survivor, *aggs).select(*keys, *fields, *extra).select(*wanted, *extra)

