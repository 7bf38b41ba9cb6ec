"""Positions and running sums of rows within groups, where one group may hold most rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import fresh, stored


def positions(df: DataFrame, group: list[str], order: list[Column], sums: dict[str, Column], name: str) -> DataFrame:
    """``df`` plus, for each entry of ``sums``, the sum of its column over the earlier rows of the row's group.

    ``order`` sorts the rows of a group. All rows are range-partitioned by (group, order), so a hot group or value lies on many
    tasks (rows equal in both are told apart by where they were read), and stored with their place; sums run within a
    partition, and what a group has in earlier partitions is added. At most the first group of a partition has such rows, so the
    table of these carries has fewer rows than there are partitions and is broadcast. Nulls of ``group`` are a group.
    """
    at, part, tie = fresh(df, "at", "part", "tie")
    tied = df.withColumn(tie, F.monotonically_increasing_id())
    placed = tied.orderBy(*[F.col(f"`{g}`") for g in group], *order, tie).drop(tie).withColumn(at, F.monotonically_increasing_id())
    rows = stored(placed, name).withColumn(part, F.shiftright(F.col(at), 33))
    names = fresh(rows, *[f"sum{i}" for i in range(len(sums))])
    wide = rows.withColumns(dict(zip(names, sums.values(), strict=True)))
    totals = wide.groupBy(*[F.col(f"`{g}`") for g in group], part).agg(*[F.sum(c).alias(c) for c in names])
    earlier = Window.partitionBy(*[F.col(f"`{g}`") for g in group]).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)  # a row a partition
    carried = fresh(wide, *[f"carried{i}" for i in range(len(sums))])
    keys = fresh(wide, *[f"key{i}" for i in range(len(group) + 1)])
    carries = totals.select(*[F.col(f"`{g}`").alias(k) for g, k in zip([*group, part], keys, strict=True)],
                            *[F.sum(c).over(earlier).alias(d) for c, d in zip(names, carried, strict=True)]).where(F.col(carried[0]).isNotNull())
    match = F.lit(True)
    for g, k in zip([*group, part], keys, strict=True):
        match = match & F.col(f"`{g}`").eqNullSafe(F.col(k))
    local = Window.partitionBy(*[F.col(f"`{g}`") for g in group], part).orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0)
    run = wide.withColumns({c: F.coalesce(F.sum(c).over(local), zero) for c in names}).join(F.broadcast(carries), match, "left")
    done = {out: (F.col(c) + F.coalesce(F.col(d), zero)).cast("long") for out, c, d in zip(sums, names, carried, strict=True)}
    return run.select(*[F.col(f"`{c}`") for c in df.columns], *[v.alias(k) for k, v in done.items()])
