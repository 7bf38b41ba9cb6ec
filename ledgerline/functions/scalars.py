"""Scalar column expressions, all built-in (JVM-side, whole-stage codegen).

Every parse is a ``try_cast``: Spark 4 runs with ANSI mode on, where a plain cast raises on the
first bad value and kills the whole batch. With ``try_cast`` bad text becomes NULL and the
quality checks count it instead.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
RATING = "decimal(5,2)"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def title_case(c: str | Column) -> Column:
    """First letter of each space-separated word upper, the rest lower (``initcap``)."""
    return F.initcap(col(c))


def parse_timestamp(c: str | Column) -> Column:
    """Text to a wall-clock timestamp (no zone: the warehouse type is ``TIMESTAMP``)."""
    return col(c).try_cast("timestamp_ntz")


def parse_date(c: str | Column) -> Column:
    return col(c).try_cast("date")


def to_money(c: str | Column) -> Column:
    return col(c).try_cast(MONEY)


def to_int(c: str | Column) -> Column:
    return col(c).try_cast("int")


def date_of(c: str | Column) -> Column:
    """Calendar date of a timestamp (or a date)."""
    return F.to_date(col(c))


def date_key(c: str | Column) -> Column:
    """``yyyymmdd`` as an integer, computed arithmetically (no string formatting)."""
    d = col(c)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def month_name(c: str | Column) -> Column:
    return F.date_format(col(c), "MMMM")


def iso_week(c: str | Column) -> Column:
    return F.weekofyear(col(c))


def day_difference(later: str | Column, earlier: str | Column) -> Column:
    return F.datediff(col(later), col(earlier))


def surrogate_key(*parts: str | Column) -> Column:
    """60-bit key from the md5 of the parts joined by ``|``; NULL when any part is NULL.

    The same value is ``('0x' || substr(md5(k), 1, 15))::BIGINT`` in DuckDB, so the oracle can
    rebuild it. 15 hex digits never overflow a signed 64-bit integer.
    """
    pieces: list[Column] = []
    for i, p in enumerate(parts):
        if i:
            pieces.append(F.lit("|"))
        pieces.append(col(p))
    return F.conv(F.substring(F.md5(F.concat(*pieces)), 1, 15), 16, 10).cast("long")


def money_sum(c: str | Column) -> Column:
    """Exact decimal sum cast back to the money contract (Spark widens it to 28 digits)."""
    return F.sum(col(c)).cast(MONEY)
