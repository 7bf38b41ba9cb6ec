"""Load of the star into a database over JDBC (K5, K6, T4): staged beside the tables, then changed in one transaction.

A load of ten tables must not leave some with the new run and some with the old one, and a failed write must not lose the
days it was to replace. So

1. Spark writes each table's rows into a staging table of the run (``stg_<table>_<run>``), over many connections;
2. one connection then makes what is missing of the tables and, for all of them, deletes what the run replaces and inserts from
   staging, and commits once. The server copies the rows; none pass through the driver;
3. the staging tables go, whether the load went well or not.

If step 1 fails, no statement has touched a table; if step 2 fails, it is rolled back. A repeated load replaces the same
rows. A task that Spark repeats after its rows were committed leaves copies in staging; their number is compared with what was
written, and copies are removed by DISTINCT (rows are unique by key).

Table and column types come from the contracts, lengths from ``TEXT_LENGTHS``; keys of the daily tables include ``batch_date``,
since a key may come again on another day.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Protocol

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.contracts import FACTS, GOLD, conform
from ledgerline.operators.publish import write_jdbc

# fixed values: lengths of the warehouse's text columns; others have 100
TEXT_LENGTHS = {
    "customer_id": 20, "seller_id": 20, "product_id": 20, "phone_number": 20, "month_name": 20,
    "order_id": 32, "order_item_id": 32, "payment_id": 32, "delivery_id": 32, "inventory_snapshot_id": 32,
    "segment": 30, "order_status": 30, "payment_status": 30, "delivery_status": 30, "inventory_status": 30, "status": 30,
    "seller_type": 50, "payment_method": 50,
    "customer_name": 255, "email": 255, "seller_name": 255, "product_name": 255, "message": 4000,
}
DEFAULT_LENGTH = 100

KEYS = {name: (contract.fields[0].name, *(["batch_date"] if name in FACTS else [])) for name, contract in GOLD.items()}


class Connection(Protocol):
    """What a load needs of a database connection; nothing is committed before ``commit``."""

    def execute(self, sql: str) -> int: ...
    def count(self, table: str) -> int: ...
    def has_table(self, schema: str | None, name: str) -> bool: ...
    def quote(self, name: str) -> str: ...
    def commit(self) -> None: ...
    def rollback(self) -> None: ...
    def close(self) -> None: ...


class JdbcConnection:
    """A connection of the driver's JVM, out of auto-commit."""

    def __init__(self, spark: SparkSession, url: str, properties: Mapping[str, str]) -> None:
        jvm = spark.sparkContext._jvm
        options = jvm.java.util.Properties()
        for key, value in properties.items():
            options.setProperty(key, value)
        if "driver" in properties:
            jvm.org.apache.spark.sql.execution.datasources.jdbc.DriverRegistry.register(properties["driver"])
        self._dialect = jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(url)
        self._connection = jvm.java.sql.DriverManager.getConnection(url, options)
        self._connection.setAutoCommit(False)

    def execute(self, sql: str) -> int:
        statement = self._connection.createStatement()
        try:
            return statement.executeUpdate(sql)
        finally:
            statement.close()

    def count(self, table: str) -> int:
        statement = self._connection.createStatement()
        try:
            rows = statement.executeQuery(f"SELECT COUNT(*) FROM {table}")
            rows.next()
            return rows.getLong(1)
        finally:
            statement.close()

    def has_table(self, schema: str | None, name: str) -> bool:
        found = self._connection.getMetaData()
        # databases fold the case of unquoted names either way
        return any(found.getTables(self._connection.getCatalog(), form(schema) if schema else None, form(name), None).next() for form in (str, str.upper, str.lower))

    def quote(self, name: str) -> str:
        return self._dialect.quoteIdentifier(name)

    def commit(self) -> None:
        self._connection.commit()

    def rollback(self) -> None:
        self._connection.rollback()

    def close(self) -> None:
        self._connection.close()


@dataclass(frozen=True)
class Target:
    """A database and a schema in it. ``connect`` and ``write`` are how the driver connects and how Spark writes a staging table."""

    url: str
    schema: str | None = None
    properties: Mapping[str, str] = field(default_factory=dict)
    num_partitions: int = 8
    batch_size: int = 10_000
    connect: Callable[[SparkSession, str, Mapping[str, str]], Connection] = JdbcConnection
    write: Callable[..., None] = write_jdbc

    def name(self, table: str) -> str:
        return f"{self.schema}.{table}" if self.schema else table


def target_of(jdbc: Target | Mapping) -> Target:
    """``jdbc`` itself, or the target that a mapping (url, schema, properties, …) names."""
    return jdbc if isinstance(jdbc, Target) else Target(**jdbc)


@dataclass(frozen=True)
class Replace:
    """The rows of a table that a load replaces: all, those with ``column`` in ``values``, or none."""

    column: str | None = None
    values: Sequence[dt.date | int] = ()
    all: bool = False

    def condition(self, quote: Callable[[str], str]) -> str:
        marks = ", ".join(f"DATE '{v.isoformat()}'" if isinstance(v, dt.date) else str(int(v)) for v in self.values)
        return f"{quote(self.column)} IN ({marks})"


@dataclass(frozen=True)
class Load:
    table: str
    rows: DataFrame
    replace: Replace


def column_type(column: T.StructField) -> str:
    kind = column.dataType
    if isinstance(kind, T.StringType):
        return f"VARCHAR({TEXT_LENGTHS.get(column.name, DEFAULT_LENGTH)})"
    if isinstance(kind, T.DecimalType):
        return f"DECIMAL({kind.precision}, {kind.scale})"
    return {T.IntegerType: "INTEGER", T.LongType: "BIGINT", T.BooleanType: "BOOLEAN", T.DateType: "DATE", T.TimestampNTZType: "TIMESTAMP"}[type(kind)]


def create_table(target: Target, table: str, quote: Callable[[str], str]) -> str:
    keys = KEYS[table]
    columns = [f"{quote(c.name)} {column_type(c)}{' NOT NULL' if c.name in keys else ''}" for c in GOLD[table].fields]
    return f"CREATE TABLE {target.name(table)} ({', '.join(columns)}, PRIMARY KEY ({', '.join(map(quote, keys))}))"


def _text_types(table: str) -> str:
    return ", ".join(f"{c.name} {column_type(c)}" for c in GOLD[table].fields if isinstance(c.dataType, T.StringType))


def load(spark: SparkSession, target: Target, loads: Iterable[Load], run: str | None = None) -> dict[str, int]:
    """Replace rows of all tables in one transaction; rows inserted per table."""
    loads, run = list(loads), run or uuid.uuid4().hex[:12]
    staging = {x.table: target.name(f"stg_{x.table}_{run}") for x in loads}
    begun: list[str] = []
    written: dict[str, int] = {}
    try:
        for x in loads:
            observed = Observation(f"staged-{x.table}")
            rows = conform(x.rows, GOLD[x.table]).observe(observed, F.count(F.lit(1)).alias("rows"))
            begun.append(x.table)
            target.write(rows, target.url, staging[x.table], mode="errorifexists", properties=dict(target.properties), num_partitions=target.num_partitions,
                         batch_size=target.batch_size, column_types=_text_types(x.table))
            written[x.table] = int(observed.get["rows"])
        connection = target.connect(spark, target.url, target.properties)
        try:
            _change(connection, target, loads, staging, written)
            connection.commit()
        except BaseException:
            connection.rollback()
            raise
        finally:
            connection.close()
    finally:
        _drop(spark, target, [staging[t] for t in begun])
    return written


def _change(connection: Connection, target: Target, loads: list[Load], staging: dict[str, str], written: dict[str, int]) -> None:
    quote = connection.quote
    for x in loads:  # before anything is deleted: some databases commit when a table is made
        if not connection.has_table(target.schema, x.table):
            connection.execute(create_table(target, x.table, quote))
    for x in loads:
        if x.replace.all or x.replace.values:
            where = "" if x.replace.all else f" WHERE {x.replace.condition(quote)}"
            connection.execute(f"DELETE FROM {target.name(x.table)}{where}")
        columns = ", ".join(quote(c) for c in GOLD[x.table].fieldNames())
        copies = "DISTINCT " if connection.count(staging[x.table]) != written[x.table] else ""
        inserted = connection.execute(f"INSERT INTO {target.name(x.table)} ({columns}) SELECT {copies}{columns} FROM {staging[x.table]}")
        if inserted != written[x.table]:
            raise RuntimeError(f"{x.table}: {written[x.table]} rows were written, {inserted} arrived; nothing is changed")


def _drop(spark: SparkSession, target: Target, tables: list[str]) -> None:
    """Drop what the run staged. A table that its write never made, or a lost connection, is no fault of the load."""
    if not tables:
        return
    try:
        connection = target.connect(spark, target.url, target.properties)
    except Exception:  # noqa: BLE001
        return
    try:
        for table in tables:
            try:
                connection.execute(f"DROP TABLE {table}")
                connection.commit()
            except Exception:  # noqa: BLE001
                connection.rollback()
    finally:
        connection.close()
