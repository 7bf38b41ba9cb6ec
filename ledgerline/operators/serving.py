"""A serving copy whose tables change together (K1, K2, K6, F11): run-named folders and one pointer file per publish.

A publish writes its tables into folders of its run: ``<dimension>/run=<run>``, and ``<fact>/batch_date=<day>/run=<run>`` for each of its
days. Nothing that a reader sees is touched. Then one pointer file ``_pointers/<number>.json`` names, for each table, the run that
holds it (for a fact, the run of each day); the one with the highest number is what readers see. The file is written beside and renamed to its number,
which fails if another publish took the number; the publish then starts from that one's pointer and takes the next. So

* a stop at any point leaves all tables as before or all as after;
* two publishes at a time both end whole: each adds its own tables and days to what is current;
* a reader that has read a pointer keeps its folders: those that only the dropped pointers name go once ``KEEP`` newer publishes stand.

On HDFS the rename is refused if the number is taken, on a local disk the hard link that stands for it; on an object store use a committer or a table format of the store instead.
Folders of a run that never ended are named by no pointer; ``orphans`` lists them.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerline.contracts import GOLD
from ledgerline.operators.publish import replace_by_key
from ledgerline.sources import files
from ledgerline.sources.layers import as_date

KEEP = 5
_TRIES = 50


@dataclass
class Pointer:
    """``whole``: the run of each dimension; ``days``: the run of each day of a fact."""

    number: int = 0
    whole: dict[str, str] = field(default_factory=dict)
    days: dict[str, dict[str, str]] = field(default_factory=dict)

    def folders(self, root: str) -> set[str]:
        return {whole_path(root, t, r) for t, r in self.whole.items()} | {day_path(root, t, d, r) for t, days in self.days.items() for d, r in days.items()}


def whole_path(root: str, table: str, run: str) -> str:
    return f"{root.rstrip('/')}/gold/{table}/run={run}"


def day_path(root: str, table: str, day: str, run: str) -> str:
    return f"{root.rstrip('/')}/gold/{table}/batch_date={day}/run={run}"


def _pointers(root: str) -> str:
    return f"{root.rstrip('/')}/_pointers"


def numbers(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the pointer files, ascending."""
    return sorted(int(n[:-5]) for n in files.names(spark, _pointers(root)) if n.endswith(".json") and n[:-5].isdigit())


def read_pointer(spark: SparkSession, root: str, number: int | None = None) -> Pointer:
    """The pointer of that number, or the current one; an empty one before the first publish."""
    if number is None:
        known = numbers(spark, root)
        if not known:
            return Pointer()
        number = known[-1]
    held = json.loads(files.read_text(spark, f"{_pointers(root)}/{number:012d}.json"))
    return Pointer(number, held["whole"], held["days"])


class Publish:
    """One run's tables: ``dimension``, ``keyed`` and ``fact`` write them, ``commit`` shows them all at once."""

    def __init__(self, spark: SparkSession, root: str, run: str | None = None) -> None:
        self.spark, self.root, self.run = spark, root, run or uuid.uuid4().hex
        self._whole: dict[str, str] = {}
        self._keyed: dict[str, tuple[DataFrame, Sequence[str], str | None]] = {}
        self._days: dict[str, dict[str, str | None]] = {}

    def dimension(self, table: str, rows: DataFrame) -> int:
        observed = Observation(f"publish-{table}")
        rows.observe(observed, F.count(F.lit(1)).alias("rows")).write.parquet(whole_path(self.root, table, self.run))
        self._whole[table] = self.run
        return int(observed.get["rows"])

    def keyed(self, table: str, rows: DataFrame, keys: Sequence[str]) -> int:
        """``rows`` replace those of their keys; the others stay. Rows of the whole table. Merged again if another publish changes the table first."""
        return self._merge(table, rows, keys, read_pointer(self.spark, self.root))

    def _merge(self, table: str, rows: DataFrame, keys: Sequence[str], current: Pointer) -> int:
        base, observed = current.whole.get(table), Observation(f"publish-{table}")
        merged = rows if base is None else replace_by_key(read(self.spark, self.root, table, pointer=current), rows, keys)
        self._whole[table] = f"{self.run}-{current.number}"
        merged.observe(observed, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(whole_path(self.root, table, self._whole[table]))
        self._keyed[table] = (rows, keys, base)
        return int(observed.get["rows"])

    def fact(self, table: str, rows: DataFrame, days: Iterable[dt.date | str]) -> int:
        """``rows`` become the days' only rows; a day without rows becomes empty."""
        wanted = sorted({as_date(d) for d in days})
        observed = Observation(f"publish-{table}")
        mine = rows.where(F.col("batch_date").isin(*[F.lit(d) for d in wanted])).hint("rebalance", "batch_date")
        counted = mine.observe(observed, F.count(F.lit(1)).alias("rows"), F.collect_set("batch_date").alias("days"))
        placed = counted.withColumn("run", F.lit(self.run))
        placed.write.mode("append").partitionBy("batch_date", "run").parquet(f"{self.root.rstrip('/')}/gold/{table}")
        held = {as_date(d) for d in observed.get["days"] or []}
        self._days[table] = {d.isoformat(): self.run if d in held else None for d in wanted}
        return int(observed.get["rows"])

    def commit(self) -> Pointer:
        """The pointer that shows this run's tables and, of everything else, what was current when its number was taken."""
        for _ in range(_TRIES):
            current = read_pointer(self.spark, self.root)
            for table, (rows, keys, base) in list(self._keyed.items()):
                if current.whole.get(table) != base:
                    files.delete(self.spark, whole_path(self.root, table, self._whole[table]))
                    self._merge(table, rows, keys, current)
            whole = current.whole | self._whole
            days = {t: dict(d) for t, d in current.days.items()}
            for table, changed in self._days.items():
                merged = days.get(table, {}) | changed
                days[table] = {d: r for d, r in sorted(merged.items()) if r is not None}
            made = Pointer(current.number + 1, whole, days)
            body = json.dumps({"run": self.run, "whole": whole, "days": days}, sort_keys=True)
            if files.create_text(self.spark, f"{_pointers(self.root)}/{made.number:012d}.json", body):
                _clean(self.spark, self.root)
                return made
        raise RuntimeError(f"{self.root}: {_TRIES} other publishes ended first; run this one again")


def _clean(spark: SparkSession, root: str) -> None:
    """Drop pointers older than the last ``KEEP`` and the folders that only they name."""
    known = numbers(spark, root)
    old = known[:-KEEP]
    if not old:
        return
    kept = set().union(*(read_pointer(spark, root, n).folders(root) for n in known[-KEEP:]))
    for n in old:  # folders first: a stop in between leaves the pointer, and the next publish goes on
        try:
            for folder in read_pointer(spark, root, n).folders(root) - kept:
                files.delete(spark, folder)
        except (OSError, ValueError):  # another publish cleans too
            continue
        files.delete(spark, f"{_pointers(root)}/{n:012d}.json")


def read(spark: SparkSession, root: str, table: str, days: Sequence[dt.date | str] | None = None, pointer: Pointer | None = None) -> DataFrame:
    """A published table, of a fact the ``days`` (all if None). Read several tables with one ``pointer`` to have them of one publish."""
    at = read_pointer(spark, root) if pointer is None else pointer
    contract = GOLD[table]
    if table in at.whole:
        return spark.read.schema(contract).parquet(whole_path(root, table, at.whole[table]))
    held = at.days.get(table, {})
    wanted = sorted(held) if days is None else sorted({as_date(d).isoformat() for d in days} & set(held))
    if not wanted:
        return spark.createDataFrame([], contract)
    paths = [day_path(root, table, d, held[d]) for d in wanted]
    rows = spark.read.schema(contract).option("basePath", f"{root.rstrip('/')}/gold/{table}").parquet(*paths)
    return rows.select(*contract.fieldNames())


def orphans(spark: SparkSession, root: str) -> list[str]:
    """Folders of runs that no kept pointer names: left by runs that stopped, or of a run that is not over."""
    named = set().union(*(read_pointer(spark, root, n).folders(root) for n in numbers(spark, root)), set())
    found = []
    for table in files.names(spark, f"{root.rstrip('/')}/gold"):
        base = f"{root.rstrip('/')}/gold/{table}"
        for name in files.names(spark, base):
            below = [f"{base}/{name}/{r}" for r in files.names(spark, f"{base}/{name}")] if name.startswith("batch_date=") else [f"{base}/{name}"]
            found += [f for f in below if f.rpartition("/")[2].startswith("run=") and f not in named]
    return sorted(found)
