"""Batch stages: raw CSV → bronze → silver → gold → warehouse.

Every stage takes a list of batch days, and a backfill range gives what its days one by one
give: rows are deduplicated, counted and reconciled within their day. A range is one scan per table
over all the days, one partitioned write, and one audit row per day and stage.

Layout under ``root`` (shared storage on a cluster):

    bronze/<entity>[/batch_date=D]   source text + ingested_at
    silver/<entity>[/batch_date=D]   typed, deduplicated
    gold/<dim_* | fact_*/batch_date=D>
    _staging/<run>/<table>           one run's output before it is checked and published
    audit/pipeline_run_audit

Reruns are idempotent: master tables are swapped in whole and daily tables replace exactly the
days of the run (an empty day clears the day). Silver is staged first, in a folder of its run, and
the checks read the staged copy (no lineage is recomputed per check); nothing in silver changes unless
every blocking check passes, and a failure is audited, for each of the days, before it is raised.
Layer tables are read by their declared schemas, so a table without rows yet is an empty table.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from functools import wraps

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.contracts import BATCH_ENTITIES, DIMENSIONS, FACTS, GOLD, MASTER_ENTITIES, SILVER
from ledgerline.operators import audit as A
from ledgerline.operators import checks as Q
from ledgerline.operators import compact as C
from ledgerline.operators import distinct_partials as B
from ledgerline.operators import history as H
from ledgerline.operators import key_days as K
from ledgerline.operators import publish as P
from ledgerline.operators import reports as R
from ledgerline.operators import serving as V
from ledgerline.operators import star as G
from ledgerline.operators import warehouse as W
from ledgerline.operators.clean import SPECS, clean_entity
from ledgerline.operators.run_metrics import marked
from ledgerline.sources import csv_extract as X
from ledgerline.sources import files
from ledgerline.sources.layers import as_date, filter_batches, scan, table_path
from ledgerline.streaming.merge_payments import with_accepted

_MESSAGE = W.TEXT_LENGTHS["message"]
NON_BLOCKING = ("orders_duplicates",)
COPIES = "_copies"  # staged orders only: bronze rows per order_id


def _days(days: Sequence[dt.date | str] | dt.date | str) -> list[dt.date]:
    if isinstance(days, (dt.date, str)):
        days = [days]
    out = sorted({as_date(d) for d in days})
    if not out:
        raise ValueError("no batch days given")
    return out


def day_range(start: dt.date | str, end: dt.date | str) -> list[dt.date]:
    lo, hi = as_date(start), as_date(end)
    return [lo + dt.timedelta(days=i) for i in range((hi - lo).days + 1)]


def _read_days(spark: SparkSession, root: str, layer: str, table: str, days: list[dt.date]) -> DataFrame:
    df = scan(spark, root, layer, table)
    return filter_batches(df, days[0], days[-1]).where(F.col("batch_date").isin(*[F.lit(d) for d in days]))


def _day_counts(spark: SparkSession, root: str, layer: str, table: str, days: list[dt.date]) -> dict[dt.date, int]:
    """Stored rows of each of ``days`` (0 where there are none), counted from the written files; a row a day."""
    found = _read_days(spark, root, layer, table, days).groupBy("batch_date").agg(F.count(F.lit(1)).alias("n")).collect()
    return {d: 0 for d in days} | {r.batch_date: r.n for r in found}


def _audit_days(
    spark: SparkSession, root: str, stage: str, counts: Mapping[dt.date, int | None], status: str = A.SUCCESS, message: str | Mapping[dt.date, str | None] | None = None
) -> None:
    """One audit row per day, in one append. ``message`` is one for all days, or a mapping."""
    _append_audit(root, _audit_rows(spark, stage, counts, status, message))


def _append_audit(root: str, rows: DataFrame) -> None:
    rows.coalesce(1).write.mode("append").parquet(A.audit_path(root))


def _audit_rows(
    spark: SparkSession, stage: str, counts: Mapping[dt.date, int | None], status: str = A.SUCCESS, message: str | Mapping[dt.date, str | None] | None = None
) -> DataFrame:
    note = message if isinstance(message, Mapping) else dict.fromkeys(counts, message)
    rows = [(day, stage, status, n, note.get(day)) for day, n in sorted(counts.items())]
    return A.with_audit_ids(spark.createDataFrame(rows, "batch_date date, pipeline_stage string, status string, row_count long, message string"))


@contextmanager
def _audited(spark: SparkSession, root: str, stage: str, days: list[dt.date]) -> Iterator[None]:
    """Mark the stage's jobs for its metrics; audit any failure, a row a day, before it is raised. Failed checks have their own rows."""
    try:
        with marked(spark, stage, days):
            yield
    except Q.QualityCheckError:
        raise
    except Exception as exc:
        _audit_days(spark, root, stage, dict.fromkeys(days), A.FAILED, f"{type(exc).__name__}: {exc}".split("\n")[0][:_MESSAGE])
        raise


def _audits(stage: str) -> Callable:
    """Decorator of a stage (spark, root, days, …) with ``_audited``."""

    def wrap(run: Callable) -> Callable:
        @wraps(run)
        def audited(spark: SparkSession, root: str, days, *args, **options):
            with _audited(spark, root, stage, _days(days)):
                return run(spark, root, days, *args, **options)

        return audited

    return wrap


# ---- T1 ---------------------------------------------------------------------------------------
def to_bronze(spark: SparkSession, raw_root: str, root: str, days) -> dict[str, int]:
    """Raw CSV → bronze. Master snapshots are overwritten and count for each day; daily files replace their days."""
    days = _days(days)
    written: dict[str, int] = {}
    for entity in MASTER_ENTITIES:
        with _audited(spark, root, f"bronze_{entity}", days):
            df, malformed = _count_malformed(X.read_master(spark, raw_root, entity), None)
            written[entity] = P.write_snapshot(X.with_ingest_time(df), table_path(root, "bronze", entity))
            _audit_days(spark, root, f"bronze_{entity}", dict.fromkeys(days, written[entity]), message=_malformed_note(malformed.get["malformed"]))
    for entity in BATCH_ENTITIES:
        with _audited(spark, root, f"bronze_{entity}", days):
            df, malformed = _count_malformed(X.read_batches(spark, raw_root, entity, days), days)
            written[entity] = P.write_batches(X.with_ingest_time(df), table_path(root, "bronze", entity), days)
            found = malformed.get
            notes = {d: _malformed_note(found.get(d.isoformat())) for d in days}
            _audit_days(spark, root, f"bronze_{entity}", _day_counts(spark, root, "bronze", entity, days), message=notes)
    return written


def _count_malformed(df: DataFrame, days: list[dt.date] | None) -> tuple[DataFrame, Observation]:
    """Count rows whose field count didn't fit the header while they are written (no extra pass), each day's if there are days."""
    obs = Observation("malformed")
    bad = F.col(X.CORRUPT).isNotNull()
    of = {"malformed": bad} if days is None else {d.isoformat(): bad & (F.col("batch_date") == F.lit(d)) for d in days}
    counts = [F.sum(F.when(which, 1).otherwise(0)).alias(name) for name, which in of.items()]
    return df.observe(obs, *counts).drop(X.CORRUPT), obs


def _malformed_note(n: int | None) -> str | None:
    return f"malformed_rows={n}" if n else None


# ---- T2 ---------------------------------------------------------------------------------------
@_audits("silver_transform")
def to_silver(
    spark: SparkSession,
    root: str,
    days,
    pairs: Sequence[tuple[str, str]] = Q.VALID_CITY_REGION_PAIRS,
    tolerance: float = 1.0,
    include_orders_without_items: bool = False,
) -> list:
    """Bronze → staged silver → 13 checks on the staged copy → publish (or audit FAILED + raise)."""
    days = _days(days)
    bronze = {e: scan(spark, root, "bronze", e) for e in MASTER_ENTITIES}
    bronze.update({e: _read_days(spark, root, "bronze", e, days) for e in BATCH_ENTITIES})

    # Orders keep their bronze copy count from the dedupe (staging only), so the duplicate
    # check is one more sum over the staged copy, not a second pass over bronze.
    run = table_path(root, "_staging", uuid.uuid4().hex)
    staged: dict[str, DataFrame] = {}
    try:
        for entity, df in bronze.items():
            copies = COPIES if entity == "orders" else None
            clean = clean_entity(df, entity, copies=copies)
            if entity == "payments":
                clean = with_accepted(spark, root, clean, days)  # late ones that the stream brought stay
            P.write_snapshot(clean, f"{run}/{entity}")
            schema = SILVER[entity] if copies is None else T.StructType([*SILVER[entity].fields, T.StructField(COPIES, T.LongType())])
            staged[entity] = spark.read.schema(schema).parquet(f"{run}/{entity}")

        results = Q.silver_suite(
            None, staged["orders"], staged["order_items"], staged["payments"], staged["deliveries"],
            staged["customers"], staged["products"], pairs=pairs, tolerance=tolerance,
            include_orders_without_items=include_orders_without_items, copies=COPIES,
        ).collect()
        staged["orders"] = staged["orders"].drop(COPIES)
        results = Q.in_suite_order(results)
        blocking = [r for r in results if r["check_name"] not in NON_BLOCKING]
        try:
            Q.raise_for_failed(blocking)
        except Q.QualityCheckError as exc:
            _audit_days(spark, root, "silver_transform", dict.fromkeys(days), A.FAILED, str(exc))
            raise

        for entity in MASTER_ENTITIES:
            P.write_snapshot(staged[entity], table_path(root, "silver", entity))
        for entity in BATCH_ENTITIES:
            P.write_batches(staged[entity], table_path(root, "silver", entity), days)
    finally:
        files.delete(spark, run)
    _audit_days(spark, root, "silver_transform", _day_counts(spark, root, "silver", "orders", days))
    return results


# ---- keys of several days (Q2, D1) --------------------------------------------------------------
@_audits("key_days")
def to_key_days(spark: SparkSession, root: str, days) -> dict[str, int]:
    """Look for keys of the days' silver rows on other days (``key_days``); keys found per entity, an audit row per day. Nothing is blocked.

    Run it over the stored days once, so that later days find them; again for days that late payments were merged into.
    """
    days = _days(days)
    found = {}
    for entity in BATCH_ENTITIES:
        counts = K.check_days(spark, root, entity, key_of(entity), days)
        found[entity] = sum(counts.values())
        _audit_days(spark, root, f"key_days_{entity}", counts, message="keys that other days hold too")
    return found


def key_of(entity: str) -> list[str]:
    return [k for k in SPECS[entity].row_keys if k != "batch_date"]


def repeated_keys(spark: SparkSession, root: str, entity: str) -> DataFrame:
    """(key, days, batch_date): keys that several days hold, by the day that was checked."""
    return K.read_repeats(spark, root, entity, [SILVER[entity][k] for k in key_of(entity)])


# ---- history of the masters (2.16) --------------------------------------------------------------
# keys and tracked attributes of the masters with a history
HISTORY = {
    "sellers": (("seller_id",), ("seller_name", "city", "region", "seller_type", "rating")),
    "products": (("product_id",), ("seller_id", "product_name", "category", "brand", "unit_price_mmk", "is_active")),
}


@_audits("history")
def to_history(spark: SparkSession, root: str, days) -> dict[str, int]:
    """Silver masters as the snapshot of the run's last day → their versions; keys changed per entity. Days may come in any order."""
    day = _days(days)[-1]
    changed = {}
    for entity, (keys, attrs) in HISTORY.items():
        rows = scan(spark, root, "silver", entity)
        known = rows.where(F.col(keys[0]).isNotNull()).select(*keys, *attrs)  # silver has a row per key
        changed[entity] = H.apply_day(known, root, entity, day, keys, attrs)
        _audit_days(spark, root, f"history_{entity}", {day: changed[entity]}, message="keys changed")
    return changed


def history(spark: SparkSession, root: str, entity: str) -> DataFrame:
    """The versions of an entity of ``HISTORY``."""
    keys, attrs = HISTORY[entity]
    return H.read_versions(spark, root, entity, SILVER[entity], keys, attrs).drop("bucket")


# ---- T3 ---------------------------------------------------------------------------------------
@_audits("gold_transform")
def to_gold(spark: SparkSession, root: str, days) -> dict[str, int]:
    """Silver → five dimensions and five facts; ``dim_date`` gains the run's days by key."""
    days = _days(days)
    silver = {e: scan(spark, root, "silver", e) for e in MASTER_ENTITIES}
    silver.update({e: _read_days(spark, root, "silver", e, days) for e in BATCH_ENTITIES})
    dates = G.dim_date_between(spark, days[0], days[-1]).where(F.col("calendar_date").isin(*[F.lit(d) for d in days]))
    star = G.build_star(silver, dim_date=dates)

    written: dict[str, int] = {}
    for name in ("dim_customer", "dim_seller", "dim_product", "dim_region"):
        written[name] = P.write_snapshot(star[name], table_path(root, "gold", name))
    # Facts join the dimensions as stored: their Parquet size is exact, so the planner
    # broadcasts a small dimension up front (and shuffles when it is not) instead of
    # shuffling the fact on an estimate and switching strategy afterwards.
    stored = {n: scan(spark, root, "gold", n) for n in ("dim_region", "dim_product")}
    star["fact_orders"] = G.fact_orders(silver["orders"], stored["dim_region"])
    star["fact_order_items"] = G.fact_order_items(silver["order_items"], stored["dim_product"])

    date_path = table_path(root, "gold", "dim_date")
    current = P.read_snapshot(spark, date_path)
    dates = star["dim_date"] if current is None else P.replace_by_key(current, star["dim_date"], ["date_key"])
    written["dim_date"] = P.write_snapshot(dates, date_path)

    for name in FACTS:
        written[name] = P.write_batches(star[name], table_path(root, "gold", name), days)
    counts = _day_counts(spark, root, "gold", "fact_orders", days)
    empty = [d for d, n in sorted(counts.items()) if not n]
    if empty:
        message = f"Data quality checks failed: gold_fact_orders_non_empty(0) on {', '.join(d.isoformat() for d in empty)}"
        _audit_days(spark, root, "gold_transform", {d: 0 for d in empty}, A.FAILED, message)
        if len(empty) < len(days):
            _audit_days(spark, root, "gold_transform", {d: n for d, n in counts.items() if n})
        raise Q.QualityCheckError(message)
    _audit_days(spark, root, "gold_transform", counts)
    return written


# ---- per-day partials of distinct counts (A5) ---------------------------------------------------
@_audits("partials")
def to_partials(spark: SparkSession, root: str, days) -> int:
    """Gold orders → the days' bitmaps of order codes and sums, from which ``report_from_partials`` reads; rows written."""
    days = _days(days)
    n = B.store_days(_read_days(spark, root, "gold", "fact_orders", days), root, days)
    counts = dict.fromkeys(days, 0)
    counts |= {r.batch_date: r["count"] for r in B.read_partials(spark, root, days).groupBy("batch_date").count().collect()}
    _audit_days(spark, root, "partials_orders", counts)
    return n


def report_from_partials(spark: SparkSession, root: str, name: str, days=None) -> DataFrame:
    """``report`` of one of ``FROM_PARTIALS`` over days that went through ``to_partials``, without a scan of the fact."""
    parts = B.read_partials(spark, root, None if days is None else _days(days))
    return FROM_PARTIALS[name](parts, scan(spark, root, "gold", R.REPORTS[name][1][1]))


FROM_PARTIALS = {
    "report_gmv_by_city": lambda parts, dim: R.gmv_of_keys(B.merged(parts, ["region_key"], "orders", "gmv"), dim),
    "report_order_trends": lambda parts, dim: R.trends_of_days(B.merged(parts, ["order_date"], "total_orders", "gmv_mmk"), dim),
}


# ---- T4 ---------------------------------------------------------------------------------------
def publish(spark: SparkSession, root: str, target_root: str, days, jdbc: W.Target | dict | None = None) -> dict[str, int]:
    """Gold → serving copy with replace semantics per table kind (K4/K6), all ten tables at once (``serving``).

    Dimensions are replaced whole, ``dim_date`` by key, facts by batch day. With ``jdbc``
    (a ``warehouse.Target``, or its fields: ``url``, ``schema``, ``properties``, …) the same rows and the run's audit rows also go to a
    database, all tables in one transaction. Read the copy with ``published``.
    """
    days = _days(days)
    with _audited(spark, root, "warehouse_load", days):
        run = V.Publish(spark, target_root)
        written: dict[str, int] = {}
        keys = [int(d.strftime("%Y%m%d")) for d in days]
        loads: list[W.Load] = []
        for name in DIMENSIONS:
            df = scan(spark, root, "gold", name)
            if name == "dim_date":
                df = df.where(F.col("date_key").isin(keys))
                loads.append(W.Load(name, df, W.Replace("date_key", keys)))
                written[name] = run.keyed(name, df, ["date_key"])
            else:
                loads.append(W.Load(name, df, W.Replace(all=True)))
                written[name] = run.dimension(name, df)
        for name in FACTS:
            df = _read_days(spark, root, "gold", name, days)
            loads.append(W.Load(name, df, W.Replace("batch_date", days)))
            written[name] = run.fact(name, df, days)
        pointer = run.commit()
        found = V.read(spark, target_root, "fact_orders", days, pointer).groupBy("batch_date").agg(F.count(F.lit(1)).alias("n")).collect()
        counts = {d: 0 for d in days} | {r.batch_date: r.n for r in found}
        done = _audit_rows(spark, "warehouse_load", counts, message="Gold datasets published").collect()  # a row a day
        audit = spark.createDataFrame(done, A.AUDIT)
        if jdbc:
            W.load(spark, W.target_of(jdbc), [*loads, W.Load("pipeline_run_audit", audit, W.Replace())])
        _append_audit(root, audit)
    return written


def published(spark: SparkSession, target_root: str, table: str, days=None) -> DataFrame:
    """A table of the serving copy as of its last publish; of a fact the ``days``, all if None."""
    return V.read(spark, target_root, table, None if days is None else _days(days))


# ---- reports over the stored star schema -------------------------------------------------------
def report(spark: SparkSession, root: str, name: str, days=None) -> DataFrame:
    """One of the eight business reports over the stored gold tables (facts limited to
    ``days`` when given; the batch filter prunes partitions)."""
    _, inputs = R.REPORTS[name]
    gold = {}
    for table in inputs:
        if table in FACTS and days is not None:
            gold[table] = _read_days(spark, root, "gold", table, _days(days))
        else:
            gold[table] = scan(spark, root, "gold", table)
    return R.run_report(name, gold)


def compact(spark: SparkSession, root: str, target_bytes: int = C.TARGET_BYTES, spare: int = C.SPARE) -> dict[str, int]:
    """Rewrite what has too many small files: days of the tables that late payments are appended to, and the audit; days (tables) rewritten."""
    done = {}
    for layer, table, contract in (("silver", "payments", SILVER["payments"]), ("gold", "fact_payments", GOLD["fact_payments"])):
        done[table] = len(C.compact_days(spark, table_path(root, layer, table), contract, target_bytes, spare))
    done["audit"] = int(C.compact_table(spark, A.audit_path(root), A.AUDIT, target_bytes, spare))
    return done


# ---- T5 / T6 ----------------------------------------------------------------------------------
def run_batch(spark: SparkSession, raw_root: str, root: str, days, target_root: str | None = None, jdbc: W.Target | dict | None = None, with_history: bool = False,
              with_key_days: bool = False, with_partials: bool = False, **silver_options) -> None:
    """All stages in order for one day or a list of days, on one session; the last with ``target_root``, into a database too with ``jdbc``.
    ``with_history``: the masters' versions too; ``with_key_days``: keys that other days hold; ``with_partials``: partials of distinct counts."""
    days = _days(days)
    if jdbc and not target_root:
        raise ValueError("jdbc loads the rows published to target_root")
    to_bronze(spark, raw_root, root, days)
    to_silver(spark, root, days, **silver_options)
    if with_history:
        to_history(spark, root, days)
    if with_key_days:
        to_key_days(spark, root, days)
    to_gold(spark, root, days)
    if with_partials:
        to_partials(spark, root, days)
    if target_root:
        publish(spark, root, target_root, days, jdbc)


def run_range(spark: SparkSession, raw_root: str, root: str, start, end, target_root: str | None = None, jdbc: W.Target | dict | None = None, **silver_options) -> None:
    """Backfill: every day in [start, end] as one job per stage."""
    run_batch(spark, raw_root, root, day_range(start, end), target_root, jdbc, **silver_options)
