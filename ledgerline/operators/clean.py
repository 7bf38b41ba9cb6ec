"""Silver cleaners (L1–L8) as declarative specs run by one ``clean`` function.

A spec names the key to deduplicate on (daily entities: within each batch day, so several days
cleaned at once equal the days cleaned one by one), the text columns to title-case, the derived columns
and the per-column defaults. Types come from the silver contract through ``conform``
(``try_cast``), so a spec never lists casts. Geography is title-cased in every entity that
carries it, so ``Yangon`` and ``YANGON`` are one place in ``dim_region`` and in the joins.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import types as T

from ledgerline.contracts import BATCH_ENTITIES, SILVER, conform, require_columns
from ledgerline.functions import scalars as S
from ledgerline.operators.dedupe import keep_latest


@dataclass(frozen=True)
class CleanSpec:
    entity: str
    keys: tuple[str, ...]
    title_case: tuple[str, ...] = ()
    derived: Mapping[str, Callable[[], Column]] = field(default_factory=dict)
    defaults: Mapping[str, object] = field(default_factory=dict)

    @property
    def contract(self):
        return SILVER[self.entity]

    @property
    def row_keys(self) -> tuple[str, ...]:
        """The key that identifies a row: a daily entity's id is unique within its batch day."""
        return (*self.keys, "batch_date") if self.entity in BATCH_ENTITIES else self.keys


SPECS: dict[str, CleanSpec] = {
    "customers": CleanSpec("customers", ("customer_id",), ("customer_name", "city", "region")),
    "sellers": CleanSpec("sellers", ("seller_id",), ("seller_name", "city", "region")),
    "products": CleanSpec("products", ("product_id",)),
    "orders": CleanSpec(
        "orders",
        ("order_id",),
        ("city", "region"),
        derived={"order_date": lambda: S.date_of("order_timestamp")},
        # fixed values: the reference's defaults for a missing status and payment method
        defaults={"order_status": "placed", "payment_method": "cash_on_delivery"},
    ),
    "order_items": CleanSpec("order_items", ("order_item_id",)),
    "payments": CleanSpec("payments", ("payment_id",)),
    "deliveries": CleanSpec(
        "deliveries",
        ("delivery_id",),
        ("region", "city"),
        derived={"delivery_delay_days": lambda: S.day_difference("actual_delivery_date", "promised_delivery_date")},
    ),
    "inventory_snapshots": CleanSpec("inventory_snapshots", ("inventory_snapshot_id",)),
}


def fill_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Per-column default for NULLs."""
    return df.fillna(dict(defaults)) if defaults else df


def clean(df: DataFrame, spec: CleanSpec, dedupe: bool = True, copies: str | None = None, columns: Sequence[str] | None = None) -> DataFrame:
    """Bronze rows of one entity → typed, deduplicated silver rows.

    With ``copies`` (and ``dedupe``), a column of that name follows the contract's columns,
    holding how many bronze rows each key had (see ``keep_latest``). With ``columns``, the rows are the same and only
    these of the contract's columns are made, so the dedupe carries no more text than their values need.
    """
    require_columns(df, [f.name for f in spec.contract.fields if f.name not in spec.derived], f"bronze {spec.entity}")
    keep = (copies,) if copies and dedupe else ()
    if columns is not None and not set(columns) & set(spec.derived):  # a derived column may need any other
        made = T.StructType([f for f in spec.contract.fields if f.name in columns])
        derived = {}
    else:
        made, derived = spec.contract, spec.derived
    if dedupe:
        df = keep_latest(df, spec.row_keys, copies=copies, columns=None if made is spec.contract else made.fieldNames())
    if spec.title_case:
        df = df.withColumns({c: S.title_case(c) for c in spec.title_case if c in df.columns})
    typed = conform(df, made, keep=keep)
    if derived:
        typed = typed.withColumns({name: make() for name, make in derived.items()})
    filled = fill_defaults(typed, {c: v for c, v in spec.defaults.items() if c in typed.columns})
    return filled if columns is None else filled.select(*[c for c in spec.contract.fieldNames() if c in columns], *keep)


def clean_entity(df: DataFrame, entity: str, dedupe: bool = True, copies: str | None = None, columns: Sequence[str] | None = None) -> DataFrame:
    return clean(df, SPECS[entity], dedupe=dedupe, copies=copies, columns=columns)
