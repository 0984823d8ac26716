"""Landed text tables to typed staging tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import (
    composite_key,
    decode,
    full_name,
    leading_timestamp,
    mask_tail,
    presence_label,
)
from ..operators.incremental import incremental_slice, merge_upsert
from ..operators.latest import dedupe_latest
from ..operators.shape import conform
from ..sources.registry import SOURCES, TYPES, SourceTable, StagedColumn

MODIFIED = "ModifiedDate"

# --- fixed values ----------------------------------------------------------------

ORDER_STATUS = {
    1: "In process",
    2: "Approved",
    3: "Backordered",
    4: "Rejected",
    5: "Shipped",
    6: "Cancelled",
}

# (has person, has store) -> customer type
CUSTOMER_TYPE = {
    (True, False): "Individual",
    (False, True): "Store",
    (True, True): "StoreContact",
    (False, False): "Unknown",
}

# Merge key of the two staging tables that are loaded incrementally.
MERGE_KEYS = {
    "stg_sales_order_header": "sales_order_bk",
    "stg_sales_order_detail": "sales_order_line_bk",
}
LOOKBACK_DAYS = 1

# --- end of fixed values -----------------------------------------------------------

DERIVED: dict[tuple[str, str], Callable[[], Column]] = {
    ("Customer", "customer_type"): lambda: presence_label("PersonID", "StoreID", CUSTOMER_TYPE),
    ("SalesOrderHeader", "order_status"): lambda: decode(F.col("Status").cast("int"), ORDER_STATUS),
    ("SalesOrderDetail", "sales_order_line_bk"): lambda: composite_key("SalesOrderID", "SalesOrderDetailID"),
    ("Person", "full_name"): lambda: full_name("FirstName", "MiddleName", "LastName", "Suffix"),
}


def staged_expression(table: SourceTable, column: StagedColumn) -> Column:
    if column.kind == "derived":
        return DERIVED[table.name, column.name]()
    raw = F.col(f"`{column.source}`")
    if column.kind == "text":
        return raw
    if column.kind == "leading_timestamp":
        return leading_timestamp(raw)
    if column.kind == "trimmed":
        return F.trim(raw)
    if column.kind == "masked":
        return mask_tail(raw)
    return raw.cast(TYPES[column.kind])


def stage(table: str | SourceTable, landed: DataFrame) -> DataFrame:
    """Latest row per source key, renamed and cast."""
    spec = SOURCES[table] if isinstance(table, str) else table
    latest = dedupe_latest(landed, spec.dedupe_keys, MODIFIED)
    return conform(latest, {c.name: staged_expression(spec, c) for c in spec.staged})


def staged_batch(
    table: str | SourceTable, landed: DataFrame, target: DataFrame | None, marks: DataFrame | None = None
) -> DataFrame:
    """Staged rows modified since the target's newest (or that of its ``marks``) less the lookback; all on a first run.

    The lookback compares the typed modification time. The batch is unique by
    construction: it was deduplicated on the columns of its key.
    """
    spec = SOURCES[table] if isinstance(table, str) else table
    timed = landed.withColumn("_modified", leading_timestamp(MODIFIED))
    fresh = incremental_slice(timed, target, "_modified", "modified_at", LOOKBACK_DAYS, marks).drop("_modified")
    return stage(spec, fresh)


def stage_incremental(table: str | SourceTable, landed: DataFrame, target: DataFrame | None) -> DataFrame:
    """The stored staging table with the new batch merged by key."""
    spec = SOURCES[table] if isinstance(table, str) else table
    batch = staged_batch(spec, landed, target)
    return merge_upsert(target, batch, [MERGE_KEYS[spec.staged_as]], check_unique=False)


def stage_views(landed: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The 20 staging tables that are recomputed by their readers."""
    return {
        spec.staged_as: stage(spec, landed[name])
        for name, spec in SOURCES.items()
        if spec.staged_as not in MERGE_KEYS
    }
